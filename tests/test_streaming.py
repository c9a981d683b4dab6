from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.html import extract_html
from corpusloom.session import shared_dir
from corpusloom.sources.http import Response
from corpusloom.streaming.sinks import post_batches_stream, post_stream, write_objects_stream

URL = "http://service.example/post"


def stream_of(spark, sf_dir, name):
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def answer(request):
    return Response(200, request.body.upper())


def test_text_and_html_run_on_streams(spark, sf_dir):
    docs = stream_of(spark, sf_dir, "documents").select("doc_id", T.word_count("text").alias("words"))
    pages = extract_html(stream_of(spark, sf_dir, "pages"), "html", ["page_id"])
    for frame, name in ((docs, "words_out"), (pages, "chunks_out")):
        run(frame.writeStream.format("memory").queryName(name))
    stored = spark.read.parquet(f"{sf_dir}/pages.parquet")
    wanted = extract_html(stored, "html", ["page_id"])
    assert spark.table("chunks_out").exceptAll(wanted).count() == 0
    assert spark.table("chunks_out").count() == wanted.count()
    assert spark.table("words_out").count() == 200


def test_posting_a_stream(spark, sf_dir, tmp_path):
    events = stream_of(spark, sf_dir, "events").select("event_id", "event_type")
    run(post_stream(events, URL, "event_type", f"{tmp_path}/out", f"{tmp_path}/cp", transport=answer))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 1000
    assert out.where("response.body = upper(event_type)").count() == 1000
    # a second run finds nothing new to send
    run(post_stream(events, URL, "event_type", f"{tmp_path}/out", f"{tmp_path}/cp", transport=answer))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000


def folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {str(entry.getPath()) for entry in system.listStatus(path)}


def test_posting_batches_of_a_stream(spark, sf_dir, tmp_path):
    before = folders(spark)
    events = stream_of(spark, sf_dir, "events").select("event_id", "props")
    run(
        post_batches_stream(
            events, "props", ["event_id"], URL, 300, f"{tmp_path}/out", f"{tmp_path}/cp",
            transport=answer,
        )
    )
    out = spark.read.parquet(f"{tmp_path}/out").orderBy("batch_id")
    assert [r.row_count for r in out.collect()] == [300, 300, 300, 100]
    # nothing is left of the micro-batches in the shared folder
    assert folders(spark) <= before


def test_writing_objects_of_a_stream(spark, sf_dir, tmp_path):
    path = F.concat(F.lit(f"file://{tmp_path}/objects/"), "doc_id", F.lit(".txt"))
    docs = stream_of(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    run(write_objects_stream(docs, "path", "text", f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert len(list((tmp_path / "objects").glob("*.txt"))) == 200
    assert "text" not in spark.read.parquet(f"{tmp_path}/out").columns
