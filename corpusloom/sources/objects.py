"""Reading, writing and probing objects whose addresses stand in a column.

The calls are made inside the tasks that hold the rows and only the addresses (and contents)
pass to Python, so no content is ever shuffled. A bounded store in each task keeps small objects
that recur; what a task reads ahead is bounded by number and by bytes.
"""

from __future__ import annotations

import sys
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import chain, groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StringType

from corpusloom.functions.retry import DEFAULT_IN_FLIGHT, InFlight
from corpusloom.functions.text import as_column, fill_nulls, strip_newlines, text_mode
from corpusloom.operators.scripts import transform_text, transform_text_per_row
from corpusloom.session import pinned

SCHEMES = ("s3", "s3a", "file", "hdfs", "gs")
_PATH = r"^([a-z0-9]+)://([^/]*)/(.*)$"
# Messages.
WRONG_SCHEME = "S3 path must start with s3://"
WRONG_FORMAT = "Invalid S3 path format. Expected s3://bucket/key"
FETCH_FAILED = "Failed to fetch S3 object"
PUT_FAILED = "Failed to put S3 object"
# contents held by a task: read ahead, and before they go on as one array
AHEAD_BYTES = 64 << 20
HELD_BYTES = 16 << 20
# objects up to this size may be kept for rows that name them again, this much in all per task
KEEP_OBJECT_BYTES = 1 << 20
KEEP_TOTAL_BYTES = 64 << 20
# objects asked for by one thread in one call
PROBED_AT_ONCE = 64
# what one task of a scan reads at most, and the tasks for each core below which none are joined
SCANNED_OBJECTS = 1 << 13
SCANNED_BYTES = 128 << 20
SCAN_TASKS = 32
# where Spark makes the parts of a scan, those that one task reads
SCANNED_PARTS = 8
# rows of a listing that go on as one batch
LISTED_ROWS = 1 << 16


class ObjectError(ValueError):
    """An address is malformed or an object cannot be read or written."""


def parse_path(path: Column | str, strict: bool = False) -> Column:
    """struct(scheme, bucket, key) of an address, split at the first ``/`` after the bucket.

    What is no address gives empty texts, or with ``strict`` the error that a fetch would give.
    """
    column = as_column(path)
    parts = F.struct(
        *[
            F.regexp_extract(column, _PATH, i).alias(name)
            for i, name in enumerate(("scheme", "bucket", "key"), 1)
        ]
    )
    if not strict:
        return parts
    known = parts.scheme.isin(*SCHEMES)
    named = column.rlike("^(" + "|".join(SCHEMES) + ")://")
    message = F.when(named, F.lit(f"{WRONG_FORMAT}: ")).otherwise(F.lit(f"{WRONG_SCHEME}: "))
    wrong = F.raise_error(F.concat(message, column)).cast("struct<scheme:string,bucket:string,key:string>")
    return F.when(known | column.isNull(), parts).otherwise(wrong)


def split_path(path: str) -> tuple[str, str, str]:
    scheme, found, rest = path.partition("://")
    if not found or scheme not in SCHEMES:
        raise ObjectError(f"{WRONG_SCHEME} (or another of {', '.join(SCHEMES[1:])}): {path}")
    bucket, slash, key = rest.partition("/")
    if not slash:
        raise ObjectError(f"{WRONG_FORMAT}: {path}")
    return scheme, bucket, key


# A resolver turns an address into a file system and the path in it.
Resolver = Callable[[str], tuple[fs.FileSystem, str]]


class DefaultResolver:
    """File systems from addresses, one per scheme and bucket in each task.

    Credentials come from where the storage client looks for them by itself.
    """

    def __init__(self) -> None:
        self._known: dict[tuple[str, str], fs.FileSystem] = {}

    def __call__(self, path: str) -> tuple[fs.FileSystem, str]:
        scheme, bucket, key = split_path(path)
        if scheme == "s3a":
            scheme = "s3"
        system = self._known.get((scheme, bucket))
        if system is None:
            system, _ = fs.FileSystem.from_uri(f"{scheme}://{bucket}/")
            self._known[(scheme, bucket)] = system
        inner = f"/{key}" if scheme in ("file", "hdfs") else f"{bucket}/{key}"
        return system, inner

    def __getstate__(self) -> dict:
        return {"_known": {}}


class _Recent:
    """Contents seen lately, up to a number of bytes."""

    def __init__(self) -> None:
        self._texts: OrderedDict[str, tuple[str, int]] = OrderedDict()
        self._bytes = 0

    def get(self, path: str) -> str | None:
        if path not in self._texts:
            return None
        self._texts.move_to_end(path)
        return self._texts[path][0]

    def put(self, path: str, text: str) -> None:
        size = sys.getsizeof(text)
        if size > KEEP_OBJECT_BYTES or path in self._texts:
            return
        self._texts[path] = text, size
        self._bytes += size
        while self._bytes > KEEP_TOTAL_BYTES:
            self._bytes -= self._texts.popitem(last=False)[1][1]


def _read(resolve: Resolver, path: str, claim: Callable[[int], None] = lambda size: None) -> str:
    """The object as text; ``claim`` is told its size before it is read."""
    system, inner = resolve(path)
    try:
        with system.open_input_file(inner) as stream:
            claim(stream.size())
            data = stream.read()
    except (OSError, pa.ArrowException) as error:
        raise ObjectError(f"{FETCH_FAILED}: {path}: {error}") from error
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError as error:
        raise ObjectError(f"object is not valid UTF-8: {path}") from error


def _write(resolve: Resolver, path: str, content: str) -> str:
    system, inner = resolve(path)
    data = content.encode("utf-8")
    try:
        if isinstance(system, (fs.LocalFileSystem, fs.HadoopFileSystem)):
            # readers see the old or the new object, also when a task runs twice at once
            parent = inner.rsplit("/", 1)[0]
            part = f"{parent}/.{uuid.uuid4().hex}.part"
            try:
                opened = system.open_output_stream(part)
            except FileNotFoundError:
                system.create_dir(parent, recursive=True)
                opened = system.open_output_stream(part)
            with opened as stream:
                stream.write(data)
            system.move(part, inner)
        else:
            with system.open_output_stream(inner) as stream:
                stream.write(data)
    except (OSError, pa.ArrowException) as error:
        raise ObjectError(f"{PUT_FAILED} '{path}': {error}") from error
    return path


def _exists(resolve: Resolver, path: str) -> bool:
    system, inner = resolve(path)
    try:
        return system.get_file_info(inner).type == fs.FileType.File
    except (OSError, pa.ArrowException) as error:
        raise ObjectError(f"{FETCH_FAILED}: {path}: {error}") from error


def _exist(resolve: Resolver, paths: list[str]) -> list[bool]:
    """:func:`_exists` of several objects, one call for each file system."""
    by_system: dict[int, tuple[fs.FileSystem, list[int], list[str]]] = {}
    for k, path in enumerate(paths):
        system, inner = resolve(path)
        _, rows, inners = by_system.setdefault(id(system), (system, [], []))
        rows.append(k)
        inners.append(inner)
    found = [False] * len(paths)
    for system, rows, inners in by_system.values():
        for k, info in zip(rows, system.get_file_info(inners), strict=True):
            found[k] = info.type == fs.FileType.File
    return found


def _settle(call: Callable, on_error: str) -> Callable:
    """``call`` as it is, or with NULL in place of an error."""
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error is fail or null, not {on_error!r}")
    if on_error == "fail":
        return call

    def lenient(*args):
        try:
            return call(*args)
        except ObjectError:
            return None

    return lenient


def fetch_udf(resolver: Resolver, max_in_flight: int, on_error: str, max_bytes: int = AHEAD_BYTES):
    read = _settle(_read, on_error)

    @F.arrow_udf(StringType())
    def fetch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        recent = _Recent()

        def one(path: str | None, claim: Callable[[int], None]) -> str | None:
            known = None if path is None else recent.get(path)
            return known if path is None or known is not None else read(resolver, path, claim)

        with InFlight(max_in_flight, max_bytes) as flight:
            for batch in batches:
                paths, texts, held = batch.to_pylist(), [], 0
                # rows side by side that share an address are one call
                runs = [(path, len(list(rows))) for path, rows in groupby(paths)]
                found = flight.map(one, [path for path, _ in runs], claims=True)
                for (path, rows), text in zip(runs, found, strict=True):
                    if text is not None:
                        recent.put(path, text)
                    for _ in range(rows):
                        texts.append(text)
                        held += len((text or "").encode())
                        if held > HELD_BYTES:
                            yield pa.array(texts, pa.string())
                            texts, held = [], 0
                if texts or not paths:
                    yield pa.array(texts, pa.string())

    return fetch.asNondeterministic()


def fetch_text(
    path: Column | str,
    resolver: Resolver | None = None,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    null_compat: bool = False,
    max_bytes: int = AHEAD_BYTES,
) -> Column:
    """The whole object as UTF-8 text.

    A task reads ahead up to ``max_in_flight`` objects that have ``max_bytes`` together; one
    larger object is read alone.
    """
    fetch = fetch_udf(resolver or DefaultResolver(), max_in_flight, on_error, max_bytes)
    return fill_nulls(fetch(as_column(path)), "", null_compat)


def put_udf(resolver: Resolver, max_in_flight: int, on_error: str):
    write = _settle(_write, on_error)

    @F.arrow_udf(StringType())
    def put(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def one(path, text):
            return None if path is None or text is None else write(resolver, path, text)

        with ThreadPoolExecutor(max_in_flight) as pool:
            for paths, texts in batches:
                written = pool.map(one, paths.to_pylist(), texts.to_pylist())
                yield pa.array(list(written), pa.string())

    return put.asNondeterministic()


def put_text(
    path: Column | str,
    content: Column | str,
    resolver: Resolver | None = None,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    null_compat: bool = False,
) -> Column:
    """Write one object per row and give its address; NULL path or content writes nothing.

    An object that exists is replaced, so running a task again does no harm. Rows that share
    an address overwrite each other in no given order.
    """
    put = put_udf(resolver or DefaultResolver(), max_in_flight, on_error)
    return fill_nulls(put(as_column(path), as_column(content)), "", null_compat)


def exists_udf(resolver: Resolver, max_in_flight: int, on_error: str):
    probe = _settle(_exists, on_error)

    @F.arrow_udf(BooleanType())
    def exists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def some(paths: list[str]) -> list[bool | None]:
            try:
                return _exist(resolver, paths)
            except (ObjectError, OSError, pa.ArrowException):
                # one by one, so that the error is that of its object
                return [probe(resolver, p) for p in paths]

        with ThreadPoolExecutor(max_in_flight) as pool:
            for batch in batches:
                paths = batch.to_pylist()
                wanted = list({p for p in paths if p is not None})
                size = max(1, min(PROBED_AT_ONCE, len(wanted) // max_in_flight))
                parts = [wanted[at : at + size] for at in range(0, len(wanted), size)]
                found = dict(zip(wanted, chain.from_iterable(pool.map(some, parts))))
                yield pa.array([found.get(p) for p in paths], pa.bool_())

    return exists.asNondeterministic()


def object_exists(
    path: Column | str,
    resolver: Resolver | None = None,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    null_compat: bool = False,
) -> Column:
    """Whether an object is there; asks for its entry, not its content."""
    exists = exists_udf(resolver or DefaultResolver(), max_in_flight, on_error)
    return fill_nulls(exists(as_column(path)), False, null_compat)


# --- operators over tables -------------------------------------------------------------------


def _left_out(name: str, folder: bool) -> bool:
    """Whether Spark's scans of files leave out a name below the folder that they are given."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


# address, bytes, whether it is a folder
_ENTRY = "path string, size long, folder boolean"


def _entry(path: str, info: fs.FileInfo) -> tuple[str, int, bool] | None:
    """The row of a folder or an object; none where an object is empty, as Spark's scans leave that out."""
    if info.type == fs.FileType.Directory:
        return path, 0, True
    return (path, info.size, False) if info.type == fs.FileType.File and info.size else None


def _below(folders: DataFrame, resolver: Resolver) -> DataFrame:
    """What lies right in the folders, each listed by one call of a task."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                system, inner = resolver(folder)
                try:
                    infos = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
                except (OSError, pa.ArrowException) as error:
                    raise ObjectError(f"{FETCH_FAILED}: {folder}: {error}") from error
                for at in range(0, len(infos), LISTED_ROWS):
                    some = [i for i in infos[at : at + LISTED_ROWS] if not _left_out(i.base_name, i.type == fs.FileType.Directory)]
                    entries = [_entry(f"{folder.rstrip('/')}/{i.base_name}", i) for i in some]
                    if rows := [entry for entry in entries if entry]:
                        columns = map(pa.array, zip(*rows), (pa.string(), pa.int64(), pa.bool_()))
                        yield pa.record_batch(list(columns), names=["path", "size", "folder"])

    return folders.select("path").mapInArrow(listed, _ENTRY)


def _roots(spark: SparkSession, folder: str, resolver: Resolver) -> tuple[str, list[tuple[str, int, bool]]]:
    """The start of all addresses below ``folder`` and the entries it names; none if a task cannot list them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    several = set("{}[]*?\\").intersection(path.toString())
    paths = [status.getPath() for status in system.globStatus(path) or ()] if several else [path]
    uris = [p.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri() for p in paths]
    if not uris or uris[0].getScheme() not in SCHEMES:
        return "", []
    start = f"{uris[0].getScheme()}://{uris[0].getAuthority() or ''}"
    addresses = [f"{start}{uri.getPath()}" for uri in uris]
    try:
        infos = resolver(addresses[0])[0].get_file_info([resolver(address)[1] for address in addresses])
    except (ObjectError, OSError, pa.ArrowException):
        return "", []
    if any(info.type == fs.FileType.NotFound for info in infos):
        return "", []
    # a folder that is named is read whatever its name
    named = [(a, i) for a, i in zip(addresses, infos, strict=True) if i.type == fs.FileType.Directory or not _left_out(i.base_name, False)]
    return start, [entry for entry in (_entry(*pair) for pair in named) if entry]


def _scanned_by_spark(spark: SparkSession, folder: str, pattern: str | None) -> DataFrame:
    """The rows of :func:`read_objects` where the driver lists all objects.

    Spark counts each object as 4 MB at least, so of many small ones a part has only 32: where there
    are many parts, a task reads up to ``SCANNED_PARTS`` of them.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(folder).select("path", F.decode("content", "UTF-8").alias("content"))
    parts = found.rdd.getNumPartitions()
    tasks = max(SCAN_TASKS * spark.sparkContext.defaultParallelism, -(-parts // SCANNED_PARTS))
    return found.coalesce(tasks) if tasks < parts else found


def read_objects(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(path, content) of all objects below a folder, by name pattern if given.

    The scan form: the tasks list the folders once, now, a level of folders at a time, and the listing
    is in the shared folder; the driver holds none of it, and a task that of one folder (some 260
    bytes for each object). The objects are split over the tasks. Names, patterns and paths are those
    of Spark's binaryFile, which also leaves out objects without content and names that begin with
    ``.`` or ``_``. A folder that the storage client of the tasks does not reach is listed by Spark on
    the driver. Content that is not UTF-8 fails the query.
    """
    resolver = DefaultResolver()
    start, roots = _roots(spark, folder, resolver)
    if not roots:
        return _scanned_by_spark(spark, folder, pattern)
    wanted = F.lit(True)
    if pattern:
        name = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
        wanted = F.col("folder") | F.substring_index("path", "/", -1).rlike(f"(?s)\\A(?:{name})\\z")
    lists = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level, found, objects, size = spark.createDataFrame(roots, _ENTRY).where(wanted), [], 0, 0
    while True:
        counts = level.groupBy("folder").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
        folders = sum(row.n for row in counts if row.folder)
        if here := sum(row.n for row in counts if not row.folder):
            found.append(level.where(~F.col("folder")).select("path"))
            objects, size = objects + here, size + sum(row.size for row in counts)
        if not folders:
            break
        # only the numbers come to the driver
        below = _below(level.where("folder").repartition(min(lists, folders), "path"), resolver)
        level = pinned(below.where(wanted), "listed")
    if not found:
        return spark.createDataFrame([], "path string, content string")
    listed = reduce(DataFrame.unionByName, found)
    if len(roots) > 1:
        listed = listed.distinct()  # one may lie in another
    tasks = max(SCAN_TASKS * spark.sparkContext.defaultParallelism, -(-objects // SCANNED_OBJECTS), -(-size // SCANNED_BYTES))
    listed = listed.repartition(min(tasks, objects), "path")
    # Hadoop spells an address that has no bucket without the slashes before it
    spelled = F.regexp_replace("path", "^([a-z0-9]+:)//", "$1") if start.endswith("://") else F.col("path")
    return listed.select(spelled.alias("path"), fetch_text("path", resolver).alias("content"))


def fetch_objects(df: DataFrame, path_col: str, out: str = "content", **options) -> DataFrame:
    """Add ``out`` = the text of the object that ``path_col`` names."""
    return df.withColumn(out, fetch_text(F.col(f"`{path_col}`"), **options))


def write_objects(
    df: DataFrame, path_col: str, content_col: str, out: str = "written", **options
) -> DataFrame:
    """Add ``out`` = the address written, one object per row; writes when the rows are computed."""
    column = put_text(F.col(f"`{path_col}`"), F.col(f"`{content_col}`"), **options)
    return df.withColumn(out, column)


def objects_exist(df: DataFrame, path_col: str, out: str = "found", **options) -> DataFrame:
    """Add ``out`` = whether the object that ``path_col`` names is there."""
    return df.withColumn(out, object_exists(F.col(f"`{path_col}`"), **options))


def fetch_stripped(df: DataFrame, path_col: str, out: str = "content", **options) -> DataFrame:
    """Fetch, then put the text on one line."""
    return fetch_objects(df, path_col, out, **options).withColumn(out, strip_newlines(out))


def fetch_with_mode(
    df: DataFrame, path_col: str, mode: Column | str | None, out: str = "content", **options
) -> DataFrame:
    """Fetch, then apply a named mode (a name for all rows or a column of names)."""
    return fetch_objects(df, path_col, out, **options).withColumn(out, text_mode(out, mode))


def fetch_with_script(
    df: DataFrame,
    path_col: str,
    script: str | list[str] | None = None,
    script_col: str | None = None,
    out: str = "content",
    scripts: list[str] | DataFrame = (),
    **options,
) -> DataFrame:
    """Fetch, then apply a script given for all rows, or the one of ``scripts`` that ``script_col`` holds."""
    fetched = fetch_objects(df, path_col, out, **options)
    if script_col:
        return transform_text_per_row(fetched, out, script_col, scripts)
    return transform_text(fetched, out, script)
