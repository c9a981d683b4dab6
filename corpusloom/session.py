"""Session helpers: a tuned local session and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "corpusloom", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only where the session names none (tests, a single machine) is a fresh folder made.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_folders: weakref.WeakKeyDictionary[SparkSession, set[str]] = weakref.WeakKeyDictionary()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    folder = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _folders.setdefault(spark, set()).add(folder)
    if (made := _made.get()) is not None:
        made.append(folder)
    return folder


def drop_folders(spark: SparkSession, *folders: str) -> None:
    """Delete folders that :func:`new_folder` named for this session."""
    known = _folders.get(spark, set())
    for folder in folders:
        if folder not in known:
            raise ValueError(f"not a folder of this session: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        known.discard(folder)


def drop_all_folders(spark: SparkSession) -> None:
    """Delete all of them; call it when what reads from them is written elsewhere."""
    drop_folders(spark, *_folders.get(spark, ()))


# the folders made inside the innermost open scratch block of this thread
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], None]]:
    """Drop the folders made inside the block when it ends, but those of kept tables."""
    made: list[str] = []
    kept: set[str] = set()
    token = _made.set(made)
    try:
        yield lambda frame: kept.add(_pinned_at[frame])
    finally:
        _made.reset(token)
        drop_folders(spark, *[f for f in made if f not in kept and f in _folders.get(spark, ())])
        if (outer := _made.get()) is not None:
            outer.extend(kept)


def pinned(df: DataFrame, label: str, source: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` written to the shared folder and read back.

    Cuts the lineage: what was computed once stays as it is when executors are lost, and later
    steps read only the columns they need. ``source`` is a pinned table that only ``df`` reads;
    its folder is dropped.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    frame = spark.read.schema(df.schema).parquet(folder)
    _pinned_at[frame] = folder
    if source is not None:
        drop_folders(spark, _pinned_at.pop(source))
    return frame


_pinned_at: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


SPREAD_KEY = "corpusloom.spread"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt anew to as many parts as the session's ``corpusloom.spread`` says, else as it is.

    For costly row functions over a file with fewer row groups than there are cores. Nothing is
    decided by size: a large table is read in enough parts, and the setting is left out.
    """
    parts = df.sparkSession.conf.get(SPREAD_KEY, None)
    return df.repartition(int(parts)) if parts else df
