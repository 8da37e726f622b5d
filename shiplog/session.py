"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# AQE picks the join side, splits skewed partitions and sizes the output files from
# measured shuffle sizes. The zone is part of the data model: days are UTC days.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# Folders of local applications for which the cluster names none.
_own_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in REQUIRED_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by all executors")
    # The setting cannot be changed once the session runs.
    application = spark.sparkContext.applicationId
    if application not in _own_roots:
        _own_roots[application] = tempfile.mkdtemp(prefix="shiplog-")
    return _own_roots[application]


# (path, whether the job's result is read from it) of what the running job has written.
_written: ContextVar[list[tuple[str, bool]] | None] = ContextVar("written", default=None)


def staged(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage so a lost executor re-reads files instead of recomputing, and lets later
    readers of the same data prune columns. Within a job (see `scratch`) the files go when it
    ends, unless its result is read from them (`keep`).
    """
    path = _written_out(df, scratch_root(df.sparkSession), label, keep)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_under(
    settings: dict[str, str], df: DataFrame, change: Callable[[DataFrame], DataFrame], label: str
) -> DataFrame:
    """`change` of `df`, written to the shared folder by a session with `settings` of its own.

    For settings that hold for whole plans: queries of the caller's session are not touched.
    """
    spark = df.sparkSession
    root = scratch_root(spark)
    source = _written_out(df, root, label, False)
    other = configure(spark.newSession())
    for name, value in settings.items():
        other.conf.set(name, value)
    changed = change(other.read.schema(df.schema).parquet(source))
    path = _written_out(changed, root, label, False)
    return spark.read.schema(changed.schema).parquet(path)


def scratch_folder(root: str, label: str, keep: bool = False) -> str:
    """A new path in the shared folder, deleted when the running job ends unless it is kept."""
    path = f"{root}/staged/{label}-{uuid.uuid4().hex}"
    written = _written.get()
    if written is not None:
        written.append((path, keep))
    return path


def _written_out(df: DataFrame, root: str, label: str, keep: bool) -> str:
    path = scratch_folder(root, label, keep)
    df.write.parquet(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside, also if the job fails.

    What a job keeps goes with the job around it, if there is one; else it is left to the caller,
    who reads the result.
    """
    outer, written = _written.get(), []
    token = _written.set(written)
    try:
        yield
    finally:
        _written.reset(token)
        for path, keep in written:
            if keep and outer is not None:
                outer.append((path, False))
            elif not keep:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def job(function: Callable) -> Callable:
    """A job on a store, whose staged tables go when it ends."""

    @wraps(function)
    def run(store, *args, **options):
        with scratch(store.spark):
            return function(store, *args, **options)

    return run
