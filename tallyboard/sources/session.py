"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .files import write_dealt, write_table

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
"""Adaptive execution sizes the shuffles and splits skewed join partitions."""


def settle(df: DataFrame, dealt_by: Sequence[str] = (), tasks: int = 0) -> DataFrame:
    """Write a result that several branches read to the shared checkpoint folder, and read it back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. A local
    session without one gets a temporary folder; a cluster must name a shared one.
    Parquet keeps later reads to the columns they use. :func:`release_settled` deletes it.
    Rows are counted while they are written, see :func:`rows_at_most`. A frame dealt over
    ``tasks`` by the columns ``dealt_by`` is written as it lies, a file per task, so that
    joins and groups by these columns read it back without another shuffle.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="settle-")
        context.setCheckpointDir(named)
    path = f"{context.getCheckpointDir()}/{uuid.uuid4().hex}"
    _settled.append(path)
    seen = Observation()
    with dropping_shuffles(df.sparkSession):
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        out = write_dealt(counted, path, dealt_by, tasks) if dealt_by else write_table(counted, path)
    out._settled_at, out._settled_rows = path, seen.get["rows"]
    return out


def rows_at_most(df: DataFrame) -> int | None:
    """How many rows a frame has at most, where writing it or :func:`bounded` has told; else None."""
    return vars(df).get("_settled_rows")


def bounded(df: DataFrame, *sources: DataFrame) -> DataFrame:
    """``df`` itself, marked as having no more rows than ``sources`` together, if these are known.

    For projections, filters, distinct rows and unions of settled frames.
    """
    known = [rows_at_most(s) for s in sources]
    if None not in known:
        df._settled_rows = sum(known)
    return df


def release(df: DataFrame) -> None:
    """Delete what one frame that ``settle`` returned has written, once nothing reads it any more."""
    _settled.remove(df._settled_at)
    _delete(df.sparkSession, df._settled_at)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Results of frames made inside leave no shuffle files on the executors once they are complete.

    Without it the files stay until the driver's garbage collector meets them, which may be
    long after many rounds have filled the disks. A frame that is computed twice writes them
    again. What counts is where a frame is made, not where it is computed; see :func:`last_read`.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def last_read(df: DataFrame) -> pa.Table:
    """A small result on the driver, for a frame that is not computed again: its shuffle files are gone."""
    with dropping_shuffles(df.sparkSession):
        return df.select("*").toArrow()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _delete(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_settled: list[str] = []


def settled_so_far() -> int:
    """How many frames this session has settled and not released: a mark for :func:`release_settled`."""
    return len(_settled)


def release_settled(spark: SparkSession, since: int = 0) -> int:
    """Delete what ``settle`` has written, from the mark ``since`` on; returns how many frames.

    Call it once the results that read them are written.
    """
    gone = 0
    while len(_settled) > since:
        gone += bool(_delete(spark, _settled.pop()))
    return gone


def build_session(app: str, master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above and any others given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
