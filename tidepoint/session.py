"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Points carry UTC nanoseconds, so naive timestamps must be read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tidepoint-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tidepoint-{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Fix the rows of ``df`` in reliable storage.

    Used where two branches of a plan must see the very same row placement, also after an
    executor is lost.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


LOCAL_ROWS = 10_000


def small_or_pinned(df: DataFrame, most: int = LOCAL_ROWS) -> DataFrame:
    """Fix the rows of ``df``; a table of at most ``most`` rows becomes a local relation.

    The planner then knows how small it is. A computed table keeps the size estimate of the
    plan it came from, by which Spark would shuffle the other side of a join with it.
    """
    fixed = pin(df)
    rows = fixed.limit(most + 1).toArrow()
    return df.sparkSession.createDataFrame(rows, df.schema) if rows.num_rows <= most else fixed
