"""Session settings and the size checks that guard every broadcast."""

from __future__ import annotations

import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

# A table joined by broadcast has at most this many rows; beyond it the same
# operator runs as a shuffled equi-join.
BROADCAST_ROWS = 20_000


def build_session(app: str = "screenline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job of this package assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Where the session names none and runs in local mode (tests), a new folder
    on this machine is made; on a cluster that would not be shared, so it is
    refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="screenline-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the plan restarts from files in the shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when the table has at most ``rows`` rows (reads no more than that)."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table for broadcast when the row check passes, else leave the
    choice of join to the optimizer."""
    return F.broadcast(df) if fits(df, rows) else df


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over all cores where the input has fewer splits than there
    are cores (one small file); with enough splits nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def local_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table of given rows, held in the plan itself (no Python task)."""
    fields = spark.createDataFrame([], schema).schema
    if not rows:
        return spark.createDataFrame([], fields)
    cols = {f.name: [r[i] for r in rows] for i, f in enumerate(fields)}
    return spark.createDataFrame(pa.table(cols, schema=to_arrow_schema(fields)), fields)
