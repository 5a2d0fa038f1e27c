"""The same screening on arriving rows, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenline.operators.collect import block_venues, drop_rejected, kept
from screenline.session import shared_dir
from screenline.sources.stage import finish_replacement, path_exists, pdf_files, replace_partitions

BINARY = "path string, modificationTime timestamp, length long, content binary"


def stream_intake(papers: DataFrame, rules: DataFrame, state: DataFrame) -> DataFrame:
    """Arriving papers without blocked venues and earlier rejections; stateless."""
    return drop_rejected(kept(block_venues(papers, rules)), state)


def stream_dedupe(rows: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """One row per key while its repeats come within the delay; state older
    than the watermark is let go."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def progress_counts(events: DataFrame, ts: str, status: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Counts per window and status: with ``run_available`` each is given once,
    when the watermark has passed its window, with ``run_counts`` as it stands
    after each batch. When the watermark has passed, what was counted is let go;
    rows that come later still are left out (``run_available`` tells how many)."""
    d = events.withWatermark(ts, delay).groupBy(F.window(ts, width), status).agg(F.count("*").alias("n"))
    return d.select(F.col("window.start").alias("window_start"), status, "n")


def stream_files(spark: SparkSession, folder: str) -> DataFrame:
    """PDF files dropped into a folder."""
    d = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return pdf_files(d)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> dict[str, int]:
    """Take in everything there is, to a parquet table. Gives what the run's
    progress reports say (they reach back as many batches as the session keeps
    reports of): rows that came after their window was given, and the most rows
    of state held after a batch."""
    q = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    q.awaitTermination()
    held = [o for p in q.recentProgress for o in p["stateOperators"]]
    late = sum(o["numRowsDroppedByWatermark"] for o in held)
    return {"late_rows": late, "state_rows": max((o["numRowsTotal"] for o in held), default=0)}


class PartitionedState:
    """A state table in the shared folder, cut in ``parts`` by a hash of its key.

    A batch folds into the partitions of its own keys and writes only those,
    first beside the table, then over it; a replacement that a failure cut short
    is completed before the next one. The folds are idempotent, so a batch that
    is run again, or a query that starts anew with a fresh checkpoint folder,
    gives the same state."""

    def __init__(self, spark: SparkSession, folder: str | None, schema: str, keys: Sequence[str], parts: int = 64):
        self.spark = spark
        self.folder = folder or f"{shared_dir(spark)}/state"
        self.schema = schema
        self.keys, self.parts = list(keys), parts

    def _marked(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_part", F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def _stored(self) -> DataFrame:
        finish_replacement(self.spark, self.folder)
        if not path_exists(self.spark, self.folder):
            return self._marked(self.spark.createDataFrame([], self.schema))
        return self.spark.read.schema(f"{self.schema}, _part int").parquet(self.folder)

    def read(self) -> DataFrame:
        return self._stored().drop("_part")

    def update(self, rows: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """``fold(old, rows)`` into the state; gives the partitions written."""
        touched = sorted(r[0] for r in self._marked(rows).select("_part").distinct().collect())
        if touched:
            old = self._stored().where(F.col("_part").isin(touched)).drop("_part")
            replace_partitions(self._marked(fold(old, rows)).repartition("_part"), self.folder, ["_part"])
        return touched


def stream_fold(
    stream: DataFrame,
    state: PartitionedState,
    fold: Callable[[DataFrame, DataFrame], DataFrame],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Fold each batch of rows (with the state's key columns) into the state
    until the input is used up."""

    def step(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        state.update(kept, fold)
        kept.unpersist()

    q = stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def run_counts(counts: DataFrame, state: PartitionedState, checkpoint: str) -> None:
    """Take in everything there is and keep every count as it stands, windows
    that are still open included; a batch's counts replace earlier ones."""

    def newest(old: DataFrame, rows: DataFrame) -> DataFrame:
        return old.join(rows, state.keys, "left_anti").unionByName(rows)

    stream_fold(counts, state, newest, checkpoint, "update")
