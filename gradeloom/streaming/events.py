"""Structured Streaming over growing logs.

The batch operators and these streams give the same rows on the same input.  There is no event-time
rule in the data, so no watermark is claimed; state is keyed by entity and bounded by their number.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom.functions.ordered import last_per_key
from gradeloom.operators.runlog import line_kind
from gradeloom.session import ensure_checkpoint_dir

#: Sample numbers that one state of a condition covers.
ALERT_BLOCK = 1024


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoints, shared by all executors."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stream_events(spark: SparkSession, folder: str, schema, files: str = "*", file_format: str = "parquet",
                  per_trigger: int = 64) -> DataFrame:
    """Tail a folder of log files; a bounded number of new files per micro-batch."""
    return (spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", files)
            .option("maxFilesPerTrigger", per_trigger).load(folder))


def drain_to_table(stream: DataFrame, path: str, mode: str = "append") -> None:
    """Write what is available now, restartable from the stream's own checkpoint."""
    query = (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
             .option("checkpointLocation", path + ".progress").trigger(availableNow=True).start())
    query.awaitTermination()


def drain_updates(stream: DataFrame, path: str) -> None:
    """Append every micro-batch's changed rows with its number; a replayed batch overwrites itself."""
    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch_no", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (stream.writeStream.outputMode("update").option("checkpointLocation", path + ".progress")
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()


def fold_deck_state(lines: DataFrame) -> DataFrame:
    """Per deck: last kind and message, lines seen and complaints; resumes from state."""
    kind = line_kind(F.col("message"))
    return lines.groupBy("deck").agg(
        F.max_by(F.struct(kind.alias("kind"), F.col("message").alias("last")), "line_no").alias("s"),
        F.max("us").alias("last_us"), F.count(F.lit(1)).alias("lines"),
        F.count_if(kind.isin("rejected", "no_op_repair")).alias("complaints")).select("deck", "s.*", "last_us", "lines", "complaints")


def newest_state(spark: SparkSession, path: str, keys: Sequence[str] = ("deck",)) -> DataFrame:
    """The latest row per key over all written updates."""
    rows = spark.read.parquet(path)
    cols = [c for c in rows.columns if c not in (*keys, "batch", "batch_no")]
    return last_per_key(rows, list(keys), ["batch_no"], cols)


def condition_blocks(conditions: DataFrame, block: int = ALERT_BLOCK) -> DataFrame:
    """The samples of each condition ``(seq, nth, kind, id, confirm)``, gathered in blocks of ``block`` sample numbers.

    The state is one row per condition and block, of at most ``block`` samples, so a condition that holds a third
    of the log is many small states.  Samples may come in any order, chunking and micro-batch; repeated ones count once.
    """
    sample = F.struct("nth", "seq", "confirm")
    return (conditions.withColumn("block", F.floor(F.col("nth") / block))
            .groupBy("kind", "id", "block").agg(F.array_sort(F.collect_set(sample)).alias("held")))


def alerts_of_blocks(blocks: DataFrame, block: int = ALERT_BLOCK) -> DataFrame:
    """Alerts ``(seq, kind, id)`` of the newest ``condition_blocks``: where a condition has held ``confirm`` samples in a row.

    The length of a run is the distance to the last number without a sample.  Within a block that number is read off
    the block; a run that touches the block's start takes it from the blocks before, of which only one number each is windowed.
    """
    first, last = F.col("block") * block, (F.col("block") + 1) * block - 1
    n, nths = F.size("held"), F.col("held.nth")
    # the places in a block whose sample does not follow the one before; the last of them begins the block's last run
    gaps = F.filter(F.sequence(F.lit(0), n - 1), lambda k: F.when(k == 0, F.get(nths, k) != first)
                    .otherwise(F.get(nths, k) != F.get(nths, k - 1) + 1))
    inner = F.when(F.element_at(nths, -1) != last, last).when(F.size(gaps) > 0, F.get(nths, F.element_at(gaps, -1)) - 1)
    own = Window.partitionBy("kind", "id").orderBy("block")
    told = blocks.select("kind", "id", "block", inner.alias("gap"))
    # a block that is not there is all gap: its last number counts for the next one that is
    absent = F.when(F.coalesce(F.lag("block").over(own), F.lit(-2)) != F.col("block") - 1, first - 1)
    told = told.withColumn("absent", absent).withColumn("low", F.greatest("absent", "gap"))
    before = told.withColumn("carried", F.greatest("absent", F.max("low").over(own.rowsBetween(Window.unboundedPreceding, -1))))
    rows = (blocks.join(before.select("kind", "id", "block", "carried"), ["kind", "id", "block"])
            .select("kind", "id", "block", "carried", F.explode("held").alias("s")).select("kind", "id", "block", "carried", "s.*"))
    inside = Window.partitionBy("kind", "id", "block").orderBy("nth")
    step = F.col("nth") - 1
    hole = F.when(F.lag("nth").over(inside).isNull(), F.when(F.col("nth") == first, F.col("carried")).otherwise(step)).when(
        F.lag("nth").over(inside) != step, step)
    runs = rows.withColumn("hole", hole).withColumn("since", F.last("hole", ignorenulls=True).over(inside))
    return runs.where(F.col("nth") - F.col("since") == F.col("confirm")).select("seq", "kind", "id")
