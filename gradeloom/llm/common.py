"""Shared helpers: the folder all machines see, written intermediate tables, components, batching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a session without one (tests) gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and outlives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def boxed(df: DataFrame, *leave: str):
    """The row's columns but ``leave`` as one struct, so that no column's name meets an operator's own."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in leave))


def text_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most_bytes`` of text, or of one longer row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)`` as (node, component): every linked node, its smallest reachable node.

    Alternating stars: every node hands its larger neighbours to its smallest one, then its smaller
    neighbours too.  Chains shrink geometrically.  Each round is written to the shared folder, and
    the joins on a hub are equi-joins that adaptive execution splits.  Null ends are ignored.
    """
    edges = (links.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = written(edges, "edges")
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == mark or now["n"] == 0:
            return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                    .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
        mark = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(small, "a")
        edges = written(star.select("a", F.col("m").alias("b")).unionByName(
            star.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
