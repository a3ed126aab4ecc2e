"""Registering inputs by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.ordered import first_per_key, last_per_key, ranked_rows
from gradeloom.operators import policies as P


def reject_reason(content: Column, listing: Column) -> Column:
    """Why bytes are not a deck, or null when they are.  ``listing`` is the archive's part names."""
    head = F.hex(F.substring(content, 1, 8))
    return (F.when(content.isNull(), "missing")
            .when(F.length(content) == 0, "empty")
            .when(head.startswith(P.MAGIC_OLE2),
                  F.when(F.contains(content.cast("string"), F.lit("EncryptedPackage")), "encrypted")
                  .otherwise("legacy_ppt"))
            .when(~head.startswith(P.MAGIC_ZIP), "not_a_zip")
            .when(listing.isNull(), "corrupt_zip")
            .when(~F.array_contains(listing, "ppt/presentation.xml"),
                  F.when(F.exists(listing, lambda p: p.startswith("word/")), "not_a_deck: word")
                  .when(F.exists(listing, lambda p: p.startswith("xl/")), "not_a_deck: xl")
                  .when(F.exists(listing, lambda p: p.startswith("visio/")), "not_a_deck: visio")
                  .otherwise("not_a_deck")))


def register(files: DataFrame, claims: DataFrame) -> DataFrame:
    """Add ``holder`` and ``disposition``: a digest already claimed, or seen earlier, is a duplicate."""
    firsts = first_per_key(files, ["digest"], ["ord"], ["ord", "path"]).select(
        "digest", F.col("ord").alias("first_ord"), F.col("path").alias("first_path"))
    held = firsts.join(claims.select("digest", F.col("deck").alias("claimed_by")), "digest", "left")
    rows = files.join(held, "digest")
    new = F.col("claimed_by").isNull() & (F.col("ord") == F.col("first_ord"))
    return (rows.withColumn("disposition", F.when(new, "registered").otherwise("duplicate"))
            .withColumn("holder", F.when(~new, F.coalesce("claimed_by", "first_path")))
            .drop("first_ord", "first_path", "claimed_by"))


def alloc_ids(new: DataFrame, existing: DataFrame, order: str = "ord") -> DataFrame:
    """Dense ids after the current maximum, in order; one allocator per batch."""
    top = existing.agg(F.coalesce(F.max("number"), F.lit(0)).alias("top"))   # one row
    placed = ranked_rows(new, [F.col(order)], "place")
    number = F.col("top") + F.col("place") + 1
    return (placed.join(F.broadcast(top), how="cross").withColumn("number", number)
            .withColumn("deck", F.concat(F.lit("deck"), F.expr(
                "lpad(cast(number as string), greatest(4, length(cast(number as string))), '0')")))
            .drop("top", "place"))


def latest_rejects(log: DataFrame) -> DataFrame:
    """Last rejection of each path (name where the path is unknown)."""
    key = F.coalesce(F.nullif("path", F.lit("")), F.col("name"))
    return last_per_key(log.withColumn("key", key), ["key"], ["ord"],
                        ["ord", "path", "name", "reason"])


def ingest_summary(dispositions: DataFrame) -> DataFrame:
    """(disposition, n) with the scanned total, and whether the parts add up to it."""
    parts = dispositions.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("disposition").isin("registered", "duplicate", "rejected")
    total = dispositions.agg(F.count(F.lit(1)).alias("n"), F.count_if(~known).alias("__odd"))
    return (parts.withColumn("balanced", F.lit(None).cast("boolean"))
            .unionByName(total.select(F.lit("scanned").alias("disposition"), "n",
                                      (F.col("__odd") == 0).alias("balanced"))))
