"""Line dedup by site-relative frequency.

A line's ratio is the pages of a host that contain it over the pages of that host.  Pages that are exact
copies of one another count once, since they are for near-dedup and not boilerplate.  Lines above
``ratio`` on at least ``least_pages`` pages are dropped from every page of that host; blank lines are
neither counted nor dropped.  Lines are compared without blanks at their ends, kept lines stay as they
are, and all rows stay, with an empty text if every line went.

Shares of a host's lines add up to its lines per page, so at most (lines per page / ratio) lines of a
host can be dropped: that list is one short row per host, joined by host.  It is written and counted
first; up to ``BROADCAST_LINES`` lines in all it is broadcast and the texts are not shuffled, beyond that
the texts are joined by host and adaptive execution splits hot hosts.

Null texts stay null and are no pages; a null host is a host of its own; repeated rows are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import boxed, written

BLANKS = " \t\r"
#: Line hashes (8 bytes each) and hosts that may be sent to every executor.
BROADCAST_LINES, BROADCAST_HOSTS = 1_000_000, 100_000


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def boilerplate(pages: DataFrame, host: str = "source", *, ratio: float = 0.05, least_pages: int = 3) -> DataFrame:
    """Per host: ``_lines``, the hashes of its boilerplate lines.  Hosts without any are absent."""
    content = (pages.where("text is not null")
               .select(F.col(host).alias("_host"), F.sha2("text", 256).alias("_page"),
                       F.array_distinct(F.filter(F.transform(F.split("text", "\n"), bare), lambda x: x != "")).alias("_l"))
               .select("_host", "_page", F.transform("_l", lambda x: F.xxhash64(x)).alias("_l"))
               .groupBy("_host", "_page").agg(F.any_value("_l").alias("_l")))
    # one pass: the line hash null stands for the host's pages
    counted = (content.select("_host", F.explode(F.concat("_l", F.array(F.lit(None).cast("long")))).alias("_line"))
               .groupBy("_host", "_line").agg(F.count("*").alias("_n")))
    totals = counted.where("_line is null").select(F.col("_host").alias("_site"), F.col("_n").alias("_total"))
    return (counted.where(F.col("_line").isNotNull() & (F.col("_n") >= least_pages))
            .join(totals, F.col("_host").eqNullSafe(F.col("_site")))
            .where(F.col("_n") > ratio * F.col("_total"))
            .groupBy("_host").agg(F.collect_set("_line").alias("_lines")))


def clean(pages: DataFrame, host: str = "source", *, ratio: float = 0.05, least_pages: int = 3) -> DataFrame:
    """``pages`` with boilerplate lines out of ``text``, and ``lines_before``, ``lines_dropped``."""
    added = ("lines_before", "lines_dropped")
    drop = written(boilerplate(pages, host, ratio=ratio, least_pages=least_pages), "boilerplate")
    size = drop.agg(F.count("*").alias("hosts"), F.coalesce(F.sum(F.size("_lines")), F.lit(0)).alias("lines")).first()
    if size["hosts"] <= BROADCAST_HOSTS and size["lines"] <= BROADCAST_LINES:
        drop = F.broadcast(drop)
    split = F.split("_text", "\n")
    keep = F.filter(split, lambda x: ~F.array_contains("_lines", F.xxhash64(bare(x))) | (bare(x) == ""))
    work = pages.select(boxed(pages, "text", *added).alias("_row"), F.col("text").alias("_text"), F.col(host).alias("_site"))
    joined = work.join(drop, F.col("_site").eqNullSafe(F.col("_host")), "left").withColumn(
        "_kept", F.when(F.col("_lines").isNotNull() & F.col("_text").isNotNull(), keep))
    return joined.select(
        *(F.coalesce(F.array_join("_kept", "\n"), "_text").alias("text") if c == "text" else F.col("_row").getField(c).alias(c)
          for c in pages.columns if c not in added),
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(split)).alias("lines_before"),
        F.when(F.col("_kept").isNull(), 0).otherwise(F.size(split) - F.size("_kept")).alias("lines_dropped"))


def clean_documents(documents: DataFrame, **how) -> DataFrame:
    """``documents`` in their own columns; ``n_chars`` follows the text where lines were dropped."""
    cleaned = clean(documents, **how)
    if "n_chars" in documents.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(*(f"`{c}`" for c in documents.columns))
