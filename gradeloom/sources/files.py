"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions.ordered import last_per_key
from gradeloom.operators.corpus import INDEX_COLUMNS

INDEX_SCHEMA = ("filename string, size long, url string, license string, title string, "
                "created string, updated string, doi string, checksum string")

POOL_SCHEMA = ("filename string, checksum string, license string, size long, status string, "
               "name string, sha256 string, score double, used_in string, "
               "fonts_missing string, triage_version int, pool_key string, version long")

EVENT_SCHEMA = ("t string, ts double, run string, event string, deck string, stage string, "
                "status string, ms long, why string, kind string, backoff_s int, "
                "_corrupt_record string")

TIMELINE_SCHEMA = ("kind string, seq long, t double, iso string, interval_s double, work string, "
                   "running long, queued long, _corrupt_record string")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Corpus index, read with only the nine known columns."""
    return spark.read.parquet(path).select(*INDEX_COLUMNS)


def read_pool(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POOL_SCHEMA).json(path)


def upsert_pool(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Newest row per pool key; ``version`` says which is newer."""
    both = current.unionByName(fresh, allowMissingColumns=True)
    cols = [c for c in both.columns if c != "pool_key"]
    return last_per_key(both, ["pool_key"], ["version"], cols)


def write_pool(pool: DataFrame, path: str) -> None:
    pool.write.mode("overwrite").json(path)


def parse_events(lines: DataFrame, schema: str = EVENT_SCHEMA) -> DataFrame:
    """Parse JSON lines; a half-written line or a non-object keeps ``ok = false`` for the audit."""
    parsed = F.from_json("line", schema, {"mode": "PERMISSIVE"})
    is_object = F.trim(F.col("line")).startswith("{") & F.trim(F.col("line")).endswith("}")
    return (lines.withColumn("rec", parsed)
            .withColumn("ok", is_object & F.col("rec").isNotNull()
                        & F.col("rec._corrupt_record").isNull()))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event log without the lines nobody can parse."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return parse_events(lines).where("ok").select("rec.*").drop("_corrupt_record")


def split_timeline(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(header, samples) of a timeline, by record kind."""
    return (records.where(F.col("kind") == "header"), records.where(F.col("kind") == "sample"))


def read_timeline(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    records = parse_events(lines, TIMELINE_SCHEMA).where("ok").select("rec.*")
    return split_timeline(records)


def last_result(lines: DataFrame) -> DataFrame:
    """Last ``result`` record of every log file, as (path, line_no, line)."""
    kind = F.get_json_object("line", "$.type")
    return last_per_key(lines.where(kind == "result"), ["path"], ["line_no"], ["line_no", "line"])


def list_sources(files: DataFrame) -> DataFrame:
    """Deck files worth reading: suffix, no temporary or hidden names, one row per real path."""
    base = F.element_at(F.split("path", "/"), -1)
    wanted = (F.lower(base).endswith(".pptx") & ~base.startswith("~$") & ~base.startswith("."))
    return files.where(wanted).groupBy("resolved").agg(F.min("path").alias("path"),
                                                       F.max("length").alias("length"))


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """List deck files under a folder without reading their bytes."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(folder).select("path", "length"))
    return list_sources(found.withColumn("resolved", F.col("path")))


def take_sorted(files: DataFrame, n: int) -> DataFrame:
    """First ``n`` files by path; ``short`` says that fewer exist."""
    first = files.orderBy("path").limit(n)
    have = first.agg((F.count(F.lit(1)) < n).alias("short"))      # one row
    return first.join(F.broadcast(have), how="cross")


def attribution_text() -> Column:
    def known(col: str, fallback: str) -> Column:
        return F.coalesce(F.nullif(F.trim(F.coalesce(col, F.lit(""))), F.lit("")), F.lit(fallback))

    bare = F.regexp_replace(F.coalesce("doi", F.lit("")), "^https://doi.org/", "")
    return F.concat_ws("\n", F.concat(F.lit("# "), known("title", "(untitled)")),
                       F.concat(F.lit("licence: "), known("license", "(unstated)")),
                       F.concat(F.lit("doi: "), known("doi", "(none)")),
                       F.concat(F.lit("creators: "), known("creators", "(not recorded)")),
                       F.concat(F.lit("link: https://doi.org/"), bare))


def render_attribution(rows: DataFrame) -> DataFrame:
    return rows.withColumn("attribution", attribution_text())


def disk_usage(files: DataFrame) -> DataFrame:
    return files.groupBy("deck").agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
