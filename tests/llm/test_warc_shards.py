"""Shard bounds follow the rows: missing ids, far outliers and sparse ids leave no shard with most of the pages."""

import json
import os

import pytest
from pyspark.sql import functions as F

from gradeloom.llm import warc
from gradeloom.llm.common import fresh_path


def skewed(spark):
    """A third of the ids missing, most others close together, two at the ends of the range."""
    own = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") == 1, F.lit(-9_000_000_000_000_000_000)).when(F.col("id") == 2, F.lit(9_000_000_000_000_000_000))
        .otherwise(F.col("id") * F.when(F.col("id") % 2 == 0, 1).otherwise(1000)).cast("long").alias("page_id"),
        F.concat(F.lit("http://h/"), "id").alias("url"), F.concat(F.repeat(F.lit("x"), 120), F.col("id").cast("string")).alias("html"))
    return own


def test_no_shard_holds_most_of_the_pages(spark):
    pages = skewed(spark)
    narrow = pages.select("page_id", F.sha2("html", 256).alias("digest"), F.octet_length("html").alias("size")).cache()
    shard, shards = warc.shard_of(narrow, 10_000)
    again, _ = warc.shard_of(narrow.repartition(7), 10_000)
    sizes = narrow.groupBy(shard.alias("s")).agg(F.sum("size").alias("n"), F.min("page_id").alias("lo"), F.max("page_id").alias("hi")).collect()
    assert max(r["n"] for r in sizes) < 45_000 and {r["s"] for r in sizes} <= set(range(shards)) and len(sizes) > 25
    ordered = sorted((r["s"], r["lo"], r["hi"]) for r in sizes if r["lo"] is not None)
    assert all(a[2] < b[1] for a, b in zip(ordered, ordered[1:]))
    assert narrow.where(shard != again).count() == 0


def test_bounds_of_odd_tables(spark):
    kinds = "page_id long, digest string, size int"
    for rows in ([], [(None, "a", 0)], [(5, "a", 10)], [(5, "a", 10)] * 50, [(None, "a", 10), (7, "b", None)]):
        narrow = spark.createDataFrame(rows, kinds)
        shard, shards = warc.shard_of(narrow, 20)
        assert all(0 <= r[0] < max(1, shards) for r in narrow.select(shard).collect())


def test_round_trip_of_skewed_pages(spark):
    pages = skewed(spark).unionByName(skewed(spark).where("page_id % 50 = 0"))
    files = warc.write(pages, fresh_path(spark, "warc-test"), shard_bytes=10_000, roll_bytes=2_000)
    out = warc.read(spark, files)
    assert out.count() == pages.count() and out.where("record_type = 'response'").select("payload").distinct().count() == 3000


REPORT = "shard int, roll int, temp string, records long, bytes long, sha256 string, name string"


def reported(spark, folder, there, named=()):
    """A folder as the writing tasks leave it: ``there`` under temporary names, ``named`` renamed by an earlier try."""
    os.makedirs(f"{folder}/_temporary")
    for k in range(40):
        at = f"{folder}/part-{k:05d}" if k in named else f"{folder}/_temporary/t{k}" if k in there else None
        if at:
            with open(at, "w") as out:
                out.write(str(k))
    return spark.createDataFrame([(k, 0, f"t{k}", 1, 2, "s", f"part-{k:05d}") for k in range(40)], REPORT)


def test_a_broken_commit_is_taken_up_again(spark, tmp_path):
    folder = str(tmp_path / "a")
    warc._commit(reported(spark, folder, range(40), named=range(0, 40, 3)), folder)
    rows = [json.loads(line) for line in open(f"{folder}/_MANIFEST.json")]
    assert [r["name"] for r in rows] == [f"part-{k:05d}" for k in range(40)]
    assert [open(f"{folder}/{r['name']}").read() for r in rows] == [str(k) for k in range(40)]
    assert sorted(os.listdir(folder))[:1] == ["_MANIFEST.json"] and len(os.listdir(folder)) == 41


def test_no_manifest_when_a_file_is_missing(spark, tmp_path):
    folder = str(tmp_path / "b")
    with pytest.raises(Exception):
        warc._commit(reported(spark, folder, range(1, 40)), folder)
    assert "_MANIFEST.json" not in os.listdir(folder)
