"""Streams equal the batch answer, across restarts."""

import random

from pyspark.sql import functions as F

from gradeloom.streaming import events as St

COND = "seq long, nth long, kind string, id string, confirm long"


def alerts(spark, source, out, per_trigger=64, block=St.ALERT_BLOCK):
    """Run the stream over what is there now, from its own checkpoint, and read the alerts."""
    stream = St.stream_events(spark, source, spark.createDataFrame([], COND).schema, "*.parquet", per_trigger=per_trigger)
    St.drain_updates(St.condition_blocks(stream, block), out)
    return St.alerts_of_blocks(St.newest_state(spark, out, ["kind", "id", "block"]), block)


def streaks(rows):
    """The alerts by a plain walk."""
    out, held = [], {}
    for seq, nth, kind, name, confirm in sorted(set(rows), key=lambda r: (r[2], r[3], r[1])):
        at, length = held.get((kind, name), (None, 0))
        length = length + 1 if at == nth - 1 else 1
        held[(kind, name)] = (nth, length)
        if length == confirm:
            out.append((seq, kind, name))
    return sorted(out)


def test_alerts_fire_once_and_rearm_across_batches(spark, tmp_path):
    first = [(10, 1, "stall", "a", 2), (20, 2, "stall", "a", 2), (30, 3, "stall", "a", 2), (10, 1, "park", "b", 1)]
    later = [(40, 4, "stall", "a", 2), (70, 7, "stall", "a", 2), (80, 8, "stall", "a", 2), (80, 8, "park", "b", 1)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in (first, later):
        spark.createDataFrame(rows, COND).coalesce(1).write.mode("append").parquet(source)
        got = alerts(spark, source, out, block=2)
    assert {tuple(r) for r in got.collect()} == {(20, "stall", "a"), (80, "stall", "a"), (10, "park", "b"), (80, "park", "b")}


def test_late_samples_join_runs_of_earlier_batches(spark, tmp_path):
    """Samples of all times in every file, one file a micro-batch: the alerts are those of a plain walk."""
    rng = random.Random(5)
    rows = [(10 * n, n, kind, "", confirm) for kind, confirm, share in (("a", 3, 0.8), ("b", 1, 0.3), ("c", 6, 0.95))
            for n in range(0, 90) if rng.random() < share and not (kind == "a" and 20 <= n < 45)]
    rows += rng.sample(rows, 30)
    rng.shuffle(rows)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, COND).repartition(4).write.parquet(source)
    assert sorted(tuple(r) for r in alerts(spark, source, out, per_trigger=1, block=8).collect()) == streaks(rows)


def test_deck_state_resumes(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "line_no long, deck string, us long, message string"
    for rows in ([(1, "d1", 5, "score REJECTED: x")], [(2, "d1", 9, "ok consistency=ok"), (3, "d2", 9, "BUSY: lock")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = St.stream_events(spark, source, spark.createDataFrame([], schema).schema, "*.parquet")
        St.drain_updates(St.fold_deck_state(stream), out)
    got = {r.deck: (r.kind, r.lines, r.complaints) for r in St.newest_state(spark, out).collect()}
    assert got == {"d1": ("packaged", 2, 1), "d2": ("blocked", 1, 0)}
    assert St.newest_state(spark, out).select(F.count("*")).first()[0] == 2


def test_alerts_do_not_depend_on_chunks_or_order(spark, tmp_path):
    """40,000 samples of one condition, shuffled over files of several micro-batches: one alert, as in a batch."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(1, 40001).select(F.col("id").alias("seq"), F.col("id").alias("nth"), F.lit("memory").alias("kind"), F.lit("").alias("id"), F.lit(3).cast("long").alias("confirm"))
    rows.unionByName(rows.where("nth % 7 = 0")).orderBy(F.xxhash64("nth")).repartition(5).write.parquet(source)
    assert [tuple(r) for r in alerts(spark, source, out, per_trigger=1).collect()] == [(3, "memory", "")]


def test_no_conditions_no_alerts(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], COND).write.parquet(source)
    assert alerts(spark, source, out).count() == 0
