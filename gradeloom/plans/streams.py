"""Streaming queries: the stream runs over what is available and its written result is returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions.ordered import running_sum
from gradeloom.operators import runlog as R
from gradeloom.plans.registry import query
from gradeloom.plans.runlog import _COND, _FOLD
from gradeloom.streaming import events as St


@query("stream_event_tail", "S9", "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type")
def stream_event_tail(m):
    schema = m["events"].schema
    tail = St.stream_events(m.spark, m.dir, schema, "events.parquet")
    path = St.scratch(m.spark, "tail")
    St.drain_to_table(tail, path)
    return m.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("stream_deck_state", "R23", "WITH " + _FOLD + "SELECT fold.deck, kind, last, last_us, lines, coalesce((SELECT sum(n) FROM comp WHERE comp.deck = fold.deck), 0)::BIGINT AS complaints FROM fold")
def stream_deck_state(m):
    source, out = St.scratch(m.spark, "lines"), St.scratch(m.spark, "state")
    lines = m["log_lines"].select("line_no", "deck", "us", "message")
    lines.write.parquet(source)
    St.drain_updates(St.fold_deck_state(St.stream_events(m.spark, source, lines.schema, "*.parquet")), out)
    return St.newest_state(m.spark, out)


@query("stream_edge_alerts", "R19", "WITH " + _COND + "SELECT seq, kind, id FROM stk WHERE streak = confirm")
def stream_edge_alerts(m):
    days = m["samples"].select("seq", "day").withColumn("run", F.lit(1))
    nth = running_sum(days, ["run"], "day", ["seq"], F.lit(1), "nth").select("seq", "nth")
    cond = R.alert_conditions(m["samples"], m["sample_decks"], 0.993).join(nth, "seq").select(
        "seq", F.col("nth").cast("long").alias("nth"), "kind", "id", F.col("confirm").cast("long").alias("confirm"))
    source, out = St.scratch(m.spark, "conditions"), St.scratch(m.spark, "alerts")
    # files hold samples of all times: by hash, and a few of them a micro-batch
    cond.repartition(24, F.xxhash64("seq")).write.parquet(source)
    St.drain_updates(St.condition_blocks(St.stream_events(m.spark, source, cond.schema, "*.parquet", per_trigger=8)), out)
    return St.alerts_of_blocks(St.newest_state(m.spark, out, ["kind", "id", "block"]))
