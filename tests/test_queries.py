"""Every oracle agrees at the smallest scale; plan shapes of the headline queries."""

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
SAMPLE = ["licence_verdict", "dedup_first", "selection_audit", "triage_score", "shortlist", "register_by_content", "stage_staleness",
          "stage_runs", "edge_alerts", "diagnose", "group_defects", "allocate_ids", "commit_batches", "overlap_pairs", "alignment_digest",
          "pair_shapes", "match_shapes", "restored_shape_credit", "component_weights", "answer_text_leaks", "reachable_parts",
          "damage_zorder", "damage_clear_text", "apply_recipe", "half_restore", "chart_matrix", "page_boxes", "whole_objects", "failure_verdict",
          "excused_work", "native_demands", "demands_check", "notable_events", "stream_edge_alerts", "operation_scores"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canon(v):
    return "∅" if v is None else repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF)
    cols = sorted(frame.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in frame.collect())
    rel = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    want = sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(names) == cols and got == want


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    text = plan(entry_points.entry(spark))
    assert "BroadcastHashJoin" in text and "TakeOrderedAndProject" in text
    assert "CartesianProduct" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["overlap_pairs", "stage_runs", "triage_score"])
def test_no_cartesian_and_no_python(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text


def test_every_query_is_registered_with_a_survey_id():
    from gradeloom.plans import registry

    assert all(registry.COVERS[name] for name in registry.QUERIES)
    assert set(registry.ORACLES) <= set(registry.QUERIES)
