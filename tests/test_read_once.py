"""Rows that a query reads several times are written once, and only the states it asks for are scored."""

import pytest

from gradeloom.operators import scoring as P
from gradeloom.plans.registry import bound, load_all

load_all()
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["connector_credit", "drift_stats"])
def test_pages_are_walked_before_the_rows_are_read(spark, name):
    plan = bound(name)(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


ENDS, SHARES = {"gt", "noop"}, {"noop", "restored_25", "restored_50", "restored_75", "restored_100"}
ONE = {f"only_d{k}" for k in range(1, 6)}
ANSWERS = {"gt", "half", "rebuilt", "over_eager", "reencoded_all", "reencoded_untouched"}


class Asked(Exception):
    pass


@pytest.mark.parametrize("name, states, children", [
    ("calibration_curve", SHARES, SHARES | {"gt"}), ("calibration_findings", ENDS, ENDS), ("calibration_monotonic", SHARES, SHARES),
    ("calibration_per_degradation", ONE | {"noop"}, ONE | {"noop"}), ("calibration_states", ANSWERS | SHARES, ANSWERS | SHARES)])
def test_only_the_states_asked_for_are_scored(spark, monkeypatch, name, states, children):
    def caught(gt, broken, frames, components, supplied, width, height, theme, ops, facts):
        raise Asked(frames, facts)

    monkeypatch.setattr(P, "Scoring", caught)
    with pytest.raises(Asked) as found:
        bound(name)(spark, SF)
    frames, facts = found.value.args
    of = lambda df: {r[0] for r in df.select("scenario").distinct().collect()}
    assert of(frames) == states and of(facts.cells[1]) == of(facts.series[1]) == children
