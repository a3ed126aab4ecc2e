"""The answer and its damaged copy are paired from one pass over the shapes, dealt out by page once."""

import pytest

from gradeloom.operators import matching as M
from gradeloom.plans.matching import both, large_pages
from gradeloom.plans.models import DAMAGED, Models
from gradeloom.plans.registry import bound, load_all

load_all()
SF = "/root/testdata/sf0.001"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["picture_and_crop_credit", "position_credit", "rotation_credit", "box_relations", "fill_and_line_credit", "identity_facets", "match_shapes"])
def test_one_shuffle_of_the_shapes(spark, name):
    # the themes of the decks have one of their own
    assert shuffles(bound(name)(spark, SF)) <= (3 if name == "fill_and_line_credit" else 1)


@pytest.mark.parametrize("other", sorted(DAMAGED))
def test_one_pass_gives_both_tables(spark, other):
    m = Models(spark, SF)
    names = [c for c in m["shapes_gt"].columns if c not in ("deck", "slide")]
    rows = m.both(other, names)
    for side, table in ((0, "shapes_gt"), (1, other)):
        got = rows.where(rows["__side"] == side).select("deck", "slide", *names)
        want = m[table].select("deck", "slide", *names)
        assert [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_pairs_of_one_pass_are_those_of_two_tables(spark):
    m = Models(spark, SF)
    two = M.wide_pairs(m["shapes_gt"], m["shapes_input"], ["kind", "start_id"], alone=True)
    one = M.wide_pairs(m["shapes_gt"], m["shapes_input"], ["kind", "start_id"], alone=True, big=large_pages(m), both=both(m, "shapes_input"))
    assert two.columns == one.columns and two.count() == one.count() and two.exceptAll(one).isEmpty()


def test_large_pages_are_found_behind_large_decks(spark, tmp_path):
    lines = [(100 * d + o, 1) for d, n in ((3, 2100), (4, 300), (5, 1500)) for o in (1, 7) for _ in range(n if o == 1 else 900)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert large_pages(Models(spark, str(tmp_path))).collect() == [("deck000000003", 0)]


def test_chart_credit_scores_its_series_once(spark):
    plan = bound("chart_credit")(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # each reading of the series takes the order lines five times, the furniture once more
    assert plan.count("lineitem.parquet") <= 8
