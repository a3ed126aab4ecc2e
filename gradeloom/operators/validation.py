"""Record validation: rules over records give ``(deck, check, key)`` findings; none means pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ordinals and bands.
REASONING = ("direct", "relational", "inductive")
INTERACTION = ("basic", "compound", "expert")
REACH = ("on_slide", "cross_slide", "deck_wide")
EASY_STEPS, MEDIUM_STEPS = 100, 300
SPLIT = 0.25
FOCUS_OPS = {"animation": ("anim_drop_steps",), "equation": ("drop_equation",), "chart": ("chart_edit",), "effects": ("strip_effects",)}
REQUIRED_FILES = ("task.json", "input.pptx", "plan.json")


def findings(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    hits = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return rows.select("deck", F.col(key).cast("string").alias("key"), F.explode(hits).alias("check"))


def ordinal(col: Column, scale: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in scale]), col) - 1


def difficulty_bands(degradations: DataFrame) -> DataFrame:
    """Band from the hardest reasoning and interaction; size band from the step total."""
    per = degradations.groupBy("deck").agg(F.max(ordinal(F.col("reasoning"), REASONING)).alias("r"), F.max(ordinal(F.col("interaction"), INTERACTION)).alias("i"),
                                           F.sum("est_steps").alias("steps"))
    band = (F.when((F.col("r") == 2) | (F.col("i") == 2) | ((F.col("r") == 1) & (F.col("i") == 1)), "hard")
            .when((F.col("r") == 1) | (F.col("i") == 1), "medium").otherwise("easy"))
    size = F.when(F.col("steps") <= EASY_STEPS, "easy").when(F.col("steps") <= MEDIUM_STEPS, "medium").otherwise("hard")
    return per.select("deck", band.alias("band"), size.alias("size_band"), "steps")


def proposal_findings(tasks: DataFrame, degradations: DataFrame) -> DataFrame:
    """Required fields, page bounds, distractor rule and headline against parts (25% of the larger)."""
    parts = degradations.groupBy("deck").agg(F.sum("est_steps").alias("parts"), F.bool_or(F.col("reasoning") == "inductive").alias("inductive"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    t = tasks.join(parts, "deck", "left")
    head = findings(t, "name", {
        "missing name": blank("name"), "missing instruction": blank("instruction"), "no degradations": F.col("parts").isNull(),
        "inductive without distractor": F.coalesce("inductive", F.lit(False)) & blank("distractor"),
        "headline and parts disagree": F.abs(F.col("parts") - F.col("est_steps")) > SPLIT * F.greatest("parts", "est_steps")})
    d = degradations.join(tasks.select("deck", "n_slides"), "deck")
    body = findings(d, "deg", {
        "page out of bounds": (F.col("slide") < 1) | (F.col("slide") > F.col("n_slides")),
        "unusable reach": ~F.coalesce(F.col("reach").isin(*REACH), F.lit(False)),
        "unusable reasoning": ~F.coalesce(F.col("reasoning").isin(*REASONING), F.lit(False)),
        "unusable interaction": ~F.coalesce(F.col("interaction").isin(*INTERACTION), F.lit(False))})
    return head.unionByName(body)


def disclosure_gaps(required: DataFrame, declared: DataFrame, derived_kinds: Sequence[str]) -> DataFrame:
    """(deck, kind, slide, action): assets a page needs and nobody declared; plain kinds are filled in."""
    gap = required.select("deck", "kind", "slide").distinct().join(declared.select("deck", "kind", "slide").distinct(), ["deck", "kind", "slide"], "left_anti")
    return gap.withColumn("action", F.when(F.col("kind").isin(*derived_kinds), "derive").otherwise("missing"))


def recipe_findings(steps: DataFrame, ops: DataFrame, declared: DataFrame) -> DataFrame:
    """Known operations, page bounds, and both ways between steps and degradations."""
    known = ops.withColumn("__known", F.lit(True))
    rows = steps.join(known, "op", "left")
    own = findings(rows, "op", {"unknown operation": F.col("__known").isNull(), "page out of bounds": (F.col("slide") < 0) | (F.col("slide") >= F.col("n_slides"))}).distinct()
    named = steps.select("deck", "deg").distinct()
    a = named.join(declared, ["deck", "deg"], "left_anti").select("deck", F.col("deg").alias("key"), F.lit("step names an undeclared degradation").alias("check"))
    b = declared.join(named, ["deck", "deg"], "left_anti").select("deck", F.col("deg").alias("key"), F.lit("degradation without steps").alias("check"))
    return own.unionByName(a).unionByName(b)


def focused_findings(steps: DataFrame, focus: DataFrame) -> DataFrame:
    """Degradations of a focused deck with a step outside the family's operations."""
    table = F.create_map(*[x for k, ops in FOCUS_OPS.items() for x in (F.lit(k), F.array(*[F.lit(o) for o in ops]))])
    rows = steps.join(focus, "deck").withColumn("__ok", F.array_contains(F.try_element_at(table, F.col("family")), F.col("op")))
    per = rows.groupBy("deck", "deg").agg(F.count(F.lit(1)).alias("n"), F.count_if("__ok").alias("good"))
    return per.where(F.col("n") != F.col("good")).select("deck", F.col("deg").alias("key"), F.lit("operation outside the family").alias("check"))


def reconcile_findings(records: DataFrame, unmet: DataFrame) -> DataFrame:
    """Verdict and reason rules, and every unmet asset is mentioned in the note."""
    own = findings(records, "deck", {"no verdict": F.coalesce("verdict", F.lit("")) == "", "rework without a reason": (F.col("verdict") == "needs_rework") & (F.coalesce("note", F.lit("")) == "")})
    silent = (unmet.join(records.select("deck", F.lower(F.coalesce("note", F.lit(""))).alias("note")), "deck")
              .where(~F.contains(F.col("note"), F.lower("name"))).select("deck", F.col("name").alias("key"), F.lit("unmet asset not mentioned").alias("check")))
    return own.unionByName(silent)


def rubric_findings(reports: DataFrame, items: DataFrame) -> DataFrame:
    """Shape of each degradation's judgement and whether the steps add up to the total."""
    own = findings(items, "deg", {"steps missing": F.coalesce("steps", F.lit(0)) <= 0, "rivals on a determinate item": F.col("determinate") & (F.col("rivals") > 0),
                                  "evidence missing": F.coalesce(F.trim("evidence"), F.lit("")) == ""})
    sums = items.groupBy("deck").agg(F.sum("steps").alias("__sum"))
    total = findings(reports.join(sums, "deck"), "deck", {"steps do not add up": F.abs(F.col("__sum") - F.col("total")) > SPLIT * F.col("total"),
                                                          "band without a note": (F.col("band") != "ok") & (F.coalesce("note", F.lit("")) == "")})
    return own.unionByName(total)


def verdicts(reports: DataFrame, items: DataFrame) -> DataFrame:
    """First matching rule: leaked, undetermined, ambiguous, overdetermined, solvable."""
    rule = (F.when(~F.col("determinate") & (F.col("rivals") == 0), 2).when(F.col("rivals") > 0, 3).when(F.col("overdetermined"), 4).otherwise(5))
    worst = items.groupBy("deck").agg(F.min(rule).alias("__rule"))
    rows = reports.join(worst, "deck", "left").withColumn("rule", F.when(F.col("leaks") > 0, 1).otherwise(F.coalesce("__rule", F.lit(5))))
    names = F.array(*[F.lit(v) for v in ("leaked", "undetermined", "ambiguous", "overdetermined", "solvable")])
    return rows.select("deck", F.col("rule").cast("long").alias("rule"), F.element_at(names, F.col("rule").cast("int")).alias("verdict"))


def provenance_findings(recorded: DataFrame, current: DataFrame, records: DataFrame, ignore: Sequence[str]) -> DataFrame:
    """Wrong deck, refused upstream, and inputs that changed since packaging outside the ignore list."""
    own = findings(records, "deck", {"record of another deck": F.col("recorded_deck") != F.col("deck"), "upstream was refused": F.coalesce("refused", F.lit(False))})
    a, b = recorded.select("deck", "input", F.col("digest").alias("was")), current.select("deck", "input", F.col("digest").alias("now"))
    moved = (a.join(b, ["deck", "input"], "full").where(~F.col("was").eqNullSafe(F.col("now")) & ~F.col("input").isin(*ignore))
             .select("deck", F.col("input").alias("key"), F.lit("input changed").alias("check")))
    return own.unionByName(moved)


def run_findings(shipped: DataFrame, files: DataFrame, published: DataFrame) -> DataFrame:
    """Shipped decks without a required file, and ones whose publication nobody confirmed."""
    need = shipped.select("deck", F.explode(F.array(*[F.lit(f) for f in REQUIRED_FILES])).alias("name"))
    absent = need.join(files.select("deck", "name"), ["deck", "name"], "left_anti").select("deck", F.col("name").alias("key"), F.lit("required file missing").alias("check"))
    silent = shipped.select("deck").join(published.select("deck"), "deck", "left_anti").select("deck", F.col("deck").alias("key"), F.lit("publication unconfirmed").alias("check"))
    return absent.unionByName(silent)
