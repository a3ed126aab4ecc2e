"""Oracle text shared by the queries that pair snapshots."""

from gradeloom.plans.structure import SQL_KEYS

_FOLD = """list_reduce(list({{'g': [gp], 'o': [op], 'k': [key]}} ORDER BY {order}), lambda acc, x:
   CASE WHEN list_contains(acc.g, x.g[1]) OR list_contains(acc.o, x.o[1]) THEN acc ELSE {{'g': list_concat(acc.g, x.g), 'o': list_concat(acc.o, x.o), 'k': list_concat(acc.k, x.k)}} END)"""


def pairs_sql(other: str, prefix: str = "", order: str = "rank, d2, gp, oz, op", weak_filter: bool = True, gt: str = "shapes_gt",
              scenario: bool = False) -> str:
    """CTEs ending in ``{prefix}pr(deck, slide, gp, op, key)``."""
    p = prefix
    by = "deck, slide" + (", scenario" if scenario else "")
    meet = """WHERE NOT (key LIKE 'name:%' OR key LIKE 'geo:%' OR key LIKE 'kind:%') OR (abs(gcx - ocx) * 2 <= gw + ow + 18288 AND abs(gcy - ocy) * 2 <= gh + oh + 18288)""" if weak_filter else ""
    sc = "o.scenario, " if scenario else ""
    return f"""
{p}gk AS (SELECT deck, slide, path, z, cx, cy, w, h, unnest(keys) AS key, generate_subscripts(keys, 1) - 1 AS rank FROM (SELECT *, {SQL_KEYS} AS keys FROM {gt})),
{p}ok AS (SELECT {'scenario, ' if scenario else ''}deck, slide, path, z, cx, cy, w, h, unnest(keys) AS key FROM (SELECT *, {SQL_KEYS} AS keys FROM {other})),
{p}pp AS (SELECT g.deck, g.slide, {sc}g.path AS gp, o.path AS op, any_value(g.z) AS gz, any_value(o.z) AS oz, min(rank) AS rank, arg_min(key, rank) AS key,
   any_value(g.cx) AS gcx, any_value(g.cy) AS gcy, any_value(g.w) AS gw, any_value(g.h) AS gh, any_value(o.cx) AS ocx, any_value(o.cy) AS ocy, any_value(o.w) AS ow, any_value(o.h) AS oh
   FROM {p}gk g JOIN {p}ok o USING (deck, slide, key) GROUP BY ALL),
{p}pq AS (SELECT *, (gcx - ocx) * (gcx - ocx) + (gcy - ocy) * (gcy - ocy) AS d2 FROM {p}pp {meet}),
{p}fd AS (SELECT {by}, {_FOLD.format(order=order)} AS f FROM {p}pq GROUP BY {by}),
{p}pr AS MATERIALIZED (SELECT {by}, unnest(f.g) AS gp, unnest(f.o) AS op, unnest(f.k) AS key FROM {p}fd)"""
