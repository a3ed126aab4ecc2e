"""Colour columns: hex parsing, luminance changes, CIE76 distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that stand for other theme slots.
SLOT_ALIASES = {"bg1": "lt1", "tx1": "dk1", "bg2": "lt2", "tx2": "dk2"}


def channel(hex6: Column, at: int) -> Column:
    return F.conv(F.substring(hex6, at * 2 + 1, 2), 16, 10).cast("double")


def rgb_of(hex6: Column) -> Column:
    """Struct of channels 0..255; a malformed value is black, an absent one stays null."""
    clean = F.regexp_replace(F.trim(hex6), "^#", "")
    good = clean.rlike("^[0-9a-fA-F]{6}$")
    parts = [F.when(good, channel(clean, i)).otherwise(0.0).alias(n) for i, n in enumerate("rgb")]
    return F.when(hex6.isNotNull(), F.struct(*parts))


def with_luminance(rows: DataFrame, rgb: str, name: str, lum_mod: str = "lum_mod", lum_off: str = "lum_off",
                   shade: str = "shade", tint: str = "tint") -> DataFrame:
    """Add ``name``: ``rgb`` with its lightness changed in HLS space.

    The modifiers are in 1/100000 and may be null.  The steps are separate columns so that no
    expression is repeated inside another.
    """
    c = F.col
    out = rows.withColumns({f"__{n}": c(rgb)[n] / 255.0 for n in "rgb"})
    out = out.withColumns({"__top": F.greatest("__r", "__g", "__b"), "__low": F.least("__r", "__g", "__b")})
    out = out.withColumns({"__l": (c("__top") + c("__low")) / 2, "__d": c("__top") - c("__low")})
    turn = (F.when(c("__r") == c("__top"), (c("__g") - c("__b")) / c("__d"))
            .when(c("__g") == c("__top"), (c("__b") - c("__r")) / c("__d") + 2.0)
            .otherwise((c("__r") - c("__g")) / c("__d") + 4.0) / 6.0)
    flat = c("__d") == 0
    out = out.withColumns({
        "__s": F.when(flat, 0.0).when(c("__l") <= 0.5, c("__d") / (c("__top") + c("__low")))
        .otherwise(c("__d") / (F.lit(2.0) - c("__top") - c("__low"))),
        "__h": F.when(flat, 0.0).otherwise(turn)})
    out = out.withColumn("__l", c("__l") * F.coalesce(c(lum_mod), F.lit(100000)) / 100000.0)
    out = out.withColumn("__l", F.when(c(lum_off).isNotNull(), F.least(F.lit(1.0), c("__l") + c(lum_off) / 100000.0)).otherwise(c("__l")))
    out = out.withColumn("__l", c("__l") * F.coalesce(c(shade), F.lit(100000)) / 100000.0)
    share = c(tint) / 100000.0
    out = out.withColumn("__l", F.when(c(tint).isNotNull(), c("__l") * share + (F.lit(1.0) - share)).otherwise(c("__l")))
    out = out.withColumn("__l", F.greatest(F.lit(0.0), F.least(F.lit(1.0), c("__l"))))
    out = out.withColumn("__up", F.when(c("__l") <= 0.5, c("__l") * (c("__s") + 1.0)).otherwise(c("__l") + c("__s") - c("__l") * c("__s")))
    out = out.withColumn("__lo", c("__l") * 2.0 - c("__up"))
    for n, shift in (("r", 1 / 3), ("g", 0.0), ("b", -1 / 3)):
        out = out.withColumn("__x", c("__h") + shift).withColumn("__x", c("__x") - F.floor("__x"))
        value = (F.when(c("__s") == 0, c("__l"))
                 .when(c("__x") < 1 / 6, c("__lo") + (c("__up") - c("__lo")) * c("__x") * 6.0)
                 .when(c("__x") < 0.5, c("__up"))
                 .when(c("__x") < 2 / 3, c("__lo") + (c("__up") - c("__lo")) * (F.lit(2 / 3) - c("__x")) * 6.0)
                 .otherwise(c("__lo")))
        out = out.withColumn(f"__n{n}", F.bround(value * 255))
    changed = F.coalesce(c(lum_mod), c(lum_off), c(shade), c(tint)).isNotNull()
    new = F.when(changed & c(rgb).isNotNull(), F.struct(*[c(f"__n{n}").alias(n) for n in "rgb"])).otherwise(c(rgb))
    return out.withColumn(name, new).drop(*[x for x in out.columns if x.startswith("__")])


def with_delta_e(rows: DataFrame, left: Column, right: Column, name: str) -> DataFrame:
    """Add ``name``: the CIE76 distance of two rgb structs; 100 when either is unknown.

    The steps are separate columns so that no expression is repeated inside another.
    """
    c, sides, keep = F.col, "pq", rows.columns
    out = rows.withColumns({"__p": left, "__q": right})
    out = out.withColumns({f"__{s}{n}": c(f"__{s}")[n] / 255.0 for s in sides for n in "rgb"})

    def linear(x: Column) -> Column:
        return F.when(x <= 0.04045, x / 12.92).otherwise(F.pow((x + 0.055) / 1.055, F.lit(2.4)))

    def curve(t: Column) -> Column:
        return F.when(t > 0.008856, F.pow(t, F.lit(1 / 3))).otherwise(t * 7.787 + 16 / 116)

    out = out.withColumns({f"__{s}{n}": linear(c(f"__{s}{n}")) for s in sides for n in "rgb"})
    mixed = {}
    for s in sides:
        r, g, b = (c(f"__{s}{n}") for n in "rgb")
        mixed |= {f"__{s}x": (r * 0.4124 + g * 0.3576 + b * 0.1805) / 0.95047, f"__{s}y": r * 0.2126 + g * 0.7152 + b * 0.0722,
                  f"__{s}z": (r * 0.0193 + g * 0.1192 + b * 0.9505) / 1.08883}
    out = out.withColumns(mixed)
    out = out.withColumns({n: curve(c(n)) for n in mixed})
    lab = {s: (c(f"__{s}y") * 116.0 - 16.0, (c(f"__{s}x") - c(f"__{s}y")) * 500.0, (c(f"__{s}y") - c(f"__{s}z")) * 200.0) for s in sides}
    gap = F.sqrt(sum((F.pow(p - q, F.lit(2.0)) for p, q in zip(lab["p"], lab["q"])), F.lit(0.0)))
    out = out.withColumn(name, F.when(c("__p").isNull() | c("__q").isNull(), 100.0).otherwise(gap))
    return out.select(*[x for x in keep if x != name], name)
