"""Shapes of numeric columns: histograms and box statistics per group, and what shape they have."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col
from outcome_lens.functions.columns import number, require, same_keys, to_rows
from outcome_lens.functions.profiles import Profile, around, pivoted, position, profile, quantile_rows, select_ranges, sketched
from outcome_lens.session import durable

BINS = 36
MOST_LISTED = 10_000  # bins a histogram may have for empty ones to be listed
WHISKER = 1.5
SKEW_ZERO_SHARE = 0.5
DISCRETE_LEVELS = 20
CLIP_QUANTILE = 0.995
CLIP_FACTOR = 1.5
BOX = {"q1": 0.25, "median": 0.5, "q3": 0.75}
BOX_COLUMNS = ("group", "n", "mean", "whisker_low", "q1", "median", "q3", "whisker_high")


def histogram(
    df: DataFrame, name: str, group: str, bins: int = BINS, scale: str = "linear", empty_bins: bool | None = None
) -> DataFrame:
    """Rows ``(group, bin, lo, hi, n, density)``; bins span the common range of all groups.

    The density of each group has area 1 on its own. ``log10`` drops values up to 0 and cuts equal
    widths of the logarithm (the density is per unit of it); ``discrete`` centres bins of width 1 on
    whole numbers. The last bin includes its upper edge. Bins without values are listed if
    ``empty_bins``, which is the default except for ``discrete`` bins, whose number the data decide; a range of over
    ``MOST_LISTED`` bins is then an error.
    """
    if scale not in ("linear", "log10", "discrete"):
        raise AnalysisError(f"scale is linear, log10 or discrete, not {scale!r}")
    require(df, name, group)
    x = number(df, name)
    if scale == "log10":
        x = F.when(x > 0, F.log10(x))
    cells = df.select(col(group).cast("string").alias("group"), x.alias("x")).filter(
        F.col("x").isNotNull() & F.col("group").isNotNull()
    )
    edges = cells.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    low, high = edges["lo"], edges["hi"]
    if low is None:
        raise AnalysisError(f"{name} has no value to draw a histogram of")
    if math.isinf(low) or math.isinf(high):
        raise AnalysisError(f"{name} has infinite values, which no bin of a width can hold: leave them out first")
    listed = scale != "discrete" if empty_bins is None else empty_bins
    if scale == "discrete":
        low, bins, width = low - 0.5, int(round(high) - round(low)) + 1, 1.0
    else:
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
    if listed and bins > MOST_LISTED:
        raise AnalysisError(f"{bins} bins are too many to list empty ones: leave them out")

    def at(step: Column) -> Column:
        return F.when(step == bins, F.lit(float(high))).otherwise(F.lit(low) + step * F.lit(width)) if scale != "discrete" else F.lit(low) + step * F.lit(width)

    # a quotient may round across an edge: the edges themselves decide
    near = F.least(F.greatest(F.floor((F.col("x") - F.lit(low)) / F.lit(width)), F.lit(0)), F.lit(bins - 1)).cast("long")
    slot = near - (F.col("x") < at(near)).cast("long") + ((F.col("x") >= at(near + 1)) & (near + 1 < bins)).cast("long")
    # counted once, for the totals and for the bins
    counts = durable(cells.groupBy("group", slot.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("group").agg(F.sum("n").alias("_total"))
    if listed:
        grid = totals.select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
        counts = same_keys(grid, counts, ["group", "bin"], "left")
    filled = same_keys(counts, totals, ["group"]).withColumn("n", F.coalesce("n", F.lit(0)))

    def edge(step: Column) -> Column:
        return F.pow(F.lit(10.0), F.lit(low) + step * F.lit(width)) if scale == "log10" else F.lit(low) + step * F.lit(width)

    return filled.select(
        "group",
        "bin",
        edge(F.col("bin")).alias("lo"),
        edge(F.col("bin") + 1).alias("hi"),
        "n",
        (F.col("n") / (F.col("_total") * F.lit(width))).alias("density"),
    )


def shape_profile(df: DataFrame, names: Sequence[str], known: Profile | None = None) -> DataFrame:
    """One row per column: how a histogram of it should be drawn, and the numbers that decide.

    ``skewed``: over half are zeros, so only positive values are looked at further. ``discrete``:
    at most 20 distinct values (counted in ``distinct_values``, NULL beyond). ``clipped``: neither,
    and the largest value is far above the 99.5 % quantile. ``known`` is a profile that was made before.
    """
    require(df, *names)
    known = known or profile(df, names)
    facts = {r["column"]: r for r in known.rows.drop("grid").collect()}  # one row a column
    share = {n: facts[n].zeros / facts[n].rows if n in facts and facts[n].rows else math.nan for n in names}
    skewed = {n: share[n] > SKEW_ZERO_SHARE for n in names}
    # the estimate never turns 20 values into 60, so an exact count is needed only below that, where
    # it is cheap: a column with few values shuffles few
    about = {n: facts[n].positive_about if skewed[n] else facts[n].about for n in facts}
    few = [n for n in names if about.get(n, 0) <= 3 * DISCRETE_LEVELS]
    distinct = dict.fromkeys(names)
    if few:
        values = to_rows(df, few, value="x", as_type="double").filter("x is not null")
        only_positive = F.col("column").isin([n for n in few if skewed[n]])
        values = values.filter(~only_positive | (F.col("x") > 0)).distinct()
        for row in values.groupBy("column").agg(F.count(F.lit(1)).alias("k")).collect():
            distinct[row["column"]] = row["k"]
        distinct.update({n: 0 for n in few if distinct[n] is None})
    entries = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(share[n]).alias("zero_share"),
            F.lit(skewed[n]).alias("skewed"),
            F.lit(distinct[n] is not None and distinct[n] <= DISCRETE_LEVELS).alias("discrete"),
            F.lit(distinct[n] if distinct[n] is not None and distinct[n] <= DISCRETE_LEVELS else None).cast("long").alias("distinct_values"),
            F.lit(None if n not in facts else facts[n].positive_max if skewed[n] else facts[n].max).cast("double").alias("max"),
        )
        for n in names
    ]
    # of a skewed column the positive values stand behind all others
    looked_at = F.when(F.col("column").isin([n for n in names if skewed[n]]), F.col("positives")).otherwise(F.col("n"))
    at = position(CLIP_QUANTILE, looked_at, F.col("n") - looked_at)
    wanted = known.rows.select("column", F.lit("high_quantile").alias("key"), F.when(looked_at > 0, at).alias("at"))
    cut = select_ranges(df, known, [around(at)]).at(wanted).select("column", F.col("value").alias("high_quantile"))
    listed = cut.select("column", "high_quantile", F.explode(F.array(*entries)).alias("_f")).filter(F.col("column") == F.col("_f.column"))
    return listed.select(
        "_f.*",
        "high_quantile",
        (
            ~F.col("_f.skewed")
            & ~F.col("_f.discrete")
            & F.coalesce(F.col("_f.max") > F.lit(CLIP_FACTOR) * F.col("high_quantile"), F.lit(False))
        ).alias("clipped"),
    )


def box_stats(df: DataFrame, name: str, group: str, exact: bool = True) -> DataFrame:
    """One row per group: quartiles, mean, and whiskers at the last values within 1.5 IQR.

    Two scans: the first makes the groups' profiles, the second selects the values around quartiles and around where the sketch says
    that whiskers end, with the extremes of all values between. ``exact=False`` takes all from the sketch, and
    whiskers from a scan of their own.
    """
    require(df, name, group)
    cells = df.select(col(group).cast("string").alias("group"), number(df, name).alias("x")).filter(
        F.col("x").isNotNull() & F.col("group").isNotNull()
    )
    known = profile(cells, ["x"], by=["group"])
    if not exact:
        boxes = known.rows.select("group", "n", "mean", *[sketched(F.lit(p)).alias(q) for q, p in BOX.items()])
        inside = F.when(_inside(F.col("x")), F.col("x"))
        ends = same_keys(cells, durable(boxes), ["group"]).groupBy("group", "n", "mean", *BOX)
        return ends.agg(F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high")).select(*BOX_COLUMNS)
    places = {q: around(position(p, F.col("n"))) for q, p in BOX.items()}
    low, high = places["q1"], places["q3"]
    spread = {"least": F.greatest(high["lo"] - low["hi"], F.lit(0.0)), "most": high["hi"] - low["lo"]}
    fences = [
        F.struct((low["lo"] - WHISKER * spread["most"]).alias("lo"), (low["hi"] - WHISKER * spread["least"]).alias("hi")),
        F.struct((high["lo"] + WHISKER * spread["least"]).alias("lo"), (high["hi"] + WHISKER * spread["most"]).alias("hi")),
    ]
    selection = select_ranges(cells, known, [*places.values(), *fences])
    boxes = pivoted(selection.at(quantile_rows(known, BOX)), known, list(BOX)).drop("column")
    boxes = same_keys(boxes, known.rows.select("group", "n", "mean"), ["group"])
    found = same_keys(selection.rows.select("group", "x", "least", "most"), durable(boxes), ["group"])
    # a gap between ranges is inside or outside as a whole, as its extremes are
    least, most = F.when(_inside(F.col("least")), F.col("least")), F.when(_inside(F.col("most")), F.col("most"))
    ends = found.groupBy("group", "n", "mean", *BOX).agg(F.min(least).alias("whisker_low"), F.max(most).alias("whisker_high"))
    return ends.select(*BOX_COLUMNS)


def _inside(x: Column) -> Column:
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    return (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)


__all__ = ["box_stats", "histogram", "shape_profile"]
