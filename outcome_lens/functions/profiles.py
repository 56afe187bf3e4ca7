"""Profiles of numeric columns: moments and a quantile sketch from one scan, exact order statistics from a second.

A profile is a small table, written once, that any number of callers share. Its mergeable sketch tells in which narrow ranges the
wanted ranks lie; the second scan keeps the values of these ranges, and counts all others between them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col
from outcome_lens.functions.columns import number, require, same_keys
from outcome_lens.functions.ordering import running_totals
from outcome_lens.session import durable

SKETCH_SIZE = 4096
STEPS = 1024  # shares of the ranks at which a profile keeps the sketch's value
REACH = 0.003  # of the ranks on either side of a wanted one: over twice the error that the sketch is known for
ABOUT = 0.02  # relative error of an estimated number of values


@dataclass(frozen=True)
class Profile:
    """``rows`` has one row per group and column: its moments, and ``grid``, the sketch's values at even shares of the ranks."""

    names: tuple[str, ...]
    by: tuple[str, ...]
    rows: DataFrame

    def cells(self, df: DataFrame) -> DataFrame:
        """The columns that the profile is of, as ``x0, x1, ..``, with its groups."""
        return df.select(*[col(b) for b in self.by], *[number(df, n).alias(f"x{i}") for i, n in enumerate(self.names)])


def profile(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> Profile:
    """Count, mean, deviation, extremes, zeros, positives, estimated distinct values and sketched quantiles of each column, in one scan."""
    require(df, *names, *by)
    facts = []
    for i, n in enumerate(names):
        x = number(df, n)
        positive = F.when(x > 0, x)
        entry = F.struct(
            F.lit(n).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"), F.count_if(x == 0).alias("zeros"), F.count(positive).alias("positives"), F.max(positive).alias("positive_max"),
            F.approx_count_distinct(x, ABOUT).alias("about"), F.approx_count_distinct(positive, ABOUT).alias("positive_about"),
            F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE)).alias("sketch"),
        )
        facts.append(entry.alias(f"_{i}"))
    one = df.groupBy(*[col(b) for b in by]).agg(*facts)
    entries = F.explode(F.array(*[f"_{i}" for i in range(len(names))])).alias("_e")
    rows = one.select(*[col(b) for b in by], entries).select(*[col(b) for b in by], "_e.*")
    shares = F.array(*[F.lit(k / STEPS) for k in range(STEPS + 1)])
    grid = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", shares)).alias("grid")
    return Profile(tuple(names), tuple(by), durable(rows.select("*", grid).drop("sketch")))


def position(p: float, n: Column, skipped: Column | None = None) -> Column:
    """Where quantile ``p`` lies among ``n`` ordered values, from 0, behind the ``skipped`` smallest."""
    at = F.lit(float(p)) * (n - 1)
    return at if skipped is None else at + skipped


def sketched(share: Column, up: bool = False) -> Column:
    """The sketch's value at a share of the ranks, or at the nearest kept share below it, or above it with ``up``."""
    step = F.ceil(share * STEPS) if up else F.floor(share * STEPS)
    return F.get("grid", F.least(F.greatest(step, F.lit(0)), F.lit(STEPS)).cast("int"))


def around(at: Column) -> Column:
    """A range of values that holds the ones next to a position, as a struct of ``lo`` and ``hi``."""
    n = F.col("n")
    return F.struct(sketched((at - 1) / n - REACH).alias("lo"), sketched((at + 2) / n + REACH, up=True).alias("hi"))


@dataclass(frozen=True)
class Selection:
    """``rows`` are the values of some ranges and, between these, how many values there are, the least and the greatest.

    Columns: groups, ``column``, ``region``, ``x`` (null between ranges), ``n``, ``least``, ``most`` and ``upto``, the running total.
    """

    of: Profile
    rows: DataFrame

    def at(self, wanted: DataFrame) -> DataFrame:
        """``value`` for rows of groups, ``column``, ``key`` and ``at``, a position that may lie between two values.

        An error if a position was not in the ranges selected.
        """
        keys = [*self.of.by, "column"]
        ranks = wanted.filter(F.col("at") >= 0).withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
        hit = same_keys(self.rows, ranks, keys).filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        value = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.coalesce("x", F.raise_error(F.lit(OUTSIDE)).cast("double")))
        part = F.max(F.col("at") - F.floor("at"))
        low, high = (F.max(F.when(F.col("rank") == side("at"), value)) for side in (F.floor, F.ceil))
        found = hit.groupBy(*[col(k) for k in keys], "key").agg((low + (high - low) * part).alias("value"))
        return same_keys(wanted, found, [*keys, "key"], "left").drop("at")


OUTSIDE = "a rank is outside the ranges of its sketch"


def select_ranges(df: DataFrame, of: Profile, ranges: Sequence[Column]) -> Selection:
    """Select by one scan the values in ``ranges``, structs of ``lo`` and ``hi`` over a profile row.

    Values between the ranges shrink to one row a task and gap before anything is shuffled.
    """
    by, number_of = list(of.by), len(ranges)
    known = of.rows.filter("n > 0").select(*[col(b) for b in by], "column", F.array(*ranges).alias("r"))
    place = {n: i for i, n in enumerate(of.names)}
    cells = of.cells(df)
    if by:
        wide = known.groupBy(*[col(b) for b in by]).agg(*[F.max(F.when(F.col("column") == n, F.col("r"))).alias(f"r{i}") for n, i in place.items()])
        cells = same_keys(cells, wide, by)
        edge = lambda i, j, side: F.get(F.col(f"r{i}"), F.lit(j))[side]
    else:
        found = {r["column"]: r["r"] for r in known.collect()}  # one row a column
        edge = lambda i, j, side: F.lit(found[of.names[i]][j][side] if of.names[i] in found else None).cast("double")

    def cell(i: int) -> Column:
        x = F.col(f"x{i}")
        above = [F.coalesce((x > edge(i, j, side)).cast("int"), F.lit(0)) for j in range(number_of) for side in ("lo", "hi")]
        inside = reduce(lambda a, b: a | b, [x.between(edge(i, j, "lo"), edge(i, j, "hi")) for j in range(number_of)])
        return F.struct(F.lit(of.names[i]).alias("column"), reduce(lambda a, b: a + b, above).alias("region"), F.when(inside, x).alias("x"), x.alias("v"))

    coded = cells.select(*[col(b) for b in by], F.explode(F.array(*[cell(i) for i in range(len(of.names))])).alias("_e"))
    coded = coded.select(*[col(b) for b in by], "_e.*").filter(F.col("v").isNotNull())
    keys = [*by, "column", "region"]
    counts = coded.groupBy(*[col(k) for k in keys], "x").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    placed = running_totals(counts, [*by, "column"], [F.col("region").asc(), F.col("x").asc_nulls_first()], {"upto": F.col("n")})
    return Selection(of, durable(placed))


def quantile_rows(of: Profile, probs: Mapping[str, float]) -> DataFrame:
    """What ``Selection.at`` is to be asked for plain quantiles; ``key`` names each."""
    entries = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), position(p, F.col("n")).alias("at")) for k, p in probs.items()])).alias("_e")
    return of.rows.select(*[col(b) for b in of.by], "column", entries).select(*[col(b) for b in of.by], "column", "_e.*")


def exact_quantiles(df: DataFrame, of: Profile, probs: Mapping[str, float]) -> DataFrame:
    """Groups, ``column`` and one column a quantile, interpolated linearly; exact, from one scan after the profile's."""
    if not probs:
        raise AnalysisError("no quantile is asked for")
    selection = select_ranges(df, of, [around(position(p, F.col("n"))) for p in probs.values()])
    return pivoted(selection.at(quantile_rows(of, probs)), of, probs)


def pivoted(values: DataFrame, of: Profile, names: Sequence[str]) -> DataFrame:
    keys = [*of.by, "column"]
    return values.groupBy(*[col(k) for k in keys]).agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in names])
