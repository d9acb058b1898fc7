"""Exact running totals and quantiles without a single-task sort.

Input is first reduced to one row per distinct value. Those rows are written once, cut into
contiguous ranges of about equal size, summed inside each range, and shifted by the totals of
the ranges before. There are more ranges than shuffle partitions, however many those are. The cut
points come from rows whose hash lies under a threshold, so they depend on the data alone: a
recomputed task, or a second evaluation, cuts in the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import materialize

RANGES_PER_PARTITION = 4
SAMPLE_PER_RANGE = 8


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality on all keys."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def _cut_points(points: DataFrame, key: Column, ranges: int) -> Column:
    """Sorted array of about ``ranges`` keys, as a scalar subquery over a sample of that size."""
    size, rows = ranges * SAMPLE_PER_RANGE, max(1, points.count())
    keys = points.select(key.alias("k"))
    sample = keys if rows <= size else keys.where(F.pmod(F.xxhash64("k"), F.lit(rows)) < size)
    picked = sample.agg(F.sort_array(F.collect_list("k")).alias("ks")).select(
        F.filter("ks", lambda _, i: i % SAMPLE_PER_RANGE == SAMPLE_PER_RANGE - 1)
    )
    return picked.scalar()


def _with_range(points: DataFrame, key: Column, ranges: int) -> DataFrame:
    """Add ``_range``, how many cut points lie below the key, by unrolled binary search.

    Plain array lookups stay inside one compiled stage, where the cut points are shared by all
    rows instead of being copied into each.
    """
    columns = points.columns
    width = 1
    while width < ranges:  # room for twice the ranges, as the sample's size varies
        width *= 2
    steps, low = [], "0"
    while width:
        below = f"coalesce(get(_cuts, {low} + {width - 1}) < _key, false)"
        steps.append(f"{low} + IF({below}, {width}, 0) AS _low{width}")
        low, width = f"_low{width}", width // 2
    cut = points.select("*", key.alias("_key"), _cut_points(points, key, ranges).alias("_cuts"))
    found = cut.selectExpr("*", *steps)
    return found.select(*columns, F.col(low).alias("_range"))


def running_totals(
    points: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    with_next: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``run_<c>`` (inclusive running total) and ``all_<c>`` (group total) per column.

    ``points`` must hold one row per (``by``, ``order``). A group of any size spreads over as
    many ranges as its share of the rows; no group is handled by one task. The points are written
    to the shared folder, so what they come from is evaluated once. ``with_next`` also adds ``next_<order>``, the value of the following point in the group.
    """
    by = list(by)
    points = materialize(points, "points")
    if ranges is None:
        ranges = RANGES_PER_PARTITION * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*by, order) if by else F.col(order)
    located = _with_range(points, key, ranges)

    def sorted_by(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    # At most (groups + ranges) rows from here to the offsets.
    first = (F.max if descending else F.min)(order)
    totals = located.groupBy(*by, "_range").agg(
        first.alias("_first"), *[F.sum(c).alias(f"_{c}") for c in sums]
    )
    group = Window.partitionBy(*(by or [F.lit(0)]))
    in_order = group.orderBy(sorted_by("_range"))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_{c}").over(group).alias(f"all_{c}") for c in sums],
        *([F.lead("_first").over(in_order).alias("_later")] if with_next else []),
    )

    inside = Window.partitionBy(*by, "_range").orderBy(sorted_by(order))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = located.select(
        "*",
        *[F.sum(c).over(so_far).alias(f"_in_{c}") for c in sums],
        *([F.lead(order).over(inside).alias("_next")] if with_next else []),
    )
    joined = summed.alias("s").join(
        offsets.alias("o"),
        F.expr(" AND ".join(f"s.`{c}` <=> o.`{c}`" for c in [*by, "_range"])),
    )
    return joined.select(
        *[F.col(f"s.`{c}`") for c in points.columns],
        *[(F.col(f"s._in_{c}") + F.col(f"o._before_{c}")).alias(f"run_{c}") for c in sums],
        *[F.col(f"o.all_{c}") for c in sums],
        *([F.coalesce("s._next", "o._later").alias(f"next_{order}")] if with_next else []),
    )


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value with its count; NULL and NaN are left out."""
    column = F.col(value).cast("double")
    kept = df.where(column.isNotNull() & ~F.isnan(column))
    return kept.groupBy(*by, column.alias(value)).agg(F.count(F.lit(1)).alias("n"))


def _at_rank(rank: str, value: str, count: str) -> str:
    """Smallest value whose running count passes the zero-based rank."""
    return f"min(CASE WHEN run_{count} > {rank} THEN `{value}` END)"


def _place(prob: float, total: str) -> str:
    return f"{float(prob)!r}D * ({total} - 1)"


def linear_quantiles(
    totals: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], count: str = "n"
) -> DataFrame:
    """(by..., q0, q1, ...): linear-interpolated quantiles from rows of ``running_totals``."""
    ends = [F.expr(f"max(all_{count})").alias("_total")]
    for i, prob in enumerate(probs):
        place = _place(prob, f"all_{count}")
        for name, rank in (("low", f"floor({place})"), ("high", f"ceil({place})")):
            ends.append(F.expr(_at_rank(rank, value, count)).alias(f"_{name}{i}"))
    found = totals.groupBy(*by).agg(*ends)
    out = []
    for i, prob in enumerate(probs):
        place = _place(prob, "_total")
        part, gap = f"({place} - floor({place}))", f"(_high{i} - _low{i})"
        # Measured from the nearer end, so that a place on an exact rank returns that value.
        out.append(
            f"IF({part} >= 0.5D, _high{i} - {gap} * (1 - {part}), _low{i} + {gap} * {part}) AS q{i}"
        )
    return found.selectExpr(*[f"`{c}`" for c in by], *out)


def nearest_quantiles(
    totals: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], count: str = "n"
) -> DataFrame:
    """(by..., q0, q1, ...): the values at rank ``round(prob * (n - 1))``, halves to even."""
    return totals.groupBy(*by).agg(
        *[
            F.expr(_at_rank(f"rint({_place(p, f'all_{count}')})", value, count)).alias(f"q{i}")
            for i, p in enumerate(probs)
        ]
    )


def quantiles_of_counts(
    counts: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    count: str = "n",
    method: str = "linear",
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles per group from (group, value, count) rows."""
    totals = running_totals(counts.select(*by, value, count), value, [count], by, ranges=ranges)
    pick = {"linear": linear_quantiles, "nearest": nearest_quantiles}[method]
    found = pick(totals, value, list(probs.values()), by, count)
    return found.withColumnsRenamed({f"q{i}": name for i, name in enumerate(probs)})


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    method: str = "linear",
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles per group; ``probs`` maps output column to probability."""
    counts = value_counts(df, value, by)
    return quantiles_of_counts(counts, value, probs, by, method=method, ranges=ranges)
