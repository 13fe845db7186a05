"""Ordering inside groups that may be arbitrarily large.

A section, an account or a title may hold a third of all rows, so nothing here
sorts a whole group in one task:

* ``first_per_key`` and ``top_k`` filter on a literal rank bound, which lets Spark
  keep only the leading rows of each group on the map side before the shuffle;
* ``positions`` numbers every row of every group exactly, by splitting groups into
  quantile ranges, counting those, and numbering each range on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Quantile ranges per key, a power of two.
RANGES = 256


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The leading row of every key."""
    return top_k(df, key, order, 1)


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of every group; ``rank`` names a column that keeps the position."""
    name = rank or "_rank"
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= F.lit(k))
    return out if rank else out.drop(name)


def _range_of(key: Column, bounds: Column) -> Column:
    """Number of the quantile range that ``key`` lies in: a binary search over the ascending bounds."""
    steps = F.array(*[F.lit(RANGES >> e) for e in range(1, RANGES.bit_length())])
    down = lambda lo, step: F.when(F.get(bounds, lo + step - 1) <= key, lo + step).otherwise(lo)
    return F.aggregate(steps, F.lit(0), down).cast("bigint")


def positions(
    df: DataFrame,
    group: Sequence[str],
    keys: Sequence[str],
    name: str,
    exact: Sequence[str] = (),
    measure: DataFrame | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based position of every row inside its group, by integer ``keys`` ascending.

    Each key is cut at its quantiles into ``RANGES`` ranges, so an outlier or a cluster of
    values moves bounds and not loads. A row's path is (range of key 1, key 1, ..., range of
    the last key), and paths sort like rows. Rows are counted per path with map-side partial
    aggregation, running totals turn the counts into offsets, and only rows sharing a path
    are sorted together.

    Keys named in ``exact`` have few values (a score) and are their own range. The
    quantiles of the others are one aggregate over ``measure`` (by default ``df``), read as a
    scalar subquery. They set ranges and never results, so ``measure`` may be any cheaper
    table with the same keys, such as the rows before a filter. ``total`` names a column for
    the number of rows of the group, from the same counts.
    """
    group, keys = list(group), list(keys)
    measured = [k for k in keys if k not in exact]
    keyed, path = df, []
    if measured:
        shares = [i / RANGES for i in range(1, RANGES)]
        bounds = (
            (df if measure is None else measure)
            .agg(*[F.percentile_approx(F.col(k).cast("bigint"), shares, 4 * RANGES).alias(f"at_{k}") for k in measured])
            .select(F.struct("*"))
            .scalar()
        )
        keyed = keyed.withColumn("_bounds", bounds)
    for key in keys:
        if key in exact:
            path.append(key)
            continue
        keyed = keyed.withColumn(f"_range_{key}", _range_of(F.col(key).cast("bigint"), F.col(f"_bounds.at_{key}")))
        path.append(f"_range_{key}")
        if key != keys[-1]:
            path.append(key)
    keyed = keyed.drop("_bounds")

    # Structs as keys: they compare NULL members as equal, and one exchange on the path
    # serves the numbering window and the join of the offsets.
    keyed = keyed.withColumn("_path", F.struct(*group, *path))
    before = Window.unboundedPreceding
    counts = keyed.groupBy("_path").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_coarse", F.struct(*[F.col(f"_path.{c}") for c in [*group, path[0]]]))
    inside = Window.partitionBy("_coarse").orderBy("_path").rowsBetween(before, -1)
    whole = Window.partitionBy(F.struct(*[F.col(f"_coarse.{c}") for c in group]))
    ahead = whole.orderBy("_coarse").rowsBetween(before, -1)
    size = [F.sum("_n").over(whole).alias(total)] if total else []
    coarse = (
        counts.groupBy("_coarse")
        .agg(F.sum("_n").alias("_n"))
        .select("_coarse", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"), *size)
    )
    offsets = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(coarse, "_coarse")
    local = Window.partitionBy("_path").orderBy(*keys)
    numbered = keyed.withColumn("_local", F.row_number().over(local))
    out = numbered.join(offsets.select("_path", "_inside", "_ahead", *([total] if total else [])), "_path")
    return out.withColumn(name, (F.col("_local") + F.col("_inside") + F.col("_ahead")).cast("bigint")).drop(
        "_path", *[c for c in path if c.startswith("_range_")], "_local", "_inside", "_ahead"
    )
