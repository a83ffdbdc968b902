"""Positions and selections in a total order, planned without running anything and without copies of the table.

``global_index`` ranks in two passes over the same rows. Bounds are data: the rows of least key hash (a fixed number, the same
ones whenever the plan runs) are sorted into one broadcast array. The first pass counts the keys between
bounds; the second puts each row into its range by binary search, numbers it inside and
adds the count of the ranges below. Nothing is checkpointed; a task that runs again finds the same bounds.

``rows_between`` returns the rows of some ranks without ranking the table: few are taken by a bounded top-n; for many, passes
over the keys count them between pivots and narrow to the interval that holds the boundary, and one filter reads the rows.

Keys are compared as structs: ascending, nulls first. They should name a row; rows with equal keys are numbered in any order.
The input must give the same rows each time it is read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .ordering import attach_scalars

RANGE_BYTES = 64 << 20
MOST_RANGES = 4096
PER_RANGE = 20     # sampled keys for each bound
TOP_N = 100_000    # ranks up to which a bounded top-n is taken
PIVOTS = 31


def _key(cols: Sequence[str | Column]) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(cols)])


def _n_ranges(df: DataFrame) -> int:
    """Ranges of about RANGE_BYTES by the plan's estimate, between the shuffle's partitions and MOST_RANGES."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, min(MOST_RANGES, 8 * least, size // RANGE_BYTES))


def _ranged(df: DataFrame, cols: Sequence[str | Column], n: int) -> DataFrame:
    """``df`` with its key ``_key`` and the range ``_range`` (0 to n - 1) it lies in."""
    keyed = df.withColumn("_key", _key(cols))
    some = keyed.select("_key").orderBy(F.xxhash64("_key"), "_key").limit(n * PER_RANGE)
    one = some.agg(F.sort_array(F.collect_list("_key")).alias("_s"))
    # every PER_RANGE-th sampled key, n - 1 of them (fewer of a small table)
    step = F.greatest(F.floor(F.size("_s") / n), F.lit(1)).cast("int")
    bounds = F.expr("filter(transform(sequence(1, _n), i -> get(_s, i * _step)), x -> x is not null)")
    one = one.withColumn("_n", F.lit(max(n - 1, 1))).withColumn("_step", step).select(bounds.alias("_bounds"))
    steps = [1 << k for k in reversed(range(max(n - 1, 1).bit_length()))]
    at: Column = F.lit(0)
    found = F.aggregate(F.array(*map(F.lit, steps)), at, lambda lo, s: F.when(
        (lo + s <= F.size("_bounds")) & (F.get("_bounds", lo + s - 1) <= F.col("_key")), lo + s).otherwise(lo))
    return attach_scalars(keyed, one).withColumn("_range", found).drop("_bounds")


def _before(per: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Per range (at most MOST_RANGES rows, or as many per group ``by``) the sum of ``value`` over the ranges below."""
    over = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    return per.withColumn(name, F.coalesce(F.sum(value).over(over), F.lit(0))).drop(value)


def global_index(df: DataFrame, order_cols: Sequence[str | Column], name: str = "row_idx") -> DataFrame:
    """Number the rows 0, 1, .. in the order of ``order_cols``."""
    ranged = _ranged(df, order_cols, _n_ranges(df))
    below = _before(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_cnt")), "_cnt", "_off")
    inside = F.row_number().over(W.partitionBy("_range").orderBy("_key"))
    return (ranged.withColumn("_loc", inside).join(F.broadcast(below), "_range")
                  .withColumn(name, (F.col("_off") + F.col("_loc") - 1).cast("bigint")).drop("_range", "_key", "_loc", "_off"))


def index_within_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                       name: str = "idx_in_group") -> DataFrame:
    """0-based position inside each group; a hot group is spread over many ranges."""
    group = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)]
    names = [f"_g{i}" for i in range(len(group))]
    ranged = _ranged(df, [*group_cols, *order_cols], _n_ranges(df)).select("*", *group)
    below = _before(ranged.groupBy(*names, "_range").agg(F.count(F.lit(1)).alias("_cnt")), "_cnt", "_off", by=names)
    below = below.filter("_off > 0").withColumnsRenamed({c: f"{c}x" for c in names}).withColumnRenamed("_range", "_rangex")
    inside = F.row_number().over(W.partitionBy("_range", *names).orderBy("_key"))
    on = F.col("_range") == F.col("_rangex")
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}x"))
    return (ranged.withColumn("_loc", inside).join(below, on, "left")
                  .withColumn(name, (F.coalesce("_off", F.lit(0)) + F.col("_loc") - 1).cast("bigint"))
                  .drop("_range", "_rangex", "_key", "_loc", "_off", *names, *[f"{c}x" for c in names]))


def global_cumsum(df: DataFrame, order_cols: Sequence[str | Column], value: str | Column, name: str = "cumsum") -> DataFrame:
    """Inclusive running sum of ``value`` in the order."""
    given = df.withColumn("_v", F.col(value) if isinstance(value, str) else value)
    ranged = _ranged(given, order_cols, _n_ranges(df))
    below = _before(ranged.groupBy("_range").agg(F.sum("_v").alias("_tot")), "_tot", "_off")
    inside = F.sum("_v").over(W.partitionBy("_range").orderBy("_key").rowsBetween(W.unboundedPreceding, W.currentRow))
    return (ranged.withColumn("_loc", inside).join(F.broadcast(below), "_range")
                  .withColumn(name, F.col("_off") + F.col("_loc")).drop("_range", "_key", "_v", "_loc", "_off"))


# Selection --------------------------------------------------------------------
def _cut(keyed: DataFrame, rank: int) -> tuple[DataFrame, int] | None:
    """(one row ``_cut``: the key of rank ``rank``, how many rows lie below that key); None beyond the last row.
    Each pass counts the rows of the open interval between PIVOTS of its keys and keeps the part that holds the rank."""
    part, below = keyed.select("_key"), 0
    while True:
        left = part.count()
        if rank - below >= left:
            return None
        if left <= TOP_N:
            near = part.orderBy("_key").limit(rank - below + 1)
            cut = near.agg(F.max("_key").alias("_cut"))
            equal = attach_scalars(near, cut).filter(F.col("_key") == F.col("_cut")).count()
            return cut, rank + 1 - equal
        # pivots are distinct keys of least hash, so that a frequent key counts once
        some = part.groupBy(F.pmod(F.xxhash64("_key"), F.lit(PIVOTS)).alias("g")).agg(F.min_by("_key", F.xxhash64("_key", F.lit(1))).alias("_key"))
        one = some.agg(F.sort_array(F.collect_list("_key")).alias("_p"))
        # even: between two pivots, odd: a pivot itself
        place = F.aggregate("_p", F.lit(0), lambda a, p: a + F.when(p < F.col("_key"), 2).when(p == F.col("_key"), 1).otherwise(0))
        placed = attach_scalars(part, one).withColumn("_at", place)
        for r in sorted(placed.groupBy("_at").count().collect()):  # at most 2 * PIVOTS + 1 rows
            if rank - below < r["count"]:
                break
            below += r["count"]
        inside = placed.filter(F.col("_at") == r["_at"]).select("_key")
        if r["_at"] % 2:  # all rows of the interval have one key
            return inside.limit(1).withColumnRenamed("_key", "_cut"), below
        part = inside


def _select(keyed: DataFrame, lo: int, hi: int) -> DataFrame:
    """Rows of ranks lo to hi - 1, by their keys against the boundary keys."""
    def equal(marked: DataFrame) -> DataFrame:
        return marked.filter(F.col("_key") == F.col("_cut")).drop("_cut")

    low, high = _cut(keyed, lo) if lo else None, _cut(keyed, hi)
    if lo and low is None:
        return keyed.limit(0)
    out, extra = keyed, None
    if low and lo > low[1]:  # some of the rows of the boundary key lie below
        marked = attach_scalars(keyed, low[0])
        same = equal(marked)
        end = hi - low[1]
        if high and high[1] == low[1]:
            return same.limit(hi - lo)
        extra = same.limit(min(same.count(), end) - (lo - low[1]))
        out = marked.filter(F.col("_key") > F.col("_cut")).drop("_cut")
    elif low:
        out = attach_scalars(keyed, low[0]).filter(F.col("_key") >= F.col("_cut")).drop("_cut")
    if high:
        marked = attach_scalars(out, high[0])
        out = marked.filter(F.col("_key") < F.col("_cut")).drop("_cut")
        if hi > high[1]:
            out = out.unionByName(equal(marked).limit(hi - max(high[1], lo)))
    return out if extra is None else out.unionByName(extra)


def rows_between(df: DataFrame, order_cols: Sequence[str | Column], lo: int, hi: int, name: str | None = None) -> DataFrame:
    """The rows of ranks ``lo`` to ``hi`` - 1, numbered by rank if ``name`` is given. The table is neither sorted nor
    copied. Of rows that share a boundary key as many are kept as the ranks say."""
    lo, hi = max(lo, 0), max(hi, lo, 0)
    keyed = df.withColumn("_key", _key(order_cols))
    if hi <= lo:
        out = keyed.limit(0)
    elif hi <= TOP_N:
        out = keyed.orderBy("_key").limit(hi)
        if lo:
            return _numbered(out.drop("_key"), order_cols, name, lo)
    else:
        out = _select(keyed, lo, hi)
    out = out.drop("_key")
    return out if name is None else global_index(out, order_cols, name).withColumn(name, F.col(name) + F.lit(lo).cast("bigint"))


def _numbered(first: DataFrame, order_cols: Sequence[str | Column], name: str | None, lo: int) -> DataFrame:
    ranked = global_index(first, order_cols, name or "_rank").filter(F.col(name or "_rank") >= lo)
    return ranked if name else ranked.drop("_rank")


def without_last(df: DataFrame, order_cols: Sequence[str | Column], m: int) -> DataFrame:
    """All rows but the last ``m`` of the order (m up to TOP_N: one bounded top-n of the keys from the end)."""
    if m <= 0:
        return df
    if m > TOP_N:
        return rows_between(df, order_cols, 0, df.count() - m)
    keyed = df.withColumn("_key", _key(order_cols))
    tail = keyed.select("_key").orderBy(F.desc("_key")).limit(m)
    cut = tail.agg(F.min("_key").alias("_cut"))
    marked = attach_scalars(keyed, cut)
    out = marked.filter(F.col("_key") < F.col("_cut")).drop("_cut", "_key")
    same = marked.filter(F.col("_key") == F.col("_cut"))
    left = same.count() - attach_scalars(tail, cut).filter(F.col("_key") == F.col("_cut")).count()
    return out.unionByName(same.limit(left).drop("_cut", "_key")) if left else out


def first_rows(df: DataFrame, order_cols: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of the order, unnumbered."""
    return rows_between(df, order_cols, 0, n)
