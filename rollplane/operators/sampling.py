"""Prompt ordering, epoch cursors, buffers and batch selection (G1-G9, C8,
S1-S4, D1, D2).

Positions in a total order come from ``plans.ranking`` (ranges counted, then
numbered), never from an unpartitioned window; taking n rows selects them
without ranking the table; only bounded scalars (a row count) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ranking import first_rows, global_cumsum, global_index, index_within_group, rows_between, without_last

# Integer LCG used as the seeded shuffle key (a bijection on
# ids below 2**31; larger ids share keys by their remainder and follow each other by id).
LCG_A, LCG_C, LCG_M = 1103515245, 12345, 2147483648


def shuffle_key(id_col: Column | str, seed: int, epoch: int) -> Column:
    """G1 order key of an id for ``seed + epoch``; always computed from the
    original id, so a shuffle is idempotent per epoch."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    small = F.pmod(c.cast("long"), F.lit(LCG_M))  # the product stays inside a long
    return F.pmod(small * F.lit(LCG_A) + F.lit((seed + epoch) * 7919 + LCG_C), F.lit(LCG_M))


def epoch_shuffle(df: DataFrame, *, id_col: str, seed: int, epoch: int, shuffle: bool = True,
                  out_col: str = "rank") -> DataFrame:
    """Position of every row in the epoch's order (hash order, id ties)."""
    return global_index(df, _epoch_order(id_col, seed, epoch, shuffle), out_col)


def _epoch_order(id_col: str, seed: int, epoch: int, shuffle: bool = True) -> list[Column]:
    return [shuffle_key(id_col, seed, epoch), F.col(id_col)] if shuffle else [F.col(id_col)]


def next_batch(df: DataFrame, *, id_col: str, seed: int, offset: int, n: int, shuffle: bool = True,
               total: int | None = None) -> DataFrame:
    """Rows at global positions ``offset .. offset+n-1`` where position =
    epoch * N + rank in that epoch's order; crossing the end continues in
    the next epoch's order (always n rows).  Returns epoch, rank and
    ``batch_pos`` (0..n-1)."""
    total = total if total is not None else df.count()   # one bounded scalar
    e0, e1 = offset // total, (offset + n - 1) // total
    parts = []
    for e in range(e0, e1 + 1):
        lo = max(offset - e * total, 0)
        hi = min(offset + n - e * total, total)
        parts.append(rows_between(df, _epoch_order(id_col, seed, e, shuffle), lo, hi, "rank")
                      .withColumn("epoch", F.lit(e))
                      .withColumn("batch_pos", F.col("rank") + F.lit(e * total - offset)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cursor_after(offset: int, n: int, total: int) -> dict:
    """Cursor state after ``next_batch`` (sample_offset, epoch_id)."""
    end = offset + n
    return {"sample_offset": end % total, "epoch_id": end // total}


# G3 -------------------------------------------------------------------------
def pop_first(buffer: DataFrame, dataset: DataFrame, n: int, *, arrival_cols: Sequence[str],
              group_col: str, dataset_order: Sequence[str]) -> DataFrame:
    """Take up to n groups from the buffer in arrival order, the rest from
    the dataset in its order; ``source`` tells which."""
    g = buffer.groupBy(group_col).agg(*[F.min(c).alias(c) for c in arrival_cols])
    from_buf = rows_between(g, list(arrival_cols) + [group_col], 0, n, "slot").select(
        group_col, F.lit("buffer").alias("source"), "slot")
    k = min(n, g.count())   # one bounded scalar
    rest = rows_between(dataset, dataset_order, 0, n - k, "_r").select(
        F.col(group_col), F.lit("dataset").alias("source"), (F.col("_r") + k).alias("slot"))
    return from_buf.unionByName(rest)


# G4 -------------------------------------------------------------------------
def newest_groups(items: DataFrame, n: int, *, group_col: str = "instance_id", ts: Column) -> DataFrame:
    """Group time = max item time (missing -> 0); keep the items of the n
    newest groups (ties: smaller group id first).  ``n`` bounds the
    broadcast side of the semi join."""
    gt = items.groupBy(group_col).agg(F.coalesce(F.max(ts), F.lit(0.0)).alias("group_ts"))
    top = gt.orderBy(F.col("group_ts").desc(), F.col(group_col)).limit(n)
    return items.join(F.broadcast(top), group_col, "left_semi").join(gt, group_col)


# G5 -------------------------------------------------------------------------
def accept_first_n(groups: DataFrame, n: int, *, keep_col: str, completion_cols: Sequence[str],
                   index_col: str) -> DataFrame:
    """First n kept groups in completion order, returned with their rank in
    sample-index order (``pos``)."""
    return global_index(first_rows(groups.filter(F.col(keep_col)), list(completion_cols), n), [index_col], "pos")


# G6 -------------------------------------------------------------------------
def oversampling_report(groups: DataFrame, *, n: int, block_size: int, keep_col: str,
                        submit_cols: Sequence[str]) -> DataFrame:
    """Prompts are submitted in blocks of ``block_size`` until n groups are
    kept: per block kept / dropped / accepted / surplus and whether the
    block was needed."""
    r = global_index(groups, list(submit_cols), "_s").withColumn("block", F.floor(F.col("_s") / block_size))
    per = r.groupBy("block").agg(F.count_if(F.col(keep_col)).alias("kept"),
                                 F.count_if(~F.col(keep_col)).alias("dropped"))
    cum = global_cumsum(per, ["block"], "kept", "kept_cum")
    before = F.col("kept_cum") - F.col("kept")
    return cum.select("block", "kept", "dropped",
                      F.greatest(F.least(F.col("kept"), F.lit(n) - before), F.lit(0)).alias("accepted"),
                      F.greatest(F.col("kept") - F.greatest(F.lit(n) - before, F.lit(0)), F.lit(0)).alias("surplus"),
                      (before < n).alias("used"))


# G7 -------------------------------------------------------------------------
def train_test_split(df: DataFrame, *, id_col: str, seed: int, n_train: int, n_val: int) -> DataFrame:
    """Shuffle, keep the first n_train + n_val rows; the last n_val of those
    are the test split."""
    r = rows_between(df, _epoch_order(id_col, seed, 0), 0, n_train + n_val, "rank")
    return r.withColumn("split", F.when(F.col("rank") < n_train, "train").otherwise("test"))


# G9 -------------------------------------------------------------------------
def round_robin_shard(df: DataFrame, dp: int, *, order_cols: Sequence[str]) -> DataFrame:
    """Rank r takes rows r, r+dp, ... of the order."""
    g = global_index(df, order_cols, "_rr")
    return g.withColumn("dp_rank", F.pmod(F.col("_rr"), F.lit(dp)).cast("int")).drop("_rr")


# C8 -------------------------------------------------------------------------
def trim_to_batch(df: DataFrame, batch: int, *, order_cols: Sequence[str]) -> DataFrame:
    """Keep the first floor(n / batch) * batch rows of the order."""
    n = df.count()   # one bounded scalar
    return without_last(df, order_cols, n % batch)


# D1 / S1 ----------------------------------------------------------------------
def union_question_ids(*dumps: DataFrame, id_col: str = "question_id") -> DataFrame:
    out = dumps[0].select(id_col)
    for d in dumps[1:]:
        out = out.union(d.select(id_col))
    return out.distinct()


def solvable_semi_join(prompts: DataFrame, dumps: Sequence[DataFrame], *, id_col: str = "question_id",
                       reward_col: str = "reward") -> DataFrame:
    """Keep prompts whose mean reward over all past dumps is > 0 (dumps with
    differing columns are unioned by name)."""
    u = dumps[0].select(id_col, reward_col)
    for d in dumps[1:]:
        u = u.unionByName(d.select(id_col, reward_col))
    good = u.groupBy(id_col).agg(F.avg(reward_col).alias("_m")).filter(F.col("_m") > 0).select(id_col)
    return prompts.join(good, id_col, "left_semi")


# D2 -------------------------------------------------------------------------
def skip_anti_join(items: DataFrame, skips: DataFrame, *, id_col: str, read_order: Sequence[str],
                   n_repeat: int = 1) -> DataFrame:
    """Skip each listed id as many times as it is listed (x n_repeat), in
    read order; later occurrences pass."""
    cnt = skips.groupBy(id_col).agg((F.count(F.lit(1)) * n_repeat).alias("_skip"))
    occ = index_within_group(items, [id_col], list(read_order), "_occ")
    return (occ.join(cnt, id_col, "left")
               .filter(F.col("_occ") >= F.coalesce(F.col("_skip"), F.lit(0)))
               .drop("_occ", "_skip"))
