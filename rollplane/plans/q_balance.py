"""Queries: balancing and scheduling.

First fit, lightest part and byte buckets have twins that fold each batch by
recursion; the differencing partitions are checked by reports (``q_more``) of
what every right assignment has in common and by ``tests/test_balance.py``.
Batches are the training steps of the samples table: 256 samples in the
global (group_index, idx_in_group) order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import balance as B
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W
from .ranking import global_index
from .registry import register

STEP = 256

_LISTS = """
, o AS (SELECT response_length AS l, row_number() OVER (ORDER BY group_index, idx_in_group) - 1 AS row_idx FROM samples),
b AS (SELECT row_idx // 256 AS batch, list(l ORDER BY row_idx) AS ls, list(row_idx ORDER BY row_idx) AS ids FROM o GROUP BY 1)
"""


def _fold(sql: str) -> str:
    """A twin that walks each batch's list by recursion."""
    return W(_LISTS + sql, "samples").replace("WITH ", "WITH RECURSIVE ", 1)


_GREEDY = _fold("""
, f AS (SELECT batch, ls, ids, 0 AS i, list_transform(range(8), lambda x: 0::BIGINT) AS s, []::INTEGER[] AS part FROM b
  UNION ALL SELECT batch, ls, ids, i + 1, list_concat(list_concat(s[:p - 1], [s[p] + ls[i + 1]]), s[p + 1:]),
                   list_append(part, CAST(p - 1 AS INTEGER))
  FROM (SELECT *, list_position(s, list_min(s)) AS p FROM f WHERE i < len(ls)) z)
SELECT batch, unnest(ids) AS row_idx, unnest(part) AS part FROM f WHERE i = len(ls)""")
_FIRST_FIT = _fold("""
, f AS (SELECT batch, ls, 0 AS i, []::BIGINT[] AS s FROM b
  UNION ALL SELECT batch, ls, i + 1, CASE WHEN coalesce(p, 0) = 0 THEN list_append(s, x)
                                          ELSE list_concat(list_concat(s[:p - 1], [s[p] + x]), s[p + 1:]) END
  FROM (SELECT *, ls[i + 1] AS x, list_position(list_transform(s, lambda v: v + ls[i + 1] <= 600), true) AS p FROM f WHERE i < len(ls)) z)
SELECT batch, CAST(len(s) AS INTEGER) AS num_microbatches FROM f WHERE i = len(ls)""")
_BYTES = _fold("""
, f AS (SELECT batch, ls, ids, 0 AS i, 0 AS k, 0::BIGINT AS load, []::INTEGER[] AS bucket FROM b
  UNION ALL SELECT batch, ls, ids, i + 1, k2, CASE WHEN k2 > k THEN x ELSE load + x END, list_append(bucket, k2)
  FROM (SELECT *, ls[i + 1] AS x, CASE WHEN load > 0 AND load + ls[i + 1] >= 400 THEN k + 1 ELSE k END AS k2 FROM f WHERE i < len(ls)) z)
SELECT batch, unnest(ids) AS row_idx, unnest(bucket) AS bucket FROM f WHERE i = len(ls)""")



def _ordered(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group", "response_length")
    g = global_index(s, ["group_index", "idx_in_group"], "row_idx")
    return g.withColumn("batch", F.floor(F.col("row_idx") / STEP).cast("bigint"))


def _batch_lists(spark, sf):
    g = _ordered(spark, sf)
    return g.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("row_idx", "response_length"))).alias("_l"))


@register("balanced_partitions")
def q_balanced_partitions(spark, sf):
    g = _ordered(spark, sf)
    return B.balanced_partitions(g, batch_cols=["batch"], item_col="row_idx", length_col="response_length", k=8)


@register("greedy_partitions", _GREEDY)
def q_greedy_partitions(spark, sf):
    b = _batch_lists(spark, sf)
    lens = F.transform("_l", lambda e: e["response_length"])
    b = b.select("batch", "_l", B.greedy_assign(lens, 8).alias("_part"))
    z = b.select("batch", F.arrays_zip(F.transform("_l", lambda e: e["row_idx"]).alias("row_idx"),
                                       F.col("_part").alias("part")).alias("z"))
    return z.select("batch", F.explode("z").alias("e")).select("batch", "e.row_idx", "e.part")


@register("first_fit_count", _FIRST_FIT)
def q_first_fit_count(spark, sf):
    b = _batch_lists(spark, sf)
    lens = F.transform("_l", lambda e: e["response_length"])
    return b.select("batch", B.first_fit_count(lens, 600).alias("num_microbatches"))


@register("chunk_by_bytes", _BYTES)
def q_chunk_by_bytes(spark, sf):
    b = _batch_lists(spark, sf)
    lens = F.transform("_l", lambda e: e["response_length"])
    z = b.select("batch", F.arrays_zip(F.transform("_l", lambda e: e["row_idx"]).alias("row_idx"),
                                       B.byte_buckets(lens, 400).alias("bucket")).alias("z"))
    return z.select("batch", F.explode("z").alias("e")).select("batch", "e.row_idx", "e.bucket")


@register("group_balance_shard")
def q_group_balance_shard(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group", "response_length")
    # whole batches of 64 groups only (the step is trimmed as in C8)
    from ..operators.sampling import trim_to_batch
    groups = global_index(trim_to_batch(s.select("group_index").distinct(), 64, order_cols=["group_index"]),
                          ["group_index"], "g_idx")
    s = s.join(groups.withColumn("batch", F.floor(F.col("g_idx") / 64).cast("bigint")), "group_index")
    out = B.group_balance_shard(s, batch_cols=["batch"], group_col="group_index", length_col="response_length",
                                dp_size=4)
    return out.select("batch", "group_index", "idx_in_group", "dp_rank")


@register("microbatch_schedule")
def q_microbatch_schedule(spark, sf):
    from ..operators.sampling import trim_to_batch
    # whole steps only, as training does
    g = trim_to_batch(FX.samples(spark, sf).select("group_index", "idx_in_group", "response_length"), 512, order_cols=["group_index", "idx_in_group"])
    g = global_index(g, ["group_index", "idx_in_group"], "row_idx")
    return B.microbatch_schedule(g, order_col="row_idx", length_col="response_length", global_batch=512,
                                 dp_size=4, max_tokens=300)


@register("fixed_microbatches", W("""
, o AS (SELECT group_index, idx_in_group, row_number() OVER (ORDER BY group_index, idx_in_group) - 1 AS i FROM samples)
SELECT group_index, idx_in_group, i // 512 AS step, CAST((i % 512) % 4 AS INTEGER) AS dp_rank,
       CAST(((i % 512) // 4) // 12 AS INTEGER) AS microbatch, CAST(11 AS INTEGER) AS num_microbatches FROM o""", "samples"))
def q_fixed_microbatches(spark, sf):
    m = B.fixed_microbatches(_ordered(spark, sf), order_col="row_idx", global_batch=512, dp_size=4, micro_batch=12)
    return m.select("group_index", "idx_in_group", "step", "dp_rank", "microbatch", "num_microbatches")


# every item once, and as many parts as the tokens need
@register("pack_by_budget_report", W(f"""
, o AS (SELECT response_length, (row_number() OVER (ORDER BY group_index, idx_in_group) - 1) // {STEP} AS batch FROM samples)
SELECT batch, count(*) AS n_items, CAST(sum(response_length) AS BIGINT) AS tokens,
       least(count(*), CAST(ceil(sum(response_length) / 1000.0) AS BIGINT)) AS n_parts FROM o GROUP BY batch""", "samples"))
def q_pack_by_budget_report(spark, sf):
    g = _ordered(spark, sf)
    parts = B.balanced_partitions(g, batch_cols=["batch"], item_col="row_idx", length_col="response_length", max_tokens=1000)
    j = parts.join(g.select("batch", "row_idx", "response_length"), ["batch", "row_idx"])
    return j.groupBy("batch").agg(F.count_distinct("row_idx").alias("n_items"), F.sum("response_length").cast("long").alias("tokens"),
                                  F.count_distinct("part").alias("n_parts"))
