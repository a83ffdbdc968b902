"""Queries: shuffle, cursors, buffers, batch selection and set operations
(G1-G9, C8, S1, S2, D1, D2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups as G, sampling as S
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W
from ..sources.tables import read_table
from .ranking import global_index
from .registry import register

SEED = 42
KEY_SQL = "((question_id * 1103515245 + ({s} * 7919 + 12345)) % 2147483648)"


def key_sql(epoch: int) -> str:
    return KEY_SQL.format(s=SEED + epoch)


# G1 -------------------------------------------------------------------------
@register("epoch_shuffle", W(f"""
SELECT question_id, row_number() OVER (ORDER BY {key_sql(3)}, question_id) - 1 AS "rank" FROM prompts""", "prompts"))
def q_epoch_shuffle(spark, sf):
    p = FX.prompts(spark, sf).select("question_id")
    return S.epoch_shuffle(p, id_col="question_id", seed=SEED, epoch=3).select("question_id", "rank")


# G2 -------------------------------------------------------------------------
@register("next_batch", W(f"""
, n AS (SELECT count(*) AS n FROM prompts),
r AS (SELECT question_id, 1 AS epoch, row_number() OVER (ORDER BY {key_sql(1)}, question_id) - 1 AS "rank" FROM prompts
      UNION ALL
      SELECT question_id, 2 AS epoch, row_number() OVER (ORDER BY {key_sql(2)}, question_id) - 1 AS "rank" FROM prompts)
SELECT question_id, CAST(epoch AS INTEGER) AS epoch, "rank", CAST(epoch * n + "rank" - (2 * n - 37) AS BIGINT) AS batch_pos
FROM r, n WHERE epoch * n + "rank" >= 2 * n - 37 AND epoch * n + "rank" < 2 * n - 37 + 100""", "prompts"))
def q_next_batch(spark, sf):
    p = FX.prompts(spark, sf).select("question_id")
    n = p.count()
    b = S.next_batch(p, id_col="question_id", seed=SEED, offset=2 * n - 37, n=100, total=n)
    return b.select("question_id", F.col("epoch").cast("int"), "rank", F.col("batch_pos").cast("bigint"))


# G3 -------------------------------------------------------------------------
@register("pop_first", W("""
, b AS (SELECT instance_id, row_number() OVER (ORDER BY min(ts), instance_id) - 1 AS r FROM buffer_items GROUP BY instance_id),
bk AS (SELECT instance_id, 'buffer' AS source, r AS slot FROM b WHERE r < 200),
k AS (SELECT count(*) AS k FROM bk),
d AS (SELECT question_id AS instance_id, row_number() OVER (ORDER BY question_id) - 1 AS r FROM prompts)
SELECT * FROM bk
UNION ALL
SELECT instance_id, 'dataset' AS source, r + k AS slot FROM d, k WHERE r < 200 - k""", "buffer_items", "prompts"))
def q_pop_first(spark, sf):
    buf = FX.buffer_items(spark, sf)
    ds = FX.prompts(spark, sf).select(F.col("question_id").alias("instance_id"))
    return S.pop_first(buf, ds, 200, arrival_cols=["ts"], group_col="instance_id", dataset_order=["instance_id"])


# G4 -------------------------------------------------------------------------
@register("newest_groups", W("""
, g AS (SELECT instance_id, coalesce(max(epoch_us(ts) / 1e6), 0.0) AS group_ts FROM buffer_items GROUP BY instance_id),
t AS (SELECT * FROM g ORDER BY group_ts DESC, instance_id LIMIT 10)
SELECT b.instance_id, b.uid, t.group_ts FROM buffer_items b JOIN t ON b.instance_id = t.instance_id""", "buffer_items"))
def q_newest_groups(spark, sf):
    b = FX.buffer_items(spark, sf)
    out = S.newest_groups(b, 10, group_col="instance_id", ts=F.unix_micros("ts") / 1e6)
    return out.select("instance_id", "uid", "group_ts")


# G5 -------------------------------------------------------------------------
_GROUPS_SQL = """
, gk AS (SELECT group_index, max(finished_at) AS done_at, count(*) >= 2 AND max(reward) > min(reward) AS keep
         FROM samples GROUP BY group_index)
"""


def _groups(spark, sf):
    s = FX.samples(spark, sf)
    st = G.group_stats(s, ("group_index",))
    return (s.groupBy("group_index").agg(F.max("finished_at").alias("done_at"))
             .join(st.select("group_index", ((F.col("_gs_n") >= 2) & (F.col("_gs_max") > F.col("_gs_min"))).alias("keep")),
                   "group_index"))


@register("accept_first_n", W(_GROUPS_SQL + """
, f AS (SELECT group_index FROM (SELECT group_index, row_number() OVER (ORDER BY done_at, group_index) AS k
                                 FROM gk WHERE keep) WHERE k <= 500)
SELECT group_index, row_number() OVER (ORDER BY group_index) - 1 AS pos FROM f""", "samples"))
def q_accept_first_n(spark, sf):
    out = S.accept_first_n(_groups(spark, sf), 500, keep_col="keep", completion_cols=["done_at", "group_index"],
                           index_col="group_index")
    return out.select("group_index", "pos")


# G6 -------------------------------------------------------------------------
@register("oversampling_report", W(_GROUPS_SQL + """
, r AS (SELECT *, (row_number() OVER (ORDER BY group_index) - 1) // 64 AS block FROM gk),
p AS (SELECT block, count(*) FILTER (WHERE keep) AS kept, count(*) FILTER (WHERE NOT keep) AS dropped FROM r GROUP BY block),
c AS (SELECT *, sum(kept) OVER (ORDER BY block) - kept AS before FROM p)
SELECT CAST(block AS BIGINT) AS block, CAST(kept AS BIGINT) AS kept, CAST(dropped AS BIGINT) AS dropped,
       CAST(greatest(least(kept, 500 - before), 0) AS BIGINT) AS accepted,
       CAST(greatest(kept - greatest(500 - before, 0), 0) AS BIGINT) AS surplus, before < 500 AS used
FROM c""", "samples"))
def q_oversampling_report(spark, sf):
    out = S.oversampling_report(_groups(spark, sf), n=500, block_size=64, keep_col="keep", submit_cols=["group_index"])
    return out.select(F.col("block").cast("bigint"), F.col("kept").cast("bigint"), F.col("dropped").cast("bigint"),
                      F.col("accepted").cast("bigint"), F.col("surplus").cast("bigint"), "used")


# G7 -------------------------------------------------------------------------
@register("train_test_split", W(f"""
SELECT question_id, CASE WHEN r < 600 THEN 'train' ELSE 'test' END AS split
FROM (SELECT question_id, row_number() OVER (ORDER BY {key_sql(0)}, question_id) - 1 AS r FROM prompts) x
WHERE r < 700""", "prompts"))
def q_train_test_split(spark, sf):
    p = FX.prompts(spark, sf).select("question_id")
    return S.train_test_split(p, id_col="question_id", seed=SEED, n_train=600, n_val=100).select("question_id", "split")


# G8 -------------------------------------------------------------------------
@register("sort_by_index", W("""
SELECT group_index, idx_in_group, row_number() OVER (ORDER BY group_index, idx_in_group) - 1 AS pos FROM samples""",
    "samples"))
def q_sort_by_index(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group")
    return global_index(s, ["group_index", "idx_in_group"], "pos")


# G9 -------------------------------------------------------------------------
@register("round_robin_shard", W("""
SELECT group_index, idx_in_group, CAST((row_number() OVER (ORDER BY group_index, idx_in_group) - 1) % 8 AS INTEGER) AS dp_rank
FROM samples""", "samples"))
def q_round_robin_shard(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group")
    return S.round_robin_shard(s, 8, order_cols=["group_index", "idx_in_group"])


# C8 -------------------------------------------------------------------------
@register("trim_to_batch", W("""
SELECT group_index, idx_in_group FROM (
  SELECT group_index, idx_in_group, row_number() OVER (ORDER BY group_index, idx_in_group) - 1 AS i,
         count(*) OVER () AS n FROM samples) x
WHERE i < (n // 256) * 256""", "samples"))
def q_trim_to_batch(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group")
    return S.trim_to_batch(s, 256, order_cols=["group_index", "idx_in_group"])


# S1 / D1 ----------------------------------------------------------------------
_DUMPS_SQL = """
, nd AS (SELECT count(*) AS nd FROM documents),
da AS (SELECT group_index % nd AS question_id, reward FROM samples, nd WHERE status = 'completed'),
db AS (SELECT group_index % nd AS question_id, reward FROM samples, nd WHERE status = 'truncated')
"""


def _dumps(spark, sf):
    s = FX.samples(spark, sf)
    nd = read_table(spark, sf, "documents").count()   # bounded scalar
    qid = (F.col("group_index") % nd).alias("question_id")
    return (s.filter(F.col("status") == "completed").select(qid, "reward"),
            s.filter(F.col("status") == "truncated").select(qid, "reward"))


@register("union_question_ids", W(_DUMPS_SQL + """
SELECT question_id FROM da UNION SELECT question_id FROM db""", "samples"))
def q_union_question_ids(spark, sf):
    a, b = _dumps(spark, sf)
    return S.union_question_ids(a, b)


@register("solvable_semi_join", W(_DUMPS_SQL + """
SELECT question_id FROM prompts WHERE question_id IN (
  SELECT question_id FROM (SELECT * FROM da UNION ALL SELECT * FROM db) u GROUP BY question_id HAVING avg(reward) > 0)""",
    "samples", "prompts"))
def q_solvable_semi_join(spark, sf):
    a, b = _dumps(spark, sf)
    return S.solvable_semi_join(FX.prompts(spark, sf), [a, b]).select("question_id")


# D2 -------------------------------------------------------------------------
@register("skip_anti_join", W("""
, sk AS (SELECT user_id AS instance_id, count(*) AS skip FROM events WHERE event_type = 'signup' GROUP BY user_id),
o AS (SELECT uid, instance_id, row_number() OVER (PARTITION BY instance_id ORDER BY ts, uid) - 1 AS occ FROM buffer_items)
SELECT uid, instance_id FROM o LEFT JOIN sk USING (instance_id) WHERE occ >= coalesce(skip, 0)""", "buffer_items"))
def q_skip_anti_join(spark, sf):
    items = FX.buffer_items(spark, sf)
    skips = read_table(spark, sf, "events").filter(F.col("event_type") == "signup") \
        .select(F.col("user_id").alias("instance_id"))
    return S.skip_anti_join(items, skips, id_col="instance_id", read_order=["ts", "uid"]).select("uid", "instance_id")


# S2 -------------------------------------------------------------------------
@register("flatten_groups", W("""
SELECT group_index, idx_in_group, reward FROM samples""", "samples"))
def q_flatten_groups(spark, sf):
    s = FX.samples(spark, sf)
    # groups of n samples as nested rows (bounded by n), then flattened back
    nested = s.groupBy("group_index").agg(F.collect_list(F.struct("idx_in_group", "reward")).alias("samples"))
    return nested.select("group_index", F.explode("samples").alias("s")).select("group_index", "s.idx_in_group", "s.reward")
