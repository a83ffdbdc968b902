"""Queries: evaluation summaries and reductions (E7, E8, E14-E16, E20, S3,
C10, C11), sinks and dumps (A3/A4, A8, A9), sample projections (B24, B25,
T25), joins (D8, D10), buffer id union (S4) and the hook surface (X1, X2,
X4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import groups as G, hooks as H, metrics as M, prompts as P
from ..sources import fixtures as FX, io
from ..sources.fixtures import with_fixtures as W
from ..sources.tables import read_table
from ..streaming.buffer import run_dir
from .ranking import global_index
from .q_grading import F1_FROM_PARTS, f1_sql_subquery
from .registry import r6, register

MONTH_SQL = "((year(finished_at) - 1992) * 12 + month(finished_at) - 1)"


def _month(c="finished_at"):
    return ((F.year(c) - 1992) * 12 + F.month(c) - 1).cast("int")


def _with_priority(spark, sf, df):
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("group_index"),
                                               F.col("o_orderpriority").alias("dataset"))
    return df.join(o, "group_index")


# E8 -------------------------------------------------------------------------
_EVAL_SQL = """
, ev AS (SELECT o.o_orderpriority AS dataset, s.* FROM samples s JOIN orders o ON s.group_index = o.o_orderkey),
w AS (SELECT dataset, avg(reward) AS reward, avg(CASE WHEN status = 'truncated' THEN 1.0 ELSE 0.0 END) AS truncated_ratio,
             avg(response_length) AS response_len_mean FROM ev GROUP BY dataset),
lg AS (SELECT dataset, 'eval/' || dataset || '/reward' AS key, reward AS value FROM w
       UNION ALL SELECT dataset, 'eval/' || dataset || '/truncated_ratio', truncated_ratio FROM w
       UNION ALL SELECT dataset, 'eval/' || dataset || '/response_len_mean', response_len_mean FROM w)
"""


def _eval_long(spark, sf):
    s = _with_priority(spark, sf, FX.samples(spark, sf))
    return M.eval_summary(s, dataset_col="dataset", reward=F.col("reward"), length=F.col("response_length"))


@register("eval_summary", W(_EVAL_SQL + "SELECT dataset, key, round(value, 6) AS value FROM lg", "samples"))
def q_eval_summary(spark, sf):
    return _eval_long(spark, sf).select("dataset", "key", r6("value").alias("value"))


# S3 -------------------------------------------------------------------------
@register("merge_eval_sets", W(_EVAL_SQL + """
, n4 AS (SELECT o.o_orderpriority AS dataset, s.* FROM samples s JOIN orders o ON s.group_index = o.o_orderkey),
pg AS (SELECT dataset, group_index, count(*) AS n, count(*) FILTER (WHERE reward = 1) AS c FROM n4 GROUP BY ALL),
pk AS (SELECT dataset, 'eval/' || dataset || '/pass@' || CAST(k AS VARCHAR) AS key,
              avg(CASE WHEN n - c < k THEN 1.0 WHEN c = 0 THEN 0.0
                       ELSE 1.0 - list_reduce(list_transform(range(n - c + 1, n + 1), lambda i: 1.0 - k / i),
                                              lambda a, b: a * b, 1.0) END) AS value
       FROM pg, (SELECT unnest([1, 2, 4]) AS k) ks GROUP BY dataset, k)
SELECT dataset, key, round(value, 6) AS value FROM lg UNION ALL SELECT dataset, key, round(value, 6) FROM pk""",
    "samples"))
def q_merge_eval_sets(spark, sf):
    summary = _eval_long(spark, sf)
    n4 = _with_priority(spark, sf, FX.samples(spark, sf))
    pk = M.pass_at_k(n4, group_cols=["group_index"], n=4, extra_keys=["dataset"], allow_uneven=True)
    pk = pk.select("dataset", F.concat(F.lit("eval/"), F.col("dataset"), F.lit("/pass@"), F.col("k").cast("string"))
                   .alias("key"), F.col("pass_at_k").alias("value"))
    return summary.unionByName(pk).select("dataset", "key", r6("value").alias("value"))


# C10 ------------------------------------------------------------------------
@register("metric_gate", W(_EVAL_SQL + """
SELECT bool_or(value >= 0.34) AS passed, round(max(value), 6) AS best FROM lg WHERE key LIKE '%/reward'""", "samples"))
def q_metric_gate(spark, sf):
    lg = _eval_long(spark, sf).withColumn("name", F.regexp_extract("key", r"([^/]+)$", 1))
    g = M.metric_gate(lg, key="reward", key_col="name", threshold=0.34)
    return g.select("passed", r6("best").alias("best"))


# E14 ------------------------------------------------------------------------
@register("rank_mean_reduce", W("""
, s AS (SELECT group_index, idx_in_group, sum(lp * m) / greatest(sum(m), 1) AS v FROM tok GROUP BY ALL),
r AS (SELECT (row_number() OVER (ORDER BY group_index, idx_in_group) - 1) % 8 AS dp_rank, v FROM s),
pr AS (SELECT dp_rank, avg(v) AS m, count(*) AS n FROM r GROUP BY dp_rank)
SELECT round(avg(m), 6) AS mean_of_means, round(sum(m * n) / sum(n), 6) AS weighted_mean FROM pr""", "tok"))
def q_rank_mean_reduce(spark, sf):
    t = FX.token_rows(spark, sf).select("group_index", "idx_in_group", A.mmean("log_probs", "loss_mask").alias("v"))
    t = global_index(t, ["group_index", "idx_in_group"], "i").withColumn("dp_rank", F.pmod("i", F.lit(8)))
    a = M.rank_mean_reduce(t, rank_col="dp_rank", value=F.col("v")).withColumnRenamed("value", "mean_of_means")
    b = M.rank_mean_reduce(t, rank_col="dp_rank", value=F.col("v"), weighted=True).withColumnRenamed("value", "weighted_mean")
    from .ordering import attach_scalars
    return attach_scalars(a, b).select(r6("mean_of_means").alias("mean_of_means"),
                                       r6("weighted_mean").alias("weighted_mean"))


# E15 / A9 ----------------------------------------------------------------------
_STEP_SQL = """
, s AS (SELECT group_index, idx_in_group, sum(lp * m) AS lps, sum((lp - rlp) * m) AS kls, sum(m) AS n FROM tok GROUP BY ALL),
st AS (SELECT (row_number() OVER (ORDER BY group_index, idx_in_group) - 1) // 256 AS step, * FROM s),
red AS (SELECT step, sum(lps) / sum(n) AS log_probs, sum(kls) / sum(n) AS kl FROM st GROUP BY step)
"""


def _step_reduce(spark, sf):
    t = FX.token_rows(spark, sf).select("group_index", "idx_in_group",
                                         A.msum("log_probs", "loss_mask").alias("lps"),
                                         A.msum(F.zip_with("log_probs", "ref_log_probs", lambda a, b: a - b), "loss_mask").alias("kls"),
                                         A.mcount("loss_mask").alias("n"))
    t = global_index(t, ["group_index", "idx_in_group"], "i").withColumn("step", F.floor(F.col("i") / 256).cast("bigint"))
    return M.step_metric_reduce(t, step_col="step", metrics={"log_probs": F.col("lps"), "kl": F.col("kls")},
                                denom=F.col("n"))


@register("step_metric_reduce", W(_STEP_SQL + """
SELECT step, round(log_probs, 6) AS log_probs, round(kl, 6) AS kl FROM red""", "tok"))
def q_step_metric_reduce(spark, sf):
    return _step_reduce(spark, sf).select("step", r6("log_probs").alias("log_probs"), r6("kl").alias("kl"))


@register("metrics_sink", W(_STEP_SQL + """
SELECT step, 'train/log_probs' AS key, round(log_probs, 6) AS value FROM red
UNION ALL SELECT step, 'train/kl', round(kl, 6) FROM red""", "tok"))
def q_metrics_sink(spark, sf):
    reduced, path = _step_reduce(spark, sf), run_dir(spark, "metrics")
    kind = reduced.schema["step"].dataType
    for _ in range(2):  # a repeated write replaces the first
        io.metrics_sink(reduced, path, step_col="step", prefix="train/")
    return spark.read.parquet(path).select(F.col("step").cast(kind).alias("step"), "key", r6("value").alias("value"))


# E16 ------------------------------------------------------------------------
@register("throughput", W("""
SELECT CAST(year(finished_at) AS INTEGER) AS rollout_id, round(max(response_length) / 100.0, 6) AS longest_sample_tokens_per_sec,
       round(sum(response_length) / 100.0 / 8, 6) AS tokens_per_gpu_per_sec
FROM samples GROUP BY 1""", "samples"))
def q_throughput(spark, sf):
    s = FX.samples(spark, sf).withColumn("rollout_id", F.year("finished_at"))
    t = M.throughput(s, rollout_col="rollout_id", length=F.col("response_length"), rollout_time=100.0, num_gpus=8)
    return t.select("rollout_id", r6("longest_sample_tokens_per_sec").alias("longest_sample_tokens_per_sec"),
                    r6("tokens_per_gpu_per_sec").alias("tokens_per_gpu_per_sec"))


# E20 ------------------------------------------------------------------------
@register("weighted_meta_merge", W("""
, polls AS (SELECT CAST(ts AS DATE) AS poll, count(*) AS total_samples, avg(reward) AS avg_reward FROM buffer_items GROUP BY 1)
SELECT CAST(sum(total_samples) AS BIGINT) AS total_samples, round(sum(avg_reward * total_samples) / sum(total_samples), 6) AS avg_reward
FROM polls""", "buffer_items"))
def q_weighted_meta_merge(spark, sf):
    b = FX.buffer_items(spark, sf)
    polls = b.groupBy(F.to_date("ts").alias("poll")).agg(F.count(F.lit(1)).alias("total_samples"),
                                                         F.avg("reward").alias("avg_reward"))
    m = M.weighted_meta_merge(polls, keys=[], weight_col="total_samples", value_cols=["avg_reward"])
    return m.select(F.col("total_samples").cast("bigint"), r6("avg_reward").alias("avg_reward"))


# E7 -------------------------------------------------------------------------
@register("repetition_truncation")
def q_repetition_truncation(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", F.length("text").alias("n_chars"), M.has_repetition("text").alias("repetitive"))


# A8 -------------------------------------------------------------------------
@register("union_dumps", W("""
SELECT group_index, idx_in_group, reward, NULL::BIGINT AS response_length FROM samples WHERE status = 'completed'
UNION ALL
SELECT group_index, idx_in_group, reward, response_length FROM samples WHERE status <> 'completed'""", "samples"))
def q_union_dumps(spark, sf):
    s = FX.samples(spark, sf)
    a = s.filter(F.col("status") == "completed").select("group_index", "idx_in_group", "reward")
    b = s.filter(F.col("status") != "completed").select("group_index", "idx_in_group", "response_length",
                                                         F.col("reward").cast("float").alias("reward"))
    u = io.union_dumps([a, b])
    return u.select("group_index", "idx_in_group", F.col("reward").cast("double"), "response_length")


# A3 / A4 ----------------------------------------------------------------------
@register("load_dump_subsample", W(f"""
, d AS (SELECT *, {MONTH_SQL} AS rollout_id FROM samples),
r AS (SELECT *, row_number() OVER (PARTITION BY rollout_id ORDER BY group_index, idx_in_group) - 1 AS i,
             count(*) OVER (PARTITION BY rollout_id) AS n FROM d)
SELECT CAST(rollout_id AS INTEGER) AS rollout_id, group_index, idx_in_group FROM r
WHERE CAST(floor(n * 0.5) AS BIGINT) > 0
  AND (i < CAST(floor(n * 0.5) AS BIGINT) // 2 OR i >= n - (CAST(floor(n * 0.5) AS BIGINT) - CAST(floor(n * 0.5) AS BIGINT) // 2))""",
    "samples"))
def q_load_dump_subsample(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group", "reward", "status",
                                     _month().alias("rollout_id"), F.lit("train").alias("category"))
    path = run_dir(spark, "dumps")
    io.dump_samples(s, path, partition_by=("category", "rollout_id"))
    out = io.load_dump_subsample(spark, path, rollout_id=None, ratio=0.5, order_cols=["group_index", "idx_in_group"])
    return out.select(F.col("rollout_id").cast("int"), "group_index", "idx_in_group")


# B24 ------------------------------------------------------------------------
@register("sampling_seed", W("""
SELECT group_index, idx_in_group, 1234 + idx_in_group AS seed FROM samples""", "samples"))
def q_sampling_seed(spark, sf):
    s = FX.samples(spark, sf)
    return s.select("group_index", "idx_in_group", P.sampling_seed(1234, "idx_in_group").alias("seed"))


# B25 ------------------------------------------------------------------------
@register("tool_call_message", W("""
SELECT group_index, idx_in_group, CAST(len(calls) AS INTEGER) AS n_calls,
       CASE WHEN len(calls) > 0 AND json_extract_string(calls[1], '$.name') IS NOT NULL
            THEN json_extract_string(calls[1], '$.name') ELSE 'respond' END AS action,
       CASE WHEN len(calls) > 0 THEN json_extract_string(calls[1], '$.arguments.code') END AS code
FROM (SELECT *, regexp_extract_all(response, '(?s)<tool_call>(.*?)</tool_call>', 1) AS calls FROM graded) x""", "graded"))
def q_tool_call_message(spark, sf):
    g = FX.graded(spark, sf)
    calls = P.tool_calls("response")
    return g.select("group_index", "idx_in_group", F.size(calls).alias("n_calls"),
                    P.tool_call_action("response").alias("action"), F.get(calls, 0)["code"].alias("code"))


# T25 ------------------------------------------------------------------------
@register("token_delta", W(r"""
SELECT conv_id, turn, CAST(len(words) AS INTEGER) AS n_tokens,
       CAST(CASE WHEN role = 'assistant' THEN len(words) ELSE 0 END AS INTEGER) AS mask_sum
FROM chat_msgs""", "chat_msgs"))
def q_token_delta(spark, sf):
    d = P.token_delta(FX.chat(spark, sf))
    return d.select("conv_id", "turn", F.size("tokens").alias("n_tokens"),
                    F.aggregate("loss_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


# C11 ------------------------------------------------------------------------
@register("staleness_filter", W(f"""
, v AS (SELECT group_index, count(DISTINCT v) AS n_versions
        FROM (SELECT group_index, unnest([{MONTH_SQL} // 2, {MONTH_SQL} // 2 + l_linenumber % 2]) AS v FROM samples) GROUP BY 1),
g AS (SELECT group_index, min({MONTH_SQL}) AS start_rollout_id, any_value(n_versions) AS n_versions
      FROM samples JOIN v USING (group_index) GROUP BY group_index),
cur AS (SELECT max({MONTH_SQL}) AS current FROM samples)
SELECT group_index FROM g, cur WHERE current - start_rollout_id <= 60 AND n_versions <= 3""", "samples"))
def q_staleness_filter(spark, sf):
    s = FX.samples(spark, sf).withColumn("rollout_id", _month())
    half = F.floor(F.col("rollout_id") / 2)
    s = s.withColumn("weight_versions", F.array(half, half + F.col("l_linenumber") % 2))
    return G.staleness_filter(s, current=s.agg(F.max("rollout_id").alias("current")), max_lag=60, max_versions=3,
                              group_cols=["group_index"]).select("group_index").distinct()


# D8 -------------------------------------------------------------------------
@register("teacher_align", W("""
SELECT group_index, idx_in_group, round(sum(rlp) * 0.7071067811865476, 6) AS teacher_sum FROM tok GROUP BY ALL""", "tok"))
def q_teacher_align(spark, sf):
    t = FX.token_rows(spark, sf)
    teacher = t.select("group_index", "idx_in_group",
                       F.concat(F.array_repeat(F.lit(-1.0), 5), F.col("ref_log_probs")).alias("teacher_log_probs"))
    j = t.select("group_index", "idx_in_group", "response_length").join(teacher, ["group_index", "idx_in_group"])
    n = F.col("response_length").cast("int")
    aligned = F.slice("teacher_log_probs", -n, n)
    return j.select("group_index", "idx_in_group", F.round(A.asum(aligned) * F.lit(0.7071067811865476), 6).alias("teacher_sum"))


# D10 ------------------------------------------------------------------------
# The evaluation config of this query (one row per dataset).
EVAL_CONFIG = [("1-URGENT", "f1", 8, 2048), ("2-HIGH", "dapo", 4, 1024), ("3-MEDIUM", "gpqa", 4, 1024),
               ("4-NOT SPECIFIED", "f1", 2, 512), ("5-LOW", "dapo", 2, 512)]


@register("eval_config_join", W("""
, cfg AS (SELECT * FROM (VALUES ('1-URGENT', 'f1', 8, 2048), ('2-HIGH', 'dapo', 4, 1024), ('3-MEDIUM', 'gpqa', 4, 1024),
                                ('4-NOT SPECIFIED', 'f1', 2, 512), ('5-LOW', 'dapo', 2, 512))
          t(dataset, rm_type, n_samples_per_eval_prompt, max_response_len))
SELECT s.group_index, s.idx_in_group, cfg.rm_type, CAST(cfg.n_samples_per_eval_prompt AS INTEGER) AS n_samples_per_eval_prompt,
       CAST(least(s.response_length, cfg.max_response_len) AS BIGINT) AS capped_len
FROM samples s JOIN orders o ON s.group_index = o.o_orderkey JOIN cfg ON cfg.dataset = o.o_orderpriority""", "samples"))
def q_eval_config_join(spark, sf):
    s = _with_priority(spark, sf, FX.samples(spark, sf))
    cfg = spark.createDataFrame(EVAL_CONFIG, "dataset string, rm_type string, n_samples_per_eval_prompt int, "
                                             "max_response_len int")
    j = s.join(F.broadcast(cfg), "dataset")   # config rows: one per dataset
    return j.select("group_index", "idx_in_group", "rm_type", "n_samples_per_eval_prompt",
                    F.least("response_length", F.col("max_response_len").cast("bigint")).alias("capped_len"))


# S4 -------------------------------------------------------------------------
@register("finished_ids_union", W("""
SELECT DISTINCT instance_id FROM (SELECT CAST(ts AS DATE) AS poll, instance_id FROM buffer_items WHERE finish_reason = 'stop') x""",
    "buffer_items"))
def q_finished_ids_union(spark, sf):
    b = FX.buffer_items(spark, sf).filter(F.col("finish_reason") == "stop")
    return b.select("instance_id").distinct()


# X1 / X2 / X4 ----------------------------------------------------------------
@register("custom_reward", W("""
SELECT group_index, idx_in_group, round(reward - 0.001 * response_length, 6) AS reward FROM samples""", "samples"))
def q_custom_reward(spark, sf):
    s = FX.samples(spark, sf)
    out = H.custom_reward(s, "length_penalty", reward="reward", length="response_length")
    return out.select("group_index", "idx_in_group", r6("reward").alias("reward"))


@register("group_reward", W("""
SELECT group_index, idx_in_group,
       round(CAST(rank() OVER (PARTITION BY group_index ORDER BY response_length) AS DOUBLE)
             / count(*) OVER (PARTITION BY group_index), 6) AS reward
FROM samples""", "samples"))
def q_group_reward(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group", "response_length")
    def rank_reward(pdf):
        g = pdf.groupby("group_index")["response_length"]
        return g.rank(method="min") / g.transform("size")

    out = H.group_reward(s, rank_reward, group_cols=["group_index"])
    return out.select("group_index", "idx_in_group", r6("reward").alias("reward"))


@register("custom_filter", W("""
SELECT CASE WHEN avg(reward) = 0 THEN 'all_wrong' ELSE 'all_right' END AS reason, CAST(count(*) AS BIGINT) AS n_groups
FROM (SELECT group_index, avg(reward) AS reward FROM samples GROUP BY group_index) g
WHERE reward = 0 OR reward = 1 GROUP BY ALL""".replace("avg(reward) = 0", "reward = 0"), "samples"))
def q_custom_filter(spark, sf):
    s = FX.samples(spark, sf)

    def verdict(_df):
        m = F.avg("reward")
        return F.struct(((m > 0) & (m < 1)).alias("keep"),
                        F.when(m == 0, "all_wrong").when(m == 1, "all_right").alias("reason"))

    _, drops = H.custom_filter(s, verdict, group_cols=["group_index"])
    return drops.select("reason", F.col("n_groups").cast("bigint"))


# A5 -------------------------------------------------------------------------
@register("dump_train_data", W(f"""
SELECT CAST({MONTH_SQL} AS INTEGER) AS rollout_id, CAST((row_number() OVER (ORDER BY group_index, idx_in_group) - 1) % 4 AS INTEGER) AS "rank",
       group_index, idx_in_group, response_length
FROM samples""", "samples"))
def q_dump_train_data(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group", "response_length", _month().alias("rollout_id"))
    s = global_index(s, ["group_index", "idx_in_group"], "_i").withColumn("rank", F.pmod("_i", F.lit(4)).cast("int"))
    path = run_dir(spark, "train_dump")
    io.dump_train_data(s.drop("_i"), path)
    back = spark.read.parquet(path)
    return back.select(F.col("rollout_id").cast("int"), F.col("rank").cast("int"), "group_index", "idx_in_group",
                       "response_length")


# A6 -------------------------------------------------------------------------
@register("scan_dumps", W(f"""
SELECT CAST({MONTH_SQL} AS INTEGER) AS rollout_id, group_index, idx_in_group,
       '{{"group_index":' || CAST(group_index AS VARCHAR) || ',"status":"' || status || '","response_length":' ||
       CAST(response_length AS VARCHAR) || '}}' AS sample_json
FROM samples WHERE status IN ('completed', 'truncated')""", "samples"))
def q_scan_dumps(spark, sf):
    s = FX.samples(spark, sf).select("group_index", "idx_in_group", "status", "response_length", "reward",
                                     _month().alias("rollout_id"))
    path = run_dir(spark, "scan_dumps")
    io.dump_samples(s.withColumn("category", F.when(F.col("status") == "aborted", "eval").otherwise("train")), path)
    return io.scan_dumps(spark, path, categories=["train"], whitelist=["group_index", "status", "response_length"])


# A7 -------------------------------------------------------------------------
@register("write_dataset", W("""
SELECT question_id, prompt, label FROM prompts""", "prompts"))
def q_write_dataset(spark, sf):
    p = FX.prompts(spark, sf).select("question_id", "prompt", "label")
    path = run_dir(spark, "dataset") + "/prompts.jsonl"
    io.write_dataset(p, path)
    back = io.read_prompts(spark, path, schema="question_id long, prompt string, label string")
    return back.select("question_id", "prompt", "label")


# C12 ------------------------------------------------------------------------
@register("pending_reward_only", W(f"""
, f AS ({f1_sql_subquery('graded', 'response', 'label', 'group_index, idx_in_group')})
SELECT x.group_index, x.idx_in_group,
       CASE WHEN x.status IN ('completed', 'truncated') AND x.kind % 2 = 0 THEN 1.0 ELSE round({F1_FROM_PARTS}, 6) END AS reward
FROM (SELECT g.group_index, g.idx_in_group, g.kind, sm.status FROM graded g JOIN samples sm USING (group_index, idx_in_group)) x
JOIN f ON f.group_index = x.group_index AND f.idx_in_group = x.idx_in_group""", "graded"))
def q_pending_reward_only(spark, sf):
    g = FX.graded(spark, sf).join(FX.samples(spark, sf).select("group_index", "idx_in_group", "status"),
                                  ["group_index", "idx_in_group"])
    existing = F.when(F.col("status").isin("completed", "truncated") & (F.col("kind") % 2 == 0), F.lit(1.0))
    g = g.withColumn("reward", existing)
    from ..functions import text as TX
    out = G.grade_pending(g, lambda d: d.withColumn("reward", TX.f1_grade("response", "label")["f1"]))
    return out.select("group_index", "idx_in_group", r6("reward").alias("reward"))


# E22 ------------------------------------------------------------------------
@register("rollout_step_id", W("""
SELECT CAST(r AS BIGINT) AS rollout_id, CAST(r * 32 * 4 // 64 AS BIGINT) AS step, CAST(n // 32 AS BIGINT) AS rollouts_per_epoch
FROM (SELECT count(*) AS n FROM prompts) c, (SELECT unnest(range((SELECT count(*) FROM prompts) // 32)) AS r) ids""",
    "prompts"))
def q_rollout_step_id(spark, sf):
    n = FX.prompts(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    per = F.floor(F.col("n") / 32).cast("bigint")
    ids = n.select(per.alias("rollouts_per_epoch"), F.explode(F.sequence(F.lit(0).cast("bigint"), per - 1)).alias("rollout_id"))
    return ids.select("rollout_id", M.rollout_step(F.col("rollout_id"), rollout_batch_size=32, n_samples=4,
                                                   global_batch_size=64).alias("step"), "rollouts_per_epoch")


# C9 -------------------------------------------------------------------------
_ITEM_JSON_SQL = """
'{"uid":' || CAST(event_id AS VARCHAR) || ',"instance_id":' || CAST(user_id AS VARCHAR) ||
CASE WHEN event_type = 'view' THEN '' ELSE ',"messages":[{"role":"assistant","content":"' || event_type || '"}]' END ||
CASE WHEN event_type = 'error' THEN '' ELSE ',"reward":' || CAST(value AS VARCHAR) END ||
CASE WHEN event_type = 'signup' THEN '' ELSE ',"extra_info":{"k":1}' END || '}'"""


@register("required_fields", """
SELECT event_id AS uid,
       array_to_string(list_filter([CASE WHEN event_type = 'view' THEN 'messages' END,
                                    CASE WHEN event_type = 'error' THEN 'reward' END,
                                    CASE WHEN event_type = 'signup' THEN 'extra_info' END], lambda x: x IS NOT NULL), ',') AS missing,
       event_type NOT IN ('view', 'error', 'signup') AS valid
FROM events""")
def q_required_fields(spark, sf):
    e = read_table(spark, sf, "events")
    item = F.to_json(F.struct(
        F.col("event_id").alias("uid"), F.col("user_id").alias("instance_id"),
        F.when(F.col("event_type") != "view", F.array(F.struct(F.lit("assistant").alias("role"),
                                                               F.col("event_type").alias("content")))).alias("messages"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("reward"),
        F.when(F.col("event_type") != "signup", F.struct(F.lit(1).alias("k"))).alias("extra_info")))
    items = e.select(F.col("event_id").alias("uid"), item.alias("item"))
    return G.required_fields(items, json_col="item").select("uid", "missing", "valid")
