"""Queries: group filters, normalisation and group metrics (C*, E1-E6, E19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups as G, metrics as M
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W
from .registry import r6, register

GI = ("group_index",)


@register("nonzero_std_filter", W("""
SELECT group_index, idx_in_group, reward FROM samples
WHERE group_index IN (SELECT group_index FROM samples GROUP BY group_index
                      HAVING count(*) >= 2 AND max(reward) > min(reward))""", "samples"))
def q_nonzero_std_filter(spark, sf):
    return G.nonzero_std_filter(FX.samples(spark, sf), group_cols=GI).select("group_index", "idx_in_group", "reward")


@register("filter_drop_reasons", W("""
SELECT 'zero_std_' || CAST(CAST(round_even(lo, 1) AS DOUBLE) AS VARCHAR) AS reason, CAST(count(*) AS BIGINT) AS n_groups
FROM (SELECT group_index, min(reward) AS lo FROM samples GROUP BY group_index
      HAVING NOT (count(*) >= 2 AND max(reward) > min(reward))) g
GROUP BY 1""", "samples"))
def q_filter_drop_reasons(spark, sf):
    return G.filter_drop_reasons(FX.samples(spark, sf), group_cols=GI)


@register("valid_group", W("""
SELECT instance_id, CAST(count(*) AS BIGINT) AS group_size,
       CAST(count(*) FILTER (WHERE trim(props) <> '') AS BIGINT) AS valid_count,
       count(*) >= 8 AND count(*) FILTER (WHERE trim(props) <> '') >= 8 AS is_valid
FROM (SELECT b.*, e.props FROM buffer_items b JOIN events e ON b.uid = e.event_id) x
GROUP BY instance_id""", "buffer_items"))
def q_valid_group(spark, sf):
    from ..sources.tables import read_table
    items = FX.buffer_items(spark, sf).join(
        read_table(spark, sf, "events").select(F.col("event_id").alias("uid"), "props"), "uid")
    return G.valid_group(items, group_cols=("instance_id",), min_size=8, text_col="props")


@register("split_aborted_groups", W("""
SELECT group_index, idx_in_group,
       CASE WHEN bool_or(status = 'aborted') OVER (PARTITION BY group_index) THEN 'buffer' ELSE 'train' END AS route
FROM samples""", "samples"))
def q_split_aborted_groups(spark, sf):
    return G.route_aborted_groups(FX.samples(spark, sf), group_cols=GI).select("group_index", "idx_in_group", "route")


@register("group_norm_rewards", W("""
SELECT group_index, idx_in_group,
       round((reward - avg(reward) OVER w) / coalesce(stddev_samp(reward) OVER w + 1e-6, 1), 6) AS norm_reward
FROM samples WINDOW w AS (PARTITION BY group_index)""", "samples"))
def q_group_norm_rewards(spark, sf):
    out = G.group_norm_rewards(FX.samples(spark, sf), group_cols=GI, estimator="grpo")
    return out.select("group_index", "idx_in_group", r6("norm_reward").alias("norm_reward"))


@register("group_norm_valid", W("""
SELECT uid, instance_id, raw_reward,
       round(CASE WHEN nz = 0 AND nv > 0 THEN raw_reward
                  WHEN NOT (raw_reward >= 0 AND raw_reward <= 1) THEN raw_reward
                  WHEN s < 1e-8 THEN 0.0
                  ELSE (raw_reward - m) / (s + 1e-8) END, 6) AS reward
FROM (SELECT uid, instance_id, reward AS raw_reward,
             avg(CASE WHEN reward BETWEEN 0 AND 1 THEN reward END) OVER w AS m,
             stddev_pop(CASE WHEN reward BETWEEN 0 AND 1 THEN reward END) OVER w AS s,
             count(*) FILTER (WHERE reward BETWEEN 0 AND 1) OVER w AS nv,
             count(*) FILTER (WHERE reward BETWEEN 0 AND 1 AND reward <> 0) OVER w AS nz
      FROM buffer_items WINDOW w AS (PARTITION BY instance_id)) x""", "buffer_items"))
def q_group_norm_valid(spark, sf):
    out = G.group_norm_valid(FX.buffer_items(spark, sf), group_cols=("instance_id",))
    return out.select("uid", "instance_id", "raw_reward", r6("reward").alias("reward"))


@register("zero_std_counts", W("""
SELECT 'zero_std/count_' || CAST(CAST(round_even(lo, 1) AS DOUBLE) AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS n_groups
FROM (SELECT group_index, min(reward) AS lo, max(reward) AS hi FROM samples GROUP BY group_index) g
WHERE lo = hi GROUP BY 1""", "samples"))
def q_zero_std_counts(spark, sf):
    return G.zero_std_counts(FX.samples(spark, sf), group_cols=GI)


@register("pass_at_k", W("""
SELECT k, round(avg(CASE WHEN n - c < k THEN 1.0 WHEN c = 0 THEN 0.0
                         ELSE 1.0 - list_reduce(list_transform(range(n - c + 1, n + 1), lambda i: 1.0 - k / i),
                                                lambda a, b: a * b, 1.0) END), 6) AS pass_at_k
FROM (SELECT group_index, count(*) AS n, count(*) FILTER (WHERE reward = 1) AS c FROM samples GROUP BY group_index) g,
     (SELECT CAST(unnest([1, 2, 4]) AS BIGINT) AS k) ks
GROUP BY k""", "samples"))
def q_pass_at_k(spark, sf):
    out = M.pass_at_k(FX.samples(spark, sf), group_cols=GI, n=4, allow_uneven=True)
    return out.select("k", r6("pass_at_k").alias("pass_at_k"))


@register("len_stats", W("""
SELECT round(avg(response_length), 6) AS response_len_mean,
       round(CAST(quantile_cont(response_length, 0.5) AS DOUBLE), 6) AS response_len_median
FROM samples""", "samples"))
def q_len_stats(spark, sf):
    out = M.len_stats(FX.samples(spark, sf), length=M.effective_length(None))
    return out.select(r6("response_len_mean").alias("response_len_mean"),
                      r6("response_len_median").alias("response_len_median"))


@register("buffer_group_stats", W("""
SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(count(DISTINCT instance_id) AS BIGINT) AS num_groups,
       round(count(*) / count(DISTINCT instance_id), 6) AS avg_group_size, round(avg(reward), 6) AS avg_reward
FROM buffer_items""", "buffer_items"))
def q_buffer_group_stats(spark, sf):
    out = M.buffer_group_stats(FX.buffer_items(spark, sf))
    return out.select("total_samples", "num_groups", r6("avg_group_size").alias("avg_group_size"),
                      r6("avg_reward").alias("avg_reward"))


@register("reward_category_frac", W("""
SELECT 'error_cat/' || status AS key, round(count(*) / (SELECT count(*) FROM samples), 6) AS frac
FROM samples GROUP BY status""", "samples"))
def q_reward_category_frac(spark, sf):
    out = M.reward_category_frac(FX.samples(spark, sf), category=F.col("status"))
    return out.select("key", r6("frac").alias("frac"))
