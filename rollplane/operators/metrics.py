"""Rollout / evaluation metrics as aggregations (partial + final)."""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import pandas as pd

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import attach_scalars


# E3 -------------------------------------------------------------------------
def pass_at_k_estimate(n: Column, c: Column, k: int) -> Column:
    """Unbiased pass@k of one group: 1 - C(n-c, k)/C(n, k) as the product
    prod_{i=n-c+1..n} (1 - k/i); 1 when n - c < k; 0 when c = 0."""
    prod = F.aggregate(F.sequence(n - c + 1, n), F.lit(1.0),
                       lambda acc, i: acc * (F.lit(1.0) - F.lit(float(k)) / i))
    return (F.when(n - c < k, F.lit(1.0))
             .when(c == 0, F.lit(0.0))
             .otherwise(F.lit(1.0) - prod))


def pass_at_k(df: DataFrame, *, group_cols: Sequence[str], n: int, reward_col: str = "reward",
              extra_keys: Sequence[str] = (), allow_uneven: bool = False) -> DataFrame:
    """Mean pass@k over groups for k = 1, 2, 4, ... <= n.  A sample passes
    when reward == 1.  Groups must hold exactly n samples unless
    ``allow_uneven`` (then each group uses its own size).  n = 1 -> empty."""
    ks = [2 ** i for i in range(int(math.log2(n)) + 1)] if n > 1 else []
    per_group = df.groupBy(*extra_keys, *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(reward_col) == 1).alias("_c"))
    size = F.col("_n") if allow_uneven else F.when(
        F.col("_n") == n, F.col("_n")).otherwise(
        F.raise_error(F.concat(F.lit("pass@k: group size "), F.col("_n").cast("string"),
                               F.lit(f" != n_samples_per_prompt {n}"))).cast("bigint"))
    est = per_group.select(*extra_keys, *[pass_at_k_estimate(size, F.col("_c"), k).alias(f"p{k}") for k in ks])
    agg = est.groupBy(*extra_keys).agg(*[F.avg(f"p{k}").alias(f"p{k}") for k in ks]) if ks else None
    if agg is None:
        return df.sparkSession.createDataFrame([], "k bigint, pass_at_k double")
    stack = F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.col(f"p{k}").alias("pass_at_k"))
                                for k in ks]))
    return agg.select(*extra_keys, stack.alias("_kv")).select(*extra_keys, "_kv.k", "_kv.pass_at_k")


# E4 -------------------------------------------------------------------------
def effective_length(mask_col: str | None = "loss_mask", length_col: str = "response_length") -> Column:
    """sum(loss_mask) when a mask is present, else response_length."""
    if mask_col is None:
        return F.col(length_col)
    return F.coalesce(F.aggregate(F.col(mask_col), F.lit(0).cast("bigint"), lambda a, x: a + x),
                      F.col(length_col))


def len_stats(df: DataFrame, *, length: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and exact (interpolated) median of effective lengths."""
    return df.groupBy(*keys).agg(F.avg(length).alias("response_len_mean"),
                                 F.median(length).cast("double").alias("response_len_median"))


# E6 -------------------------------------------------------------------------
def reward_category_frac(df: DataFrame, *, category: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows per reward category (``error_cat/<cat>``)."""
    per = df.groupBy(*keys, category.alias("category")).agg(F.count(F.lit(1)).alias("_n"))
    tot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_t"))
    j = per.join(F.broadcast(tot), list(keys)) if keys else attach_scalars(per, tot)
    return j.select(*keys, F.concat(F.lit("error_cat/"), F.col("category")).alias("key"),
                    (F.col("_n") / F.col("_t")).alias("frac"))


# E19 ------------------------------------------------------------------------
def buffer_group_stats(df: DataFrame, *, group_col: str = "instance_id", reward_col: str = "reward") -> DataFrame:
    """total samples, groups, average group size, average reward; zeros if empty."""
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_distinct(group_col).alias("num_groups"),
        F.coalesce(F.count(F.lit(1)) / F.nullif(F.count_distinct(group_col), F.lit(0)), F.lit(0.0)).alias("avg_group_size"),
        F.coalesce(F.avg(reward_col), F.lit(0.0)).alias("avg_reward"))


# E20 ------------------------------------------------------------------------
def weighted_meta_merge(df: DataFrame, *, keys: Sequence[str], weight_col: str,
                        value_cols: Sequence[str]) -> DataFrame:
    """Merge per-poll averages weighted by their sample counts."""
    w = F.col(weight_col)
    return df.groupBy(*keys).agg(
        F.sum(w).alias(weight_col),
        *[(F.sum(F.col(c) * w) / F.nullif(F.sum(w), F.lit(0))).alias(c) for c in value_cols])


# E8 -------------------------------------------------------------------------
def eval_summary(df: DataFrame, *, dataset_col: str, reward: Column, status_col: str = "status",
                 length: Column | None = None, prefix: str = "eval/") -> DataFrame:
    """Per dataset: mean reward, truncated ratio and mean response length as
    a long table ``(dataset, key, value)`` with keys ``<prefix><ds>/<name>``
    (one aggregation pass, then an unpivot)."""
    aggs = [F.avg(reward).alias("reward"),
            F.avg((F.col(status_col) == "truncated").cast("double")).alias("truncated_ratio")]
    if length is not None:
        aggs.append(F.avg(length).alias("response_len_mean"))
    wide = df.groupBy(dataset_col).agg(*aggs)
    names = [a for a in ("reward", "truncated_ratio", "response_len_mean") if a in wide.columns]
    kv = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]))
    long = wide.select(dataset_col, kv.alias("_kv"))
    return long.select(dataset_col, F.concat(F.lit(prefix), F.col(dataset_col).cast("string"), F.lit("/"),
                                             F.col("_kv.name")).alias("key"), F.col("_kv.value").alias("value"))


# C10 ------------------------------------------------------------------------
def metric_gate(metrics: DataFrame, *, key: str, threshold: float, key_col: str = "key",
                value_col: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Pass when the metric reached the threshold at any evaluation."""
    return (metrics.filter(F.col(key_col) == key).groupBy(*by)
                   .agg(F.bool_or(F.col(value_col) >= threshold).alias("passed"),
                        F.max(value_col).alias("best")))


def log_prob_gate(df: DataFrame, *, log_probs: str = "log_probs", ref_log_probs: str | None = None,
                  entropy: str | None = None, entropy_range: tuple[float, float] = (0.0, 0.5),
                  log_prob_range: tuple[float, float] = (-0.5, 0.0)) -> DataFrame:
    """One row of checks over a rollout's samples: whether the mean log-prob (and
    entropy) lies inside its open range and, for a first rollout, whether
    log-probs and reference log-probs agree to 1e-8 on average."""
    def mean_of(c):
        return F.sum(F.aggregate(c, F.lit(0.0), lambda a, x: a + x)) / F.sum(F.size(c))

    def inside(m, r):
        return F.coalesce((m > r[0]) & (m < r[1]), F.lit(False))
    out = [inside(mean_of(F.col(log_probs)), log_prob_range).alias("log_probs_ok")]
    if entropy is not None:
        out.append(inside(mean_of(F.col(entropy)), entropy_range).alias("entropy_ok"))
    if ref_log_probs is not None:
        out.append((F.abs(mean_of(F.col(log_probs)) - mean_of(F.col(ref_log_probs))) < 1e-8).alias("same_as_ref"))
    return df.agg(*out)


# E14 ------------------------------------------------------------------------
def rank_mean_reduce(df: DataFrame, *, rank_col: str, value: Column, weighted: bool = False) -> DataFrame:
    """Mean over ranks of the per-rank means (or the sample-weighted mean)."""
    per = df.groupBy(rank_col).agg(F.avg(value).alias("_m"), F.count(F.lit(1)).alias("_n"))
    if weighted:
        return per.agg((F.sum(F.col("_m") * F.col("_n")) / F.sum("_n")).alias("value"))
    return per.agg(F.avg("_m").alias("value"))


# E15 ------------------------------------------------------------------------
def step_metric_reduce(df: DataFrame, *, step_col: str, metrics: dict[str, Column], denom: Column) -> DataFrame:
    """Per train step: sum(metric) / sum(samples or tokens)."""
    return df.groupBy(step_col).agg(*[(F.sum(c) / F.sum(denom)).alias(k) for k, c in metrics.items()])


# E16 ------------------------------------------------------------------------
def throughput(df: DataFrame, *, rollout_col: str, length: Column, rollout_time: Column | float,
               num_gpus: int | None) -> DataFrame:
    """tokens/gpu/s and longest-sample tokens/s per rollout."""
    t = rollout_time if isinstance(rollout_time, Column) else F.lit(float(rollout_time))
    agg = df.groupBy(rollout_col).agg(F.sum(length).alias("_tok"), F.max(length).alias("_max"))
    cols = [rollout_col, (F.col("_max") / t).alias("longest_sample_tokens_per_sec")]
    if num_gpus:
        cols.append((F.col("_tok") / t / num_gpus).alias("tokens_per_gpu_per_sec"))
    return agg.select(*cols)


# E7 -------------------------------------------------------------------------
def _is_repetitive(t) -> bool:
    if t is None or len(t) <= 10000:
        return False
    raw = t[-10000:].encode("utf-8")
    return len(raw) / len(zlib.compress(raw, 9)) > 10


def _repetitive_batch(texts: pd.Series) -> pd.Series:
    return texts.map(_is_repetitive)


def _repetitive_udf():
    return F.pandas_udf(_repetitive_batch, "boolean")


def has_repetition(text: Column | str) -> Column:
    """Text longer than 10 000 characters whose last 10 000 compress more
    than 10x with zlib level 9 (Arrow-batched pandas function; only texts
    longer than the limit are compressed)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(c) > 10000, _repetitive_udf()(c)).otherwise(F.lit(False))


def repetition_truncation(df: DataFrame, *, keys: Sequence[str] = (), text: str = "response", status: str = "status") -> DataFrame:
    """Per ``keys`` (a rollout; none: the whole table) the number of samples and the fractions of repetitive and of truncated
    ones. A null text is not repetitive, a null status not truncated; no samples give no row, or nulls without keys."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    # flagged first, so that texts stay out of the aggregation
    flags = df.select(*keys, flag(has_repetition(text)).alias("_r"), flag(F.col(status) == "truncated").alias("_t"))
    return flags.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"), F.avg("_r").alias("repetition_frac"), F.avg("_t").alias("truncated_ratio"))


# E22 ------------------------------------------------------------------------
def rollout_step(rollout_id: Column, *, rollout_batch_size: int, n_samples: int, global_batch_size: int,
                 use_train_step: bool = True) -> Column:
    """Logging step of a rollout: rollout_id * batch * n // global batch
    (or the rollout id itself)."""
    if not use_train_step:
        return rollout_id.cast("bigint")
    return F.floor(rollout_id * (rollout_batch_size * n_samples) / global_batch_size).cast("bigint")


# E18 ------------------------------------------------------------------------
def forward_flops(seqlen: Column, *, hidden: int, heads: int, kv_groups: int, ffn: int, layers: int, vocab: int,
                  moe_ffn: int | None = None, moe_layers: int = 0) -> Column:
    """Forward FLOPs of one sequence (exact integer arithmetic): per layer
    q/kv projections 2*s*h*d*(heads + 2*kv_groups), attention 4*heads*s^2*d,
    output 2*s*h^2, gated MLP 6*s*h*ffn; plus the LM head 2*s*h*vocab.  MoE
    layers use ``moe_ffn`` (routed top-k width plus shared experts)."""
    s = seqlen.cast("bigint")
    d = hidden // heads

    def layer(f: int) -> Column:
        return (F.lit(2 * hidden * d * (heads + 2 * kv_groups)) * s + F.lit(4 * heads * d) * s * s
                + F.lit(2 * hidden * hidden) * s + F.lit(6 * hidden * f) * s)

    total = layer(ffn) * F.lit(layers - moe_layers) + F.lit(2 * hidden * vocab) * s
    if moe_layers:
        total = total + layer(moe_ffn) * F.lit(moe_layers)
    return total


# E9 -------------------------------------------------------------------------
def spec_metrics(rollup: DataFrame) -> DataFrame:
    """Mean accept rate and accept length over samples (see ``spec_info_rollup``)."""
    return rollup.agg(F.avg("spec_accept_rate").alias("spec_accept_rate"), F.avg("spec_accept_length").alias("spec_accept_length"))


# E17 ------------------------------------------------------------------------
def timer_perf(timers: DataFrame, work: DataFrame, *, keys: Sequence[str], name: str = "name", seconds: str = "seconds",
               flops: str = "fwd_flops", tokens: str = "tokens") -> DataFrame:
    """Per ``keys`` (a rollout): seconds by timer name, and the derived rates;
    a rate is null when its timer is absent or zero. ``work`` has the forward
    FLOPs and token count of each key."""
    names = ("actor_train", "log_probs", "ref_log_probs", "train_wait", "train")
    wide = timers.groupBy(*keys).agg(*[F.sum(F.when(F.col(name) == n, F.col(seconds))).alias(f"{n}_time") for n in names])
    j = wide.join(work, list(keys), "left")

    def per_second(x, timer):
        return F.when(F.col(f"{timer}_time") > 0, x / F.col(f"{timer}_time"))
    trained = F.col("actor_train_time").isNotNull()
    total = F.col("train_wait_time") + F.col("train_time")
    return j.select(*keys, *[f"{n}_time" for n in names],
                    F.when(trained, per_second(F.col(flops), "log_probs")).alias("log_probs_tflops"),
                    F.when(trained, per_second(F.col(flops), "ref_log_probs")).alias("ref_log_probs_tflops"),
                    per_second(3 * F.col(flops), "actor_train").alias("actor_train_tflops"),
                    per_second(F.col(tokens), "actor_train").alias("actor_train_tok_per_s"),
                    F.when(total > 0, total).alias("step_time"),
                    F.when(total > 0, F.col("train_wait_time") / total).alias("wait_time_ratio"))
