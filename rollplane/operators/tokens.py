"""DataFrame-level token operators: reductions over samples (E10-E13),
advantage dispatch (H21), chunked GAE for long trajectories (H6), batch
normalisation of IS weights (H14) and the policy-loss report (H17).

Global statistics (whitening, batch means) are one-row aggregates —
partial sums per task, merged once — attached back with a broadcast of
that single row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import arrays as A
from ..plans.ordering import attach_scalars
from . import scans


# E10 ------------------------------------------------------------------------
def sum_of_sample_mean(x: Column | str, mask: Column | str, per_token: bool = False) -> Column:
    """Aggregate expression: sum over samples of the masked sample mean, or
    (per_token) the masked token sum."""
    return F.sum(A.msum(x, mask) if per_token else A.mmean(x, mask))


def masked_mean_report(df: DataFrame, x: str, mask: str = "loss_mask") -> DataFrame:
    """Sum of sample means, its mean over samples, token sum and token mean."""
    return df.agg(
        F.sum(A.mmean(x, mask)).alias("sum_of_sample_mean"),
        F.avg(A.mmean(x, mask)).alias("sample_mean"),
        F.sum(A.msum(x, mask)).alias("token_sum"),
        (F.sum(A.msum(x, mask)) / F.sum(A.mcount(mask))).alias("token_mean"))


# E11 ------------------------------------------------------------------------
TOKEN_KEYS = ("log_probs", "ref_log_probs", "rollout_log_probs", "returns", "advantages", "values")


def rollout_metric_means(df: DataFrame, cols: Sequence[str], mask: str = "loss_mask") -> DataFrame:
    """Per column: masked sample mean averaged over samples for token columns,
    plain mean for scalar columns (element mean for other arrays)."""
    out = []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, T.ArrayType):
            if c in TOKEN_KEYS:
                out.append(F.avg(A.mmean(c, mask)).alias(c))
            else:
                out.append((F.sum(A.asum(c)) / F.sum(F.size(c))).alias(c))
        else:
            out.append(F.avg(F.col(c).cast("double")).alias(c))
    return df.agg(*out)


# E12 ------------------------------------------------------------------------
def multi_turn_stats(df: DataFrame, *, mask: str = "loss_mask", max_response_len: int,
                     round_col: str | None = None) -> DataFrame:
    raw = F.size(mask).cast("double")
    obs = A.mcount(mask)
    aggs = [F.avg(raw).alias("raw_len_mean"), F.max(raw).alias("raw_len_max"), F.min(raw).alias("raw_len_min"),
            F.avg((raw >= max_response_len).cast("double")).alias("raw_len_clip_ratio"),
            F.avg(obs).alias("wo_obs_len_mean"), F.max(obs).alias("wo_obs_len_max"), F.min(obs).alias("wo_obs_len_min")]
    if round_col:
        r = F.col(round_col).cast("double")
        aggs += [F.avg(r).alias("round_number_mean"), F.max(r).alias("round_number_max"),
                 F.min(r).alias("round_number_min")]
    return df.agg(*aggs)


# E13 ------------------------------------------------------------------------
def masked_whiten(df: DataFrame, x: str, mask: str = "loss_mask", *, out_col: str | None = None,
                  shift_mean: bool = True, eps: float = 1e-8) -> DataFrame:
    """Whiten an array column with global masked statistics (Bessel corrected
    when the mask count >= 2); every position is transformed, masked or
    not.  The mask is 0 or 1; a zero mask sum fails."""
    out_col = out_col or x
    # moments of the masked-in tokens by Spark's central-moment aggregates, which keep their digits at any mean
    token = df.select(F.explode(F.arrays_zip(F.col(x).alias("v"), F.col(mask).alias("m"))).alias("t")).filter("t.m != 0")
    n = F.col("_wn")
    mean = F.col("_wa")
    var = F.when(n >= 2, F.col("_wp") * n / (n - 1)).otherwise(F.col("_wp"))
    stats = token.agg(F.count(F.lit(1)).alias("_wn"), F.avg("t.v").alias("_wa"), F.var_pop("t.v").alias("_wp")).select(
        F.when(n == 0, F.raise_error(F.lit("The global mask sum is zero.")).cast("double")).otherwise(mean).alias("_wm"),
        var.alias("_wv"))
    j = attach_scalars(df, stats)
    wh = F.transform(F.col(x), lambda v: (v - F.col("_wm")) / F.sqrt(F.col("_wv") + A.lit(eps))
                     + (F.lit(0.0) if shift_mean else F.col("_wm")))
    return j.withColumn(out_col, wh).drop("_wm", "_wv")


# H21 ------------------------------------------------------------------------
ESTIMATORS = ("grpo", "gspo", "ppo", "reinforce_plus_plus", "reinforce_plus_plus_baseline",
              "on_policy_distillation")


def compute_advantages(df: DataFrame, estimator: str, *, reward: str = "reward", log_probs: str = "log_probs",
                       ref_log_probs: str = "ref_log_probs", values: str = "values", mask: str = "loss_mask",
                       teacher_log_probs: str = "teacher_log_probs", kl_coef: float = 0.0,
                       kl_type: str = "k1", gamma: float = 1.0, lambd: float = 1.0,
                       normalize: bool = False) -> DataFrame:
    """Add ``advantages`` and ``returns`` arrays for the named estimator;
    unknown names fail.  With kl_coef == 0 the KL arrays are zeros and the
    reference log-probs are never read.  ``normalize`` whitens advantages
    with global masked statistics (E13)."""
    if estimator not in ESTIMATORS:
        raise NotImplementedError(f"advantage_estimator {estimator} is not supported.")
    kl = A.zeros_like(log_probs) if kl_coef == 0 else A.approx_kl(log_probs, ref_log_probs, kl_type)
    if estimator in ("grpo", "gspo"):
        adv = A.grpo_returns(reward, kl)
        out = df.withColumn("advantages", adv).withColumn("returns", adv)
    elif estimator == "ppo":
        out = gae_rows(df, rewards=A.kl_shaped_rewards(reward, kl, kl_coef), values=values, gamma=gamma, lambd=lambd)
    elif estimator == "reinforce_plus_plus":
        out = rpp_returns(df, reward=reward, kl=kl, mask=mask, kl_coef=kl_coef, gamma=gamma)
        out = out.withColumn("advantages", F.col("returns"))
    elif estimator == "reinforce_plus_plus_baseline":
        adv = A.rpp_baseline_adv(reward, kl, kl_coef)
        out = df.withColumn("advantages", adv).withColumn("returns", adv)
    else:
        adv = A.opd_advantage(teacher_log_probs, log_probs)
        out = df.withColumn("advantages", adv).withColumn("returns", adv)
    if normalize:
        out = masked_whiten(out, "advantages", mask)
    return out


# H3 / H5: suffix recurrences (see operators.scans) ---------------------------
def suffix_scan_rows(df: DataFrame, x: str, out: str, w: float) -> DataFrame:
    """Add ``out`` = the discounted suffix sums of the array column ``x`` (null
    stays null); only that array goes to Python."""
    return df.withColumn(out, scans.discounted_sums(x, w))


def rpp_returns(df: DataFrame, *, reward: str, kl: Column, mask: str, kl_coef: float, gamma: float,
                out_col: str = "returns") -> DataFrame:
    """H3 as a table operator: the token rewards in one projection, then the scan."""
    shaped = df.withColumn("_x", A.rpp_token_rewards(reward, kl, mask, kl_coef))
    return suffix_scan_rows(shaped, "_x", out_col, gamma).drop("_x")


def gae_rows(df: DataFrame, *, rewards: Column, values: str, gamma: float, lambd: float) -> DataFrame:
    """H5 as a table operator: adds ``advantages`` and ``returns``."""
    d = df.withColumn("_r", rewards).withColumn("_g", scans.gae("_r", values, gamma, lambd))
    return d.withColumn("advantages", F.col("_g.advantages")).withColumn("returns", F.col("_g.returns")).drop("_r", "_g")


# H6 -------------------------------------------------------------------------
def _chunked_gae_np(rewards: np.ndarray, values: np.ndarray, gamma: float, lambd: float,
                    chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """GAE of one trajectory in chunks: inside a chunk the discounted suffix
    sum is one triangular matmul (powers w^(k-t), k-t < chunk), chunks are
    joined by a carried value scaled by w^(t_end-t+1).  No w^-t scaling,
    so nothing underflows for long T."""
    T_ = len(rewards)
    nxt = np.append(values[1:], 0.0)
    delta = rewards + gamma * nxt - values
    w = gamma * lambd
    adv = np.empty(T_, dtype=np.float64)
    if w == 0.0:
        adv[:] = delta
        return adv, adv + values
    idx = np.arange(chunk)
    expo = idx[None, :] - idx[:, None]                 # k - t
    tri = np.where(expo >= 0, np.power(w, np.clip(expo, 0, None)), 0.0)
    carry = 0.0
    for start in range(((T_ - 1) // chunk) * chunk, -1, chunk * -1):
        d = delta[start:start + chunk]
        m = len(d)
        local = tri[:m, :m] @ d
        local += np.power(w, m - np.arange(m)) * carry
        adv[start:start + m] = local
        carry = local[0]
    return adv, adv + values


def gae_chunked(df: DataFrame, *, rewards: str, values: str, gamma: float, lambd: float,
                chunk: int = 128, keep: Sequence[str] = ()) -> DataFrame:
    """H6 over an Arrow batch iterator (``mapInPandas``): each trajectory is a
    row; long rows stay in one task but are computed in O(T*chunk)."""
    keep = list(keep)
    schema = T.StructType([df.schema[c] for c in keep] + [
        T.StructField("advantages", T.ArrayType(T.DoubleType())),
        T.StructField("returns", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for pdf in batches:
            advs, rets = [], []
            for r, v in zip(pdf[rewards], pdf[values]):
                a, b = _chunked_gae_np(np.asarray(r, dtype=np.float64), np.asarray(v, dtype=np.float64),
                                       gamma, lambd, chunk)
                advs.append(a)
                rets.append(b)
            out = pdf[keep].copy()
            out["advantages"] = advs
            out["returns"] = rets
            yield out

    return df.select(*keep, rewards, values).mapInPandas(run, schema)


# H14 ------------------------------------------------------------------------
def with_mis_weights(df: DataFrame, out_col: str, train_lp: str, rollout_lp: str, mask: str = "loss_mask", *, level: str = "token",
                     mode: str = "truncate", upper: float = 2.0, lower: float | None = None) -> DataFrame:
    """H12 as a table operator: adds the struct ``out_col``; the weights are a column that its fields share, so
    the log-ratio and its mean are computed once a row."""
    staged = df.withColumn("_w0", A.mis_weights_before(train_lp, rollout_lp, mask, level))
    return staged.withColumn(out_col, A.mis_bounded("_w0", mask, mode=mode, upper=upper, lower=lower)).drop("_w0")


def mis_batch_normalize(df: DataFrame, weights: str, mask: str = "loss_mask", *, level: str = "token",
                        out_col: str | None = None) -> DataFrame:
    """Divide IS weights by their batch mean (token-weighted, or the mean of
    sequence means); skipped when the mean <= 1e-8; geometric level fails."""
    out_col = out_col or weights
    if level == "token":
        stats = df.agg((F.sum(A.msum(weights, mask)) / F.greatest(F.sum(A.mcount(mask)), F.lit(1.0))).alias("_bm"))
    elif level == "sequence":
        stats = df.agg(F.avg(A.mmean(weights, mask)).alias("_bm"))
    else:
        raise ValueError(f"Unsupported tis_level: {level}")
    j = attach_scalars(df, stats)
    factor = F.when(F.col("_bm") > 1e-8, F.col("_bm")).otherwise(F.lit(1.0))
    return (j.withColumn(out_col, F.transform(F.col(weights), lambda w: w / factor))
             .withColumn("batch_norm_factor", factor).drop("_bm"))


# token table ----------------------------------------------------------------
def token_table(df: DataFrame, keys: Sequence[str], arrays: dict[str, str]) -> DataFrame:
    """One row per token: ``keys`` + ``pos`` + one column per aligned array.
    Per-token arithmetic on this table runs in whole-stage codegen, and a
    per-sample aggregation collapses it again before any shuffle (all
    tokens of a sample sit in the same partition, so the partial
    aggregate emits one row per sample)."""
    z = F.arrays_zip(*[F.col(c).alias(n) for n, c in arrays.items()])
    ex = df.select(*keys, F.posexplode(z).alias("pos", "_e"))
    return ex.select(*keys, "pos", *[F.col(f"_e.{n}").alias(n) for n in arrays])


def _clamp(x: Column, lo: float | None, hi: float | None) -> Column:
    if lo is not None:
        x = F.greatest(x, F.lit(float(lo)))
    if hi is not None:
        x = F.least(x, F.lit(float(hi)))
    return x


def _token_kl(lp: Column, base: Column, kl_type: str) -> Column:
    lr = lp - base
    if kl_type == "k1":
        return lr
    if kl_type == "k2":
        return lr * lr / 2.0
    k3 = F.exp(-lr) - 1.0 + lr
    if kl_type == "k3":
        return k3
    if kl_type == "low_var_kl":
        return _clamp(k3, -10.0, 10.0)
    raise ValueError(f"Unknown kl_loss_type: {kl_type}")


# H17 ------------------------------------------------------------------------
def policy_loss_report(df: DataFrame, *, log_probs: str, old_log_probs: str, advantages: str, mask: str,
                       eps_clip: float, eps_clip_high: float, entropy: str | None = None,
                       entropy_coef: float = 0.0, ref_log_probs: str | None = None, kl_loss_coef: float = 0.0,
                       kl_type: str = "low_var_kl", rollout_log_probs: str | None = None,
                       use_tis: bool = False, tis_low: float = 0.0, tis_high: float = 2.0,
                       gspo: bool = False, abs_ppo_kl: bool = False, per_token: bool = False,
                       keys: Sequence[str] | None = None) -> DataFrame:
    """One row of loss metrics reduced with ``sum_of_sample_mean`` and divided
    by the number of samples: pg_loss, pg_clipfrac, ppo_kl, entropy_loss,
    kl_loss, loss = pg - c_e*entropy + c_kl*kl, train/rollout abs diff and
    (with TIS) ois, tis, tis_abs, tis_clipfrac.  Computed on the token
    table (codegen arithmetic + per-sample partial aggregation); GSPO, whose
    ratio needs a sequence-level KL first, uses the array expressions."""
    if gspo:
        return _policy_loss_report_arrays(
            df, log_probs=log_probs, old_log_probs=old_log_probs, advantages=advantages, mask=mask,
            eps_clip=eps_clip, eps_clip_high=eps_clip_high, entropy=entropy, entropy_coef=entropy_coef,
            ref_log_probs=ref_log_probs, kl_loss_coef=kl_loss_coef, kl_type=kl_type,
            rollout_log_probs=rollout_log_probs, use_tis=use_tis, tis_low=tis_low, tis_high=tis_high, gspo=True,
            abs_ppo_kl=abs_ppo_kl, per_token=per_token)
    keys = list(keys) if keys else ["_sample"]
    src = df if keys != ["_sample"] else df.withColumn("_sample", F.monotonically_increasing_id())
    arrays = {"lp": log_probs, "olp": old_log_probs, "a": advantages, "m": mask}
    if ref_log_probs:
        arrays["rlp"] = ref_log_probs
    if rollout_log_probs:
        arrays["rol"] = rollout_log_probs
    if entropy:
        arrays["ent"] = entropy
    tok = token_table(src, keys, arrays)
    lp, olp, a, m = F.col("lp"), F.col("olp"), F.col("a"), F.col("m").cast("double")
    kl = olp - lp
    ratio = F.exp(-kl)
    p1 = -ratio * a
    p2 = -_clamp(ratio, 1 - eps_clip, 1 + eps_clip_high) * a
    pg = F.greatest(p1, p2)
    per: dict[str, Column] = {}
    if use_tis and rollout_log_probs:
        tis = F.exp(olp - F.col("rol"))
        w = _clamp(tis, tis_low, tis_high)
        pg = pg * w
        per["ois"] = ratio
        per["tis"] = tis
        per["tis_abs"] = F.exp(F.abs(olp - F.col("rol")))
        per["tis_clipfrac"] = (w != tis).cast("double")
    per["pg_loss"] = pg
    per["pg_clipfrac"] = (p2 > p1).cast("double")
    per["ppo_kl"] = F.abs(kl) if abs_ppo_kl else kl
    if entropy:
        per["entropy_loss"] = F.col("ent")
    if ref_log_probs:
        per["kl_loss"] = _token_kl(lp, F.col("rlp"), kl_type)
    if rollout_log_probs:
        per["train_rollout_logprob_abs_diff"] = F.abs(olp - F.col("rol"))
    sums = tok.groupBy(*keys).agg(F.sum(m).alias("_n"), *[F.sum(v * m).alias(k) for k, v in per.items()])
    denom = F.lit(1.0) if per_token else F.greatest(F.col("_n"), F.lit(1.0))
    n = F.count(F.lit(1))
    agg = sums.agg(*[(F.sum(F.col(k) / denom) / n).alias(k) for k in per])
    if "entropy_loss" not in per:
        agg = agg.withColumn("entropy_loss", F.lit(0.0))
    if "kl_loss" not in per:
        agg = agg.withColumn("kl_loss", F.lit(0.0))
    return agg.withColumn("loss", F.col("pg_loss") - A.lit(entropy_coef) * F.col("entropy_loss")
                          + A.lit(kl_loss_coef) * F.col("kl_loss"))


def _policy_loss_report_arrays(df: DataFrame, *, log_probs: str, old_log_probs: str, advantages: str, mask: str,
                       eps_clip: float, eps_clip_high: float, entropy: str | None = None,
                       entropy_coef: float = 0.0, ref_log_probs: str | None = None, kl_loss_coef: float = 0.0,
                       kl_type: str = "low_var_kl", rollout_log_probs: str | None = None,
                       use_tis: bool = False, tis_low: float = 0.0, tis_high: float = 2.0,
                       gspo: bool = False, abs_ppo_kl: bool = False, per_token: bool = False) -> DataFrame:
    """One row of loss metrics reduced with ``sum_of_sample_mean`` and divided
    by the number of samples: pg_loss, pg_clipfrac, ppo_kl, entropy_loss,
    kl_loss, loss = pg - c_e*entropy + c_kl*kl, train/rollout abs diff and
    (with TIS) ois, tis, tis_abs, tis_clipfrac."""
    if gspo:
        ppo_kl = A.gspo_seq_kl(old_log_probs, log_probs, mask)
    else:
        ppo_kl = F.zip_with(F.col(old_log_probs), F.col(log_probs), lambda a, b: a - b)
    pg = A.ppo_clip_loss(ppo_kl, advantages, eps_clip, eps_clip_high)
    pg_loss = pg["pg_loss"]
    red = (lambda x: A.msum(x, mask)) if per_token else (lambda x: A.mmean(x, mask))
    cols: dict[str, Column] = {}
    if use_tis and rollout_log_probs:
        t = A.tis_weights(old_log_probs, rollout_log_probs, tis_low, tis_high)
        pg_loss = F.zip_with(pg_loss, t["weights"], lambda a, b: a * b)
        cols["ois"] = red(F.transform(ppo_kl, lambda k: F.exp(-k)))
        cols["tis"] = red(t["tis"])
        cols["tis_abs"] = red(t["tis_abs"])
        cols["tis_clipfrac"] = red(t["clipfrac"])
    kl_abs = F.transform(ppo_kl, lambda k: F.abs(k)) if abs_ppo_kl else ppo_kl
    cols["pg_loss"] = red(pg_loss)
    cols["pg_clipfrac"] = red(pg["clipfrac"])
    cols["ppo_kl"] = red(kl_abs)
    cols["entropy_loss"] = red(entropy) if entropy else F.lit(0.0)
    cols["kl_loss"] = red(A.approx_kl(log_probs, ref_log_probs, kl_type)) if ref_log_probs else F.lit(0.0)
    if rollout_log_probs:
        cols["train_rollout_logprob_abs_diff"] = red(
            F.zip_with(F.col(old_log_probs), F.col(rollout_log_probs), lambda a, b: F.abs(a - b)))
    n = F.count(F.lit(1))
    agg = df.agg(*[(F.sum(v) / n).alias(k) for k, v in cols.items()])
    return agg.withColumn("loss", F.col("pg_loss") - A.lit(entropy_coef) * F.col("entropy_loss")
                          + A.lit(kl_loss_coef) * F.col("kl_loss"))


# H16 ------------------------------------------------------------------------
def mis_metrics_report(df: DataFrame, *, train_lp: str = "log_probs", rollout_lp: str = "rollout_log_probs",
                       mask: str = "loss_mask", level: str = "token", mode: str = "truncate", upper: float = 2.0,
                       lower: float | None = None, veto_threshold: float | None = None) -> DataFrame:
    """One row of ``mis_`` metrics: sample means (masked token means first) of the
    weights before and after, of the fractions below and above the bounds and,
    with ``veto_threshold``, of the catastrophic tokens and sequences."""
    d = with_mis_weights(df.select(mask, train_lp, rollout_lp), "_w", train_lp, rollout_lp, mask, level=level, mode=mode,
                         upper=upper, lower=lower)
    cols = {"mis_mean_is_weight_before_clip": "_w.weights_before", "mis_mean_is_weight_after_clip": "_w.weights",
            f"mis_{mode}_fraction_low": "_w.frac_low", f"mis_{mode}_fraction_high": "_w.frac_high"}
    if veto_threshold is not None:
        d = d.withColumn("_v", A.mis_rejection_veto(train_lp, rollout_lp, mask, F.col("_w.modified_mask"), level=level,
                                                    rs_lower=0.0, rs_upper=float("inf"), veto_threshold=veto_threshold))
        cols |= {"mis_catastrophic_token_fraction": "_v.catastrophic_token", "mis_catastrophic_seq_fraction": "_v.catastrophic_seq"}
    return d.agg(*[F.avg(A.mmean(c, mask)).alias(k) for k, c in cols.items()])
