"""Queries: token-array arithmetic (H*) and token reductions.

Spark computes on array columns with higher-order functions; the SQL twin
explodes the arrays into a token table (``tok``) and uses windows and
group-bys.  Per-sample array results are compared through two signatures,
sum(x) and sum((t+1)*x), rounded to 6 digits.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions import arrays as A
from ..operators import groups as G, tokens as TK
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W
from .registry import r6, register

KL_COEF, GAMMA, LAMBD = 0.1, 0.99, 0.95
KEY = ("group_index", "idx_in_group")


def wsum(x: Column) -> Column:
    return F.aggregate(F.transform(x, lambda v, i: v * (i + 1).cast("double")), F.lit(0.0), lambda a, v: a + v)


# Signatures are scaled by 1/sqrt(2): results built from short decimals
# (k/50 log-probs, means over 2^j tokens) otherwise land exactly on a
# rounding tie at the 6th digit, where a 1-ulp difference flips the digit.
SIG = 0.7071067811865476


def rsig(x: Column) -> Column:
    return F.round(x * F.lit(SIG), 6)


def sigs(prefix: str, x: Column) -> list[Column]:
    return [rsig(A.asum(x)).alias(f"{prefix}_sum"), rsig(wsum(x)).alias(f"{prefix}_wsum")]


def _tok(spark, sf):
    return FX.token_rows(spark, sf)


SIG_SQL = ("round(sum({x}) * 0.7071067811865476, 6) AS {p}_sum, "
           "round(sum(({x}) * (t + 1)) * 0.7071067811865476, 6) AS {p}_wsum")


def sig_sql(p: str, x: str) -> str:
    return SIG_SQL.format(p=p, x=x)


# H1 -------------------------------------------------------------------------
@register("approx_kl", W(f"""
SELECT group_index, idx_in_group,
       round(sum(lp - rlp), 6) AS k1, round(sum((lp - rlp) * (lp - rlp) / 2), 6) AS k2,
       round(sum(exp(-(lp - rlp)) - 1 + (lp - rlp)), 6) AS k3,
       round(sum(least(greatest(exp(-(lp - rlp)) - 1 + (lp - rlp), -10), 10)), 6) AS low_var_kl
FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_approx_kl(spark, sf):
    t = _tok(spark, sf)
    return t.select(*KEY, *[r6(A.asum(A.approx_kl("log_probs", "ref_log_probs", k))).alias(k) for k in A.KL_TYPES])


# H2 -------------------------------------------------------------------------
@register("grpo_returns", W(f"""
SELECT group_index, idx_in_group, {sig_sql('ret', 'reward')} FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_grpo_returns(spark, sf):
    t = _tok(spark, sf)
    return t.select(*KEY, *sigs("ret", A.grpo_returns("reward", "log_probs")))


# H3 -------------------------------------------------------------------------
_RPP_SQL = f"""
, x AS (SELECT *, -{KL_COEF} * (lp - rlp)
                  + CASE WHEN t = max(CASE WHEN m = 1 THEN t END) OVER s THEN reward ELSE 0 END AS r
        FROM tok WINDOW s AS (PARTITION BY group_index, idx_in_group)),
y AS (SELECT *, sum(r * pow({GAMMA}, t)) OVER (PARTITION BY group_index, idx_in_group ORDER BY t DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / pow({GAMMA}, t) AS g FROM x)
SELECT group_index, idx_in_group, {sig_sql('ret', 'g')} FROM y GROUP BY group_index, idx_in_group"""


@register("rpp_returns", W(_RPP_SQL, "tok"))
def q_rpp_returns(spark, sf):
    t = _tok(spark, sf)
    kl = A.approx_kl("log_probs", "ref_log_probs", "k1")
    t = t.select(*KEY, "reward", "loss_mask", kl.alias("kl"))
    out = TK.rpp_returns(t, reward="reward", kl=F.col("kl"), mask="loss_mask", kl_coef=KL_COEF, gamma=GAMMA)
    return out.select(*KEY, *sigs("ret", F.col("returns")))


# H4 -------------------------------------------------------------------------
@register("rpp_baseline_adv", W(f"""
, c AS (SELECT group_index, idx_in_group, reward - avg(reward) OVER (PARTITION BY group_index) AS c FROM samples)
SELECT group_index, idx_in_group, {sig_sql('adv', f'c - {KL_COEF} * (lp - rlp)')}
FROM tok JOIN c USING (group_index, idx_in_group)
GROUP BY group_index, idx_in_group""", "tok"))
def q_rpp_baseline_adv(spark, sf):
    t = _tok(spark, sf)
    c = G.group_norm_rewards(t, group_cols=("group_index",), estimator="reinforce_plus_plus_baseline",
                             out_col="centred")
    kl = A.approx_kl("log_probs", "ref_log_probs", "k1")
    return c.select(*KEY, *sigs("adv", A.rpp_baseline_adv("centred", kl, KL_COEF)))


# H7 -------------------------------------------------------------------------
@register("kl_shaped_rewards", W(f"""
SELECT group_index, idx_in_group,
       {sig_sql('r', f'-{KL_COEF} * (lp - rlp) + CASE WHEN t = response_length - 1 THEN reward ELSE 0 END')}
FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_kl_shaped_rewards(spark, sf):
    t = _tok(spark, sf)
    kl = A.approx_kl("log_probs", "ref_log_probs", "k1")
    return t.select(*KEY, *sigs("r", A.kl_shaped_rewards("reward", kl, KL_COEF)))


# H5 -------------------------------------------------------------------------
_W = GAMMA * LAMBD
_GAE_SQL = f"""
, x AS (SELECT *, -{KL_COEF} * (lp - rlp) + CASE WHEN t = response_length - 1 THEN reward ELSE 0 END
                  + {GAMMA} * coalesce(lead(v) OVER s, 0) - v AS d
        FROM tok WINDOW s AS (PARTITION BY group_index, idx_in_group ORDER BY t)),
y AS (SELECT *, sum(d * pow({_W}, t)) OVER (PARTITION BY group_index, idx_in_group ORDER BY t DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / pow({_W}, t) AS a FROM x)
SELECT group_index, idx_in_group, {sig_sql('adv', 'a')}, round(sum(a + v), 6) AS ret_sum
FROM y GROUP BY group_index, idx_in_group"""


@register("gae", W(_GAE_SQL, "tok"))
def q_gae(spark, sf):
    t = _tok(spark, sf)
    kl = A.approx_kl("log_probs", "ref_log_probs", "k1")
    t = t.select(*KEY, A.kl_shaped_rewards("reward", kl, KL_COEF).alias("r"), "values")
    g = TK.gae_rows(t.select(*KEY, "values", "r"), rewards=F.col("r"), values="values", gamma=GAMMA, lambd=LAMBD)
    return g.select(*KEY, *sigs("adv", F.col("advantages")), r6(A.asum("returns")).alias("ret_sum"))


# H8 -------------------------------------------------------------------------
@register("opd_advantage", W(f"""
SELECT group_index, idx_in_group, {sig_sql('adv', 'rlp - lp')} FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_opd_advantage(spark, sf):
    t = _tok(spark, sf)
    return t.select(*KEY, *sigs("adv", A.opd_advantage("ref_log_probs", "log_probs")))


# H9 -------------------------------------------------------------------------
_EPS, _EPSH, _DUAL = 0.2, 0.28, 3.0
_PG_SQL = f"""
, x AS (SELECT *, exp(-(olp - lp)) AS ratio FROM tok),
y AS (SELECT *, greatest(-ratio * v, -least(greatest(ratio, {1 - _EPS}), {1 + _EPSH}) * v) AS l1,
             CASE WHEN -least(greatest(ratio, {1 - _EPS}), {1 + _EPSH}) * v > -ratio * v THEN 1.0 ELSE 0.0 END AS cf
      FROM x),
z AS (SELECT *, CASE WHEN v < 0 THEN least(-{_DUAL} * v, l1) ELSE l1 END AS pl FROM y)
SELECT group_index, idx_in_group, round(sum(pl * m) / greatest(sum(m), 1), 6) AS pg_loss,
       round(sum(cf * m) / greatest(sum(m), 1), 6) AS clipfrac
FROM z GROUP BY group_index, idx_in_group"""


@register("ppo_clip_loss", W(_PG_SQL, "tok"))
def q_ppo_clip_loss(spark, sf):
    t = _tok(spark, sf)
    kl = F.zip_with(F.col("rollout_log_probs"), F.col("log_probs"), lambda a, b: a - b)
    pg = A.ppo_clip_loss(kl, "values", _EPS, _EPSH, _DUAL)
    return t.select(*KEY, pg.alias("pg"), "loss_mask").select(
        *KEY, r6(A.mmean("pg.pg_loss", "loss_mask")).alias("pg_loss"),
        r6(A.mmean("pg.clipfrac", "loss_mask")).alias("clipfrac"))


# H10 ------------------------------------------------------------------------
@register("gspo_seq_kl", W("""
SELECT group_index, idx_in_group, round(sum((olp - lp) * m) / greatest(sum(m), 1), 6) AS seq_kl,
       CAST(count(*) AS BIGINT) AS n_tokens
FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_gspo_seq_kl(spark, sf):
    t = _tok(spark, sf)
    s = A.gspo_seq_kl("rollout_log_probs", "log_probs", "loss_mask")
    return t.select(*KEY, r6(F.get(s, 0)).alias("seq_kl"), F.size(s).cast("bigint").alias("n_tokens"))


# H11 ------------------------------------------------------------------------
_TLO, _THI = 0.5, 2.0


@register("tis_weights", W(f"""
SELECT group_index, idx_in_group,
       round(sum(exp(lp - olp) * m) / greatest(sum(m), 1), 6) AS tis,
       round(sum(exp(abs(lp - olp)) * m) / greatest(sum(m), 1), 6) AS tis_abs,
       round(sum(least(greatest(exp(lp - olp), {_TLO}), {_THI}) * m) / greatest(sum(m), 1), 6) AS weights,
       round(sum(CASE WHEN least(greatest(exp(lp - olp), {_TLO}), {_THI}) <> exp(lp - olp) THEN 1.0 ELSE 0.0 END * m)
             / greatest(sum(m), 1), 6) AS clipfrac
FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_tis_weights(spark, sf):
    t = _tok(spark, sf)
    w = A.tis_weights("log_probs", "rollout_log_probs", _TLO, _THI)
    return t.select(*KEY, w.alias("w"), "loss_mask").select(
        *KEY, *[r6(A.mmean(f"w.{k}", "loss_mask")).alias(k) for k in ("tis", "tis_abs", "weights", "clipfrac")])


# H12 ------------------------------------------------------------------------
@register("mis_weights", W("""
, x AS (SELECT *, exp(least(greatest(lp - olp, -20), 20)) AS w0,
               exp(least(greatest(sum((lp - olp) * m) OVER s / greatest(sum(m) OVER s, 1), -20), 20)) AS wg
        FROM tok WINDOW s AS (PARTITION BY group_index, idx_in_group))
SELECT group_index, idx_in_group,
       round(sum(least(greatest(w0, 0), 2.0) * m * m) / greatest(sum(m), 1), 6) AS trunc_weight,
       round(sum(CASE WHEN w0 > 2.0 THEN 1.0 ELSE 0.0 END * m) / greatest(sum(m), 1), 6) AS trunc_frac_high,
       round(sum(wg * m * m) / greatest(sum(m), 1), 6) AS geo_weight,
       round(CAST(sum(m * CASE WHEN wg >= 0.5 AND wg <= 2.0 THEN 1.0 ELSE 0.0 END) AS DOUBLE), 6) AS geo_mask_sum,
       round(sum(CASE WHEN wg < 0.5 THEN 1.0 ELSE 0.0 END * m) / greatest(sum(m), 1), 6) AS geo_frac_low,
       round(sum(CASE WHEN wg > 2.0 THEN 1.0 ELSE 0.0 END * m) / greatest(sum(m), 1), 6) AS geo_frac_high
FROM x GROUP BY group_index, idx_in_group""", "tok"))
def q_mis_weights(spark, sf):
    t = _tok(spark, sf)
    t = TK.with_mis_weights(t, "tr", "log_probs", "rollout_log_probs", level="token", mode="truncate", upper=2.0)
    t = TK.with_mis_weights(t, "ge", "log_probs", "rollout_log_probs", level="geometric", mode="mask", upper=2.0)
    return t.select(
        *KEY,
        r6(A.mmean("tr.weights", "loss_mask")).alias("trunc_weight"),
        r6(A.mmean("tr.frac_high", "loss_mask")).alias("trunc_frac_high"),
        r6(A.mmean("ge.weights", "loss_mask")).alias("geo_weight"),
        r6(A.asum(F.col("ge.modified_mask"))).alias("geo_mask_sum"),
        r6(A.mmean("ge.frac_low", "loss_mask")).alias("geo_frac_low"),
        r6(A.mmean("ge.frac_high", "loss_mask")).alias("geo_frac_high"))


# H13 ------------------------------------------------------------------------
_VETO = 0.2


@register("mis_rejection_veto", W(f"""
, x AS (SELECT *, exp(least(greatest(lp - olp, -20), 20)) AS rs,
               CASE WHEN (lp - olp) < ln({_VETO}) AND m <> 0 THEN 1.0 ELSE 0.0 END AS cat
        FROM tok)
SELECT group_index, idx_in_group,
       round(CAST(CASE WHEN max(cat) > 0 THEN 0.0 ELSE sum(m * CASE WHEN rs >= 0.5 AND rs <= 2.0 THEN 1.0 ELSE 0.0 END) END AS DOUBLE), 6) AS mask_sum,
       round(CAST(sum(cat) AS DOUBLE), 6) AS catastrophic_tokens, round(CAST(max(cat) AS DOUBLE), 6) AS catastrophic_seq
FROM x GROUP BY group_index, idx_in_group""", "tok"))
def q_mis_rejection_veto(spark, sf):
    t = _tok(spark, sf)
    mm = F.transform("loss_mask", lambda k: k.cast("double"))
    v = A.mis_rejection_veto("log_probs", "rollout_log_probs", "loss_mask", mm, level="token",
                             rs_lower=0.5, rs_upper=2.0, veto_threshold=_VETO)
    return t.select(*KEY, v.alias("v")).select(
        *KEY, r6(A.asum(F.col("v.mask"))).alias("mask_sum"),
        r6(A.asum(F.col("v.catastrophic_token"))).alias("catastrophic_tokens"),
        r6(F.coalesce(F.array_max("v.catastrophic_seq"), F.lit(0.0))).alias("catastrophic_seq"))


# H14 ------------------------------------------------------------------------
@register("mis_batch_normalize", W("""
, x AS (SELECT *, least(greatest(exp(least(greatest(lp - olp, -20), 20)), 0), 2.0) * m AS w FROM tok),
b AS (SELECT sum(w * m) / greatest(sum(m), 1) AS bm FROM x)
SELECT group_index, idx_in_group,
       round(sum(w / CASE WHEN bm > 1e-8 THEN bm ELSE 1.0 END * m) / greatest(sum(m), 1), 6) AS norm_weight
FROM x, b GROUP BY group_index, idx_in_group""", "tok"))
def q_mis_batch_normalize(spark, sf):
    t = _tok(spark, sf)
    tr = A.mis_weights("log_probs", "rollout_log_probs", "loss_mask", level="token", mode="truncate", upper=2.0)
    w = t.select(*KEY, "loss_mask", tr["weights"].alias("w"))
    n = TK.mis_batch_normalize(w, "w", "loss_mask", level="token")
    return n.select(*KEY, r6(A.mmean("w", "loss_mask")).alias("norm_weight"))


# H15 ------------------------------------------------------------------------
_MM_KEYS = ("training_log_ppl", "training_ppl", "rollout_log_ppl", "rollout_ppl", "kl", "k3_kl",
            "log_ppl_diff", "log_ppl_abs_diff", "ppl_ratio", "chi2_token", "chi2_seq")


@register("mismatch_metrics", W("""
, s AS (SELECT group_index, idx_in_group,
               sum(lp * m) / greatest(sum(m), 1) AS tm, sum(olp * m) / greatest(sum(m), 1) AS rm,
               sum((olp - lp) * m) / greatest(sum(m), 1) AS kl,
               sum((exp(lp - olp) - (lp - olp) - 1) * m) / greatest(sum(m), 1) AS k3,
               sum(exp(least(greatest(lp - olp, -20), 20)) * exp(least(greatest(lp - olp, -20), 20)) * m)
                   / greatest(sum(m), 1) AS rho2,
               least(greatest(sum((lp - olp) * m), -20), 20) AS lsum,
               CASE WHEN sum(m) > 0 THEN 1.0 ELSE 0.0 END AS q
        FROM tok GROUP BY group_index, idx_in_group)
SELECT round(avg(-tm * q), 6) AS training_log_ppl, round(avg(exp(-tm) * q), 6) AS training_ppl,
       round(avg(-rm * q), 6) AS rollout_log_ppl, round(avg(exp(-rm) * q), 6) AS rollout_ppl,
       round(avg(kl), 6) AS kl, round(avg(k3), 6) AS k3_kl,
       round(avg((rm - tm) * q), 6) AS log_ppl_diff, round(avg(abs(rm - tm) * q), 6) AS log_ppl_abs_diff,
       round(avg(exp(rm - tm) * q), 6) AS ppl_ratio, round(avg((rho2 - 1.0) * q), 6) AS chi2_token,
       round(avg((exp(2.0 * lsum) - 1.0) * q), 6) AS chi2_seq
FROM s""", "tok"))
def q_mismatch_metrics(spark, sf):
    t = _tok(spark, sf)
    mm = A.mismatch_metrics("log_probs", "rollout_log_probs", "loss_mask")
    return t.agg(*[r6(F.avg(mm[k])).alias(k) for k in _MM_KEYS])


# H17 ------------------------------------------------------------------------
@register("policy_loss_report", W(f"""
, x AS (SELECT *, exp(-(olp - lp)) AS ratio, exp(olp - rlp) AS tis FROM tok),
y AS (SELECT *, greatest(-ratio * v, -least(greatest(ratio, {1 - _EPS}), {1 + _EPSH}) * v)
                 * least(greatest(tis, {_TLO}), {_THI}) AS pl,
             CASE WHEN -least(greatest(ratio, {1 - _EPS}), {1 + _EPSH}) * v > -ratio * v THEN 1.0 ELSE 0.0 END AS cf,
             least(greatest(exp(-(lp - rlp)) - 1 + (lp - rlp), -10), 10) AS kl
      FROM x),
s AS (SELECT group_index, idx_in_group,
             sum(pl * m) / greatest(sum(m), 1) AS pg, sum(cf * m) / greatest(sum(m), 1) AS cf,
             sum((olp - lp) * m) / greatest(sum(m), 1) AS pk, sum(kl * m) / greatest(sum(m), 1) AS kl,
             sum(ratio * m) / greatest(sum(m), 1) AS ois, sum(tis * m) / greatest(sum(m), 1) AS tis,
             sum(exp(abs(olp - rlp)) * m) / greatest(sum(m), 1) AS tis_abs,
             sum(CASE WHEN least(greatest(tis, {_TLO}), {_THI}) <> tis THEN 1.0 ELSE 0.0 END * m) / greatest(sum(m), 1) AS tcf,
             sum(abs(olp - rlp) * m) / greatest(sum(m), 1) AS ad
      FROM y GROUP BY group_index, idx_in_group)
SELECT round(avg(pg), 6) AS pg_loss, round(avg(cf), 6) AS pg_clipfrac, round(avg(pk), 6) AS ppo_kl,
       CAST(0.0 AS DOUBLE) AS entropy_loss, round(avg(kl), 6) AS kl_loss, round(avg(ois), 6) AS ois,
       round(avg(tis), 6) AS tis, round(avg(tis_abs), 6) AS tis_abs, round(avg(tcf), 6) AS tis_clipfrac,
       round(avg(ad), 6) AS train_rollout_logprob_abs_diff, round(avg(pg) + 0.01 * avg(kl), 6) AS loss
FROM s""", "tok"))
def q_policy_loss_report(spark, sf):
    t = _tok(spark, sf)
    rep = TK.policy_loss_report(t, log_probs="log_probs", old_log_probs="rollout_log_probs", advantages="values",
                                mask="loss_mask", eps_clip=_EPS, eps_clip_high=_EPSH, ref_log_probs="ref_log_probs",
                                kl_loss_coef=0.01, kl_type="low_var_kl", rollout_log_probs="ref_log_probs",
                                use_tis=True, tis_low=_TLO, tis_high=_THI, keys=list(KEY))
    return rep.select(*[r6(c).alias(c) for c in rep.columns])


# H18 ------------------------------------------------------------------------
@register("value_clip_loss", W("""
, x AS (SELECT *, v + ((t % 3) - 1) * 0.15 AS ov FROM tok),
y AS (SELECT *, ov + least(greatest(v - ov, -0.2), 0.2) AS vc FROM x)
SELECT group_index, idx_in_group,
       round(sum(greatest((vc - reward) * (vc - reward), (v - reward) * (v - reward)) * m) / greatest(sum(m), 1)
             * 0.7071067811865476, 6) AS value_loss,
       round(sum(CASE WHEN abs(v - ov) > 0.2 THEN 1.0 ELSE 0.0 END * m) / greatest(sum(m), 1), 6) AS value_clipfrac
FROM y GROUP BY group_index, idx_in_group""", "tok"))
def q_value_clip_loss(spark, sf):
    t = _tok(spark, sf)
    old = F.transform("values", lambda x, i: x + ((i % 3) - 1).cast("double") * 0.15)
    ret = A.grpo_returns("reward", "values")
    vl = A.value_clip_loss("values", old, ret, 0.2)
    return t.select(*KEY, "loss_mask", vl.alias("vl")).select(
        *KEY, rsig(A.mmean("vl.loss", "loss_mask")).alias("value_loss"),
        r6(A.mmean("vl.clipfrac", "loss_mask")).alias("value_clipfrac"))


# H19 ------------------------------------------------------------------------
@register("sft_nll", W("""
, s AS (SELECT sum(lp * m) / greatest(sum(m), 1) AS sm, sum(lp * m) AS ts FROM tok GROUP BY group_index, idx_in_group)
SELECT round(-sum(sm), 6) AS loss, round(-sum(ts), 6) AS loss_per_token, CAST(count(*) AS BIGINT) AS n_samples FROM s""",
    "tok"))
def q_sft_nll(spark, sf):
    t = _tok(spark, sf)
    return t.agg(r6(-TK.sum_of_sample_mean("log_probs", "loss_mask")).alias("loss"),
                 r6(-TK.sum_of_sample_mean("log_probs", "loss_mask", per_token=True)).alias("loss_per_token"),
                 F.count(F.lit(1)).alias("n_samples"))


# E10 ------------------------------------------------------------------------
@register("masked_mean", W("""
, s AS (SELECT sum(lp * m) / greatest(sum(m), 1) AS sm, sum(lp * m) AS ts, sum(m) AS n
        FROM tok GROUP BY group_index, idx_in_group)
SELECT round(sum(sm), 6) AS sum_of_sample_mean, round(avg(sm), 6) AS sample_mean,
       round(sum(ts), 6) AS token_sum, round(sum(ts) / sum(n), 6) AS token_mean FROM s""", "tok"))
def q_masked_mean(spark, sf):
    r = TK.masked_mean_report(_tok(spark, sf), "log_probs", "loss_mask")
    return r.select(*[r6(c).alias(c) for c in r.columns])


# E11 ------------------------------------------------------------------------
@register("rollout_metric_means", W("""
, s AS (SELECT group_index, idx_in_group, any_value(reward) AS reward, any_value(response_length) AS response_length,
               sum(lp * m) / greatest(sum(m), 1) AS log_probs, sum(rlp * m) / greatest(sum(m), 1) AS ref_log_probs,
               sum(olp * m) / greatest(sum(m), 1) AS rollout_log_probs, sum(v * m) / greatest(sum(m), 1) AS "values"
        FROM tok GROUP BY group_index, idx_in_group)
SELECT round(avg(log_probs), 6) AS log_probs, round(avg(ref_log_probs), 6) AS ref_log_probs,
       round(avg(rollout_log_probs), 6) AS rollout_log_probs, round(avg("values"), 6) AS "values",
       round(avg(response_length), 6) AS response_length, round(avg(reward), 6) AS reward FROM s""", "tok"))
def q_rollout_metric_means(spark, sf):
    cols = ["log_probs", "ref_log_probs", "rollout_log_probs", "values", "response_length", "reward"]
    r = TK.rollout_metric_means(_tok(spark, sf), cols)
    return r.select(*[r6(c).alias(c) for c in r.columns])


# E12 ------------------------------------------------------------------------
@register("multi_turn_stats", W("""
, s AS (SELECT CAST(count(*) AS DOUBLE) AS raw, CAST(sum(m) AS DOUBLE) AS obs FROM tok GROUP BY group_index, idx_in_group)
SELECT round(avg(raw), 6) AS raw_len_mean, round(max(raw), 6) AS raw_len_max, round(min(raw), 6) AS raw_len_min,
       round(avg(CASE WHEN raw >= 40 THEN 1.0 ELSE 0.0 END), 6) AS raw_len_clip_ratio,
       round(avg(obs), 6) AS wo_obs_len_mean, round(max(obs), 6) AS wo_obs_len_max, round(min(obs), 6) AS wo_obs_len_min
FROM s""", "tok"))
def q_multi_turn_stats(spark, sf):
    r = TK.multi_turn_stats(_tok(spark, sf), max_response_len=40)
    return r.select(*[r6(c).alias(c) for c in r.columns])


# E13 ------------------------------------------------------------------------
@register("masked_whiten", W(f"""
, st AS (SELECT sum(v * m) / sum(m) AS mu, sum(v * v * m) / sum(m) AS q, sum(m) AS n FROM tok),
pr AS (SELECT mu, CASE WHEN n >= 2 THEN (q - mu * mu) * n / (n - 1) ELSE q - mu * mu END AS var FROM st),
x AS (SELECT tok.*, (v - mu) / sqrt(var + 1e-8) AS w FROM tok, pr)
SELECT group_index, idx_in_group, {sig_sql('w', 'w')}
FROM x GROUP BY group_index, idx_in_group""", "tok"))
def q_masked_whiten(spark, sf):
    w = TK.masked_whiten(_tok(spark, sf), "values", "loss_mask", out_col="w")
    return w.select(*KEY, *sigs("w", F.col("w")))


# H21 ------------------------------------------------------------------------
@register("advantage_dispatch", W(f"""
, x AS (SELECT *, -{KL_COEF} * (exp(-(lp - rlp)) - 1 + (lp - rlp))
                  + CASE WHEN t = max(CASE WHEN m = 1 THEN t END) OVER s THEN reward ELSE 0 END AS r
        FROM tok WINDOW s AS (PARTITION BY group_index, idx_in_group)),
y AS (SELECT *, sum(r * pow({GAMMA}, t)) OVER (PARTITION BY group_index, idx_in_group ORDER BY t DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / pow({GAMMA}, t) AS g FROM x),
st AS (SELECT sum(g * m) / sum(m) AS mu, sum(g * g * m) / sum(m) AS q, sum(m) AS n FROM y),
pr AS (SELECT mu, (q - mu * mu) * n / (n - 1) AS var FROM st),
z AS (SELECT y.*, (g - mu) / sqrt(var + 1e-8) AS a FROM y, pr)
SELECT group_index, idx_in_group, {sig_sql('adv', 'a')}, round(sum(g), 6) AS ret_sum
FROM z GROUP BY group_index, idx_in_group""", "tok"))
def q_advantage_dispatch(spark, sf):
    out = TK.compute_advantages(_tok(spark, sf), "reinforce_plus_plus", kl_coef=KL_COEF, kl_type="k3",
                                gamma=GAMMA, normalize=True)
    return out.select(*KEY, *sigs("adv", F.col("advantages")), r6(A.asum(F.col("returns"))).alias("ret_sum"))


# H6 -------------------------------------------------------------------------
_GAEC_SQL = f"""
, p AS (SELECT group_index, lp, v,
               row_number() OVER (PARTITION BY group_index ORDER BY idx_in_group, t) - 1 AS pos FROM tok),
x AS (SELECT *, lp + {GAMMA} * coalesce(lead(v) OVER (PARTITION BY group_index ORDER BY pos), 0) - v AS d FROM p),
y AS (SELECT *, sum(d * pow({_W}, pos)) OVER (PARTITION BY group_index ORDER BY pos DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / pow({_W}, pos) AS a FROM x)
SELECT group_index, round(sum(a) * 0.7071067811865476, 6) AS adv_sum,
       round(sum(a * (pos + 1)) * 0.7071067811865476, 6) AS adv_wsum, round(sum(a + v), 6) AS ret_sum,
       CAST(count(*) AS BIGINT) AS n_tokens
FROM y GROUP BY group_index"""


@register("gae_chunked", W(_GAEC_SQL, "tok"))
def q_gae_chunked(spark, sf):
    t = _tok(spark, sf)
    # one trajectory per order: its samples' arrays concatenated in sample order
    # (an order holds at most 7 samples, so the collected list is bounded)
    traj = t.groupBy("group_index").agg(
        F.array_sort(F.collect_list(F.struct("idx_in_group", "log_probs", "values"))).alias("s"))
    traj = traj.select("group_index", F.flatten(F.transform("s", lambda e: e["log_probs"])).alias("r"),
                       F.flatten(F.transform("s", lambda e: e["values"])).alias("v"))
    g = TK.gae_chunked(traj, rewards="r", values="v", gamma=GAMMA, lambd=LAMBD, chunk=16, keep=["group_index"])
    return g.select("group_index", *sigs("adv", F.col("advantages")),
                    r6(A.asum(F.col("returns"))).alias("ret_sum"), F.size("advantages").cast("bigint").alias("n_tokens"))


# H20 ------------------------------------------------------------------------
@register("logits_logprob_entropy", W("""
, e AS (SELECT vec_id, label, unnest(embedding) / 0.7 AS x, unnest(range(len(embedding))) AS j FROM vectors),
s AS (SELECT vec_id, max(x) AS mx FROM e GROUP BY vec_id),
z AS (SELECT e.vec_id, any_value(s.mx) AS mx, sum(exp(x - s.mx)) AS se, sum(exp(x - s.mx) * x) AS sx,
             max(CASE WHEN j = label THEN x END) AS xc
      FROM e JOIN s ON e.vec_id = s.vec_id GROUP BY e.vec_id)
SELECT vec_id, round(xc - (mx + ln(se)), 6) AS log_prob, round(mx + ln(se) - sx / se, 6) AS entropy FROM z""",
    "vectors"))
def q_logits_logprob_entropy(spark, sf):
    v = FX.vectors(spark, sf)
    r = A.logits_logprob_entropy("embedding", "label", temperature=0.7)
    return v.select("vec_id", r6(r["log_prob"]).alias("log_prob"), r6(r["entropy"]).alias("entropy"))
