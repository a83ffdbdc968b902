"""Token-array arithmetic as Column expressions (H*, E10).

Every builder returns a ``Column`` made of Spark higher-order functions
(``transform``, ``zip_with``, ``aggregate``), so the work stays in the JVM
next to the scan; nothing here calls Python per row.  Arrays are aligned
per sample: log-probs, masks, values and KL all have the response length.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit(x: float) -> Column:
    return F.lit(float(x))


# ------------------------------------------------------------------ masks
def msum(x: ColumnOrName, mask: ColumnOrName) -> Column:
    """sum(x * mask) of one row."""
    return F.aggregate(F.zip_with(_c(x), _c(mask), lambda a, m: a * m.cast("double")), F.lit(0.0),
                       lambda acc, v: acc + v)


def mcount(mask: ColumnOrName) -> Column:
    return F.aggregate(_c(mask), F.lit(0.0), lambda acc, m: acc + m.cast("double"))


def mmean(x: ColumnOrName, mask: ColumnOrName) -> Column:
    """masked mean with the denominator clamped to >= 1."""
    return msum(x, mask) / F.greatest(mcount(mask), F.lit(1.0))


def asum(x: ColumnOrName) -> Column:
    return F.aggregate(_c(x), F.lit(0.0), lambda acc, v: acc + v)


def broadcast_like(value: Column, like: ColumnOrName) -> Column:
    """Repeat a scalar along an array (``expand_as``); the scalar is bound
    once, not re-evaluated per element."""
    from .text import let
    return let(lambda v: F.transform(v["arr"], lambda _: v["val"]), val=value.cast("double"), arr=_c(like))


def clamp(x: Column, lo: float | None, hi: float | None) -> Column:
    if lo is not None:
        x = F.greatest(x, lit(lo))
    if hi is not None:
        x = F.least(x, lit(hi))
    return x


# --------------------------------------------------------------- H1 KL
KL_TYPES = ("k1", "k2", "k3", "low_var_kl")


def approx_kl(log_probs: ColumnOrName, base: ColumnOrName, kl_type: str = "k1") -> Column:
    """Per-token KL estimate with lr = logp - base: k1 = lr, k2 = lr^2/2,
    k3 = exp(-lr) - 1 + lr, low_var_kl = k3 clamped to [-10, 10]."""
    if kl_type not in KL_TYPES:
        raise ValueError(f"Unknown kl_loss_type: {kl_type}")

    def f(a, b):
        lr = a - b
        if kl_type == "k1":
            return lr
        if kl_type == "k2":
            return lr * lr / 2.0
        k3 = F.exp(-lr) - 1.0 + lr
        return k3 if kl_type == "k3" else clamp(k3, -10.0, 10.0)

    return F.zip_with(_c(log_probs), _c(base), f)


def zeros_like(arr: ColumnOrName) -> Column:
    return F.transform(_c(arr), lambda _: F.lit(0.0))


# ------------------------------------------------------ suffix recurrences
def suffix_scan(x: ColumnOrName, w: float) -> Column:
    """y_t = x_t + w * y_{t+1} (y after the end = 0) as a log-depth parallel
    scan: pass s adds w^(2^s) * y_{t+2^s}.  Only positive powers of w appear
    (no underflowing w^-t rescaling) and a row of T tokens costs exactly
    ceil(log2 T) array passes."""
    arr = _c(x)
    passes = F.ceil(F.log2(F.greatest(F.size(arr), F.lit(2)))).cast("int")
    init = F.struct(arr.alias("y"), F.lit(1).alias("step"), lit(w).alias("wp"))

    def one_pass(acc, _):
        y = F.transform(acc["y"], lambda e, i: e + acc["wp"] * F.coalesce(F.get(acc["y"], i + acc["step"]), F.lit(0.0)))
        return F.struct(y.alias("y"), (acc["step"] * 2).alias("step"), (acc["wp"] * acc["wp"]).alias("wp"))

    return F.aggregate(F.sequence(F.lit(1), passes), init, one_pass, lambda acc: acc["y"])


def suffix_scan_fold(x: ColumnOrName, w: float | Column) -> Column:
    """Sequential twin of ``suffix_scan`` (one fold over the reversed array)."""
    wc = w if isinstance(w, Column) else lit(w)
    init = F.struct(F.lit(0.0).alias("run"), F.array().cast("array<double>").alias("out"))

    def step(acc, v):
        run = v + wc * acc["run"]
        return F.struct(run.alias("run"), F.concat(F.array(run), acc["out"]).alias("out"))

    return F.aggregate(F.reverse(_c(x)), init, step, lambda acc: acc["out"])


# -------------------------------------------------------- H2-H8 advantages
def grpo_returns(reward: ColumnOrName, like: ColumnOrName) -> Column:
    """H2: the sequence reward on every token (advantages = returns)."""
    return broadcast_like(_c(reward), like)


def last_masked_index(mask: ColumnOrName) -> Column:
    """0-based index of the last mask==1 token; fails on a fully masked row."""
    pos = F.array_position(F.reverse(_c(mask)), 1)
    return F.when(pos > 0, F.size(_c(mask)) - pos).otherwise(
        F.raise_error(F.lit("sequence is fully masked")).cast("bigint"))


def rpp_returns(reward: ColumnOrName, kl: ColumnOrName, mask: ColumnOrName, kl_coef: float,
                gamma: float) -> Column:
    """H3 REINFORCE++: discounted suffix sum with gamma of the token rewards."""
    return suffix_scan(rpp_token_rewards(reward, kl, mask, kl_coef), gamma)


def rpp_token_rewards(reward: ColumnOrName, kl: ColumnOrName, mask: ColumnOrName, kl_coef: float) -> Column:
    """-kl_coef*kl per token, plus the sequence reward at the last masked-in token."""
    from .text import let
    return let(lambda v: F.transform(v["kl"], lambda k, i: lit(-kl_coef) * k + F.when(i == v["last"], v["r"])
                                    .otherwise(0.0)),
               kl=_c(kl), last=last_masked_index(mask), r=_c(reward).cast("double"))


def rpp_baseline_adv(reward: ColumnOrName, kl: ColumnOrName, kl_coef: float) -> Column:
    """H4: (group-centred) reward - kl_coef * kl on every token."""
    return F.transform(_c(kl), lambda k: _c(reward) - lit(kl_coef) * k)


def kl_shaped_rewards(reward: ColumnOrName, kl: ColumnOrName, kl_coef: float) -> Column:
    """H7 PPO: -kl_coef*kl per token, plus the reward on the last position
    (the mask is ignored here)."""
    from .text import let
    return let(lambda v: F.transform(v["kl"], lambda k, i: lit(-kl_coef) * k + F.when(i == F.size(v["kl"]) - 1, v["r"])
                                     .otherwise(0.0)),
               kl=_c(kl), r=_c(reward).cast("double"))


def gae_deltas(rewards: ColumnOrName, values: ColumnOrName, gamma: float) -> Column:
    """delta_t = r_t + gamma*V_{t+1} - V_t (V after the end = 0)."""
    v = _c(values)
    return F.transform(_c(rewards), lambda r, i: r + lit(gamma) * F.coalesce(F.get(v, i + 1), F.lit(0.0)) - F.get(v, i))


def gae(rewards: ColumnOrName, values: ColumnOrName, gamma: float, lambd: float) -> Column:
    """H5: struct(advantages, returns).  delta_t = r_t + gamma*V_{t+1} - V_t
    (V after the end = 0); A_t = delta_t + gamma*lambda*A_{t+1}; R = A + V."""
    v = _c(values)
    adv = suffix_scan(gae_deltas(rewards, v, gamma), gamma * lambd)
    return F.struct(adv.alias("advantages"), F.zip_with(adv, v, lambda a, b: a + b).alias("returns"))


def opd_advantage(teacher: ColumnOrName, student: ColumnOrName) -> Column:
    """H8: teacher log-probs cut to the last len(student) tokens, minus student."""
    n = F.size(_c(student))
    t = F.slice(_c(teacher), -n, n)
    return F.zip_with(t, _c(student), lambda a, b: a - b)


# ----------------------------------------------------------- H9-H13 losses
def ppo_clip_loss(ppo_kl: ColumnOrName, adv: ColumnOrName, eps_clip: float, eps_clip_high: float,
                  eps_clip_c: float | None = None) -> Column:
    """H9: struct(pg_loss, clipfrac) arrays.  ratio = exp(-ppo_kl)."""
    if eps_clip_c is not None and eps_clip_c <= 1.0:
        raise ValueError("dual-clip c must be > 1")

    def loss(k, a):
        ratio = F.exp(-k)
        p1 = -ratio * a
        p2 = -clamp(ratio, 1 - eps_clip, 1 + eps_clip_high) * a
        lo = F.greatest(p1, p2)
        if eps_clip_c is not None:
            lo = F.when(a < 0, F.least(lit(-eps_clip_c) * a, lo)).otherwise(lo)
        return lo

    def frac(k, a):
        ratio = F.exp(-k)
        return (-clamp(ratio, 1 - eps_clip, 1 + eps_clip_high) * a > -ratio * a).cast("double")

    return F.struct(F.zip_with(_c(ppo_kl), _c(adv), loss).alias("pg_loss"),
                    F.zip_with(_c(ppo_kl), _c(adv), frac).alias("clipfrac"))


def gspo_seq_kl(old_lp: ColumnOrName, new_lp: ColumnOrName, mask: ColumnOrName) -> Column:
    """Masked mean of (old - new) per sequence, repeated on every token."""
    diff = F.zip_with(_c(old_lp), _c(new_lp), lambda a, b: a - b)
    return broadcast_like(mmean(diff, mask), new_lp)


def tis_weights(train_lp: ColumnOrName, rollout_lp: ColumnOrName, low: float, high: float) -> Column:
    """struct(tis, tis_abs, weights, clipfrac) arrays."""
    tis = F.zip_with(_c(train_lp), _c(rollout_lp), lambda a, b: F.exp(a - b))
    tis_abs = F.zip_with(_c(train_lp), _c(rollout_lp), lambda a, b: F.exp(F.abs(a - b)))
    w = F.transform(tis, lambda x: clamp(x, low, high))
    return F.struct(tis.alias("tis"), tis_abs.alias("tis_abs"), w.alias("weights"),
                    F.zip_with(w, tis, lambda a, b: (a != b).cast("double")).alias("clipfrac"))


SAFETY_BOUND = 20.0


def mis_log_ratio(train_lp: ColumnOrName, rollout_lp: ColumnOrName, mask: ColumnOrName, level: str) -> Column:
    """Log-ratio at a level: token, sequence (masked sum), geometric (masked mean)."""
    raw = F.zip_with(_c(train_lp), _c(rollout_lp), lambda a, b: a - b)
    if level == "token":
        return raw
    if level == "sequence":
        return broadcast_like(msum(raw, mask), raw)
    if level == "geometric":
        return broadcast_like(mmean(raw, mask), raw)
    raise ValueError(f"Invalid level: {level}")


def mis_weights_before(train_lp: ColumnOrName, rollout_lp: ColumnOrName, mask: ColumnOrName, level: str = "token") -> Column:
    """The weights exp(log-ratio) at a level, log-ratio clamped to +-20."""
    return F.transform(mis_log_ratio(train_lp, rollout_lp, mask, level), lambda x: F.exp(clamp(x, -SAFETY_BOUND, SAFETY_BOUND)))


def mis_weights(train_lp: ColumnOrName, rollout_lp: ColumnOrName, mask: ColumnOrName, *, level: str = "token",
                mode: str = "truncate", upper: float = 2.0, lower: float | None = None) -> Column:
    """``mis_bounded`` of ``mis_weights_before``. Each field computes the weights for itself: where several
    fields are used, ``operators.tokens.with_mis_weights`` computes them once."""
    return mis_bounded(mis_weights_before(train_lp, rollout_lp, mask, level), mask, mode=mode, upper=upper, lower=lower)


def mis_bounded(w0: ColumnOrName, mask: ColumnOrName, *, mode: str = "truncate", upper: float = 2.0, lower: float | None = None) -> Column:
    """struct(weights_before, weights, modified_mask, frac_low, frac_high) of the weights ``w0``;
    modes truncate (0..upper), clip (lower..upper) and mask (reject outside [lower, upper]); lower defaults
    to 1/upper.  Weights are zeroed where loss_mask is 0."""
    lower = 1.0 / upper if lower is None else lower
    w0, m = _c(w0), _c(mask)
    if mode == "truncate":
        w = F.zip_with(w0, m, lambda x, k: clamp(x, 0.0, upper) * k)
        mm = F.transform(m, lambda k: k.cast("double"))
        low = F.transform(w0, lambda x: F.lit(0.0))
        high = F.transform(w0, lambda x: (x > upper).cast("double"))
    elif mode in ("clip", "mask"):
        if not lower < upper:
            raise ValueError("lower bound must be < upper bound")
        low = F.transform(w0, lambda x: (x < lower).cast("double"))
        high = F.transform(w0, lambda x: (x > upper).cast("double"))
        if mode == "clip":
            w = F.zip_with(w0, m, lambda x, k: clamp(x, lower, upper) * k)
            mm = F.transform(m, lambda k: k.cast("double"))
        else:
            w = F.zip_with(w0, m, lambda x, k: x * k)
            mm = F.zip_with(w0, m, lambda x, k: k * ((x >= lower) & (x <= upper)).cast("double"))
    else:
        raise ValueError(f"Unsupported tis_mode: {mode}")
    return F.struct(w0.alias("weights_before"), w.alias("weights"), mm.alias("modified_mask"),
                    low.alias("frac_low"), high.alias("frac_high"))


def mis_rejection_veto(train_lp: ColumnOrName, rollout_lp: ColumnOrName, mask: ColumnOrName,
                       modified_mask: ColumnOrName, *, level: str, rs_lower: float, rs_upper: float,
                       veto_threshold: float | None) -> Column:
    """struct(mask, catastrophic_token, catastrophic_seq).  Second mask by
    [rs_lower, rs_upper] at its own level, then the whole sequence is zeroed
    when any masked-in token has log-ratio < log(veto_threshold)."""
    import math
    lr = mis_log_ratio(train_lp, rollout_lp, mask, level)
    rs = F.transform(lr, lambda x: F.exp(clamp(x, -SAFETY_BOUND, SAFETY_BOUND)))
    mm = F.zip_with(rs, _c(modified_mask), lambda x, k: k * ((x >= rs_lower) & (x <= rs_upper)).cast("double"))
    raw = F.zip_with(_c(train_lp), _c(rollout_lp), lambda a, b: a - b)
    if veto_threshold is None:
        cat = F.transform(raw, lambda _: F.lit(0.0))
        return F.struct(mm.alias("mask"), cat.alias("catastrophic_token"), cat.alias("catastrophic_seq"))
    thr = math.log(veto_threshold)
    cat = F.zip_with(raw, _c(mask), lambda x, k: ((x < thr) & (k != 0)).cast("double"))
    from .text import let

    def veto(v):
        any_cat = F.exists(v["cat"], lambda c: c > 0)
        return F.struct(F.transform(v["mm"], lambda k: F.when(any_cat, F.lit(0.0)).otherwise(k)).alias("mask"),
                        v["cat"].alias("catastrophic_token"),
                        F.transform(v["cat"], lambda _: any_cat.cast("double")).alias("catastrophic_seq"))

    return let(veto, cat=cat, mm=mm)


# ------------------------------------------------------------- H15 metrics
def mismatch_metrics(train_lp: ColumnOrName, rollout_lp: ColumnOrName, mask: ColumnOrName) -> dict[str, Column]:
    """Per-sequence masked means (the values ``sum_of_sample_mean``
    then averages).  Token metrics are reduced with the mask; sequence
    metrics are constant along the row so their masked mean is the value."""
    t_mean = mmean(train_lp, mask)
    r_mean = mmean(rollout_lp, mask)
    lr = F.zip_with(_c(train_lp), _c(rollout_lp), lambda a, b: a - b)
    kl = F.zip_with(_c(rollout_lp), _c(train_lp), lambda a, b: a - b)
    k3 = F.transform(lr, lambda x: F.exp(x) - x - 1.0)
    rho2 = F.transform(lr, lambda x: F.exp(clamp(x, -SAFETY_BOUND, SAFETY_BOUND)) * F.exp(clamp(x, -SAFETY_BOUND, SAFETY_BOUND)))
    lsum = clamp(msum(lr, mask), -SAFETY_BOUND, SAFETY_BOUND)
    seq = F.when(mcount(mask) > 0, F.lit(1.0)).otherwise(F.lit(0.0))  # constant * mask / max(n,1)
    log_ppl_diff = r_mean - t_mean
    return {
        "training_log_ppl": -t_mean * seq,
        "training_ppl": F.exp(-t_mean) * seq,
        "rollout_log_ppl": -r_mean * seq,
        "rollout_ppl": F.exp(-r_mean) * seq,
        "kl": mmean(kl, mask),
        "k3_kl": mmean(k3, mask),
        "log_ppl_diff": log_ppl_diff * seq,
        "log_ppl_abs_diff": F.abs(log_ppl_diff) * seq,
        "ppl_ratio": F.exp(log_ppl_diff) * seq,
        "chi2_token": (mmean(rho2, mask) - 1.0) * seq,
        "chi2_seq": (F.exp(2.0 * lsum) - 1.0) * seq,
    }


# ------------------------------------------------------------ H18 value loss
def value_clip_loss(values: ColumnOrName, old_values: ColumnOrName, returns: ColumnOrName,
                    value_clip: float) -> Column:
    """struct(loss, clipfrac): max((clip(v)-R)^2, (v-R)^2) with
    clip(v) = old + clamp(v-old, +-value_clip); clipfrac = |v-old| > clip."""
    z = F.arrays_zip(_c(values).alias("v"), _c(old_values).alias("o"), _c(returns).alias("r"))

    def loss(e):
        vc = e["o"] + clamp(e["v"] - e["o"], -value_clip, value_clip)
        return F.greatest((vc - e["r"]) * (vc - e["r"]), (e["v"] - e["r"]) * (e["v"] - e["r"]))

    return F.struct(F.transform(z, loss).alias("loss"),
                    F.transform(z, lambda e: (F.abs(e["v"] - e["o"]) > value_clip).cast("double")).alias("clipfrac"))


# ------------------------------------------------------ H20 logits -> logp
def logits_logprob_entropy(logits: ColumnOrName, chosen: ColumnOrName, temperature: float = 1.0) -> Column:
    """struct(log_prob, entropy) of one position from its logit vector:
    x = logits / T, logp = x[chosen] - (max + log sum exp(x - max)),
    entropy = max + log sum exp(x - max) - sum softmax(x) * x."""
    x = F.transform(_c(logits), lambda v: v / lit(temperature))
    mx = F.array_max(x)
    se = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - mx))
    lse = mx + F.log(se)
    sp = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - mx) / se * v)
    return F.struct((F.get(x, _c(chosen)) - lse).alias("log_prob"), (lse - sp).alias("entropy"))
