"""Response-group operators: dynamic filters, validity, reward normalisation.

Group statistics are computed with ``groupBy().agg()`` (partial + final
aggregation, so a hot group costs one combined row per map task) and
joined back on the group key; AQE's skew-join split handles a group that
holds a large share of the rows, which a ``Window.partitionBy(group)``
could not do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

GROUP_COLS = ("rollout_id", "group_index")


def _g(group_cols: Sequence[str]) -> list[str]:
    return list(group_cols)


def group_stats(df: DataFrame, group_cols: Sequence[str], reward_col: str = "reward") -> DataFrame:
    """One row per group: size, min, max, mean, sample and population std."""
    r = F.col(reward_col)
    return df.groupBy(*_g(group_cols)).agg(
        F.count(F.lit(1)).alias("_gs_n"),
        F.min(r).alias("_gs_min"), F.max(r).alias("_gs_max"),
        F.avg(r).alias("_gs_mean"),
        F.stddev_samp(r).alias("_gs_std"),
    )


def _with_stats(df: DataFrame, group_cols: Sequence[str], reward_col: str) -> DataFrame:
    return df.join(group_stats(df, group_cols, reward_col), _g(group_cols))


def _zero_std(n: Column | str = "_gs_n") -> Column:
    # std > 0  <=>  at least two samples and not all equal; exact, no float noise
    return ~((F.col("_gs_n") >= 2) & (F.col("_gs_max") > F.col("_gs_min")))


def _round1_label(x: Column) -> Column:
    # Python round(r, 1) is half-even -> bround; printed with one decimal
    return F.bround(x, 1).cast("double").cast("string")


# C1 -------------------------------------------------------------------------
def nonzero_std_filter(df: DataFrame, *, group_cols: Sequence[str] = GROUP_COLS,
                       reward_col: str = "reward") -> DataFrame:
    """Keep the samples of groups whose reward sample-std is > 0 (a one-sample
    group has NaN std and is dropped)."""
    keep = (group_stats(df, group_cols, reward_col)
            .filter((F.col("_gs_n") >= 2) & (F.col("_gs_max") > F.col("_gs_min")))
            .select(*_g(group_cols)))
    return df.join(keep, _g(group_cols), "left_semi")


# C2 -------------------------------------------------------------------------
def filter_drop_reasons(df: DataFrame, *, group_cols: Sequence[str] = GROUP_COLS,
                        reward_col: str = "reward") -> DataFrame:
    """Dropped groups of C1 counted by reason ``zero_std_<round(reward, 1)>``."""
    st = group_stats(df, group_cols, reward_col).filter(_zero_std())
    return (st.groupBy(F.concat(F.lit("zero_std_"), _round1_label(F.col("_gs_min"))).alias("reason"))
              .agg(F.count(F.lit(1)).alias("n_groups")))


# C3 -------------------------------------------------------------------------
def valid_group(df: DataFrame, *, group_cols: Sequence[str] = ("instance_id",), min_size: int = 8,
                text_col: str | None = None) -> DataFrame:
    """Per group: size, non-blank count and validity.  Default rule: size >=
    min_size; with ``text_col`` (math rule) also >= min_size non-blank
    last messages."""
    agg = df.groupBy(*_g(group_cols)).agg(
        F.count(F.lit(1)).alias("group_size"),
        (F.count_if(F.trim(F.col(text_col)) != "") if text_col else F.count(F.lit(1))).alias("valid_count"))
    ok = F.col("group_size") >= min_size
    if text_col:
        ok = ok & (F.col("valid_count") >= min_size)
    return agg.withColumn("is_valid", ok)


# C4 -------------------------------------------------------------------------
def split_aborted_groups(df: DataFrame, *, group_cols: Sequence[str] = GROUP_COLS,
                         status_col: str = "status") -> tuple[DataFrame, DataFrame]:
    """(groups without an aborted sample, groups with one -> back to buffer)."""
    flag = df.groupBy(*_g(group_cols)).agg(F.bool_or(F.col(status_col) == "aborted").alias("_aborted"))
    tagged = df.join(flag, _g(group_cols))
    return (tagged.filter(~F.col("_aborted")).drop("_aborted"),
            tagged.filter(F.col("_aborted")).drop("_aborted"))


def route_aborted_groups(df: DataFrame, *, group_cols: Sequence[str] = GROUP_COLS,
                         status_col: str = "status") -> DataFrame:
    """C4 as one table with a ``route`` column (train / buffer)."""
    flag = df.groupBy(*_g(group_cols)).agg(F.bool_or(F.col(status_col) == "aborted").alias("_aborted"))
    return (df.join(flag, _g(group_cols))
              .withColumn("route", F.when(F.col("_aborted"), "buffer").otherwise("train"))
              .drop("_aborted"))


# E1 -------------------------------------------------------------------------
NORMALIZED_ESTIMATORS = ("grpo", "gspo", "reinforce_plus_plus_baseline")


def group_norm_rewards(df: DataFrame, *, group_cols: Sequence[str] = GROUP_COLS, reward_col: str = "reward",
                       estimator: str = "grpo", normalize: bool = True, std_normalization: bool = True,
                       n_samples_per_prompt: int | None = None, out_col: str = "norm_reward",
                       eps: float = 1e-6) -> DataFrame:
    """reward - group mean; for grpo/gspo also / (sample std + eps).  Only for
    the estimators above and when normalisation is on; otherwise the raw
    reward is passed through.  ``n_samples_per_prompt=1`` disables the std
    division (the reference forbids std normalisation with n=1).  A group
    of one sample has a null std and is only centred."""
    r = F.col(reward_col)
    if not normalize or estimator not in NORMALIZED_ESTIMATORS:
        return df.withColumn(out_col, r)
    st = df.groupBy(*_g(group_cols)).agg(F.avg(r).alias("_m"), F.stddev_samp(r).alias("_s"))
    out = df.join(st, _g(group_cols)).withColumn(out_col, r - F.col("_m"))
    if estimator in ("grpo", "gspo") and std_normalization and n_samples_per_prompt != 1:
        out = out.withColumn(out_col, F.when(F.col("_s").isNull(), F.col(out_col))
                             .otherwise(F.col(out_col) / (F.col("_s") + F.lit(eps))))
    return out.drop("_m", "_s")


# E2 -------------------------------------------------------------------------
def group_norm_valid(df: DataFrame, *, group_cols: Sequence[str] = ("instance_id",), reward_col: str = "reward",
                     eps: float = 1e-8) -> DataFrame:
    """Buffer-side normalisation: statistics over rewards in [0, 1] only,
    population std; a group whose valid rewards are all 0 is unchanged;
    std < eps sets valid rewards to 0; rewards outside [0, 1] pass through.
    The input reward is kept as ``raw_reward``."""
    r = F.col(reward_col)
    valid = (r >= 0) & (r <= 1)
    st = df.groupBy(*_g(group_cols)).agg(
        F.avg(F.when(valid, r)).alias("_m"),
        F.stddev_pop(F.when(valid, r)).alias("_s"),
        F.count_if(valid).alias("_nv"),
        F.count_if(valid & (r != 0)).alias("_nz"))
    norm = (F.when((F.col("_nz") == 0) & (F.col("_nv") > 0), r)
             .when(~valid, r)
             .when(F.col("_s") < eps, F.lit(0.0))
             .otherwise((r - F.col("_m")) / (F.col("_s") + F.lit(eps))))
    return (df.join(st, _g(group_cols))
              .withColumn("raw_reward", r)
              .withColumn(reward_col, norm)
              .drop("_m", "_s", "_nv", "_nz"))


# E5 -------------------------------------------------------------------------
def zero_std_counts(df: DataFrame, *, group_cols: Sequence[str] = GROUP_COLS, reward_col: str = "reward",
                    estimator: str = "grpo") -> DataFrame:
    """Groups whose rewards are all equal, counted by the reward rounded to
    one digit (key ``zero_std/count_<r>``); nothing for ppo."""
    st = df.groupBy(*_g(group_cols)).agg(F.min(reward_col).alias("_lo"), F.max(reward_col).alias("_hi"))
    out = (st.filter(F.col("_lo") == F.col("_hi"))
             .groupBy(F.concat(F.lit("zero_std/count_"), _round1_label(F.col("_lo"))).alias("key"))
             .agg(F.count(F.lit(1)).alias("n_groups")))
    if estimator == "ppo":
        out = out.filter(F.lit(False))
    return out


# C11 ------------------------------------------------------------------------
def staleness_filter(df: DataFrame, *, current: DataFrame, max_lag: int, max_versions: int | None = None,
                     group_cols: Sequence[str] = GROUP_COLS, rollout_col: str = "rollout_id",
                     versions_col: str = "weight_versions") -> DataFrame:
    """Keep buffered groups first generated at most ``max_lag`` rollouts
    before the current one (``current``: one-row frame with ``current``)
    and, optionally, spanning at most ``max_versions`` weight versions
    (``versions_col``: the versions that generated each sample's tokens)."""
    from ..plans.ordering import attach_scalars
    g = df.groupBy(*_g(group_cols)).agg(F.min(rollout_col).alias("_start"))
    if max_versions is not None:
        seen = (df.select(*_g(group_cols), F.explode(versions_col).alias("_v")).groupBy(*_g(group_cols))
                  .agg(F.count_distinct("_v").alias("_nv")))
        g = g.join(seen, _g(group_cols), "left").fillna(0, ["_nv"])
    g = attach_scalars(g, current)
    keep = (F.col("current") - F.col("_start")) <= max_lag
    if max_versions is not None:
        keep = keep & (F.col("_nv") <= max_versions)
    return df.join(g.filter(keep).select(*_g(group_cols)), _g(group_cols), "left_semi")


# C12 ------------------------------------------------------------------------
def grade_pending(df: DataFrame, grader, *, reward_col: str = "reward") -> DataFrame:
    """Grade only rows without a reward (``grader``: DataFrame -> DataFrame
    that sets ``reward_col``); rows already graded pass through."""
    todo = grader(df.filter(F.col(reward_col).isNull()))
    return df.filter(F.col(reward_col).isNotNull()).unionByName(todo.select(*df.columns))


# D9 / T20 ---------------------------------------------------------------------
def selector_reward_join(selections: DataFrame, candidates: DataFrame, *, key: str, order_col: str,
                         text_col: str, reward_col: str, selected_col: str) -> DataFrame:
    """The selector's reward = reward of the first candidate (in
    ``order_col``) whose text contains the selected solution; 0 when no
    selection or no candidate contains it.  A theta join bounded by the key."""
    j = selections.join(candidates, key).filter(F.col(selected_col).isNotNull() &
                                                 (F.instr(F.col(text_col), F.col(selected_col)) > 0))
    first = j.groupBy(key).agg(F.min_by(reward_col, order_col).alias("selector_reward"))
    return (selections.select(key).join(first, key, "left")
                      .withColumn("selector_reward", F.coalesce("selector_reward", F.lit(0.0))))


def team_reward_adjust(samples: DataFrame, selector: DataFrame, *, key: str, reward_col: str = "reward",
                       correct_weight: float = 1.2, incorrect_weight: float = 0.8) -> DataFrame:
    """Scale every reward of an episode by ``correct_weight`` when its
    selector reward is 1, else by ``incorrect_weight``."""
    w = F.when(F.col("selector_reward") == 1, F.lit(correct_weight)).otherwise(F.lit(incorrect_weight))
    return samples.join(selector, key).withColumn(reward_col, F.col(reward_col) * w)


# C9 -------------------------------------------------------------------------
# Fields every buffer item must carry.
REQUIRED_FIELDS = ["uid", "instance_id", "messages", "reward", "extra_info"]


def required_fields(df: DataFrame, *, json_col: str, fields: Sequence[str] = tuple(REQUIRED_FIELDS),
                    fail: bool = False) -> DataFrame:
    """Per JSON item: the missing required fields (comma separated) and
    ``valid``; with ``fail`` a missing field raises instead (strict mode).
    Invalid rows are the quarantine."""
    missing = F.filter(F.array(*[F.when(F.get_json_object(F.col(json_col), f"$.{f}").isNull(), F.lit(f))
                                 for f in fields]), lambda x: x.isNotNull())
    out = df.withColumn("missing", F.array_join(missing, ",")).withColumn("valid", F.size(missing) == 0)
    if fail:
        out = out.withColumn("valid", F.when(F.col("valid"), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("missing fields: "), F.col("missing"))).cast("boolean")))
    return out
