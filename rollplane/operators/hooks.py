"""User-function surface (X*): registries of pluggable rewards, filters and
buffer selectors.  A hook is either a ``Column`` builder (stays in the JVM),
a pandas function over Arrow batches, or a ``DataFrame -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

REWARDS: dict[str, Callable[..., Column]] = {}
GROUP_REWARDS: dict[str, Callable[[pd.DataFrame], pd.Series]] = {}
FILTERS: dict[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {}
BUFFER_SELECTS: dict[str, Callable[[DataFrame, int], DataFrame]] = {}


def register_reward(name: str):
    def deco(fn):
        REWARDS[name] = fn
        return fn
    return deco


def custom_reward(df: DataFrame, name: str, *, out_col: str = "reward", **cols: str) -> DataFrame:
    """Apply a registered per-sample reward (Column builder or pandas_udf)."""
    if name not in REWARDS:
        raise KeyError(f"unknown reward hook {name}")
    return df.withColumn(out_col, REWARDS[name](*[F.col(c) for c in cols.values()]))


def group_reward(df: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], *, group_cols: Sequence[str],
                 out_col: str = "reward") -> DataFrame:
    """Reward computed on whole groups.  Each group (bounded by the
    samples per prompt) is collected into one row, so every Arrow batch of
    ``mapInPandas`` holds complete groups; ``fn`` gets a long frame of many
    whole groups (use ``groupby(group_cols)`` inside) and returns one value
    per row.  One pandas call per batch instead of one per group."""
    group_cols = list(group_cols)
    fields = [c for c in df.columns if c not in group_cols]
    packed = df.groupBy(*group_cols).agg(F.collect_list(F.struct(*fields)).alias("_rows"))
    schema = T.StructType([df.schema[c] for c in group_cols] + [df.schema[c] for c in fields]
                          + [T.StructField(out_col, T.DoubleType())])

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            long = pdf.explode("_rows", ignore_index=True)
            rows = pd.DataFrame(long.pop("_rows").tolist(), columns=fields)
            full = pd.concat([long[group_cols].reset_index(drop=True), rows], axis=1)
            full[out_col] = fn(full).astype("float64").to_numpy()
            yield full

    return packed.mapInPandas(run, schema)


def custom_filter(df: DataFrame, keep_reason: Callable[[DataFrame], Column], *, group_cols: Sequence[str]
                  ) -> tuple[DataFrame, DataFrame]:
    """A group filter given as an aggregate expression returning
    struct(keep boolean, reason string) (a bare boolean is accepted).
    Returns (kept samples, drop counts by reason)."""
    verdict = df.groupBy(*group_cols).agg(keep_reason(df).alias("_v"))
    if isinstance(verdict.schema["_v"].dataType, T.BooleanType):
        verdict = verdict.withColumn("_v", F.struct(F.col("_v").alias("keep"), F.lit(None).cast("string").alias("reason")))
    kept = df.join(verdict.filter("_v.keep").select(*group_cols), list(group_cols), "left_semi")
    drops = (verdict.filter(~F.col("_v.keep") & F.col("_v.reason").isNotNull())
                    .groupBy(F.col("_v.reason").alias("reason")).agg(F.count(F.lit(1)).alias("n_groups")))
    return kept, drops


# built-in example hooks -------------------------------------------------------
@register_reward("length_penalty")
def _length_penalty(reward: Column, length: Column) -> Column:
    """reward - 0.001 * length (a Column hook)."""
    return reward - F.lit(0.001) * length


# X3 -------------------------------------------------------------------------
def remote_reward(df: DataFrame, client: Callable[[list[dict]], list[float]], *, cols: Sequence[str],
                  out_col: str = "reward", max_retries: int = 3, batch_size: int = 128) -> DataFrame:
    """Rewards from an external scorer, called once per Arrow batch chunk
    with the rows' ``cols`` as dicts; failed calls are retried.  The client
    is injected (tests use a local fake); nothing here opens a connection."""
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.DoubleType())])
    cols = list(cols)

    def call(rows):
        err = None
        for _ in range(max_retries):
            try:
                return client(rows)
            except Exception as e:  # noqa: BLE001 - retried, then re-raised
                err = e
        raise err

    def run(batches):
        for pdf in batches:
            out = []
            recs = pdf[cols].to_dict("records")
            for i in range(0, len(recs), batch_size):
                out.extend(call(recs[i:i + batch_size]))
            res = pdf.copy()
            res[out_col] = pd.Series(out, dtype="float64").to_numpy()
            yield res

    return df.mapInPandas(run, schema)


# X5 / X6 / X10 ------------------------------------------------------------------
def register_buffer_select(name: str):
    def deco(fn):
        BUFFER_SELECTS[name] = fn
        return fn
    return deco


def select_from_buffer(buffer: DataFrame, n: int, name: str = "pop_first", **kw) -> DataFrame:
    """Groups taken from the buffer by a registered selector."""
    return BUFFER_SELECTS[name](buffer, n, **kw)


@register_buffer_select("pop_first")
def _pop_first(buffer: DataFrame, n: int, *, group_col: str = "instance_id", arrival_col: str = "ts") -> DataFrame:
    first = buffer.groupBy(group_col).agg(F.min(arrival_col).alias("_a")).orderBy("_a", group_col).limit(n)
    return buffer.join(F.broadcast(first.select(group_col)), group_col, "left_semi")   # n groups


def apply_frame_hook(df: DataFrame, hook: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """X6 reward post-processing / X10 rollout-data post-processing: a
    ``DataFrame -> DataFrame`` function applied to the plan (None = identity)."""
    return df if hook is None else hook(df)


# X7 -------------------------------------------------------------------------
def custom_generate(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """One sample in, zero or more samples out, per Arrow batch."""
    return df.mapInPandas(lambda batches: (fn(pdf) for pdf in batches), schema)


# X8 -------------------------------------------------------------------------
LOSSES: dict[str, Callable[..., Column]] = {}


def register_loss(name: str):
    def deco(fn):
        LOSSES[name] = fn
        return fn
    return deco


def loss_column(name: str, *args: Column, **kw) -> Column:
    """A replaceable per-token loss or IS-weight builder (Column -> Column)."""
    if name not in LOSSES:
        raise KeyError(f"unknown loss hook {name}")
    return LOSSES[name](*args, **kw)


@register_loss("ppo_clip")
def _ppo_clip(ppo_kl: Column, adv: Column, eps_clip: float = 0.2, eps_clip_high: float = 0.2) -> Column:
    from ..functions.arrays import ppo_clip_loss
    return ppo_clip_loss(ppo_kl, adv, eps_clip, eps_clip_high)["pg_loss"]


@register_loss("clipped_ratio")
def _clipped_ratio(log_probs: Column, rollout_log_probs: Column, low: float = 0.0, high: float = 2.0) -> Column:
    from ..functions.arrays import tis_weights
    return tis_weights(log_probs, rollout_log_probs, low, high)["weights"]


# X9 -------------------------------------------------------------------------
GENERATORS: dict[str, dict[str, Callable]] = {}


def register_generator(task_type: str, *, is_valid_group=None, transform_group=None, meta_info=None) -> None:
    """Per task type: group validity, group transform and poll statistics;
    missing parts fall back to the defaults (C3 size rule, identity, E19)."""
    GENERATORS[task_type] = {k: v for k, v in (("is_valid_group", is_valid_group), ("transform_group", transform_group),
                                               ("meta_info", meta_info)) if v is not None}


def generator_hook(task_type: str, part: str) -> Callable:
    from . import groups as G, metrics as M
    defaults = {"is_valid_group": G.valid_group, "transform_group": lambda df, **_: df,
                "meta_info": M.buffer_group_stats}
    return GENERATORS.get(task_type, {}).get(part, defaults[part])
