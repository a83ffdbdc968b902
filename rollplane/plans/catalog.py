"""All registered queries, plus the flagship plan used by ``entry``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (  # noqa: F401  (registration side effects)
    q_agents, q_balance, q_cache, q_extra, q_grading, q_groups, q_more, q_prompts, q_retrieve, q_sampling, q_streaming, q_tokens,
)
from .registry import ORACLE, QUERIES, r6

__all__ = ["QUERIES", "ORACLE", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """samples -> C1 dynamic filter -> E1 group normalisation -> per-group
    summary."""
    from ..operators import groups as G
    from ..sources import fixtures as FX
    kept = G.nonzero_std_filter(FX.samples(spark, sf_dir), group_cols=("group_index",))
    normed = G.group_norm_rewards(kept, group_cols=("group_index",), estimator="grpo")
    return (normed.groupBy("group_index")
                  .agg(F.count(F.lit(1)).alias("n"), r6(F.avg("reward")).alias("mean_reward"),
                       r6(F.max("norm_reward")).alias("max_adv"), r6(F.min("norm_reward")).alias("min_adv")))
