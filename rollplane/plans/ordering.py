"""Order-dependent building blocks without a single-partition window.

``global_index`` numbers rows 0..N-1 in a total order: the data is
range-partitioned on the order key (Spark samples the key to pick bounds,
so a hot leading column is still split as long as the full key is unique),
sorted inside each partition, tagged with ``monotonically_increasing_id``
(partition id in the upper bits) and checkpointed so the tag is stable
under re-execution and executor loss.  Per-partition counts (one row per
partition) give the offsets, which are broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def global_index(df: DataFrame, order_cols: Sequence[str | Column], name: str = "row_idx",
                 num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _cols(order_cols)
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("_gi_mid", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(spark)
    tagged = tagged.checkpoint(eager=True)
    tagged = (tagged.withColumn("_gi_pid", F.shiftright("_gi_mid", 33))
                    .withColumn("_gi_loc", F.col("_gi_mid").bitwiseAND(F.lit(_LOW33))))
    counts = tagged.groupBy("_gi_pid").agg(F.count(F.lit(1)).alias("_gi_cnt"))
    # One row per partition: an unpartitioned window is bounded by num_partitions.
    offsets = counts.select(
        "_gi_pid",
        F.coalesce(F.sum("_gi_cnt").over(W.orderBy("_gi_pid").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("_gi_off"))
    return (tagged.join(F.broadcast(offsets), "_gi_pid")
                  .withColumn(name, (F.col("_gi_off") + F.col("_gi_loc")).cast("bigint"))
                  .drop("_gi_pid", "_gi_loc", "_gi_off", "_gi_mid"))


def index_within_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                       name: str = "idx_in_group") -> DataFrame:
    """0-based position inside each group; a hot group is spread over many
    range partitions instead of being sorted by one task."""
    g = global_index(df, list(group_cols) + list(order_cols), "_iwg")
    first = g.groupBy(*group_cols).agg(F.min("_iwg").alias("_iwg_first"))
    return (g.join(first, list(group_cols))
             .withColumn(name, F.col("_iwg") - F.col("_iwg_first"))
             .drop("_iwg", "_iwg_first"))


def total_count_col(df: DataFrame, name: str = "_total") -> DataFrame:
    """Attach the global row count as a column (one-row aggregate, broadcast)."""
    return attach_scalars(df, df.agg(F.count(F.lit(1)).alias(name)))


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Broadcast a one-row aggregate (bounded size) onto every row."""
    return (df.withColumn("_one", F.lit(1))
              .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one")
              .drop("_one"))


def global_cumsum(df: DataFrame, order_cols: Sequence[str | Column], value: str | Column, name: str = "cumsum",
                  num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in a total order: range partitions
    are checkpointed, summed (one row per partition), the partition
    offsets broadcast and added to a per-partition running sum."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _cols(order_cols)
    v = F.col(value) if isinstance(value, str) else value
    tagged = (df.withColumn("_cs_v", v)
                .repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_cs_mid", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(spark)
    tagged = tagged.checkpoint(eager=True).withColumn("_cs_pid", F.shiftright("_cs_mid", 33))
    sums = tagged.groupBy("_cs_pid").agg(F.sum("_cs_v").alias("_cs_tot"))
    offsets = sums.select("_cs_pid", F.coalesce(F.sum("_cs_tot").over(
        W.orderBy("_cs_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_cs_off"))
    local = F.sum("_cs_v").over(W.partitionBy("_cs_pid").orderBy("_cs_mid")
                                 .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (tagged.withColumn("_cs_loc", local)
                  .join(F.broadcast(offsets), "_cs_pid")
                  .withColumn(name, F.col("_cs_off") + F.col("_cs_loc"))
                  .drop("_cs_v", "_cs_mid", "_cs_pid", "_cs_loc", "_cs_off"))
