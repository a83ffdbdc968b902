"""Sources and sinks (A*): prompt files, row slices, sample dumps, metrics.

Paths may carry a row-slice suffix ``@[start:end]`` (either side empty or
negative, Python slice semantics) applied over an explicit order key; the
slice is a distributed global index plus a range filter, never a
single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..plans.ranking import first_rows, index_within_group, rows_between

def split_row_range(path: str) -> tuple[str, tuple[int | None, int | None] | None]:
    """``path@[a:b]`` -> (path, (a, b)), either bound None when left out; a path
    without such a suffix -> (path, None)."""
    head, mark, tail = path.rpartition("@[")
    bounds = tail[:-1].split(":") if mark and tail.endswith("]") else []
    if len(bounds) != 2 or not all(b == "" or b.removeprefix("-").isdigit() for b in bounds):
        return path, None
    start, end = (int(b) if b else None for b in bounds)
    return head, (start, end)


# A1 -------------------------------------------------------------------------
def read_prompts(spark: SparkSession, path: str, *, schema: T.StructType | str | None = None,
                 order_cols: Sequence[str] = ()) -> DataFrame:
    """JSONL (``label`` forced to string) or Parquet by suffix, else an error;
    an ``@[a:b]`` suffix selects a row range in ``order_cols`` order."""
    real, sl = split_row_range(path)
    if real.endswith(".jsonl"):
        r = spark.read.schema(schema) if schema is not None else spark.read
        df = r.json(real)
        if "label" in df.columns:
            df = df.withColumn("label", F.col("label").cast("string"))
    elif real.endswith(".parquet"):
        df = spark.read.parquet(real)
    else:
        raise ValueError(f"{real}: prompts are read from .jsonl or .parquet files")
    if sl is not None:
        df = row_slice(df, sl[0], sl[1], order_cols=order_cols)
    return df


# A2 -------------------------------------------------------------------------
def row_slice(df: DataFrame, start: int | None, end: int | None, *, order_cols: Sequence[str]) -> DataFrame:
    """Rows ``[start:end]`` of ``df`` in ``order_cols`` order (Python slice
    rules; negatives count from the end, which needs the row count)."""
    if not order_cols:
        raise ValueError("row_slice needs an order key for a stable row order")
    if (start or 0) <= 0 and end is None and start is None:
        return df
    n = None
    if end is None or (start or 0) < 0 or end < 0:
        n = df.count()  # one bounded scalar
    start = 0 if start is None else (start + n if start < 0 else start)
    end = n if end is None else (end + n if end < 0 else end)
    return rows_between(df, order_cols, max(start, 0), max(end, 0))


# A3 / A5 ----------------------------------------------------------------------
def dump_samples(df: DataFrame, path: str, *, partition_by: Sequence[str] = ("category", "rollout_id"),
                 mode: str = "append") -> None:
    """Write samples partitioned (train/eval category, rollout id)."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def dump_train_data(df: DataFrame, path: str, *, mode: str = "append") -> None:
    df.write.mode(mode).partitionBy("rollout_id", "rank").parquet(path)


# A4 -------------------------------------------------------------------------
def load_dump_subsample(spark: SparkSession, path: str, *, rollout_id: int | None, ratio: float | None,
                        order_cols: Sequence[str], category: str = "train") -> DataFrame:
    """Reload one rollout of a dump (partition pruning on category and
    rollout id); with ``ratio`` keep the first k//2 and last k - k//2 rows,
    k = int(n * ratio).  k = 0 raises (the reference would return all rows).
    ``rollout_id`` None takes every rollout of the dump, each cut by its own rows (one with
    k = 0 raises, too)."""
    df = spark.read.parquet(path).filter(F.col("category") == category)
    if rollout_id is not None:
        df = df.filter(F.col("rollout_id") == rollout_id)
    if ratio is None:
        return df
    if rollout_id is None:
        return subsample_ends_by(df, ratio, key_cols=["rollout_id"], order_cols=order_cols)
    return subsample_ends(df, ratio, order_cols=order_cols)


def subsample_ends(df: DataFrame, ratio: float, *, order_cols: Sequence[str]) -> DataFrame:
    n = df.count()  # one bounded scalar
    k = int(n * ratio)
    if k == 0:
        raise ValueError("subsample ratio keeps no rows")
    head, tail = k // 2, k - k // 2
    if head + tail >= n:
        return df
    return first_rows(df, order_cols, head).unionByName(rows_between(df, order_cols, n - tail, n))


# A7 -------------------------------------------------------------------------
def write_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    if path.endswith(".jsonl"):
        df.write.mode(mode).json(path)
    elif path.endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"{path}: a data set is written as .jsonl or .parquet")


# A8 -------------------------------------------------------------------------
def union_dumps(dfs: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames with differing columns; missing -> null, numeric
    columns widened by Spark's union type coercion."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


# A9 -------------------------------------------------------------------------
def metrics_long(df: DataFrame, *, step_col: str, prefix: str = "") -> DataFrame:
    """Wide metric rows -> long ``(step, key, value)``; the step key itself
    is not a scalar."""
    vals = [c for c in df.columns if c != step_col]
    return df.select(F.col(step_col).cast("bigint").alias("step"),
                     F.explode(F.array(*[F.struct(F.lit(prefix + c).alias("key"),
                                                  F.col(c).cast("double").alias("value")) for c in vals])).alias("_kv")
                     ).select("step", "_kv.key", "_kv.value")


STEPS_PER_FOLDER = 1 << 16


def metrics_sink(df: DataFrame, path: str, *, step_col: str, prefix: str = "") -> None:
    """Write the metrics in long form, a folder per section (the prefix) and STEPS_PER_FOLDER steps. A repeated write replaces the
    steps it has: folders it touches are written anew with their other steps, the rest are left alone. One writer per
    section at a time."""
    spark = df.sparkSession
    section = prefix.strip("/") or "metrics"
    long = (metrics_long(df, step_col=step_col, prefix=prefix).withColumn("section", F.lit(section))
            .withColumn("steps", F.floor(F.col("step") / STEPS_PER_FOLDER).cast("bigint")))
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        old = spark.read.schema(long.schema).parquet(path).filter(F.col("section") == section)
        new = long.select(F.col("step").alias("_step"), F.col("steps").alias("_steps"))
        old = old.join(new.select("_steps").distinct(), F.col("steps").eqNullSafe(F.col("_steps")), "left_semi")
        long = long.unionByName(old.join(new.select("_step").distinct(), F.col("step").eqNullSafe(F.col("_step")), "left_anti"))
    (long.repartition("steps").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("section", "steps").parquet(path))


# A10 ------------------------------------------------------------------------
CURSOR_SCHEMA = ("rollout_id bigint, sample_offset bigint, epoch_id bigint, sample_group_index bigint, "
                 "sample_index bigint, metadata map<string,string>")


def cursor_save(spark: SparkSession, path: str, *, rollout_id: int, sample_offset: int, epoch_id: int,
                sample_group_index: int, sample_index: int, metadata: dict | None = None) -> None:
    row = [(rollout_id, sample_offset, epoch_id, sample_group_index, sample_index, metadata or {})]
    # a repeated save of a rollout replaces its cursor
    (spark.createDataFrame(row, CURSOR_SCHEMA).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("rollout_id").parquet(path))


def cursor_load(spark: SparkSession, path: str, rollout_id: int | None = None) -> DataFrame:
    """The saved cursor of ``rollout_id`` (latest when None)."""
    df = spark.read.parquet(path)
    if rollout_id is None:
        latest = df.agg(F.max("rollout_id").alias("rollout_id"))
        return df.join(latest, "rollout_id")
    return df.filter(F.col("rollout_id") == rollout_id)


def subsample_ends_by(df: DataFrame, ratio: float, *, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """``subsample_ends`` per key (e.g. per rollout id): first k//2 and last
    k - k//2 rows of each key, k = int(n_key * ratio); a key with k = 0
    raises, as in ``subsample_ends``.  Positions come from the distributed index, counts from one
    aggregate per key."""
    g = index_within_group(df, list(key_cols), list(order_cols), "_ss")
    n = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"))
    k = F.floor(F.col("_n") * ratio).cast("bigint")
    k = F.when(k > 0, k).otherwise(F.raise_error(F.lit("subsample ratio keeps no rows of a key")).cast("bigint"))
    head = F.floor(k / 2).cast("bigint")
    return (g.join(n, list(key_cols))
             .filter((F.col("_ss") < head) | (F.col("_ss") >= F.col("_n") - (k - head)))
             .drop("_ss", "_n"))


# A6 -------------------------------------------------------------------------
def scan_dumps(spark: SparkSession, path: str, *, categories: Sequence[str] = ("train", "eval"),
               whitelist: Sequence[str] = ()) -> DataFrame:
    """Enumerate dumped samples of the given categories (partition pruning)
    and render the whitelisted columns as one JSON object per sample."""
    df = spark.read.parquet(path).filter(F.col("category").isin(*categories))
    return df.select(F.col("rollout_id").cast("int"), "group_index", "idx_in_group",
                     F.to_json(F.struct(*[F.col(c) for c in whitelist])).alias("sample_json"))


# A11 ------------------------------------------------------------------------
EVAL_KEYS = ("name", "path", "rm_type", "n_samples_per_eval_prompt", "max_response_len", "top_p", "temperature",
             "prompt_key", "label_key", "metadata_overrides")


def eval_config_table(spark: SparkSession, config, *, defaults: dict | None = None, run_level: dict | None = None
                      ) -> DataFrame:
    """Dataset configs (a list of dicts, or a map name -> dict) as one row
    per dataset; a value comes from the dataset, else the eval defaults,
    else the run-level setting.  Unknown keys are rejected.  Config rows are
    few (one per dataset), so the table is small and broadcast on join."""
    items = [dict(v, name=k) for k, v in config.items()] if isinstance(config, dict) else [dict(c) for c in config]
    for c in items:
        unknown = set(c) - set(EVAL_KEYS)
        if unknown:
            raise ValueError(f"unknown eval config keys: {sorted(unknown)}")
        if "name" not in c:
            raise ValueError("eval dataset needs a name")
    defaults, run_level = defaults or {}, run_level or {}
    rows = [tuple(c.get(k, defaults.get(k, run_level.get(k))) for k in EVAL_KEYS) for c in items]
    schema = ("name string, path string, rm_type string, n_samples_per_eval_prompt int, max_response_len int, "
              "top_p double, temperature double, prompt_key string, label_key string, "
              "metadata_overrides map<string, string>")
    return spark.createDataFrame(rows, schema)


# A13 ------------------------------------------------------------------------
def task_rows(tasks: DataFrame, *, env: str, split: str, order_cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(env, split, index, metadata): tasks numbered from 0 within environment and
    split in ``order_cols`` order, their fields as one JSON object."""
    g = index_within_group(tasks, [env, split], list(order_cols), "index")
    return g.select(F.col(env).alias("env"), F.col(split).alias("split"), "index",
                    F.to_json(F.struct(*fields)).alias("metadata"))


def export_tasks(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSONL folder per environment and split."""
    rows.write.mode(mode).partitionBy("env", "split").json(path)
