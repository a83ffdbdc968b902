"""Structured Streaming for the rollout buffer.

* ``assemble_groups`` (U1/U2): items are keyed by ``instance_id`` and kept
  in state until the group is valid (size >= group_size); at that trigger
  the whole group is emitted and later items start a new one. An incomplete
  group whose last event is older than the watermark by ``timeout`` is emitted
  as ``timeout`` (event-time timer), and a key's group number leaves after a
  longer time, so the state stays bounded.
* ``PartialRollouts`` (U4): unfinished groups go back to a buffer and are taken
  first in the next micro-batch.
* ``poll_stats`` (U3): statistics of everything written since the last
  poll = one aggregate per micro-batch (``foreachBatch``).
* ``stream_metrics`` (U8): reward / truncation metrics per event-time
  window with a watermark.

State and sinks live under the session's checkpoint directory (a shared
folder on a cluster), one fresh sub-folder per run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import ensure_checkpoint_dir

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

ITEM_COLS = ["uid", "instance_id", "ts", "reward", "finish_reason"]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint directory for one streaming run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, sf_dir: str, *, max_files_per_trigger: int | None = None,
                 glob: str = "events*.parquet") -> DataFrame:
    """Buffer items (F5) from event Parquet files arriving in ``sf_dir``."""
    r = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    e = r.parquet(sf_dir)
    return e.select(
        F.col("event_id").alias("uid"), F.col("user_id").alias("instance_id"),
        F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 500).alias("reward"),
        F.when(F.col("event_type") == "error", "abort").when(F.col("event_type") == "view", "length")
         .otherwise("stop").alias("finish_reason"))


GROUP_OUT = ("instance_id long, group_seq long, uid long, ts timestamp, reward double, finish_reason string, "
             "group_size int, reason string")
GROUP_STATE = ("seq long, uids array<long>, ts array<timestamp>, rewards array<double>, "
               "reasons array<string>, last_ms long")


def _assembler(group_size: int, timeout_ms: int, ttl_ms: int):
    def emit(key, st, reason) -> pd.DataFrame:
        n = len(st["uids"])
        return pd.DataFrame({"instance_id": [key] * n, "group_seq": [st["seq"]] * n, "uid": st["uids"],
                             "ts": st["ts"], "reward": st["rewards"], "finish_reason": st["reasons"],
                             "group_size": [n] * n, "reason": [reason] * n})

    def keep(state: GroupState, st: dict) -> None:
        state.update((st["seq"], st["uids"], st["ts"], st["rewards"], st["reasons"], st["last_ms"]))
        # items wait for the group's timeout, the number alone for the longer one; a timer may not precede the watermark
        due = st["last_ms"] + timeout_ms if st["uids"] else max(st["last_ms"], st["seq"]) + ttl_ms
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        k = int(key[0])
        st = {"seq": None, "uids": [], "ts": [], "rewards": [], "reasons": [], "last_ms": 0}
        if state.exists:
            seq, uids, ts, rewards, reasons, last_ms = state.get
            st = {"seq": seq, "uids": list(uids), "ts": list(ts), "rewards": list(rewards),
                  "reasons": list(reasons), "last_ms": last_ms}
        empty = {"uids": [], "ts": [], "rewards": [], "reasons": []}
        if state.hasTimedOut:
            if not st["uids"]:
                state.remove()
                return
            yield emit(k, st, "timeout")
            keep(state, st | empty)
            return
        opened = not st["uids"]
        for pdf in pdfs:
            pdf = pdf.sort_values(["ts", "uid"], kind="stable")
            st["uids"] += pdf["uid"].tolist()
            st["ts"] += pdf["ts"].tolist()
            st["rewards"] += pdf["reward"].tolist()
            st["reasons"] += pdf["finish_reason"].tolist()
            st["last_ms"] = max(st["last_ms"], int(pd.Timestamp(pdf["ts"].max()).value // 1_000_000))
        if opened:
            first_ms = int(pd.Timestamp(min(st["ts"])).value // 1_000_000)
            st["seq"] = first_ms if st["seq"] is None else max(st["seq"] + 1, first_ms)
        if len(st["uids"]) >= group_size:
            yield emit(k, st, "complete")
            st |= empty         # the key's next items start a new group
        keep(state, st)
    return fn


def assemble_groups(items: DataFrame, *, group_size: int = 8, timeout: str = "1 day", counter_ttl: str = "4 days",
                    watermark: str | None = None) -> DataFrame:
    """Streaming DataFrame of emitted group members. A group's ``group_seq`` is the time (ms) of its first item, or
    one more than the number before if that is not smaller. A key's state has two lifetimes: its items leave with the group, at
    the latest ``timeout`` after the last item; the number stays until the watermark is ``counter_ttl`` past both the last item and
    the number. Items behind the watermark are dropped, so whatever comes later is newer than
    the number: (instance_id, group_seq) stays unique and rising over an eviction."""
    timeout_ms, ttl_ms = (int(pd.Timedelta(x).total_seconds() * 1000) for x in (timeout, counter_ttl))
    items = items.withWatermark("ts", watermark or timeout)
    return items.select(*ITEM_COLS).groupBy("instance_id").applyInPandasWithState(
        _assembler(group_size, timeout_ms, ttl_ms), GROUP_OUT, GROUP_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_to_table(stream: DataFrame, spark: SparkSession, name: str, *, mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame to completion (availableNow) into a Parquet
    sink and return the sink read back as a batch DataFrame."""
    base = run_dir(spark, name)
    q = (stream.writeStream.format("parquet").outputMode(mode)
               .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/out")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


_BATCH = "micro_batch"


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    """A micro-batch's output has a folder of its own, so that a replayed batch
    replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches so far, with their id in ``_BATCH``."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])).parquet(path)


def poll_stats(items: DataFrame, spark: SparkSession, name: str = "poll_stats") -> DataFrame:
    """E19 statistics of each micro-batch (what one poll would have
    returned since the previous one), keyed by batch id."""
    base = run_dir(spark, name)
    out = f"{base}/stats"

    def write(batch: DataFrame, batch_id: int) -> None:
        stats = batch.agg(F.count(F.lit(1)).alias("total_samples"),
                          F.count_distinct("instance_id").alias("num_groups"),
                          F.avg("reward").alias("avg_reward"))
        stats = stats.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "total_samples", "num_groups",
                             F.coalesce(F.col("total_samples") / F.nullif(F.col("num_groups"), F.lit(0)),
                                        F.lit(0.0)).alias("avg_group_size"),
                             F.coalesce("avg_reward", F.lit(0.0)).alias("avg_reward"))
        _put(stats, out, batch_id)

    q = (items.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/_checkpoint")
              .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).drop(_BATCH)


def stream_metrics(items: DataFrame, spark: SparkSession, *, window: str = "1 day", watermark: str = "1 day",
                   name: str = "stream_metrics") -> DataFrame:
    """U8: per event-time window: samples, mean reward, truncated ratio.
    Update mode; each micro-batch appends its updated windows and the read
    back keeps the latest version of every window."""
    agg = (items.withWatermark("ts", watermark)
                .groupBy(F.window("ts", window).alias("w"))
                .agg(F.count(F.lit(1)).alias("n_samples"), F.avg("reward").alias("reward_mean"),
                     F.avg((F.col("finish_reason") == "length").cast("double")).alias("truncated_ratio")))
    base = run_dir(spark, name)
    out = f"{base}/metrics"

    def write(batch: DataFrame, batch_id: int) -> None:
        _put(batch.select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.col("w.start").alias("window_start"),
                          "n_samples", "reward_mean", "truncated_ratio"), out, batch_id)

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    hist = spark.read.parquet(out).drop(_BATCH)
    last = hist.groupBy("window_start").agg(F.max("batch_id").alias("batch_id"))
    return hist.join(last, ["window_start", "batch_id"]).drop("batch_id")


def filter_groups_stream(groups: DataFrame, spark: SparkSession, name: str = "filter_refill"
                         ) -> tuple[DataFrame, DataFrame]:
    """The dynamic filter applied to each micro-batch of emitted groups
    (groups keep zero-variance rewards out of training); kept members and
    per-batch drop counts by reason are appended to two sinks and read back."""
    from ..operators import groups as G
    base = run_dir(spark, name)
    kept_path, drop_path = f"{base}/kept", f"{base}/drops"
    keys = ("instance_id", "group_seq")

    def write(batch: DataFrame, batch_id: int) -> None:
        _put(G.nonzero_std_filter(batch, group_cols=keys), kept_path, batch_id)
        _put(G.filter_drop_reasons(batch, group_cols=keys).withColumn("batch_id", F.lit(batch_id).cast("bigint")),
             drop_path, batch_id)

    q = (groups.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/_checkpoint")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return (_written(spark, kept_path, groups.schema).drop(_BATCH),
            _written(spark, drop_path, T._parse_datatype_string("reason string, n_groups long, batch_id long")).drop(_BATCH))


class PartialRollouts:
    """U4: every micro-batch is one rollout. It takes up to ``n`` groups (None: all), those of the buffer first in the order in which
    they were put back, then new ones by their last item's time; ``generate(members, rollout_id)`` goes on with them (same
    columns); groups without an aborted member are done, the others go back, as do new groups beyond
    ``n``. ``start_rollout_id`` is the rollout that first saw the group aborted and is set once.

    The buffer is two logs, what was put back and what was taken, with a folder per micro-batch that is written whole, and
    a batch reads only the folders before its own: a replayed batch takes and gives the same."""

    KEYS = ["instance_id", "group_seq"]

    def __init__(self, spark: SparkSession, schema: T.StructType, *, n: int | None = None, name: str = "partial",
                 generate: Callable[[DataFrame, int], DataFrame] | None = None):
        self.spark, self.n, self.generate = spark, n, generate or (lambda members, rollout_id: members)
        self.base = run_dir(spark, name)
        self.columns = schema.names
        self.members = T.StructType([*schema.fields, T.StructField("start_rollout_id", T.LongType())])
        self.taken = T.StructType([schema[k] for k in self.KEYS] + [T.StructField("put_in", T.LongType())])
        for what, kind in (("put", self.members), ("taken", self.taken), ("done", self._done_schema())):
            _put(spark.createDataFrame([], kind), f"{self.base}/{what}", -1)

    def _done_schema(self) -> T.StructType:
        return T.StructType([*self.members.fields, T.StructField("rollout_id", T.LongType())])

    def buffer(self, before: int = 1 << 62) -> DataFrame:
        """Members of the groups that wait after the batches before ``before``; ``put_in``: the batch that put them back."""
        put = _written(self.spark, f"{self.base}/put", self.members).filter(F.col(_BATCH) < before).withColumnRenamed(_BATCH, "put_in")
        gone = _written(self.spark, f"{self.base}/taken", self.taken).filter(F.col(_BATCH) < before).drop(_BATCH)
        return put.join(gone, [*self.KEYS, "put_in"], "left_anti")

    def done(self) -> DataFrame:
        return _written(self.spark, f"{self.base}/done", self._done_schema()).drop(_BATCH)

    def _first(self, members: DataFrame, order: list[str], n: int | None) -> DataFrame:
        """Keys of the first ``n`` groups."""
        g = members.groupBy(*self.KEYS).agg(F.max("ts").alias("ts"), *[F.max(c).alias(c) for c in order if c not in (*self.KEYS, "ts")])
        return (g if n is None else g.orderBy(*order).limit(n)).select(*self.KEYS, *[c for c in order if c == "put_in"])

    def rollout(self, batch: DataFrame, batch_id: int) -> None:
        keys = self.KEYS
        waiting = self.buffer(batch_id)
        _put(self._first(waiting, ["put_in", "ts", *keys], self.n), f"{self.base}/taken", batch_id)
        old = self.spark.read.schema(self.taken).parquet(f"{self.base}/taken/{_BATCH}={batch_id}")
        room = None if self.n is None else self.n - old.count()
        new = batch.select(*self.columns, F.lit(None).cast("long").alias("start_rollout_id"))
        # decided once and kept, as two outputs depend on it
        _put(self._first(new, ["ts", *keys], room), f"{self.base}/new", batch_id)
        first = self.spark.read.schema(T.StructType(self.taken.fields[:-1])).parquet(f"{self.base}/new/{_BATCH}={batch_id}")
        mine = waiting.join(old, [*keys, "put_in"], "left_semi").drop("put_in").unionByName(new.join(first, keys, "left_semi"))
        _put(self.generate(mine, batch_id).select(mine.columns), f"{self.base}/went_on", batch_id)
        went_on = self.spark.read.schema(mine.schema).parquet(f"{self.base}/went_on/{_BATCH}={batch_id}")
        partial = went_on.groupBy(*keys).agg(F.bool_or(F.col("finish_reason") == "abort").alias("_partial"))
        tagged = went_on.join(partial, keys)
        rollout_id = F.lit(batch_id).cast("long")
        back = tagged.filter("_partial").select(*self.columns, F.coalesce("start_rollout_id", rollout_id).alias("start_rollout_id"))
        rest = new.join(first, keys, "left_anti")
        _put(back.unionByName(rest.select(back.columns)), f"{self.base}/put", batch_id)
        _put(tagged.filter("not _partial").select(*self.columns, "start_rollout_id", rollout_id.alias("rollout_id")),
             f"{self.base}/done", batch_id)

    def run(self, groups: DataFrame) -> "PartialRollouts":
        """Every micro-batch that ``groups`` has to offer (availableNow)."""
        (groups.writeStream.foreachBatch(self.rollout).option("checkpointLocation", f"{self.base}/_checkpoint")
               .trigger(availableNow=True).start().awaitTermination())
        return self


def collect_until_target(groups: DataFrame, spark: SparkSession, target: int, name: str = "collect"
                         ) -> tuple[DataFrame, DataFrame]:
    """Take complete groups in completion order (last item time, then
    instance) until ``target`` groups are taken; later groups are kept for
    the next rollout.  The count taken so far is carried between
    micro-batches in a small state table.  Returns (taken, kept)."""
    base = run_dir(spark, name)
    taken_path, kept_path = f"{base}/taken", f"{base}/kept"
    keys = ["instance_id", "group_seq"]
    _put(spark.createDataFrame([], groups.schema), taken_path, -1)  # so that the first batch finds a table

    def write(batch: DataFrame, batch_id: int) -> None:
        # groups taken by earlier batches (a replayed batch does not count itself); bounded by target
        so_far = (_written(spark, taken_path, groups.schema).filter(F.col(_BATCH) < batch_id)
                  .select(*keys).distinct().count())
        g = batch.groupBy(*keys).agg(F.max("ts").alias("_done_at"))
        first = g.orderBy("_done_at", *keys).limit(max(target - so_far, 0)).select(*keys)
        _put(first, f"{base}/first", batch_id)  # decided once: both sinks depend on it
        first = spark.read.schema(first.schema).parquet(f"{base}/first/{_BATCH}={batch_id}")
        _put(batch.join(first, keys, "left_semi"), taken_path, batch_id)
        _put(batch.join(first, keys, "left_anti"), kept_path, batch_id)

    q = (groups.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/_checkpoint")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return (_written(spark, taken_path, groups.schema).drop(_BATCH),
            _written(spark, kept_path, groups.schema).drop(_BATCH))
