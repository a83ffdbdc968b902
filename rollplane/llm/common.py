"""Shared pieces of the training-data operators: the shared scratch folder,
word pattern, word hashing inside Arrow batches, distributed weighted cuts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import ensure_checkpoint_dir

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the session's ``spark.checkpoint.dir`` and read it
    back: cuts the lineage, survives lost executors, and gives later joins
    the true size (so Spark broadcasts it only below its own threshold)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def below_cut(keys: Sequence[Column | str], cuts: Sequence[Column | str]) -> Column:
    """keys < cuts in lexicographic order (all non-null longs)."""
    ks = [F.col(k) if isinstance(k, str) else k for k in keys]
    cs = [F.col(c) if isinstance(c, str) else c for c in cuts]
    out = ks[-1] < cs[-1]
    for k, c in list(zip(ks, cs))[-2::-1]:
        out = (k < c) | ((k == c) & out)
    return out


LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def weighted_cuts(rows: DataFrame, targets: DataFrame, keys: Sequence[str], weight: str,
                  group: str = "g", buckets: int = 4096, slack: float = 0.0) -> DataFrame:
    """For each group the lexicographic cut (c0, c1, ...) over long ``keys``
    for which the rows below it weigh as near to ``target`` as whole rows allow.

    ``targets``: (group, target double). Histograms instead of a sort: one pass
    sums the weight by (group, bucket of the key's range), which combines before
    the shuffle to at most ``buckets`` rows per group and task; only the
    boundary bucket is divided again, then the next key breaks ties at the
    boundary value. A group stops early when its boundary bucket weighs no
    more than ``slack`` * target (0: go on to single rows). Keys must lie
    within +-2^62. Result: group, c0.. (longs)."""
    spark = rows.sparkSession
    done: DataFrame | None = None
    prefix: list[str] = []
    state = targets.select(group, F.col("target").alias("full"), F.col("target").alias("need"))
    nk = len(keys)

    def finish(df: DataFrame, key_cut: Column, j: int) -> DataFrame:
        cs = [F.col(p) for p in prefix] + [key_cut] + [F.lit(LOWEST)] * (nk - j - 1)
        return df.select(group, *[c.cast("long").alias(f"c{i}") for i, c in enumerate(cs)])

    for j, key in enumerate(keys):
        base_cols = [group, "full", "need", *prefix]
        # rows tied with the boundary on the earlier keys
        st = state.select(*[F.col(c).alias(f"_{c}" if c != group else c) for c in base_cols])
        cond = rows.join(st, group)
        for i, p in enumerate(prefix):
            cond = cond.filter(F.col(keys[i]) == F.col(f"_{p}"))
        bounds = cond.groupBy(group).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        state = written(state.join(bounds, group), "cut")
        pending = state
        narrowed: DataFrame | None = None
        while True:
            st = pending.select(*[F.col(c).alias(f"_{c}" if c != group else c)
                                  for c in [*base_cols, "lo", "hi"]])
            act = rows.join(st, group)
            for i, p in enumerate(prefix):
                act = act.filter(F.col(keys[i]) == F.col(f"_{p}"))
            act = act.filter(F.col(key).between(F.col("_lo"), F.col("_hi")))
            width = F.expr(f"(_hi - _lo) div {buckets} + 1")
            act = act.withColumn("_w", width).withColumn("_b", F.expr(f"({key} - _lo) div _w"))
            hist = act.groupBy(group, "_b").agg(
                F.sum(weight).alias("bw"), F.count(F.lit(1)).alias("bn"),
                F.min(key).alias("blo"), F.max(key).alias("bhi"))
            w = W.partitionBy(group).orderBy("_b")
            cum = hist.withColumn("before", F.sum("bw").over(w) - F.col("bw"))
            j2 = cum.join(pending.select(*base_cols), group)
            # the bucket in which the running weight passes what is still needed
            cross = j2.filter((F.col("before") <= F.col("need")) & (F.col("before") + F.col("bw") > F.col("need")))
            nxt = cross.select(group, "full", (F.col("need") - F.col("before")).alias("need"), *prefix,
                               F.col("blo").alias("lo"), F.col("bhi").alias("hi"), "bw", "bn")
            # groups that need all of their rows never cross: the cut lies above the last row
            step = pending.select(*base_cols).withColumnsRenamed({"full": "full0", "need": "need0"}).join(
                nxt.drop(*prefix), group, "left")
            step = written(step, "cut")
            over = F.col("bn").isNull()
            small = ~over & ((F.col("bn") == 1) | (F.col("bw") <= F.col("full") * slack))
            last_tie = ~over & ~small & (F.col("lo") == F.col("hi")) & F.lit(j == nk - 1)
            tie = ~over & ~small & (F.col("lo") == F.col("hi")) & F.lit(j < nk - 1)
            edge = F.when(over, F.lit(HIGHEST)).when(F.col("need") * 2 >= F.col("bw"), F.col("hi") + 1) \
                .otherwise(F.col("lo"))
            ended = finish(step.filter(over | small | last_tie), edge, j)
            done = ended if done is None else done.unionByName(ended)
            t = step.filter(tie).select(group, "full", "need", *prefix, F.col("lo").alias(f"c{j}"))
            narrowed = t if narrowed is None else narrowed.unionByName(t)
            pending = step.filter(~over & ~small & (F.col("lo") < F.col("hi"))).select(
                *base_cols, "lo", "hi")
            if pending.isEmpty():
                break
        prefix = prefix + [f"c{j}"]
        if j == nk - 1:
            break
        state = written(narrowed, "cut")
        if state.isEmpty():
            break
    return written(done, "cuts")


BITMAP_BITS = 23


def maybe_among(keys: DataFrame, key: str):
    """A test for rows whose long key may be among ``keys`` (wide rows are
    screened by it before a join, so that only those the join needs are
    shuffled). It is a bitmap of fixed size: 2^23 bits, 1 MB, however many
    keys there are; with very many it lets everything through and the join
    does the work alone. Never says no to a key that is there."""
    spark = keys.sparkSession
    words = (keys.select(F.expr(f"pmod({key}, {1 << BITMAP_BITS})").alias("p"))
                 .groupBy(F.expr("cast(p div 32 as int)").alias("i"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(p % 32 as int)))").alias("bits")).collect())
    table = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for r in words:  # at most 2^18 rows
        table[r["i"]] = r["bits"]
    bitmap = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def test(k: pd.Series) -> pd.Series:
        p = k.to_numpy().astype(np.int64) % (1 << BITMAP_BITS)
        return pd.Series((bitmap.value[p >> 5] >> (p & 31).astype(np.uint32)) & np.uint32(1) == 1)

    return test


def drop_marked(docs: DataFrame, verdict: DataFrame, doc_id: Column, digest: Column) -> DataFrame:
    """``docs`` without the rows that ``verdict`` (doc_id, digest, kept) drops.
    ``doc_id`` and ``digest`` read a row given as the struct ``_doc``. An (id, digest)
    that loses all its rows is anti-joined; one that keeps a single row of several is
    reduced to its least row. Rows that the bitmap clears pass by without a shuffle."""
    pairs = written(verdict.groupBy("doc_id", "digest").agg(F.sum(F.col("kept").cast("int")).alias("k"),
                                                            F.count(F.lit(1)).alias("n"))
                           .filter("k = 0 or n > 1").select(F.col("doc_id").alias("_id"), "digest", "k"), "dropped")
    marked = maybe_among(pairs.select(F.xxhash64("digest").alias("h")), "h")
    d = docs.select(F.struct("*").alias("_doc")).withColumn("_d", digest)
    d = d.withColumn("_hit", marked(F.xxhash64("_d")))
    on = doc_id.eqNullSafe(F.col("_id")) & (F.col("_d") == F.col("digest"))
    hit = d.filter("_hit")
    once = hit.join(pairs, on, "left_anti").select("_doc")
    twice = hit.join(pairs.filter("k > 0"), on).groupBy("_id", "digest").agg(F.min("_doc").alias("_doc")).select("_doc")
    return d.filter("not _hit").select("_doc").unionByName(once).unionByName(twice).select("_doc.*")
