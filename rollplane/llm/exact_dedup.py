"""Exact dedup of an incoming batch against an immutable snapshot.

A snapshot holds its distinct digests in buckets (``spark.checkpoint.dir``) and
one static 3-wise binary-fuse filter per bucket. An incoming batch is first
grouped by digest (its own duplicates: partial sums before the shuffle, so a hot
text is one row); the distinct digests are screened by the filter of their
bucket; only positives join the exact buckets, where the texts of both sides
are compared byte for byte.

Defined cases: null text counts as empty, and empty texts are equal to each
other; a null id sorts lowest (it stays only if all ids of its group are null);
repeated rows of one id and text keep one row; an empty snapshot or batch is
allowed; texts of any length are compared whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import drop_marked, maybe_among, written

KEYS_PER_FILTER = 4096
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _slots(h: np.ndarray, seg_len: int, seg_count: int) -> np.ndarray:
    """The three slots of each key: one in each of three consecutive segments."""
    first = ((h >> np.uint64(32)) * np.uint64(seg_len * seg_count)) >> np.uint64(32)
    mask = np.uint64(seg_len - 1)
    s1 = (first + np.uint64(seg_len)) ^ ((h >> np.uint64(18)) & mask)
    s2 = (first + np.uint64(2 * seg_len)) ^ (h & mask)
    return np.stack([first, s1, s2]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_fuse(keys: np.ndarray) -> tuple[int, int, bytes]:
    """Binary-fuse filter of distinct uint64 keys: (seed, segment length, 8-bit
    table). Peeled in rounds: all keys that are alone in some slot go at once."""
    n = len(keys)
    seg_len = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    seg_count = max(1, int(np.ceil(n * factor / seg_len)) - 2)
    for attempt in range(100):
        if attempt and attempt % 10 == 0:
            seg_count += 1
        seed = 0x9E3779B97F4A7C15 * (attempt + 1) & (1 << 64) - 1
        h = _mix(keys, seed)
        slots = _slots(h, seg_len, seg_count)
        size = seg_len * (seg_count + 2)
        count = np.bincount(slots.ravel(), minlength=size)
        held = np.zeros(size, np.int64)
        np.bitwise_xor.at(held, slots.ravel(), np.tile(np.arange(n), 3))
        peeled: list[tuple[np.ndarray, np.ndarray]] = []
        left = n
        while left:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                break
            k, at = np.unique(held[alone], return_index=True)
            peeled.append((k, alone[at]))
            gone = slots[:, k]
            np.subtract.at(count, gone.ravel(), 1)
            np.bitwise_xor.at(held, gone.ravel(), np.tile(k, 3))
            left -= len(k)
        if left == 0:
            table, prints = np.zeros(size, np.uint8), _prints(h)
            for k, slot in reversed(peeled):
                s = slots[:, k]
                table[slot] = 0
                table[slot] = prints[k] ^ table[s[0]] ^ table[s[1]] ^ table[s[2]]
            return seed, seg_len, table.tobytes()
    raise RuntimeError("binary-fuse construction failed: keys repeat")


def in_fuse(keys: np.ndarray, seed: int, seg_len: int, table: bytes) -> np.ndarray:
    t = np.frombuffer(table, np.uint8)
    h = _mix(keys, seed)
    s = _slots(h, seg_len, len(t) // seg_len - 2)
    return _prints(h) == t[s[0]] ^ t[s[1]] ^ t[s[2]]


@dataclass
class Snapshot:
    """Immutable: exact buckets (bucket, key, digest, n, keep) and filters
    (bucket, seed, seg_len, fuse), both written tables."""
    buckets: DataFrame
    filters: DataFrame
    n_buckets: int


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow rows: doc_id, digest (SHA-256 of the UTF-8 text), key, rid."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
                .withColumn("key", F.xxhash64("digest"))
                .withColumn("rid", F.monotonically_increasing_id()))


def group_digests(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: count and the row that stays (largest id, then row)."""
    return rows.groupBy("digest", "key").agg(F.count(F.lit(1)).alias("n"),
                                             F.max(F.struct("doc_id", "rid")).alias("keep"))


def build_snapshot(rows: DataFrame, keys_per_filter: int = KEYS_PER_FILTER) -> Snapshot:
    groups = written(group_digests(rows), "digests")
    n_buckets = max(1, -(-groups.count() // keys_per_filter))
    buckets = groups.withColumn("bucket", F.expr(f"pmod(key, {n_buckets})"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(pdf["key"].to_numpy().astype(np.int64).view(np.uint64))
        seed, seg_len, table = build_fuse(keys)
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [np.uint64(seed).astype(np.int64)],
                             "seg_len": [seg_len], "fuse": [table]})

    filters = buckets.select("bucket", "key").groupBy("bucket").applyInPandas(
        build, "bucket long, seed long, seg_len int, fuse binary")
    return Snapshot(buckets, written(filters, "fuse"), n_buckets)


def screen(groups: DataFrame, snap: Snapshot) -> DataFrame:
    """The batch's distinct digests that their bucket's filter does not rule out."""
    def test(pdf: pd.DataFrame, flt: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(flt):
            return pdf.iloc[:0][["digest"]]
        f = flt.iloc[0]
        hit = in_fuse(pdf["key"].to_numpy().astype(np.int64).view(np.uint64),
                      int(np.int64(f["seed"]).view(np.uint64)), int(f["seg_len"]), f["fuse"])
        return pdf.loc[hit, ["digest"]]

    keyed = groups.select("digest", "key", F.expr(f"pmod(key, {snap.n_buckets})").alias("bucket"))
    return keyed.groupBy("bucket").cogroup(snap.filters.groupBy("bucket")).applyInPandas(test, "digest binary")


def byte_checked(docs: DataFrame, matches: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Digests whose snapshot text and batch text are equal byte for byte."""
    want = matches.select("digest", F.explode(F.array("keep.doc_id", "snap_keep.doc_id")).alias("_id")).distinct()
    want = written(want, "want")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                        F.unhex(F.sha2(text.cast("binary"), 256)).alias("_d"))
    # only texts that may be wanted are shuffled
    texts = texts.filter(maybe_among(want.select(F.xxhash64("digest").alias("k")), "k")(F.xxhash64("_d")))
    got = texts.join(want, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_d") == F.col("digest")))
    return (got.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b"))
               .filter(F.col("a") == F.col("b")).select("digest"))


def exact_dedup(docs: DataFrame, in_batch: Column, id_col: str = "doc_id", text_col: str = "text",
                keys_per_filter: int = KEYS_PER_FILTER) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept, rid,
    in_batch. ``in_batch`` says which rows arrive against the snapshot of the others;
    it is evaluated over (doc_id, digest, key)."""
    rows = written(digest_rows(docs, id_col, text_col).withColumn("in_batch", F.coalesce(in_batch, F.lit(False))),
                   "docdigests")
    snap = build_snapshot(rows.filter(~F.col("in_batch")), keys_per_filter)
    batch = written(group_digests(rows.filter("in_batch")), "batchgroups")
    hits = screen(batch, snap)
    matches = written(batch.join(hits, "digest", "left_semi")
                           .join(snap.buckets.select("digest", F.col("n").alias("snap_n"),
                                                     F.col("keep").alias("snap_keep")), "digest"), "matches")
    same = written(matches.join(byte_checked(docs, matches, id_col, text_col), "digest", "left_semi"), "same")
    merged = same.select("digest", F.greatest("keep", "snap_keep").alias("keep2"),
                         (F.col("n") + F.col("snap_n")).alias("n2"))
    both = snap.buckets.select("digest", "keep", "n", F.lit(False).alias("in_batch")).unionByName(
        batch.select("digest", "keep", "n", F.lit(True).alias("in_batch")))
    stats = written(both.join(merged, "digest", "left").select(
        "digest", "in_batch", F.coalesce("keep2", "keep").alias("keep"),
        F.coalesce("n2", "n").alias("group_size")), "dupstats")
    return rows.join(stats, ["digest", "in_batch"]).select(
        "doc_id", "digest", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), "rid", "in_batch")


def arrived_later() -> Column:
    """Half of the documents by a hash of id and text: the incoming batch."""
    return F.expr("pmod(xxhash64(doc_id, digest), 2) = 1")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    verdict = exact_dedup(docs, arrived_later(), id_col, text_col)
    digest = F.unhex(F.sha2(F.coalesce(F.col(f"_doc.{text_col}"), F.lit("")).cast("binary"), 256))
    return drop_marked(docs, verdict, F.col(f"_doc.{id_col}"), digest)


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    out = exact_dedup(read_table(spark, sf_dir, "documents"), arrived_later())
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP7_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
