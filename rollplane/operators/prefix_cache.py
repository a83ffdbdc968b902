"""Prefix cache as joins (D6, E21, U7): re-aimed from an in-memory trie.

Cached entries are (text, tokens, log-probs, mask, weight_version) rows; each entry holds the
tokens of its whole text. A lookup finds, per text, the longest entry that is a prefix of it.

Texts and entries are cut into blocks of ``BLOCK`` bytes. One pass over a batch gives the rolling
hash of every prefix that ends at a block boundary (prefix sums of a polynomial). An entry is
(b, hash of its first b blocks, tail of less than a block); a text is one row per block: (b, the
same hash, the block's bytes), so what is shuffled is linear in the text. Three n:1 joins follow:

1. on (b, hash) with one row per key that holds, as a bit mask, the tail lengths to be tried;
2. on (b, hash, tail) with the entries' least id, one row per entry that may be a prefix;
3. the winner (longest, then least id) fetches its entry, and its text is compared in full. Where
   that fails (equal hashes of different prefixes) all matches of the text are compared.

A prompt that all texts share makes a hot key on the text side of an n:1 join only, which
AQE splits; the first block, whose hash all texts share, is matched through a one-row broadcast.

Defined cases: null texts match nothing, null entries are never found, an empty entry is a prefix of every text; of
entries with equal text the least id stands for all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..plans.ordering import attach_scalars
from ..session import ensure_checkpoint_dir

BLOCK = 64
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
SLICE_BYTES = 1 << 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_ODD)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def prefix_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, from one pass over ``data``; equal bytes hash alike anywhere."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _powers(_ODD, len(data) + 1)[:-1], out=sums[1:])
    body = (sums[end] - sums[start]) * _powers(_INVERSE, len(data) + 1)[start]
    return _mix(body + (end - start).astype(np.uint64) * np.uint64(_ODD))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) of rows whose texts make some SLICE_BYTES."""
    for b in batches:
        off = np.frombuffer(b.column(1).buffers()[1], np.int32)[b.column(1).offset:b.column(1).offset + b.num_rows + 1].astype(np.int64)
        body = b.column(1).buffers()[2]
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + SLICE_BYTES, "right")) - 1)
            data = np.frombuffer(body, np.uint8)[off[lo]:off[hi]] if body is not None else np.empty(0, np.uint8)
            yield b.column(0).slice(lo, hi - lo), data, off[lo:hi + 1] - off[lo]
            lo = hi


def _binary(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    upto = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(int(upto[-1])) + np.repeat(start - upto[:-1], size)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(data[at])])


def text_blocks(texts: DataFrame, text_id: str, text_col: str) -> DataFrame:
    """_tid, _b, _key, _part: every block of every text, the empty one at its end included."""
    kind = texts.schema[text_id].dataType.simpleString()

    def cut(batches):
        for ids, data, off in _slices(batches):
            n = np.diff(off) // BLOCK + 1
            row = np.repeat(np.arange(len(ids)), n)
            b = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = off[row] + b * BLOCK
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(row)), pa.array(b.astype(np.int32)), pa.array(prefix_hashes(data, off[row], start).view(np.int64)),
                _binary(data, start, np.minimum(start + BLOCK, off[row + 1]))], ["_tid", "_b", "_key", "_part"])

    given = texts.filter(F.col(text_col).isNotNull()).select(F.col(text_id).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return given.mapInArrow(cut, f"_tid {kind}, _b int, _key long, _part binary")


def entry_keys(cache: DataFrame, entry_id: str, entry_col: str) -> DataFrame:
    """_eid, _b, _key, _tail of every entry."""
    kind = cache.schema[entry_id].dataType.simpleString()

    def cut(batches):
        for ids, data, off in _slices(batches):
            b = np.diff(off) // BLOCK
            start = off[:-1] + b * BLOCK
            yield pa.RecordBatch.from_arrays([ids, pa.array(b.astype(np.int32)), pa.array(prefix_hashes(data, off[:-1], start).view(np.int64)),
                                              _binary(data, start, off[1:])], ["_eid", "_b", "_key", "_tail"])

    given = cache.filter(F.col(entry_col).isNotNull()).select(F.col(entry_id).alias("_id"), F.col(entry_col).cast("binary").alias("_text"))
    return given.mapInArrow(cut, f"_eid {kind}, _b int, _key long, _tail binary")


def prefix_matches(texts: DataFrame, cache: DataFrame, *, text_id: str, text_col: str, entry_id: str, entry_col: str) -> DataFrame:
    """_tid, _eid, _bytes: for each text the entries that are a prefix by hash and tail (equal texts: the least id)."""
    keys = entry_keys(cache, entry_id, entry_col).groupBy("_b", "_key", "_tail").agg(F.min("_eid").alias("_eid"))
    masks = keys.groupBy("_b", "_key").agg(F.bit_or(F.expr("shiftleft(1L, octet_length(_tail))")).alias("_mask"))
    blocks = text_blocks(texts, text_id, text_col)
    first = masks.filter("_b = 0").agg(F.coalesce(F.bit_or("_mask"), F.lit(0).cast("long")).alias("_mask"))
    tried = attach_scalars(blocks.filter("_b = 0"), first).unionByName(blocks.filter("_b > 0").join(masks.filter("_b > 0"), ["_b", "_key"]))
    sizes = F.expr(f"filter(sequence(0, least(octet_length(_part), {BLOCK - 1})), r -> shiftright(_mask, r) % 2 != 0)")
    tails = (tried.select("_tid", "_b", "_key", "_part", F.explode(sizes).alias("_r"))
                  .select("_tid", "_b", "_key", F.expr("substring(_part, 1, _r)").alias("_tail")))
    return tails.join(keys, ["_b", "_key", "_tail"]).select("_tid", "_eid", F.expr(f"cast(_b as long) * {BLOCK} + octet_length(_tail)").alias("_bytes"))


def longest_prefix_join(texts: DataFrame, cache: DataFrame, *, text_id: str, text_col: str, entry_id: str,
                        entry_col: str, payload: Sequence[str] = ()) -> DataFrame:
    """Per text: the id and length (characters) of the longest cached entry that is a prefix, and the entry's
    ``payload`` columns (null and 0 where there is none)."""
    found = prefix_matches(texts, cache, text_id=text_id, text_col=text_col, entry_id=entry_id, entry_col=entry_col)
    t = texts.select(F.col(text_id).alias("_tid"), F.col(text_col).alias("_ttext"))
    e = cache.select(F.col(entry_id).alias("_eid"), F.col(entry_col).alias("_etext"), *payload)
    # the least id of the greatest length
    best = found.groupBy("_tid").agg(F.max_by(F.struct("_eid"), "_bytes").alias("_m"), F.count(F.lit(1)).alias("_n"))
    held = best.select("_tid", "_n", "_m._eid").join(e, "_eid").join(t, "_tid").withColumn("_ok", F.col("_ttext").startswith(F.col("_etext")))
    cols = ["_tid", "_eid", F.length("_etext").alias("_len"), *payload]
    sure = held.filter("_ok").select(cols)
    unsure = held.filter("not _ok and _n > 1").select("_tid")
    again = (found.join(unsure, "_tid").join(e, "_eid").join(t, "_tid").filter(F.col("_ttext").startswith(F.col("_etext"))).select(cols)
             .groupBy("_tid").agg(F.max_by(F.struct("_eid", "_len", *payload), "_len").alias("_m")).select("_tid", "_m.*"))
    won = sure.unionByName(again).withColumnRenamed("_tid", text_id)
    return (texts.select(text_id).join(won, text_id, "left")
                 .select(text_id, F.col("_eid").alias("match_id"), F.coalesce("_len", F.lit(0)).alias("match_len"), *payload))


def cached_tokens(texts: DataFrame, cache: DataFrame, tokenize: Callable[[Column], Column], *, text_id: str, text_col: str, entry_id: str,
                  entry_col: str, tokens: str = "tokens", log_probs: str = "log_probs", loss_mask: str = "loss_mask") -> DataFrame:
    """Tokens, log-probs and loss mask of each text: the longest entry's own, then those of the rest of the text by
    ``tokenize`` with log-prob 0 and mask 0. A text without an entry is tokenised whole. Entries without
    tokens, or with log-probs or a mask of another length, are not used; a missing log-prob or mask array
    counts as zeros."""
    n = F.size(tokens)
    fits = lambda c: F.col(c).isNull() | (F.size(c) == n)
    good = cache.filter((n > 0) & fits(log_probs) & fits(loss_mask))
    hit = longest_prefix_join(texts, good, text_id=text_id, text_col=text_col, entry_id=entry_id, entry_col=entry_col,
                              payload=[tokens, log_probs, loss_mask])
    rest = F.substring(text_col, F.col("match_len") + 1, F.length(text_col))
    j = texts.select(text_id, text_col).join(hit, text_id).withColumn("_rest", F.when(rest != "", tokenize(rest)))
    own, more = F.coalesce(F.size(tokens), F.lit(0)), F.greatest(F.coalesce(F.size("_rest"), F.lit(0)), F.lit(0))

    def padded(c: str, zero: Column) -> Column:
        return F.concat(F.coalesce(F.col(c), F.array_repeat(zero, F.greatest(own, F.lit(0)))), F.array_repeat(zero, more))

    kind = cache.schema[tokens].dataType
    nothing = F.array().cast(kind)
    return j.select(text_id, "match_id", "match_len",
                    F.concat(F.coalesce(F.col(tokens), nothing), F.coalesce(F.col("_rest").cast(kind), nothing)).alias(tokens),
                    padded(log_probs, F.lit(0.0)).alias(log_probs), padded(loss_mask, F.lit(0)).alias(loss_mask))


def prefix_cache_stats(matches: DataFrame, cache: DataFrame) -> DataFrame:
    """Cache entries, hits, misses and hit rate of a lookup batch."""
    hits = matches.agg(F.count_if(F.col("match_id").isNotNull()).alias("hits"),
                       F.count_if(F.col("match_id").isNull()).alias("misses"))
    n = cache.agg(F.count(F.lit(1)).alias("entries"))
    return attach_scalars(hits, n).select(
        "entries", "hits", "misses",
        F.coalesce(F.col("hits") / F.nullif(F.col("hits") + F.col("misses"), F.lit(0)), F.lit(0.0)).alias("hit_rate"))


# U7 ---------------------------------------------------------------------------
def outdated(cache: DataFrame, *, current_version: int, keep_versions: int, entry_id: str = "entry_id", entry_col: str = "entry",
             version_col: str = "weight_version") -> DataFrame:
    """Ids (``entry_id``) of the entries that a collection at ``current_version`` removes: those of weight version
    <= current - keep, and every entry that extends one of them (its sub-tree). A null version is never outdated."""
    old = cache.filter(F.col(version_col) <= current_version - keep_versions).select(F.col(entry_id).alias("_old"), F.col(entry_col).alias("_text"))
    under = longest_prefix_join(cache, old, text_id=entry_id, text_col=entry_col, entry_id="_old", entry_col="_text")
    return under.filter(F.col("match_id").isNotNull()).select(entry_id)


def version_gc(cache: DataFrame, *, current_version: int, keep_versions: int, max_size: int | None = None, size_col: str | None = None,
               entry_id: str = "entry_id", entry_col: str = "entry", version_col: str = "weight_version") -> DataFrame:
    """The cache without its outdated sub-trees. With ``max_size`` it is collected only when the sum of ``size_col``
    (tokens) exceeds it."""
    gone = outdated(cache, current_version=current_version, keep_versions=keep_versions, entry_id=entry_id, entry_col=entry_col,
                    version_col=version_col)
    if max_size is not None:
        total = cache.agg(F.coalesce(F.sum(size_col), F.lit(0)).alias("_total"))
        gone = attach_scalars(gone, total).filter(F.col("_total") > max_size).select(entry_id)
    return cache.join(gone, entry_id, "left_anti")


class StreamingCache:
    """U7 over a stream of entries: (entry_id, entry, size_col, weight_version, ..). Every micro-batch appends its new entries
    (a text that is already cached keeps its first entry) and, when the tokens held exceed
    ``max_size``, the ids that a collection at the batch's largest version removes. Both are folders of their own
    per batch, written whole, so a replayed batch changes nothing; live entries are the difference."""

    def __init__(self, spark: SparkSession, schema: T.StructType, *, max_size: int, keep_versions: int, size_col: str = "n_tokens",
                 entry_id: str = "entry_id", entry_col: str = "entry", version_col: str = "weight_version"):
        self.spark, self.schema, self.max_size, self.keep = spark, schema, max_size, keep_versions
        self.size_col, self.id, self.text, self.version = size_col, entry_id, entry_col, version_col
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/prefix-cache-{uuid.uuid4().hex}"
        self._put(spark.createDataFrame([], schema), "added", -1)
        self._put(spark.createDataFrame([], schema).select(entry_id), "removed", -1)

    def _put(self, df: DataFrame, what: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{what}/batch={batch_id}")

    def _read(self, what: str, schema: T.StructType, upto: int) -> DataFrame:
        kept = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(kept).parquet(f"{self.path}/{what}").filter(F.col("batch") <= upto)

    def entries(self, upto: int = (1 << 62)) -> DataFrame:
        """Live entries after batch ``upto``: those that no collection of their own or a later batch removed."""
        gone = self._read("removed", T.StructType([self.schema[self.id]]), upto).withColumnsRenamed({self.id: "_gone", "batch": "_when"})
        added = self._read("added", self.schema, upto)
        return added.join(gone, (F.col(self.id) == F.col("_gone")) & (F.col("_when") >= F.col("batch")), "left_anti").drop("batch")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        def keyed(df: DataFrame) -> DataFrame:
            return df.withColumn("_h", F.sha2(F.col(self.text).cast("binary"), 256))

        held = self.entries(batch_id - 1)
        new = keyed(batch.filter((F.length(self.text) > 0) & (F.col(self.size_col) > 0)))
        new = new.groupBy("_h").agg(F.min_by(F.struct(*self.schema.names), F.col(self.id)).alias("_e"))
        self._put(new.join(keyed(held).select("_h"), "_h", "left_anti").select("_e.*"), "added", batch_id)
        live = held.unionByName(self._read("added", self.schema, batch_id).filter(F.col("batch") == batch_id).drop("batch"))
        size = live.agg(F.sum(self.size_col).alias("size")).first()["size"] or 0
        version = batch.agg(F.max(self.version).alias("v")).first()["v"]
        gone = live.select(self.id).limit(0)
        if size > self.max_size and version is not None:
            gone = outdated(live, current_version=version, keep_versions=self.keep, entry_id=self.id, entry_col=self.text,
                            version_col=self.version)
        self._put(gone, "removed", batch_id)

    def run(self, stream: DataFrame) -> DataFrame:
        """Take in all that the stream has (availableNow); the live entries."""
        (stream.select(*self.schema.names).writeStream.foreachBatch(self.add).option("checkpointLocation", f"{self.path}/_checkpoint")
               .trigger(availableNow=True).start().awaitTermination())
        return self.entries()
