"""Byte-level BPE over a global shuffle of distinct words.

Texts are split into pre-tokens by the pattern (JVM), once. Each block of documents
lists its distinct pre-tokens once and keeps the documents as positions into
that list. Lists and positions go through one exchange: the lists are shuffled by word, so every distinct word of the corpus
is merged once, in one place; its ids go back to the blocks that hold it and the
documents are put together again by position. A word comes at most once from
each block, so frequent words make no hot key. All lists are shuffled as compressed bytes. Decoding joins the
ids with the token-byte table, whose size is the vocabulary's (broadcast).

Defined cases: null and empty text encode to no ids; a pre-token of any length
is merged in O(n log n); repeated rows give repeated rows; a null id stays null;
an empty table gives no rows; columns other than id and text are ignored. The
documents must be a replayable read (files, or a written table): blocks are named
by partition, and a checksum over each block's words guards the reassembly.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .hashing import pack, pack_strings, runs, string_hashes, unpack, unpack_strings

BLOCK_WORDS = 1_500_000
SLICE_WORDS = 250_000
SPLIT_COLUMNS = ["key", "block", "sizes", "words", "at", "check", "ids", "lens", "n_distinct"]
MERGED = pa.schema([("key", pa.int64()), ("at", pa.binary()), ("check", pa.int64()), ("n_distinct", pa.int32()),
                    ("n", pa.binary()), ("ids", pa.binary())])
ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> id, from a rank file (base64 token, space, rank) that the driver reads."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def java_pattern(pattern: str) -> str:
    """White space of the pattern as the Unicode property (Java's own \\s is ASCII)."""
    return pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged first
    (leftmost of equals) until no pair is in the vocabulary."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= 24:  # short: look over all pairs again after each merge
        parts = [word[i:i + 1] for i in range(n)]
        while True:
            pairs = [ranks.get(a + b, 1 << 31) for a, b in zip(parts, parts[1:])]
            low = min(pairs, default=1 << 31)
            if low == 1 << 31:
                return [ranks[p] for p in parts]
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
    end = list(range(1, n + 1))        # of the piece that starts at i
    left = list(range(-1, n - 1))      # start of the piece before
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not alive[i] or mid >= n or end[mid] != stop:
            continue  # one of the two pieces has been merged since
        end[i], alive[mid] = stop, False
        if stop < n:
            left[stop] = i
            if (r := ranks.get(word[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if left[i] >= 0 and (r := ranks.get(word[left[i]:stop])) is not None:
            heapq.heappush(heap, (r, left[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], limit: int):
    """(block, ids, words per document, distinct words, positions) for blocks of about ``limit`` words."""
    part, k, held, n = TaskContext.get().partitionId(), 0, [], 0

    def block():
        lists = pa.concat_arrays([b.column(1).cast(pa.list_(pa.string())) for b in held])
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # frequent words first: small positions compress well
        order = np.argsort(-np.bincount(at, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return ((part << 32) | k, pa.concat_arrays([b.column(0) for b in held]),
                np.diff(lists.offsets.to_numpy().astype(np.int64)), coded.dictionary.take(pa.array(order)), rank[at])

    for b in batches:
        if b.num_rows:
            held.append(b)
            n += len(b.column(1).flatten())
        if n >= limit:
            yield block()
            k, held, n = k + 1, [], 0
            pa.default_memory_pool().release_unused()
    if held:
        yield block()


def _checksum(words: pa.Array) -> np.ndarray:
    return (string_hashes(words) >> np.uint64(1)).astype(np.int64)


def pretokens(docs: DataFrame, pattern: str, id_col: str, text_col: str) -> DataFrame:
    found = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), found.alias("pre"))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, ids (array<int>) for every row."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(ranks)  # bounded by the vocabulary
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pre = pretokens(docs, pattern, id_col, text_col)

    def split(batches):
        """Both row kinds of a block: its positions under the block's own key, its words under the
        keys -1, -2, .. of their buckets."""
        for block, ids, lens, distinct, at in _blocks(batches, block_words):
            sums = _checksum(distinct)
            check = int(np.bitwise_xor.reduce(sums)) if len(distinct) else 0
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([block], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                pa.array([pack(at)], pa.binary()), pa.array([check], pa.int64()),
                pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([lens.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([len(distinct)], pa.int32())], SPLIT_COLUMNS)
            bucket = sums % n_buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            full = [b for b in range(n_buckets) if cuts[b] < cuts[b + 1]]
            mine = [order[cuts[b]:cuts[b + 1]] for b in full]
            packed = [pack_strings(distinct.take(pa.array(x))) for x in mine]
            yield pa.RecordBatch.from_arrays([
                pa.array([-1 - b for b in full], pa.int64()), pa.array([block] * len(full), pa.int64()),
                pa.array([x for x, _ in packed], pa.binary()), pa.array([x for _, x in packed], pa.binary()),
                pa.array([pack(np.diff(x, prepend=0)) for x in mine], pa.binary()),
                pa.array([int(np.bitwise_xor.reduce(sums[x])) for x in mine], pa.int64()),
                pa.nulls(len(full), pa.list_(pa.int64())), pa.nulls(len(full), pa.list_(pa.int32())),
                pa.array([len(x) for x in mine], pa.int32())], SPLIT_COLUMNS)

    def merge(t: pa.Table) -> pa.Table:
        if t["key"][0].as_py() >= 0:  # a block's positions: they wait for their ids
            return MERGED.empty_table()
        counts = t["n_distinct"].to_numpy().astype(np.int64)
        lists = pa.chunked_array([unpack_strings(x.as_py(), y.as_py(), int(c))
                                  for x, y, c in zip(t["sizes"], t["words"], counts)], pa.string())
        coded = lists.dictionary_encode().unify_dictionaries()
        known = table.value
        each = [merge_word(w.encode(), known) for w in coded.chunk(0).dictionary.to_pylist()]
        n = np.array([len(x) for x in each], np.int64)
        flat = np.fromiter((i for x in each for i in x), np.int32, int(n.sum()))
        start = np.cumsum(n) - n
        found = [c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in coded.chunks]
        return pa.table({
            "key": t["block"], "at": t["at"], "check": t["check"], "n_distinct": t["n_distinct"],
            "n": pa.array([pack(n[x]) for x in found], pa.binary()),
            "ids": pa.array([pack(flat[runs(start[x], n[x])]) for x in found], pa.binary())}).cast(MERGED)

    def assemble(seq: pa.Table, enc: pa.Table) -> pa.Table:
        if seq.num_rows and seq["key"][0].as_py() < 0:  # a bucket's words: merged already
            return ENCODED.empty_table()
        if seq.num_rows != 1:
            raise RuntimeError("a block came back without its documents: the input changed between reads")
        lens = seq["lens"].combine_chunks().flatten().to_numpy().astype(np.int64)
        at = unpack(seq["at"][0].as_py(), int(lens.sum()))
        check, n_words = 0, 0
        n = np.full(seq["n_distinct"][0].as_py(), -1, np.int32)
        start = np.zeros(len(n), np.int64)
        for r in range(enc.num_rows):
            given = unpack(enc["n"][r].as_py(), enc["n_distinct"][r].as_py())
            back = np.cumsum(unpack(enc["at"][r].as_py(), len(given)), dtype=np.int64)
            n[back] = given
            check ^= enc["check"][r].as_py()
            n_words += len(back)
        if n_words != len(n) or (n < 0).any() or check != seq["check"][0].as_py():
            raise RuntimeError("a block's words differ from its documents: the input changed between reads")
        ids = np.empty(int(n.sum(dtype=np.int64)), np.int32)
        filled = 0
        for r in range(enc.num_rows):
            back = np.cumsum(unpack(enc["at"][r].as_py(), enc["n_distinct"][r].as_py()), dtype=np.int64)
            ends = filled + np.cumsum(n[back], dtype=np.int64)
            start[back] = ends - n[back]
            ids[filled:ends[-1]] = unpack(enc["ids"][r].as_py(), int(ends[-1]) - filled)
            filled = int(ends[-1])
        # in slices, so that the index arrays stay small beside the block itself
        doc_ends = np.concatenate(([0], np.cumsum(lens)))
        ends = np.zeros(len(doc_ends), np.int64)
        out = np.empty(int(n[at].sum(dtype=np.int64)), np.int32)
        filled = 0
        for lo in range(0, len(at), SLICE_WORDS):
            x = at[lo:lo + SLICE_WORDS]
            each = n[x].astype(np.int64)
            upto = filled + np.cumsum(each)
            out[filled:upto[-1]] = ids[runs(start[x], each)]
            a, b = np.searchsorted(doc_ends, [lo, lo + len(x)], "right")
            ends[a:b] = upto[doc_ends[a:b] - lo - 1]
            filled = int(upto[-1])
        return pa.table({"doc_id": seq["ids"].combine_chunks().flatten(),
                         "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, pa.int32()))})

    # One pass of the pattern and one exchange serve both sides: the words are merged where they arrive,
    # the positions stay there until the ids come back to them.
    both = pre.mapInArrow(split, "key long, block long, sizes binary, words binary, at binary, check long, "
                                 "ids array<long>, lens array<int>, n_distinct int")
    merged = both.groupBy("key").applyInArrow(merge, "key long, at binary, check long, n_distinct int, n binary, ids binary")
    return both.groupBy("key").cogroup(merged.groupBy("key")).applyInArrow(assemble, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add ``decoded`` (binary): each id joined with its bytes in the broadcast
    token table. An id outside the table is an error."""
    table = encoded.sparkSession.sparkContext.broadcast(
        [t for _, t in sorted((i, t) for t, i in ranks.items())])
    schema = encoded.schema

    def join_bytes(batches):
        token = table.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                b = batch.slice(lo, 1000)
                lists = b.column(b.schema.get_field_index("ids"))
                texts = [b"".join(map(token.__getitem__, x.values.to_pylist())) if x.is_valid else None for x in lists]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())], [*b.schema.names, "decoded"])

    return encoded.mapInArrow(join_bytes, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", decoded binary")


def tokenized(docs: DataFrame, ranks_path: str, pattern: str, **kw) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256 of every row."""
    ranks = load_ranks(ranks_path)
    out = decode(encode(docs, ranks, pattern, **kw), ranks)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    from ..sources.tables import read_table
    return tokenized(read_table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).drop("ids")
