"""Phrase collocations: exact counts by double-array tries over Apriori-safe candidates.

1. Each block of texts of one language is written once as its distinct words and the positions
   as numbers into them (0: a piece ends). Word counts come from the blocks' own counts.
2. Level by level, candidates are screened by hash: a phrase of k words counts only where its
   words, and for k > 2 both its parts of k - 1 words, passed. Blocks send each phrase hash once
   with its count; the hashes' sums are never below the phrases' counts, so a phrase of
   ``min_count`` occurrences always passes. Passed keys become a Bloom filter (16 bits a key,
   2^29 bits at most: beyond, it lets more through, and the result stays the same).
3. Each position whose phrase of two words passed has a window: the longest phrase from it that
   passed (all its beginnings passed, too). Tasks send each distinct window (words, not hashes) of
   a share of their blocks once, with its count, to a shard chosen by its first two words; so all
   windows that a phrase begins are in one shard. There are as many shards as keep each to
   ``shard_phrases`` phrases, ``shard_bytes`` bytes and ``SHARD_POSITIONS`` positions, on average.
4. Each shard builds a double-array trie over the words of its windows, and numpy moves the states
   of all its windows through it, one word at a time; the windows' counts are added at every state
   they pass, so a phrase inside a longer window is counted on the way. These counts are exact and
   are the ones used. Nothing is broadcast but the Bloom filters, and the blocks are gone through a
   fixed number of times (once to a level and once for the windows), however many candidates there are.

Defined cases: null and empty text have no words; a null language counts as ``und``; long texts are
taken whole; repeated rows count each time; ties have a total order (see ``collocations``); an empty
table gives no rows; columns other than language and text are ignored, whatever their
names. The documents must be a replayable read (files or a written table).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..session import ensure_checkpoint_dir
from .hashing import mix64, pack, pack_strings, string_hashes, unpack, unpack_strings

BLOCK_BYTES = 3_000_000
HELD = 500_000  # keys or windows that a task holds before it sends them
SHARD_POSITIONS = 2_000_000
RANK_PARTS = 64
BLOCKS = "lang string, words binary, sizes binary, n binary, n_words int, at binary, n_at int"
GROWTH = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


class Scratch:
    """Written intermediate tables of one run, under ``spark.checkpoint.dir``, and its broadcasts; ``drop`` frees them."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
        self.n = 0
        self.held = []

    def broadcast(self, value):
        self.held.append(self.spark.sparkContext.broadcast(value))
        return self.held[-1]

    def written(self, df: DataFrame) -> DataFrame:
        self.n += 1
        at = f"{self.path}/{self.n}"
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self) -> None:
        for b in self.held:
            b.destroy()
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(conf).delete(path, True)


# --- blocks ------------------------------------------------------------------------------------

def _block(lang: str, texts: list[pa.Array]) -> pa.RecordBatch:
    flat = pc.fill_null(pa.concat_arrays(texts), "")
    line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), "\n")
    data = _LOWER[np.frombuffer(line[0].as_buffer(), np.uint8)]
    kind = _KIND[data]
    word = kind == 0
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
    body = pa.Array.from_buffers(pa.string(), len(begin), [
        None, pa.py_buffer(np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32)), pa.py_buffer(data[word])])
    coded = body.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    n = np.bincount(code, minlength=len(coded.dictionary))
    order = np.argsort(-n, kind="stable")  # frequent words first: small numbers compress well
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    at = np.insert(rank[code], np.flatnonzero(np.diff(piece)) + 1, 0)
    words = coded.dictionary.take(pa.array(order))
    size = np.diff(np.frombuffer(words.buffers()[1], np.int32)[:len(words) + 1]) if len(words) else np.empty(0, np.int64)
    text = pa.Codec("zstd").compress(words.buffers()[2] if len(words) else b"", asbytes=True)
    cell = lambda x, t=pa.binary(): pa.array([x], t)
    return pa.RecordBatch.from_arrays([
        cell(lang, pa.string()), cell(text), cell(pack(size)), cell(pack(n[order])), cell(len(order), pa.int32()), cell(pack(at)),
        cell(len(at), pa.int32())], ["lang", "words", "sizes", "n", "n_words", "at", "n_at"])


def blocks_of(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of texts of one language: its distinct words (end to end, with their sizes), their counts
    and the positions, all packed, so that a batch of blocks stays small."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                langs = part.column(0).dictionary_encode()
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    mine = part.column(1).filter(pc.equal(langs.indices, i))
                    held.setdefault(lang, []).append(mine)
                    size[lang] = size.get(lang, 0) + mine.nbytes
                    if size[lang] >= block_bytes:
                        yield _block(lang, held.pop(lang))
                        del size[lang]
                        pa.default_memory_pool().release_unused()
                if sum(size.values()) >= 4 * block_bytes:  # very many languages
                    for lang in list(held):
                        yield _block(lang, held.pop(lang))
                    size.clear()
        for lang, texts in held.items():
            yield _block(lang, texts)

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")).mapInArrow(gather, BLOCKS)


def _open(row: pa.RecordBatch, i: int) -> tuple[str, pa.Array, np.ndarray]:
    """Language, words and positions of a block."""
    n = row["n_words"][i].as_py()
    upto = np.concatenate(([0], np.cumsum(unpack(row["sizes"][i].as_py(), n)))).astype(np.int32)
    text = pa.Codec("zstd").decompress(row["words"][i].as_buffer(), decompressed_size=int(upto[-1])) if n else pa.py_buffer(b"")
    words = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(upto), text])
    return row["lang"][i].as_py(), words, unpack(row["at"][i].as_py(), row["n_at"][i].as_py()).astype(np.int32)


def _each_block(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        for i in range(b.num_rows):
            yield _open(b, i)
            pa.default_memory_pool().release_unused()


def word_counts(blocks: DataFrame) -> DataFrame:
    """lang, phrase, a of all words."""
    def counts(batches):
        for b in batches:
            for i in range(b.num_rows):
                lang, words, _ = _open(b, i)
                n = unpack(b["n"][i].as_py(), len(words)).astype(np.int64)
                for lo in range(0, len(words), 100_000):
                    part = words.slice(lo, 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part, pa.array(n[lo:lo + 100_000])],
                                                     ["lang", "phrase", "n"])

    return blocks.mapInArrow(counts, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("a"))


# --- screens -----------------------------------------------------------------------------------

def _lang_hash(lang: str) -> np.uint64:
    return mix64(string_hashes(pa.array([lang])))[0]


class Bitmap:
    """A Bloom filter: never says no to a member, seldom yes to others."""

    CHUNK, MOST, HASHES = 16, 29, 4

    def __init__(self, n_keys: int):
        self.bits = min(self.MOST, max(self.CHUNK, (16 * n_keys).bit_length()))

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        h = mix64(keys.astype(np.uint64) + GROWTH)
        step = mix64(h) | np.uint64(1)
        for _ in range(self.HASHES):
            yield h & np.uint64((1 << self.bits) - 1)
            h = h + step

    def of(self, keys: DataFrame, scratch: Scratch) -> "Bitmap":
        """``keys``: one long column ``key``. At most 2^(29-16) rows of 8 KB come to the driver."""
        def sent(held: list[np.ndarray]) -> pa.RecordBatch:
            """One row for each chunk: the places in it."""
            p = np.unique(np.concatenate([x.astype(np.uint32) for x in self.places(np.concatenate(held))]))
            full, cut = np.unique(p >> np.uint32(self.CHUNK), return_index=True)
            p = (p & np.uint32((1 << self.CHUNK) - 1)).astype("<u2")
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64)), pa.array(
                [p[a:b].tobytes() for a, b in zip(cut, [*cut[1:], len(p)])], pa.binary())], ["c", "p"])

        def spread(batches):
            held, size = [], 0
            for b in batches:
                held.append(b.column(0).to_numpy().view(np.uint64))
                size += b.num_rows
                if size >= HELD:
                    yield sent(held)
                    held, size = [], 0
            if size:
                yield sent(held)

        def chunk(t: pa.Table) -> pa.Table:
            bits = np.zeros(1 << self.CHUNK, np.uint8)
            for p in t["p"]:
                bits[np.frombuffer(p.as_buffer(), "<u2")] = 1
            return pa.table({"c": [t["c"][0].as_py()], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        step = 1 << (self.CHUNK - 3)
        body = np.zeros(1 << (self.bits - 3), np.uint8)
        placed = keys.select("key").mapInArrow(spread, "c long, p binary")
        for r in placed.groupBy("c").applyInArrow(chunk, "c long, bits binary").collect():
            body[r["c"] * step:(r["c"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
        self.shared = scratch.broadcast(body)  # 64 MB at most
        return self

    def test(self, keys: np.ndarray) -> np.ndarray:
        body, out = self.shared.value, np.ones(len(keys), bool)
        for p in self.places(keys):
            out &= (body[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


class Screen:
    """Which positions of a block may begin a frequent phrase of k words."""

    def __init__(self, n_buckets: int, words: Bitmap):
        self.shift = np.uint64(32 - (n_buckets.bit_length() - 1))
        self.levels: list[Bitmap] = [words]

    def keys(self, lang: str, words: pa.Array, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose parts of k - 1 words passed, and their keys (32 bits above the bucket's)."""
        salt = _lang_hash(lang)
        h = string_hashes(words)
        passed = np.concatenate(([False], self.levels[0].test(h ^ salt)))
        live = np.flatnonzero(passed[at])
        if not len(live):
            return live, np.empty(0, np.uint64)
        h = np.concatenate((np.zeros(1, np.uint64), h))[at]
        for m in range(2, k + 1):
            live = live[:-1][live[1:] == live[:-1] + 1]  # both parts of m - 1 words are there
            key = np.full(len(live), salt)
            for j in range(m):
                key = mix64(key * GROWTH + h[live + j])
            key >>= self.shift
            if m < k:
                live = live[self.levels[m - 1].test(key)]
        return live, key


def survivors(blocks: DataFrame, screen: Screen, k: int, n_buckets: int, min_count: int) -> DataFrame:
    """Keys (long) of hashed phrases of k words with ``min_count`` occurrences at least."""
    low = np.uint64(0xFFFFFFFF)

    def sent(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, n = (np.concatenate(x) for x in zip(*held))
        if len(held) > 1:
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            key, n = key[first], np.add.reduceat(n[order], first)
        full, cut = np.unique((key >> np.uint64(32)).astype(np.int64), return_index=True)
        cuts = [*cut.tolist(), len(key)]
        rest = (key & low).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(full, pa.int64()), pa.array(np.diff(cuts), pa.int32()),
            pa.array([pack(np.diff(rest[a:b], prepend=0)) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([pack(n[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())], ["bucket", "m", "keys", "n"])

    def counted(batches):
        held, size, seen = [], 0, 0
        for lang, words, at in _each_block(batches):
            key, n = np.unique(screen.keys(lang, words, at, k)[1], return_counts=True)
            if not len(key):
                continue
            held.append((key, n))
            size, seen = size + len(key), seen + len(at)
            if size >= HELD or seen >= 1 << 30:  # packed counts have 32 bits
                yield sent(held)
                held, size, seen = [], 0, 0
        if held:
            yield sent(held)

    def summed(t: pa.Table) -> pa.Table:
        m = t["m"].to_pylist()
        key = np.concatenate([np.cumsum(unpack(x, c), dtype=np.int64) for x, c in zip(t["keys"].to_pylist(), m)])
        n = np.concatenate([unpack(x, c) for x, c in zip(t["n"].to_pylist(), m)])
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        often = np.add.reduceat(n[order].astype(np.int64), first) >= min_count
        return pa.table({"key": key[first][often] + (t["bucket"][0].as_py() << 32)})

    return blocks.mapInArrow(counted, "bucket long, m int, keys binary, n binary").groupBy("bucket").applyInArrow(summed, "key long")


def _distinct(cols: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``cols`` (non-negative, as many as words of a window), ordered, and the sums of their ``n``."""
    bits = max(1, int(max(c.max() for c in cols)).bit_length())
    if bits * len(cols) < 64:
        key = np.zeros(len(n), np.int64)
        for c in cols:
            key = (key << bits) | c
        order = np.argsort(key)
        new = np.diff(key[order]) != 0
    else:
        order = np.lexsort(cols[::-1])
        new = np.zeros(len(n) - 1, bool)
        for c in cols:
            new |= np.diff(c[order]) != 0
    first = np.flatnonzero(np.concatenate(([True], new)))
    return [c[order[first]] for c in cols], np.add.reduceat(n[order], first)


WINDOWS = "shard int, lang string, sizes binary, words binary, n_words int, codes binary, n binary, m int"


def windows(blocks: DataFrame, screen: Screen, max_words: int, n_shards: int) -> DataFrame:
    """Rows of ``m`` distinct windows of a language in a shard: their words, the numbers of these by column (from 1; 0: past
    the end), and how often each window came."""
    def of_block(lang, words, at) -> tuple[pa.Array, list[np.ndarray], np.ndarray] | None:
        long = np.zeros(len(at), np.int64)
        for k in range(2, max_words + 1):
            live, key = screen.keys(lang, words, at, k)
            long[live[screen.levels[k - 1].test(key)]] = k
        begin = np.flatnonzero(long)
        if not len(begin):
            return None
        long = long[begin]
        at = np.concatenate((at, np.zeros(max_words, at.dtype)))
        cols, n = _distinct([np.where(long > j, at[begin + j], 0) for j in range(max_words)], np.ones(len(begin), np.int64))
        used = np.zeros(len(words) + 1, bool)
        for c in cols:
            used[c] = True
        used[0] = False
        number = np.cumsum(used, dtype=np.int32)
        return words.take(pa.array(np.flatnonzero(used) - 1)), [np.where(c > 0, number[c], 0).astype(np.int32) for c in cols], n

    def sent(lang: str, held: list[tuple[pa.Array, list[np.ndarray], np.ndarray]]) -> pa.RecordBatch:
        coded = pa.concat_arrays([words for words, _, _ in held]).dictionary_encode()
        words, code = coded.dictionary, np.concatenate(([0], coded.indices.to_numpy(zero_copy_only=False) + 1)).astype(np.int32)
        upto = np.cumsum([0] + [len(w) for w, _, _ in held]).tolist()
        cols = [np.concatenate([np.where(c[j] > 0, code[c[j] + lo], np.int32(0)) for (_, c, _), lo in zip(held, upto)]) for j in range(max_words)]
        cols, n = _distinct(cols, np.concatenate([n for _, _, n in held]))
        h = np.concatenate((np.zeros(1, np.uint64), string_hashes(words)))
        key = mix64(mix64(_lang_hash(lang) + GROWTH * h[cols[0]]) + GROWTH * h[cols[1]])
        shard = (key % np.uint64(n_shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        cols, n = [c[order] for c in cols], n[order]
        full, cut = np.unique(shard[order], return_index=True)
        out = []
        for x, lo, hi in zip(full.tolist(), cut, [*cut[1:], len(order)]):
            known, number = np.unique(np.concatenate([c[lo:hi] for c in cols]), return_inverse=True)
            known, number = (known[1:], number) if known[0] == 0 else (known, number + 1)
            sizes, body = pack_strings(words.take(pa.array(known - 1)))
            out.append((x, lang, sizes, body, len(known), pack(number), pack(n[lo:hi]), hi - lo))
        types = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                          ["shard", "lang", "sizes", "words", "n_words", "codes", "n", "m"])

    def gather(batches):
        held, size, seen = {}, 0, 0
        for lang, words, at in _each_block(batches):
            got = of_block(lang, words, at)
            if got is None:
                continue
            held.setdefault(lang, []).append(got)
            size, seen = size + max(len(got[2]), got[0].nbytes // 16), seen + len(at)
            if size >= HELD or seen >= 1 << 30:
                for x in list(held):
                    yield sent(x, held.pop(x))
                size, seen = 0, 0
        for x in list(held):
            yield sent(x, held.pop(x))

    return blocks.mapInArrow(gather, WINDOWS)


# --- tries -------------------------------------------------------------------------------------

class DoubleArray:
    """Base and check of a trie over codes from 1 to ``n_codes``: a state is a place, the root is 0, and
    code c leads from state s to place base[s] + c if check there is s. Both arrays end with
    n_codes + 1 places more than any state needs, so that every step stays inside."""

    def __init__(self, n_codes: int, n_states: int):
        self.n_codes = n_codes
        self.size = n_codes + 1 + n_states + n_states // 2
        self.base = np.zeros(self.size, np.int32)
        self.check = np.full(self.size, -1, np.int32)
        self.taken = np.zeros(self.size, bool)
        self.taken[0] = True
        self.width, self.near = 1 << 62, n_codes + 1  # children of the last nodes, and where they found room
        self.level = np.zeros(1, np.int64)

    def _grow(self, by: int) -> None:
        self.base = np.concatenate((self.base, np.zeros(by, np.int32)))
        self.check = np.concatenate((self.check, np.full(by, -1, np.int32)))
        self.taken = np.concatenate((self.taken, np.zeros(by, bool)))
        self.size += by

    def _fit(self, codes: np.ndarray) -> int:
        """A base whose places for ``codes`` are free. Nodes come with most children first; the search goes on
        where the last node found room, and starts again from below for nodes of half as many children."""
        if 2 * len(codes) <= self.width:
            self.width, self.near = len(codes), self.n_codes + 1
        at, step = self.near, 1024
        while True:
            if at + step + self.n_codes >= self.size:
                self._grow(self.size // 2 + step + self.n_codes)
            bases = np.flatnonzero(~self.taken[at:at + step]) + at - codes[0]
            lo, some = 1, 4
            while lo < len(codes) and len(bases):
                bases = bases[~self.taken[bases[:, None] + codes[None, lo:lo + some]].any(1)]
                lo, some = lo + some, min(4 * some, max(4, 1_000_000 // max(len(bases), 1)))
            if len(bases):
                self.near = at + int(bases[0] + codes[0] - at)
                return int(bases[0])
            at += step
            step = min(2 * step, 1 << 16)

    def add_level(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Children of the states of the level before (``parent``: indexes into it), ordered by parent and
        code, none twice. Their states."""
        states = np.empty(len(code), np.int64)
        if len(self.level) == 1 and self.level[0] == 0:
            self.taken[code], self.check[code], states[:] = True, 0, code
        else:
            first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
            n = np.diff(np.concatenate((first, [len(parent)])))
            above = self.level[parent[first]]
            self.width = 1 << 62
            order = np.argsort(-n, kind="stable")
            for o in order[n[order] > 1].tolist():
                mine = code[first[o]:first[o] + n[o]].astype(np.int64)
                x = self._fit(mine)
                self.taken[mine + x], self.check[mine + x], self.base[above[o]] = True, above[o], x
                states[first[o]:first[o] + n[o]] = mine + x
            only = order[n[order] == 1]
            free = np.flatnonzero(~self.taken[self.n_codes + 1:]) + self.n_codes + 1
            if len(free) < len(only):
                free = np.concatenate((free, np.arange(self.size, self.size + len(only) - len(free))))
                self._grow(len(only))
            place = free[:len(only)]
            self.taken[place], self.check[place], self.base[above[only]] = True, above[only], place - code[first[only]]
            states[first[only]] = place
        self.level = states
        return states

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        used = int(np.flatnonzero(self.taken)[-1]) + 1 + self.n_codes + 1
        if used > self.size:
            self._grow(used - self.size)
        return self.base[:used], self.check[:used]


class Trie:
    """The trie of distinct (lang, phrase) pairs. Codes are given to the words of each language in turn: ``langs`` and
    ``n_words`` say how many, ``words`` which (codes 1, 2, ..). ``state``: of each phrase. Arrays only, as Python objects
    would stay in the worker's memory."""

    def __init__(self, langs: pa.Array, phrases: pa.Array):
        lists = pc.split_pattern(phrases, " ")
        depth = np.diff(lists.offsets.to_numpy())
        of_phrase = np.repeat(np.arange(len(depth)), depth)
        lang = langs.dictionary_encode()
        code = self._coded(lang.dictionary, lang.indices.to_numpy(zero_copy_only=False)[of_phrase], lists.flatten())
        table = np.zeros((len(depth), int(depth.max())), np.int64)
        table[of_phrase, np.arange(len(code)) - np.repeat(np.cumsum(depth) - depth, depth)] = code
        self._place(table)

    @classmethod
    def of_windows(cls, langs: list[str], words: list[pa.Array], tables: list[np.ndarray]) -> tuple["Trie", np.ndarray]:
        """The trie of all rows of ``tables`` (each of one language: numbers into its words from 1, and 0 past a window's
        end), and the rows as codes."""
        trie = cls.__new__(cls)
        lang = pa.array(langs, pa.string()).dictionary_encode()
        upto = np.cumsum([0] + [len(w) for w in words])
        code = np.concatenate(([0], trie._coded(lang.dictionary, np.repeat(lang.indices.to_numpy(zero_copy_only=False), np.diff(upto)),
                                                pa.concat_arrays(words)))).astype(np.int32)
        table = np.concatenate([np.where(t > 0, code[t + lo], np.int32(0)) for t, lo in zip(tables, upto.tolist())])
        trie._place(table)
        return trie, table

    def _coded(self, langs: pa.Array, lang_of: np.ndarray, words: pa.Array) -> np.ndarray:
        """Codes of ``words`` of languages ``lang_of`` (indexes into ``langs``)."""
        word = words.dictionary_encode()
        both = lang_of.astype(np.int64) * len(word.dictionary) + word.indices.to_numpy(zero_copy_only=False)
        known, code = np.unique(both, return_inverse=True)
        self.langs = langs
        self.n_words = np.bincount(known // len(word.dictionary), minlength=len(self.langs))
        self.words = word.dictionary.take(pa.array(known % len(word.dictionary)))
        return code + 1

    def _place(self, table: np.ndarray) -> None:
        """Place the rows of ``table`` (codes; 0: past the end)."""
        depth = (table > 0).sum(1)
        trie = DoubleArray(len(self.words), int(depth.sum()))
        node, self.state, base_of = np.zeros(len(depth), np.int64), np.zeros(len(depth), np.int32), len(self.words) + 1
        for k in range(table.shape[1]):
            deep = np.flatnonzero(depth > k)
            if not len(deep):
                break
            nodes, node[deep] = np.unique(node[deep] * base_of + table[deep, k], return_inverse=True)
            states = trie.add_level(nodes // base_of, nodes % base_of)
            end = deep[depth[deep] == k + 1]
            self.state[end] = states[node[end]]
        self.base, self.check = trie.arrays()

    def counts(self, table: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length the (row that begins with the phrase, occurrences) of every phrase that begins rows of ``table``
        (codes; 0: past the end); ``n``: how often each row counts."""
        out = []
        live, state = np.arange(len(table)), np.zeros(len(table), np.int64)
        total, row = np.zeros(len(self.base), np.int64), np.zeros(len(self.base), np.int64)
        for k in range(table.shape[1]):
            step = self.base[state] + table[live, k]
            good = (table[live, k] > 0) & (self.check[step] == state)
            live, state = live[good], step[good]
            total[:] = 0
            np.add.at(total, state, n[live])
            row[state] = live
            hit = np.flatnonzero(total)
            out.append((row[hit], total[hit]))
        return out


def counted_phrases(windows: DataFrame, max_words: int, min_count: int) -> DataFrame:
    """lang, phrase, a: exact counts of all phrases of two words or more that begin a window, ``min_count`` at least."""
    def count(t: pa.Table) -> pa.Table:
        rows = t.drop_columns("shard").to_pylist()
        trie, table = Trie.of_windows([r["lang"] for r in rows], [unpack_strings(r["sizes"], r["words"], r["n_words"]) for r in rows],
                                      [unpack(r["codes"], max_words * r["m"]).reshape(max_words, -1).T.astype(np.int32) for r in rows])
        n = np.concatenate([unpack(r["n"], r["m"]) for r in rows]).astype(np.int64)
        del rows
        lang_of = np.repeat(np.arange(len(trie.langs)), trie.n_words)
        langs, names, a = [], [], []
        for k, (row, total) in enumerate(trie.counts(table, n)):
            if k:
                often = total >= min_count
                code = table[row[often], :k + 1] - 1
                names.append(pc.binary_join_element_wise(*(trie.words.take(pa.array(code[:, j])) for j in range(k + 1)), " "))
                langs.append(trie.langs.take(pa.array(lang_of[code[:, 0]])))
                a.append(total[often])
        return pa.table({"lang": pa.concat_arrays(langs), "phrase": pa.concat_arrays(names), "a": np.concatenate(a)})

    return windows.groupBy("shard").applyInArrow(count, "lang string, phrase string, a long")


# --- operator ----------------------------------------------------------------------------------

def count_phrases(blocks: DataFrame, words: DataFrame, scratch: Scratch, *, max_words: int, min_count: int,
                  shard_phrases: int, shard_bytes: int) -> DataFrame:
    """lang, phrase, a of all phrases of 2 to ``max_words`` words with at least ``min_count`` occurrences.
    ``words``: lang, phrase, a of the words with as many."""
    total = blocks.agg(F.sum("n_at")).first()[0] or 0
    n_buckets = 1 << max(8, (total // 1_000_000).bit_length())  # a bucket holds some million positions

    def word_keys(batches):
        for b in batches:
            salt = {lang: _lang_hash(lang) for lang in b.column(0).unique().to_pylist()}
            key = string_hashes(b.column(1)) ^ np.array([salt[x] for x in b.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

    n_words, occurrences, size = words.agg(F.count(F.lit(1)), F.sum("a"), F.sum(F.col("a") * F.octet_length("phrase"))).first()
    screen = Screen(n_buckets, Bitmap(n_words).of(words.select("lang", "phrase").mapInArrow(word_keys, "key long"), scratch))
    n_phrases = n_bytes = 0
    for k in range(2, max_words + 1):
        passed = scratch.written(survivors(blocks, screen, k, n_buckets, min_count))
        n = passed.count()
        screen.levels.append(Bitmap(n).of(passed, scratch))
        n_phrases, n_bytes = n_phrases + n, n_bytes + n * k * (1 + (size or 0) // (occurrences or 1))
    n_shards = max(1, -(-n_phrases // shard_phrases), -(-n_bytes // shard_bytes), -(-total // SHARD_POSITIONS))
    return scratch.written(counted_phrases(windows(blocks, screen, max_words, n_shards), max_words, min_count))


def scored(phrases: DataFrame, words: DataFrame, max_words: int) -> DataFrame:
    """Add l, r and score of the cut of least score (ties: the earliest). ``phrases`` and ``words``: lang, phrase, a."""
    known = words.unionByName(phrases)
    part = F.split("phrase", " ", -1)
    at = phrases.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(part) - 1)).alias("k"))
    at = at.select("*", F.array_join(F.slice(part, F.lit(1), F.col("k")), " ").alias("first"),
                   F.array_join(F.slice(part, F.col("k") + 1, F.size(part) - F.col("k")), " ").alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cut = at.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # a <= min(l, r), so the quotient is at most 10^6; a * a * 10^6 has 38 digits up to a = 10^16
    score = F.expr("cast(1000000 * cast(a as decimal(16,0)) * cast(a as decimal(16,0)) as decimal(38,0)) "
                   "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cut.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    return best.select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def contained(phrases: DataFrame) -> DataFrame:
    """lang, phrase, longer: the largest count of a longer phrase that holds it (phrases of two words or more)."""
    part = F.split("phrase", " ", -1)
    sizes = F.sequence(F.lit(2), F.size("w") - 1)
    inner = F.flatten(F.transform(sizes, lambda m: F.transform(
        F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    long = phrases.select("lang", "a", part.alias("w")).filter(F.size("w") > 2)
    return (long.select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))


def collocations(docs: DataFrame, *, max_words: int = 3, min_count: int = 10, share: int = 50, per_lang: int | None = 2000,
                 lang_col: str = "lang", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                 shard_phrases: int = 250_000, shard_bytes: int = 16_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of 2 to ``max_words`` words with at least ``min_count`` occurrences,
    best first (score, then a descending, then phrase by its bytes). A phrase inside a longer one that has ``share``
    percent of its occurrences or more is left out. ``per_lang``: how many are reported (None: all)."""
    scratch = Scratch(docs.sparkSession, "collocations")
    blocks = scratch.written(blocks_of(docs, lang_col, text_col, block_bytes))
    all_words = scratch.written(word_counts(blocks))
    words = all_words.filter(F.col("a") >= min_count)
    totals = all_words.groupBy("lang").agg(F.sum("a").alias("n"))
    phrases = count_phrases(blocks, words, scratch, max_words=max_words, min_count=min_count, shard_phrases=shard_phrases,
                            shard_bytes=shard_bytes)
    best = (scored(phrases, words, max_words).join(contained(phrases), ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))))
    first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if per_lang is not None:  # the first of each part, so that no task orders all phrases of a language
        part = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*first)
        best = best.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= per_lang)
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*first)).cast("long"))
    if per_lang is not None:
        ranked = ranked.filter(F.col("rank") <= per_lang)
    result = Scratch(docs.sparkSession, "collocations-out").written(
        ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    scratch.drop()
    return result


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    return collocations(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM split, (VALUES (1), (2), (3)) AS sizes(k))),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k AS size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.w, u.k, l.a AS l, r.a AS r,
         (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
  FROM candidates c, (VALUES (1), (2)) AS u(k), f l, f r
  WHERE u.k < c.size
    AND l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, u.k), ' ')
    AND r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, u.k + 1, c.size), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner2 AS (
  SELECT lang, array_to_string(list_slice(w, i, i + 1), ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (1), (2)) AS v(i) WHERE size = 3 GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inner2 i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, t.n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
