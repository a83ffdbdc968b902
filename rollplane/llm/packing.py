"""Packing token ids into sequences by an order-preserving dynamic programme.

Documents are tokenised and laid end to end in the order of their partition; the
programme chooses where to cut this line. A sequence holds at most ``size`` ids and
is padded to ``size`` unless its length is a power of two. The cost of a packing is

    padding + ``sentence_cost`` a cut between sentences of a document
            + ``word_cost`` a cut anywhere else inside one + ``sequence_cost`` a sequence.

Cuts between documents are free of penalty. Cuts may lie at document and sentence
ends; inside sentences longer than ``grid`` ids also every ``grid`` ids, and in the
last ``size`` ids of a block at every id. Over these places the cost is least:
best[i] = penalty[i] + min(best[j] + size - (p[i] - p[j])) over the window
p[i] - p[j] <= size, whose minimum of best[j] + p[j] a monotone queue holds, or
best[j] for the few j at a power of two before i. One block (about ``block_tokens``
ids of one partition, whole documents) is solved at a time, so memory is bounded
by a block or by the longest document, nothing is shuffled, and a lost task is
computed again alone. A block costs at most one more sequence than a longer line.

Defined cases: null and empty text have the end id only; texts of any length are
cut as often as needed; repeated rows and null ids are packed like others; of
equal costs the later start of the last sequence wins, a power of two only where it is
cheaper; an empty table gives no rows; columns other than id and text are
ignored, whatever their names. The documents must be a replayable read (files or a
written table): sequence ids name the partition.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .bpe import merge_word

SIZE = 2048
END_ID = 1
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def load_tokenizer(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks and special tokens of a byte-level BPE file of the tokenizers library (read by the
    driver). Its vocabulary writes printable Latin-1 bytes as themselves and the others as the
    characters from 256 on; its merges stand in the order of their ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}, special


LONG_BLANK = 1000


def encoder(ranks: dict[bytes, int], special: dict[str, int], pattern: str):
    """A function text -> ids (uint32). Runs of very many white-space characters overflow the
    pattern's backtracking; the pattern makes one piece of such a run, without its last character
    if other text follows, so they are merged apart."""
    import regex
    import tiktoken

    coder = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    blank = regex.compile(r"\p{White_Space}{%d,}" % LONG_BLANK)

    def encode(text: str) -> np.ndarray:
        out, at = [], 0
        for m in blank.finditer(text):
            stop = m.end() if m.end() == len(text) else m.end() - 1
            out += [coder.encode_to_numpy(text[at:m.start()], allowed_special="all"),
                    np.array(merge_word(text[m.start():stop].encode(), ranks), np.uint32)]
            at = stop
        return np.concatenate([*out, coder.encode_to_numpy(text[at:], allowed_special="all")])

    return encode


def sentence_marks(ranks: dict[bytes, int], special: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By id: the token ends a line; it ends with a stop; it begins with white space."""
    n = max([*ranks.values(), *special.values()], default=0) + 1
    line, stop, blank = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    for t, i in ranks.items():
        line[i] = t.endswith(b"\n")
        stop[i] = t.rstrip(b"\"')]").endswith((b".", b"!", b"?", "。".encode(), "！".encode(), "？".encode()))
        blank[i] = t[:1].isspace()
    return line, stop, blank


def best_cuts(places: list[int], penalty: list[int], size: int, sequence_cost: int) -> tuple[list[int], int]:
    """Places (indexes into ``places``, ascending, the last one included) that end the sequences
    of the cheapest packing, and its cost. ``places`` rise from 0, at most ``size`` apart."""
    n, total = len(places), places[-1]
    at = [-1] * (total + 1)
    for i, p in enumerate(places):
        at[p] = i
    powers = [1 << k for k in range(size.bit_length()) if 1 << k <= size]
    best, key, back = [0] * n, [0] * n, [0] * n
    queue: deque[int] = deque()
    for i in range(1, n):
        # place i-1 enters the window; a dearer one before it can never be chosen again
        k = key[i - 1] = best[i - 1] + places[i - 1]
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(i - 1)
        p = places[i]
        while places[queue[0]] < p - size:
            queue.popleft()
        j = queue[0]
        cost = key[j] + size - p
        for w in powers:
            if w > p:
                break
            x = at[p - w]
            if x >= 0 and best[x] < cost:
                cost, j = best[x], x
        best[i] = cost + penalty[i] + sequence_cost
        back[i] = j
    cuts, i = [], n - 1
    while i > 0:
        cuts.append(i)
        i = back[i]
    return cuts[::-1], best[-1]


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, marks, size: int, grid: int, sentence_cost: int,
               word_cost: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a line of ids may be cut, from 0 to its length, and the penalty of each."""
    line, stop, blank = marks
    total = len(ids)
    cost = np.full(total + 1, -1, np.int64)
    cost[max(0, total - size):] = word_cost
    first, then = ids[:-1], ids[1:]
    cost[1:-1][line[first] & ~line[then] | stop[first] & blank[then]] = sentence_cost
    cost[doc_ends], cost[0] = 0, 0
    have = np.flatnonzero(cost >= 0)
    gap = np.diff(have)
    wide = np.flatnonzero(gap > grid)
    if len(wide):
        n = (gap[wide] - 1) // grid
        steps = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1
        cost[np.repeat(have[wide], n) + steps * grid] = word_cost
        have = np.flatnonzero(cost >= 0)
    return have, cost[have]


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, *, size: int = SIZE, end_id: int = END_ID, sentence_cost: int = 4,
         word_cost: int = 64, sequence_cost: int = 8, grid: int = 64, block_tokens: int = 1_000_000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens,
    sequence_id, offset. Ids are those of the tokenizers library with add_special_tokens=False
    (a special token's string in a text is that token, as there), then ``end_id``."""
    if not 1 <= grid <= size:
        raise ValueError("grid must lie between 1 and size")
    ranks, special = load_tokenizer(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, special, sentence_marks(ranks, special)))  # bounded by the vocabulary

    def solve(held: list[tuple[pa.Array, list[np.ndarray]]], marks, first_id: int):
        each = [x for _, xs in held for x in xs]
        ids = np.concatenate(each).astype("<u4", copy=False)
        doc_ends = np.cumsum([len(x) for x in each])
        places, penalty = cut_places(ids, doc_ends, marks, size, grid, sentence_cost, word_cost)
        ends, _ = best_cuts(places.tolist(), penalty.tolist(), size, sequence_cost)
        seq_ends = places[ends]
        edges = np.union1d(seq_ends, doc_ends)
        begin = np.concatenate(([0], edges[:-1]))
        doc, seq = np.searchsorted(doc_ends, begin, "right"), np.searchsorted(seq_ends, begin, "right")
        doc_begin, seq_begin = np.concatenate(([0], doc_ends))[doc], np.concatenate(([0], seq_ends))[seq]
        names = pa.concat_arrays([a for a, _ in held])
        body = pa.Array.from_buffers(pa.binary(), len(edges), [
            None, pa.py_buffer((np.concatenate(([0], edges)) * 4).astype(np.int32)), pa.py_buffer(ids)])
        return len(seq_ends), pa.RecordBatch.from_arrays([
            names.take(pa.array(doc)), pa.array(begin - doc_begin), pa.array(edges - begin), body,
            pa.array((np.diff(doc_ends, prepend=0))[doc]), pa.array(first_id + seq), pa.array(begin - seq_begin),
        ], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, special, marks = shared.value
        encode = encoder(ranks, special, pattern)
        end, next_id = np.array([end_id], np.uint32), TaskContext.get().partitionId() << 40
        held: list[tuple[pa.Array, list[np.ndarray]]] = []
        n = 0
        for b in batches:
            lo, new = 0, []
            for i, text in enumerate(b.column(1)):
                new.append(np.concatenate((encode(text.as_py() or ""), end)))
                n += len(new[-1])
                if n >= block_tokens:
                    held.append((b.column(0).slice(lo, i + 1 - lo), new))
                    k, out = solve(held, marks, next_id)
                    yield out
                    next_id, held, n, lo, new = next_id + k, [], 0, i + 1, []
            if new:
                held.append((b.column(0).slice(lo), new))
        if held:
            yield solve(held, marks, next_id)[1]

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
               .mapInArrow(packed, PIECES)


def sequences(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """sequence_id, ids (binary), n_tokens, padded_to, documents (doc_id, start, length in order): each
    sequence put together; it has at most ``size`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    n = F.col("n_tokens")
    power: Column = F.expr("n_tokens & (n_tokens - 1)") == 0
    return (pieces.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens"))
            .select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), n,
                    F.when(power, n).otherwise(F.lit(size)).cast("long").alias("padded_to"),
                    F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"),
                                                        x["length"].alias("length"))).alias("documents")))


def op11_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    from ..sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents")
    return pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
