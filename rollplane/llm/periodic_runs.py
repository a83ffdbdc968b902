"""Runs (maximal periodic stretches of words) by a suffix automaton and link-cut access.

The states of a text's suffix automaton form a tree under their suffix links; the path
from the state of a prefix to the root holds all its suffixes. Appending word i gives
this path the colour i: the last place where its strings ended. The colours already
on it lie in segments, each the top part of a preferred path of a link-cut tree, so
the access that recolours them meets O(log n) segments a word, amortised. A segment of
colour c whose deepest state has length L says that the last L words before c and
before i agree, and no more: at distance d = i - c <= L the words from c - L + 1 to i have
period d. A longer suffix with a later end would give a later colour, so d is their
smallest period. As words come, the same (start, d) is met until the period breaks:
its last end closes the run. All links are known once the automaton is built, and a
state's strings end together in every prefix, so the tree is taken whole and only
accessed.

Before that, windows of words are compared by hash over a whole batch (numpy). In a
run all windows but those of its first period have an earlier copy, at a distance the
period bounds; only the stretches around such windows go through the automaton. The
screen may pass too much, never too little, and the automaton works on the words.

Defined cases: null and empty text have no words and no runs; texts of any length are taken
whole (one row is one task's work, some hundred bytes a word); a repeated row gives a
repeated row; a null id stays null; an empty table gives no rows; columns other than id
and text are ignored, whatever their names. Words are runs of characters other than the six ASCII
white-space characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let
from .common import WORD
from .hashing import mix64, word_hashes

SLICE_BYTES = 4_000_000
WINDOW = 8
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_automaton(words: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, length) of each state (0: root) and the state of each prefix."""
    link, length, out, ends, last = [-1], [0], [{}], [], 0
    for c in words:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        out.append({})
        p = last
        while p >= 0 and c not in out[p]:
            out[p][c] = new
            p = link[p]
        if p >= 0:
            q = out[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                out.append(out[q].copy())
                while p >= 0 and out[p].get(c) == q:
                    out[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        ends.append(new)
        last = new
    return link, length, ends


def runs_of(words: Sequence[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs with length >= max(min_length, min_exponent * period), in order."""
    link, length, ends = suffix_automaton(words)
    n = len(link)
    up = link            # parent in the splay tree, or the state above the path
    left, right = [-1] * n, [-1] * n
    colour = [-1] * n    # of a preferred path, kept at the root of its splay tree
    more = min_exponent - 1

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b >= 0:
            up[b] = p
        up[p], up[x] = x, g
        if g >= 0 and left[g] == p:
            left[g] = x
        elif g >= 0 and right[g] == p:
            right[g] = x
        else:
            colour[x] = colour[p]

    last_end: dict[tuple[int, int], int] = {}
    for i, u in enumerate(ends):
        below = -1
        while u >= 0:
            while (p := up[u]) >= 0 and (left[p] == u or right[p] == u):
                g = up[p]
                if g >= 0 and (left[g] == p or right[g] == p):
                    rotate(p if (left[g] == p) == (left[p] == u) else u)
                rotate(u)
            c = colour[u]
            if c >= 0 and (d := i - c) * more <= length[u]:
                last_end[c - length[u] + 1, d] = i
            if (r := right[u]) >= 0:
                colour[r] = c
            right[u] = below
            below = u
            u = up[u]
        colour[below] = i
    return sorted((s, e - s + 1, d) for (s, d), e in last_end.items() if e - s + 1 >= min_length)


def _stretches(mark: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the maximal stretches of true within a text."""
    value = np.concatenate(([0], np.where(mark, text + 1, 0), [0]))
    edge = value[1:] != value[:-1]
    return np.flatnonzero(edge[:-1] & mark), np.flatnonzero(edge[1:] & mark) + 1


def shortest_overlap(min_length: int, min_exponent: int) -> int:
    """The least length - period of a run."""
    q = min_length // min_exponent  # the largest period of a run of min_length words
    longer = (min_exponent - 1) * (q + 1)
    return min(min_length - q, longer) if q else longer


def suspects(hashes: np.ndarray, first: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of words (from, to) outside which no text has a run. ``first``: each
    text's first word, and the number of all words."""
    least = shortest_overlap(min_length, min_exponent)
    m = min(WINDOW, least)
    n = len(hashes) - m + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = np.zeros(n, np.uint64)
    for j in range(m):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key = mix64(key + mix64(text[:n].astype(np.uint64)))
    whole = text[:n] == text[m - 1:m - 1 + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    back = np.zeros(n, np.int64)
    back[order[1:][same]] = order[1:][same] - order[:-1][same]
    mark = (back > 0) & whole
    for _ in range(3):  # the period is bounded by the stretch, so farther copies don't count
        lo, hi = _stretches(mark, text[:n])
        keep = hi - lo >= least - m + 1
        lo, hi = lo[keep], hi[keep]
        size = hi - lo
        at = np.zeros(n, np.int64)
        idx = np.arange(int(size.sum())) + np.repeat(lo - (np.cumsum(size) - size), size)
        at[idx] = np.repeat((size + m - 1) // (min_exponent - 1), size)
        mark &= (at > 0) & (back <= at)
    lo, hi = _stretches(mark, text[:n])
    keep = hi - lo >= least - m + 1
    lo, hi = lo[keep], hi[keep]
    of = text[lo]
    a = np.maximum(first[of], lo - (hi - lo + m - 1) // (min_exponent - 1) - 1)
    b = np.minimum(first[of + 1], hi + m)
    if not len(a):
        return a, b
    order = np.argsort(a, kind="stable")  # those that overlap become one; they never reach beyond their text
    a, upto = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.concatenate(([True], a[1:] >= upto[:-1])))
    return a[new], upto[np.concatenate((new[1:] - 1, [len(a) - 1]))]


def dropped_words(runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches (from, to), apart and in order, of the words that lie in a run after its first period."""
    out: list[list[int]] = []
    for a, b in sorted((s + q, s + n) for s, n, q in runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _search(texts: pa.Array, min_length: int, min_exponent: int):
    """(number of words, runs, text with each run collapsed to one period) of each text."""
    hashes, first = word_hashes(texts)
    lo, hi = suspects(hashes, first, min_length, min_exponent)
    of = np.searchsorted(first, lo, "right") - 1
    areas: dict[int, list[tuple[int, int]]] = {}
    for t, a, b in zip(of.tolist(), (lo - first[of]).tolist(), (hi - first[of]).tolist()):
        areas.setdefault(t, []).append((a, b))
    for t, text in enumerate(texts):
        words = (text.as_py() or "").encode().split()
        runs = []
        for a, b in areas.get(t, ()):
            number: dict[bytes, int] = {}
            found = runs_of([number.setdefault(w, len(number)) for w in words[a:b]], min_length, min_exponent)
            runs += [(a + s, n, q) for s, n, q in found]
        kept = words
        if runs:
            kept, at = [], 0
            for a, b in dropped_words(runs):
                kept += words[at:a]
                at = b
            kept += words[at:]
        yield len(words), sorted(runs, key=lambda r: (r[0], r[2])), b" ".join(kept)


def periodic_runs(docs: DataFrame, *, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the text ``collapsed`` to the words
    outside the later periods of every run, joined by one space, for every row."""
    if min_length < 2 or min_exponent < 2:
        raise ValueError("a run has at least two words and two periods")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.string())
            ends = np.cumsum(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)[1:]
                             - np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)[:-1]) if len(texts) else []
            lo = 0
            while lo < len(texts):
                base = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
                rows = list(_search(texts.slice(lo, hi - lo), min_length, min_exponent))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r[1]] for r in rows], kind),
                    pa.array([r[2] for r in rows], pa.binary()).cast(pa.string()),
                ], ["doc_id", "n_words", "runs", "collapsed"])
                lo = hi

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
               .mapInArrow(search, RUNS)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period (exact); of ties the least start, then period. Null if there is none."""
    def better(best: Column, r: Column) -> Column:
        mine, its = r["length"] * best["period"], best["length"] * r["period"]
        first = F.struct(r["start"], r["period"]) < F.struct(best["start"], best["period"])
        return F.when(best.isNull() | (mine > its) | ((mine == its) & first), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def looped(doc_id: Column, text: Column) -> Column:
    """The text whose words repeat as the query's rule says: with h = crc32 of the decimal id, if h ends in 0, each word
    from a on becomes word a + (i - a) % p. Other texts stay as they are. A null id counts as an empty string."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))

    def loop(v: Column) -> Column:
        n, g = F.size(v["w"]).cast("long"), F.floor(h / 10)
        return let(lambda x: F.array_join(F.concat(
            F.slice(x["w"], F.lit(1), x["a"].cast("int")),
            F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - x["a"] - 1),
                        lambda i: F.get(x["w"], (x["a"] + i % x["p"]).cast("int")))), " "),
            w=v["w"], n=n, a=g % n, p=F.floor((n - g % n) / (g % 8 + 3)) + 1)

    body = let(lambda v: F.when(F.size(v["w"]) > 0, loop(v)).otherwise(F.lit("")), w=F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return F.when((h % 10 == 0) & text.isNotNull(), body).otherwise(text)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (periodic_runs(docs).withColumn("top", strongest(F.col("runs")))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                    F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
