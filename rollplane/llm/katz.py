"""Katz backoff language model: Good-Turing discounted bigrams over unigrams.

    P(w | h) = d(c(hw)) c(hw) / c(h)      if h w was seen in training
             = a(h) P(w)                  otherwise; P(w) if h was not seen
    P(w)     = d1(c(w)) c(w) / N          if w was seen; one unknown word has the rest

d are Good-Turing discounts for counts up to 5, from the counts of counts of all
training tokens; a(h) makes each context sum to exactly 1 (the denominator sums
P over the words seen after h; it is stored as float32). Should no mass be left
for the unseen, half a count is set aside and the seen part scaled.

Counts cover all training documents and are kept by block: a block of documents
lists its distinct words and bigrams once, and tables hashed by word and
by context add them up and hand the totals back to the blocks that
asked, where the recursion is evaluated for every token. So a
frequent word or pair is one entry a block. Contexts with more than a bucket's
share of the tokens are spread over buckets by the following word; their few sums
(at most one context per bucket) are broadcast. Words are 64-bit hashes, the
words after one context 48-bit ones; a collision would add up two entries.

Tokens: A-Z lower-cased words, then one end per document, which is also the
context of the first word.

Defined cases: null and empty text is the end token alone; a null id is
training data; no training documents: every token is the unknown word with
probability 1; repeated rows count as often as they stand; an empty table gives
no rows; columns other than id and text are ignored; texts of any length are read whole. The documents must be a
replayable read (see ``bpe``); checksums guard it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import written
from .hashing import mix64, pack, unpack, word_hashes

BLOCK_TOKENS, BUCKET_TOKENS = 2_400_000, 3_000_000
K = 5  # counts above K are not discounted
END = np.uint64(0x5851F42D4C957F2D)
_G = np.uint64(0x9E3779B97F4A7C15)

ROW = ("block long, kind int, bucket int, n int, nh int, check long, a binary, b binary, c binary, "
       "stats array<long>, hot array<struct<h: long, v: array<double>>>")
_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()),
                    ("nh", pa.int32()), ("check", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()),
                    ("stats", pa.list_(pa.int64())),
                    ("hot", pa.list_(pa.struct([("h", pa.int64()), ("v", pa.list_(pa.float64()))])))])
COUNTS, STATS = 1, 0


def _rows(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist([{f.name: r.get(f.name) for f in _ARROW} for r in rows], schema=_ARROW)


# --- probabilities -----------------------------------------------------------
def good_turing(n: list[int]) -> np.ndarray:
    """Discount ratios d[0..K] (d[0] unused) from counts of counts n[1..K+1]
    (n[0] unused), smoothed where the raw ones give no ratio between 0 and 1 (copies
    make them uneven); absolute discounting by a half where neither does."""
    r = np.arange(1, K + 2)
    raw = np.array(n[1:K + 2], float)
    tries = [raw] if (raw > 0).all() else []
    if (raw > 0).sum() >= 2:  # counts of counts smoothed by a line in log-log
        slope, level = np.polyfit(np.log(r[raw > 0]), np.log(raw[raw > 0]), 1)
        tries.append(np.exp(level + slope * np.log(r)))
    for z in tries:
        cut = (K + 1) * z[K] / z[0]
        if cut < 1:
            d = (r[1:] * z[1:] / (r[:-1] * z[:-1]) - cut) / (1 - cut)
            if ((d > 0) & (d < 1)).all():
                return np.concatenate(([1.0], d))
    return np.concatenate(([1.0], (r[:-1] - 0.5) / r[:-1]))


@dataclass
class Unigrams:
    """P(w) by count: N tokens, V words, discounts, and the unknown word's mass."""
    tokens: int
    words: int
    counts: list[int]
    d: np.ndarray = field(init=False)
    unknown: float = field(init=False)
    scale: float = field(init=False)

    def __post_init__(self):
        self.d = good_turing(self.counts)
        n = max(self.tokens, 1)
        lost = sum(self.counts[r] * r * (1 - self.d[r]) for r in range(1, K + 1)) / n
        self.unknown = 1.0 if not self.tokens else max(lost, 0.5 / (n + 1))
        self.scale = (1 - self.unknown) / (1 - lost) if lost < 1 else 0.0

    def p(self, c: np.ndarray) -> np.ndarray:
        c = np.asarray(c, np.int64)
        seen = self.d[np.minimum(c, K)] * np.where(c > K, 1 / self.d[K], 1.0) * c * self.scale / max(self.tokens, 1)
        return np.where(c > 0, seen, self.unknown)

    def log_base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.words + 1)))


def context_weights(ch: np.ndarray, m: np.ndarray, sp: np.ndarray, d: np.ndarray):
    """(backoff weight, scale of seen words) of contexts with count ch, m[r-1] distinct
    successors of count r <= K and unigram mass sp of the seen successors. Unseen contexts: 1."""
    r = np.arange(1, K + 1)
    lost = (m * r * (1 - d[1:])).sum(1) / np.maximum(ch, 1)
    left = np.maximum(lost, 0.5 / (ch + 1.0))
    a = left / np.maximum(1 - sp, 1e-12)
    return np.where(ch > 0, a, 1.0), np.where(ch > 0, (1 - left) / np.maximum(1 - lost, 1e-12), 1.0)


# --- blocks ------------------------------------------------------------------
@dataclass
class Block:
    name: int
    ids: list
    train: np.ndarray     # per document
    lens: np.ndarray      # tokens per document, end included
    words: np.ndarray     # distinct hashes, most frequent first
    at: np.ndarray        # tokens as positions in words

    @property
    def check(self) -> int:
        return int(np.bitwise_xor.reduce(self.words >> np.uint64(1)))


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Block]:
    """(doc_id, train, text) batches -> blocks of about ``limit`` tokens."""
    part, k = TaskContext.get().partitionId(), 0
    ids, train, lens, seqs, n = [], [], [], [], 0

    def block():
        seq = np.concatenate(seqs)
        words, at, count = np.unique(seq, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return Block((part << 32) | k, ids, np.concatenate(train), np.concatenate(lens), words[order], rank[at])

    for b in batches:
        for lo in range(0, b.num_rows, 1000):
            s = b.slice(lo, 1000)
            h, first = word_hashes(s.column(2), lower=True)
            ids += s.column(0).to_pylist()
            train.append(s.column(1).to_numpy(zero_copy_only=False).astype(bool))
            lens.append(np.diff(first) + 1)
            seqs.append(np.insert(h, first[1:], END))
            n += len(h) + s.num_rows
            if n >= limit:
                yield block()
                k, n = k + 1, 0
                ids, train, lens, seqs = [], [], [], []
    if ids:
        yield block()


def split(order_by: np.ndarray, n: int):
    """(bucket, members) of a bucket per entry, members in their order."""
    order = np.argsort(order_by, kind="stable")
    cuts = np.searchsorted(order_by[order], np.arange(n + 1))
    return [(b, order[cuts[b]:cuts[b + 1]]) for b in range(n) if cuts[b] < cuts[b + 1]]


# --- unigram counts ----------------------------------------------------------
def count_words(rows: DataFrame, n_buckets: int, limit: int) -> DataFrame:
    """Written table: per block and bucket the training count of each of the
    block's words; per bucket its tokens, words, counts of counts and commonest words."""
    def listed(batches):
        for b in blocks(batches, limit):
            train = np.repeat(b.train, b.lens)
            count = np.bincount(b.at[train], minlength=len(b.words))
            out = [{"block": b.name, "bucket": k, "n": len(x), "a": pack(x), "b": b.words[x].tobytes(), "c": pack(count[x]),
                    "check": int(np.bitwise_xor.reduce(b.words[x] >> np.uint64(1)))}
                   for k, x in split((b.words % np.uint64(n_buckets)).astype(np.int64), n_buckets)]
            yield from _rows(out).to_batches()

    def add(t: pa.Table) -> pa.Table:
        rs = t.select(["block", "bucket", "n", "check", "a", "b", "c"]).to_pylist()
        h = np.concatenate([np.frombuffer(r["b"], np.uint64) for r in rs])
        c = np.concatenate([unpack(r["c"], r["n"]) for r in rs])
        words, at = np.unique(h, return_inverse=True)
        total = np.bincount(at, weights=c).astype(np.int64)
        tokens = int(total.sum())
        stats = [tokens, int((total > 0).sum())] + [int((total == r).sum()) for r in range(1, K + 2)]
        # at most 50 words hold 2 % of a bucket each: candidates for contexts to spread
        top = np.flatnonzero(total > max(1, tokens // 50))
        out = [{"block": -1, "kind": STATS, "bucket": rs[0]["bucket"], "stats": stats,
                "hot": [{"h": int(words[i].view(np.int64)), "v": [float(total[i])]} for i in top]}]
        lo = 0
        for r in rs:
            out.append({"block": r["block"], "kind": COUNTS, "bucket": r["bucket"], "n": r["n"], "check": r["check"],
                        "a": r["a"], "b": pack(total[at[lo:lo + r["n"]]])})
            lo += r["n"]
        return _rows(out)

    return written(rows.mapInArrow(listed, ROW).groupBy("bucket").applyInArrow(add, ROW), "unigrams")


# --- bigram counts -----------------------------------------------------------
def _bigrams(lens: np.ndarray, at: np.ndarray, n_words: int, end: int):
    """Distinct (context, word) positions of a block in order, and each token's entry."""
    before = np.empty_like(at)
    before[1:] = at[:-1]
    before[np.cumsum(lens) - lens] = end
    key, entry = np.unique(before * n_words + at, return_inverse=True)
    return key // n_words, key % n_words, entry


def _bucket_of(context, word, bucket, hot):
    """A context's bucket, or for the spread ones the following word's."""
    return np.where(hot[context], bucket[word], bucket[context])


def _sent(b: Block, n_buckets: int, hot_words: np.ndarray, with_hashes: bool) -> dict:
    """A block's documents for its reassembly."""
    hot = np.flatnonzero(np.isin(b.words, hot_words))
    return {"block": b.name, "n": len(b.at), "nh": len(b.words), "check": b.check, "a": pack(b.at),
            "b": pack(b.words % np.uint64(n_buckets)), "c": b.words.tobytes() if with_hashes else None,
            "lens": b.lens.tolist(), "ids": b.ids, "train": b.train.tolist(),
            "end": int(np.flatnonzero(b.words == END)[0]), "hot": hot.tolist(),
            "hot_h": b.words[hot].view(np.int64).tolist()}


DOCS = ("block long, n int, nh int, check long, a binary, b binary, c binary, lens array<int>, ids array<long>, "
        "train array<boolean>, end int, hot array<int>, hot_h array<long>")
_DOCS_ARROW = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("nh", pa.int32()), ("check", pa.int64()),
                         ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("lens", pa.list_(pa.int32())),
                         ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("end", pa.int32()),
                         ("hot", pa.list_(pa.int32())), ("hot_h", pa.list_(pa.int64()))])


def _documents(rows: DataFrame, n_buckets: int, hot_words: np.ndarray, limit: int, with_hashes: bool) -> DataFrame:
    def sent(batches):
        for b in blocks(batches, limit):
            yield from pa.Table.from_pylist([_sent(b, n_buckets, hot_words, with_hashes)], schema=_DOCS_ARROW).to_batches()
    return rows.mapInArrow(sent, DOCS)


def _word_counts(doc: dict, returned: list[dict]) -> np.ndarray:
    count = np.full(doc["nh"], -1, np.int64)
    check = 0
    for r in returned:
        count[unpack(r["a"], r["n"])] = unpack(r["b"], r["n"])
        check ^= r["check"]
    if check != doc["check"] or (count < 0).any():
        raise RuntimeError("a block's words differ from its documents: the input changed between reads")
    return count


def count_bigrams(docs: DataFrame, unigram_rows: DataFrame, uni: Unigrams, n_buckets: int) -> DataFrame:
    """Written table: per block and bucket the training count of each of the
    block's bigrams, and per context its successors of count 1..K and their
    unigram mass; per bucket the counts of counts and the partial sums of spread contexts."""
    def listed(seq: pa.Table, counts: pa.Table) -> pa.Table:
        doc = seq.to_pylist()[0]
        c = _word_counts(doc, counts.to_pylist())
        at, bucket = unpack(doc["a"], doc["n"]).astype(np.int64), unpack(doc["b"], doc["nh"]).astype(np.int64)
        words = np.frombuffer(doc["c"], np.uint64)
        hot = np.zeros(doc["nh"], bool)
        hot[doc["hot"]] = True
        lens = np.array(doc["lens"], np.int64)
        h, w, entry = _bigrams(lens, at, doc["nh"], doc["end"])
        n = np.bincount(entry[np.repeat(np.array(doc["train"], bool), lens)], minlength=len(h))
        out = []
        for k, x in split(_bucket_of(h, w, bucket, hot), n_buckets):
            heads, run = np.unique(h[x], return_counts=True)
            follow = mix64(words[w[x]] ^ _G)
            out.append({"block": doc["block"], "bucket": k, "n": len(x), "nh": len(heads), "a": words[heads].tobytes()
                        + (follow & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
                        + ((follow >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2").tobytes(),
                        "b": pack(np.concatenate([run, hot[heads]])), "c": pack(np.concatenate([c[w[x]], n[x]]))})
        return _rows(out)

    def add(t: pa.Table) -> pa.Table:
        rs = t.select(["block", "bucket", "n", "nh", "a", "b", "c"]).to_pylist()
        heads, follow, run, spread, cw, n = [], [], [], [], [], []
        for r in rs:
            m, k = r["n"], r["nh"]
            heads.append(np.frombuffer(r["a"], np.uint64, k))
            follow.append(np.frombuffer(r["a"], "<u4", m, 8 * k).astype(np.uint64)
                          | np.frombuffer(r["a"], "<u2", m, 8 * k + 4 * m).astype(np.uint64) << np.uint64(32))
            v = unpack(r["b"], 2 * k)
            run.append(v[:k]), spread.append(v[k:])
            v = unpack(r["c"], 2 * m)
            cw.append(v[:m]), n.append(v[m:])
        head, head_at = np.unique(np.concatenate(heads), return_inverse=True)
        context = np.repeat(head_at, np.concatenate(run))
        key = mix64(head[context] * _G + np.concatenate(follow))
        _, first, entry = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(entry, weights=np.concatenate(n)).astype(np.int64)
        of, p = context[first], np.where(total > 0, uni.p(np.concatenate(cw)[first]), 0.0)
        sp = np.bincount(of, weights=p, minlength=len(head))
        m = np.stack([np.bincount(of[total == r], minlength=len(head)) for r in range(1, K + 1)], 1)
        hot = np.zeros(len(head), bool)
        hot[head_at[np.concatenate(spread) > 0]] = True
        out = [{"block": -1, "kind": STATS, "bucket": rs[0]["bucket"],
                "stats": [int((total == r).sum()) for r in range(1, K + 2)],
                "hot": [{"h": int(head[i].view(np.int64)), "v": [*map(float, m[i]), float(sp[i])]} for i in np.flatnonzero(hot)]}]
        lo = hlo = 0
        for r in rs:
            mine = head_at[hlo:hlo + r["nh"]]
            out.append({"block": r["block"], "kind": 2, "bucket": r["bucket"], "n": r["n"], "nh": r["nh"],
                        "a": pack(total[entry[lo:lo + r["n"]]]), "b": pack(m[mine].T.ravel()),
                        "c": sp[mine].astype("<f4").tobytes()})
            lo, hlo = lo + r["n"], hlo + r["nh"]
        return _rows(out)

    sent = docs.groupBy("block").cogroup(unigram_rows.groupBy("block")).applyInArrow(listed, ROW)
    return written(sent.groupBy("bucket").applyInArrow(add, ROW), "bigrams")


# --- scoring -----------------------------------------------------------------
SCORES = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def score_blocks(docs: DataFrame, returned: DataFrame, uni: Unigrams, d2: np.ndarray, hot_sums: dict, n_buckets: int) -> DataFrame:
    def score(seq: pa.Table, back: pa.Table) -> pa.Table:
        doc, rows = seq.to_pylist()[0], back.to_pylist()
        c = _word_counts(doc, [r for r in rows if r["kind"] == COUNTS])
        at, bucket = unpack(doc["a"], doc["n"]).astype(np.int64), unpack(doc["b"], doc["nh"]).astype(np.int64)
        hot = np.zeros(doc["nh"], bool)
        hot[doc["hot"]] = True
        lens = np.array(doc["lens"], np.int64)
        h, w, entry = _bigrams(lens, at, doc["nh"], doc["end"])
        seen = np.full(len(h), -1, np.int64)
        m, sp = np.zeros((doc["nh"], K)), np.zeros(doc["nh"])
        by_bucket = {r["bucket"]: r for r in rows if r["kind"] == 2}
        for k, x in split(_bucket_of(h, w, bucket, hot), n_buckets):
            r = by_bucket[k]
            seen[x] = unpack(r["a"], r["n"])
            heads = np.unique(h[x])
            m[heads] = unpack(r["b"], K * r["nh"]).reshape(K, -1).T
            sp[heads] = np.frombuffer(r["c"], "<f4")
        if (seen < 0).any():
            raise RuntimeError("a block's bigrams did not all come back")
        for i, key in zip(doc["hot"], doc["hot_h"]):
            m[i], sp[i] = hot_sums[key][:K], hot_sums[key][K]
        back_off, scale = context_weights(c, m, sp, d2)
        d = d2[np.minimum(seen, K)] * np.where(seen > K, 1 / d2[K], 1.0)
        p = np.where(seen > 0, scale[h] * d * seen / np.maximum(c[h], 1), back_off[h] * uni.p(c[w]))
        start = np.cumsum(lens) - lens
        return pa.table({
            "doc_id": pa.array(doc["ids"], pa.int64()), "train": pa.array(doc["train"], pa.bool_()),
            "n_tokens": pa.array(lens), "n_known": pa.array(np.add.reduceat((c[at] > 0).astype(np.int64), start)),
            "base_score": pa.array(np.add.reduceat(uni.log_base(c)[at], start)),
            "score": pa.array(np.add.reduceat(np.log10(p)[entry], start))})

    return docs.groupBy("block").cogroup(returned.groupBy("block")).applyInArrow(score, SCORES)


def katz_scores(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text",
                block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score of every
    row; the model learns from the rows for which the Column ``train`` is not false."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(True)).alias("train"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unigrams = count_words(rows, parts, block_tokens)
    info = unigrams.filter(F.col("kind") == STATS).select("stats", "hot").collect()  # one row per bucket
    stats = np.sum([r["stats"] for r in info], axis=0).tolist() if info else [0] * (K + 3)
    uni = Unigrams(stats[0], stats[1], [0, *stats[2:]])
    n_buckets = max(parts, -(-uni.tokens // bucket_tokens))
    share = uni.tokens / n_buckets
    hot = np.array([x["h"] for r in info for x in r["hot"] if x["v"][0] > share], np.int64).view(np.uint64)
    counts = unigrams.filter(F.col("kind") == COUNTS)
    bigrams = count_bigrams(_documents(rows, n_buckets, hot, block_tokens, True), counts, uni, n_buckets)
    info = bigrams.filter(F.col("kind") == STATS)
    sums = info.select("stats").collect()
    d2 = good_turing([0, *(np.sum([r["stats"] for r in sums], axis=0).tolist() if sums else [0] * (K + 1))])
    spread = info.select(F.explode("hot").alias("x")).groupBy("x.h").agg(
        *[F.sum(F.get("x.v", F.lit(i))).alias(f"v{i}") for i in range(K + 1)])
    hot_sums = {r["h"]: [r[f"v{i}"] for i in range(K + 1)] for r in spread.collect()}  # at most n_buckets contexts
    back = counts.unionByName(bigrams.filter(F.col("kind") == 2))
    scored = score_blocks(_documents(rows, n_buckets, hot, block_tokens, False), back, uni, d2, hot_sums, n_buckets)
    return scored.withColumn("train_tokens", F.lit(uni.tokens).cast("long"))


def op6_katz(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    train = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 5 != 1
    out = katz_scores(read_table(spark, sf_dir, "documents"), train)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")
