"""Near-duplicate classes by BagMinHash signatures over word shingles.

Texts are multisets of five-word shingles. BagMinHash draws, for every shingle,
Poisson points over (component, weight level); a text keeps for each component
its first point whose level lies below the shingle's weight, so two texts agree
in a component with probability equal to their weighted Jaccard similarity.
Weights are discretised into dyadic intervals [0,1), [1,2), [2,4), ..: whole
intervals below the weight run one process each, and the points of the cut
interval are split down to the level that decides. Points beyond the text's
horizon are never generated.

Signatures are banded; equal texts are one node; bands that several nodes share
propose pairs in rounds (never all pairs of a group): first each node with the
least first node of its bands, then each node still apart with its bands' first and
last, and last the pairs still in different classes. Of those, bands of a first
node with few others give the pairs that share at least 3 of them; the large
families join on the shingles in which two nodes differ alike from the family's first
text, rarest first (``possible_pairs``), which drops no pair that is similar. Each pair is verified on the
exact multisets, links make classes (min label with pointer jumping over
written tables).

With 32 bands of 4 a pair at 0.8 shares no band with probability 5e-8 and fewer
than 3 with probability 1.2e-5; above 0.8 less.

Defined cases: null text counts as empty; a text with fewer than five words is
one shingle of all its words; texts without words match only equal texts; the
row of smallest id stays (null ids last, then by row); repeated rows are copies; an empty
table gives no rows; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import drop_marked, maybe_among, written
from .hashing import mix64, word_hashes

N_BANDS, BAND_ROWS, SHINGLE, SIMILARITY = 32, 4, 5, 0.8
# Last round: shared bands a pair needs, and nodes beside a first node that make its family large.
MIN_SHARED, FAMILY = 3, 16
# Longs of a sketch of a node's differences from its family's first text.
SKETCH = 8
_G = np.uint64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 19


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words (one of all words if there are fewer)."""
    n = len(words)
    if not n:
        return words
    w = min(size, n)
    h = np.full(n - w + 1, w, np.uint64)
    for i in range(w):
        h = mix64(h * _G + words[i:n - w + 1 + i])
    return h


def bag_minhash(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures (n_docs x m, uint64) of weighted sets given as rows (document,
    element hash, integer weight >= 1). Documents without elements get zeros."""
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    best = np.full(n_docs * m, np.inf)
    todo = np.flatnonzero(total > 0)
    # horizon: by then a text has drawn enough points to have filled all m components but with probability e^-5
    factor = m * (np.log(m) + 5.0)
    while len(todo):
        open_ = np.zeros(n_docs, bool)
        open_[todo] = True
        keep = open_[doc]
        _points(doc[keep], key[keep], weight[keep], factor / np.maximum(total, 1), m, best)
        filled = np.isfinite(best.reshape(n_docs, m)).all(1)
        todo = todo[~filled[todo]]
        factor *= 2
    sig = mix64(best.view(np.uint64)).reshape(n_docs, m)
    sig[total == 0] = 0
    return sig


def _points(doc, key, weight, horizon, m, best) -> None:
    """Lower ``best`` by all points below each document's horizon."""
    j = 0
    while len(doc):
        # interval j of the weight axis: [0,1), then [2^(j-1), 2^j)
        low, width = (0, 1) if j == 0 else (1 << (j - 1), 1 << (j - 1))
        live = weight > low
        doc, key, weight = doc[live], key[live], weight[live]
        if not len(doc):
            return
        d, state = doc, mix64(key ^ np.uint64((j + 1) * int(_G) & (1 << 64) - 1))
        inside = np.minimum(weight - low, width)
        x, t = np.zeros(len(d)), horizon[doc]
        while len(d):
            state = state + _G
            r = mix64(state)
            x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
            near = x < t
            d, state, inside, x, t = d[near], state[near], inside[near], x[near], t[near]
            if not len(d):
                break
            r = mix64(state ^ np.uint64(0xD6E8FEB86659FD93))
            component = ((r >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            slot, at = d * m + component, x
            if width > 1:
                # the point's level by halving the interval: the low bits are the turns taken
                hit = (r & np.uint64(width - 1)).astype(np.int64) < inside
                slot, at = slot[hit], at[hit]
            np.minimum.at(best, slot, at)
        j += 1


def _weighted(texts: pa.Array):
    """(document, shingle, count) rows of a batch of texts."""
    words, first = word_hashes(texts)
    docs, keys, counts = [], [], []
    for i in range(len(texts)):
        s = shingles(words[first[i]:first[i + 1]])
        if len(s):
            k, c = np.unique(s, return_counts=True)
            docs.append(np.full(len(k), i))
            keys.append(k)
            counts.append(c)
    if not docs:
        e = np.empty(0, np.int64)
        return e, e.view(np.uint64), e, np.diff(first)
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(counts), np.diff(first)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_bands: int = N_BANDS,
               band_rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, node (MD5 of the text), n_words, bands (one hash per band; none without words)."""
    m = n_bands * band_rows

    def bands_of(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                b = batch.slice(lo, 2000)
                doc, key, weight, n = _weighted(b.column(2))
                sig = bag_minhash(doc, key, weight, b.num_rows, m).reshape(b.num_rows, n_bands, band_rows)
                h = np.tile(np.arange(n_bands, dtype=np.uint64), (b.num_rows, 1))
                for r in range(band_rows):
                    h = mix64(h * _G + sig[:, :, r])
                full = n > 0
                off = np.concatenate(([0], np.cumsum(full * n_bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(off), pa.array(h[full].ravel().view(np.int64)))],
                    ["doc_id", "node", "n_words", "bands"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("node"),
                       text.alias("text"))
    return rows.mapInArrow(bands_of, "doc_id long, node binary, n_words long, bands array<long>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (sorted keys, counts)."""
    common, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][ia], b[1][ib]).sum()
    return float(low) / float(a[1].sum() + b[1].sum() - low)


def _beside_heads(pairs: DataFrame, texts: DataFrame):
    """pairs (a, b) of nodes as groups (a, chunk): a's text (b null) and those of its
    members b. Chunks hold a bounded amount of text; a's text is sent once a chunk."""
    members = pairs.join(texts.select(F.col("node").alias("b"), "text", "n_chars"), "b")
    load = members.groupBy("a").agg(F.expr(f"cast(ceil(sum(n_chars) / {CHUNK_BYTES}) as int)").alias("chunks"))
    load = written(load, "load")
    b_rows = members.join(load, "a").select(
        "a", F.expr("pmod(xxhash64(b), greatest(chunks, 1))").cast("int").alias("chunk"), "b", "text")
    heads = load.select("a", F.explode(F.sequence(F.lit(0), F.greatest(F.col("chunks"), F.lit(1)) - 1)).alias("chunk"))
    a_rows = heads.join(texts.select(F.col("node").alias("a"), "text"), "a").select(
        "a", "chunk", F.lit(None).cast("binary").alias("b"), "text")
    return b_rows.unionByName(a_rows).groupBy("a", "chunk")


def _members(t: pa.Table):
    """(a, its set, [(b, its set)]) of one group; sets are (sorted shingles, counts)."""
    texts_ = t["text"].combine_chunks()
    words, first = word_hashes(texts_)
    sets = [np.unique(shingles(words[first[i]:first[i + 1]]), return_counts=True) for i in range(len(texts_))]
    names = t["b"].to_pylist()
    head = sets[names.index(None)] if None in names else None
    return t["a"][0].as_py(), head, [] if head is None else [(n, x) for n, x in zip(names, sets) if n is not None]


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """pairs (a, b) of nodes -> those at least ``threshold`` similar."""
    def check(t: pa.Table) -> pa.Table:
        a, head, rest = _members(t)
        out = [b for b, x in rest if similarity(head, x) >= threshold]
        return pa.table({"a": pa.array([a] * len(out), pa.binary()), "b": pa.array(out, pa.binary())})

    return _beside_heads(pairs, texts).applyInArrow(check, "a binary, b binary")


def _sketch(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Parities of the bits that the units of weighted keys fall on: two sketches differ in no
    more bits than their sets do in units."""
    unit = np.repeat(keys.view(np.uint64), weights)
    nth = np.arange(len(unit)) - np.repeat(np.cumsum(weights) - weights, weights)
    bit = mix64(unit + nth.astype(np.uint64) * _G) % np.uint64(64 * SKETCH)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * SKETCH) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def deltas(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """For pairs (a, b): the size of b, by how much it differs from a (norm) and where: a
    key and a weight for each shingle that b has more of, and for each it has less of; and
    a sketch: bits that each unit of these differences flips."""
    def differ(t: pa.Table) -> pa.Table:
        a, head, rest = _members(t)
        size, norm, sketch, keys, weights = [], [], [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, (k, c) in rest:
            every = np.union1d(head[0], k)
            by = np.zeros(len(every), np.int64)
            by[np.searchsorted(every, k)] = c
            by[np.searchsorted(every, head[0])] -= head[1]
            at = np.flatnonzero(by)
            size.append(int(c.sum()))
            norm.append(int(np.abs(by).sum()))
            e = every[at].view(np.int64)
            keys.append(np.where(by[at] > 0, e, ~e))
            weights.append(np.abs(by[at]))
            sketch.append(_sketch(keys[-1], weights[-1]))
        off = pa.array(np.cumsum([len(x) for x in keys]), pa.int32())
        return pa.table({"a": pa.array([a] * len(rest), pa.binary()), "b": pa.array([b for b, _ in rest], pa.binary()),
                         "size": pa.array(size, pa.int64()), "norm": pa.array(norm, pa.int64()),
                         "sketch": pa.array(sketch, pa.list_(pa.int64())),
                         "keys": pa.ListArray.from_arrays(off, pa.array(np.concatenate(keys))),
                         "weights": pa.ListArray.from_arrays(off, pa.array(np.concatenate(weights)))})

    return _beside_heads(pairs, texts).applyInArrow(
        differ, "a binary, b binary, size long, norm long, sketch array<long>, keys array<long>, weights array<long>")


def possible_pairs(family: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a family's nodes in different classes that may still be similar.

    family: (first, node, label), where a node similar to ``first`` is in its class already.
    Two sets of sizes m and n reach the threshold t only if they differ in at most
    T = (m + n)(1 - t)/(1 + t) shingles. Seen from the family's first text, x differs by nx
    shingles, y by ny, and the two by nx + ny - 2 o, o being what both gained or both lost; so
    2 o >= nx + ny - T. Pairs with o = 0 and no more than T are both similar to the first text.
    With the differences of each node put in one order (those of fewest nodes first), o is
    at most what either has from the first common one on (rest): pairs are joined on a
    difference only where 2 rest >= nx + ny - T holds for both, and only with those bins of nodes
    that have one for which it may hold. Every similar pair meets on its first common difference.
    Sketches that differ in more than T bits rule out pairs that meet by chance."""
    most = (1 - threshold) / (1 + threshold)
    d = written(deltas(family.select(F.col("first").alias("a"), F.col("node").alias("b")), texts), "deltas")
    # of two classes one is not the family's largest: its nodes look for partners
    main = (family.groupBy("first", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("first")
                  .agg(F.max_by("label", F.struct("n", "label")).alias("main")))
    bits = [f"s{i}" for i in range(SKETCH)]
    member = family.join(main, "first").select(F.col("first").alias("a"), F.col("node").alias("b"), "label",
                                               (F.col("label") != F.col("main")).alias("seeks"))
    member = member.join(d.select("a", "b", *[F.col("sketch")[i].alias(s) for i, s in enumerate(bits)]), ["a", "b"])
    member = member.withColumn("f", F.xxhash64("a")).drop("a")
    at = d.select(F.xxhash64("a").alias("f"), "b", "size", "norm", F.explode(F.arrays_zip("keys", "weights")).alias("e"))
    at = at.select("f", "b", "size", "norm", "e.keys", "e.weights").withColumnsRenamed({"keys": "key", "weights": "w"})
    held = at.groupBy("f", "key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    late = W.partitionBy("f", "b").orderBy(F.desc("k"), F.desc("key")).rowsBetween(W.unboundedPreceding, 0)
    at = at.join(held, ["f", "key"]).withColumn("rest", F.sum("w").over(late))
    at = at.withColumn("room", F.expr(f"size * {1 + 1 / threshold} * {most} + 1e-9")).filter("rest >= norm - room")
    at = written(at.join(member, ["f", "b"]).select("f", "key", F.expr("cast(8 * log2(norm) as int)").alias("bin"), "b", "label",
                                                    "seeks", "size", "norm", "rest", "room", *bits), "differences")
    # per difference and bin of norms (some 8 for each doubling): the best that its nodes offer
    bins = at.groupBy("f", "key", "bin").agg(F.min("norm").alias("least"), F.max(F.expr("2 * rest - norm")).alias("reach"),
                                             F.min("label").alias("label1"), F.max("label").alias("label2"))
    x = at.filter("seeks").drop("bin").join(bins, ["f", "key"]).filter(
        "(label1 != label or label2 != label) and norm + least <= 2 * rest + room and norm <= reach + room")
    x = x.select("f", "key", "bin", *[F.col(c).alias(f"x_{c}") for c in ("b", "label", "size", "norm", "rest", *bits)])
    apart = " + ".join(f"bit_count({s} ^ x_{s})" for s in bits)
    near = F.expr(f"label != x_label and size >= {threshold} * x_size - 1e-9 and x_size >= {threshold} * size - 1e-9 and "
                  f"norm + x_norm <= 2 * least(rest, x_rest) + (size + x_size) * {most} + 1e-9 and "
                  f"{apart} <= (size + x_size) * {most} + 1e-9")
    return x.join(at.drop("room", "seeks"), ["f", "key", "bin"]).filter(near).select(
        F.least("x_b", "b").alias("a"), F.greatest("x_b", "b").alias("b")).distinct()


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component. Every round
    takes the least neighbouring label and then the label's own label, so
    chains shorten by doubling; each round is a written table."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(nodes.select("node", F.col("node").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        step = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("label2"))
        moved = written(step.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("label2", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter(F.col("label") != F.col("old")).isEmpty():
            return labels


def link_classes(nodes: DataFrame, texts, threshold: float = SIMILARITY) -> DataFrame:
    """(node, label) for the nodes that share a band with another one.
    nodes: node, bands; ``texts``: function of the needed nodes to (node, text, n_chars)."""
    keys = nodes.select("node", F.explode("bands").alias("band"))
    shared = written(keys.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last"))
                         .filter(F.col("first") != F.col("last")), "bands")
    # most bands are held by one node: only the others' rows are shuffled again
    keys = keys.filter(maybe_among(shared, "band")(F.col("band")))
    held = written(keys.join(shared, "band"), "held")
    active = written(held.select("node").distinct(), "active")
    body = written(texts(active), "texts")
    labels = active.select("node", F.col("node").alias("label"))
    edges = None

    def labelled(pairs: DataFrame) -> DataFrame:
        la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        return pairs.join(la, "a").join(lb, "b").filter(F.col("la") != F.col("lb"))

    tried = None
    for turn in ("least", "ends", "all"):
        if turn == "least":  # one proposal for each node: the least first node among its bands
            pairs = held.filter("node != first").groupBy(F.col("node").alias("b")).agg(F.min("first").alias("a")).select("a", "b")
        elif turn == "ends":
            ends = held.select(F.explode(F.array("first", "last")).alias("a"), F.col("node").alias("b")).filter("a != b").distinct()
            pairs = labelled(ends).select("a", "b")
        else:
            # what is left: pairs of different classes that share bands
            split = held.join(labels, "node").select("band", "first", "node", "label")
            mixed = split.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("band")
            rest = written(split.join(mixed, "band", "left_semi"), "rest")
            family = rest.filter("node != first").select("first", "node", "label").distinct()
            big = written(family.groupBy("first").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FAMILY).select("first"), "big")
            few = rest.join(big, "first", "left_anti")
            r = few.select("band", F.col("node").alias("b"), F.col("label").alias("lb"))
            pairs = (few.select("band", F.col("node").alias("a"), F.col("label").alias("la")).join(r, "band")
                        .filter((F.col("la") != F.col("lb")) & (F.col("a") < F.col("b")))
                        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= MIN_SHARED).select("a", "b"))
            family = family.join(big, "first", "left_semi")
            pairs = pairs.unionByName(possible_pairs(written(family, "family"), body, threshold)).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti").join(
                tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if edges is not None and pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = verified(pairs, body, threshold)
        edges = written(found if edges is None else edges.unionByName(found), "links")
        labels = components(edges, active)
    return labels


def near_dedup(docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
               n_bands: int = N_BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, class_id (smallest id of its class), class_size, kept, node, for every row."""
    sig = written(signatures(docs, id_col, text_col, n_bands, band_rows)
                  .withColumn("rid", F.monotonically_increasing_id()), "signatures")
    # equal texts are one node; first(bands) is theirs all alike
    nodes = written(sig.groupBy("node").agg(F.first("bands").alias("bands"),
                                            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("head"),
                                            F.count(F.lit(1)).alias("n")), "nodes")

    def texts(active: DataFrame) -> DataFrame:
        want = written(nodes.join(active, "node").select("node", F.col("head.doc_id").alias("_id")), "want")
        text = F.coalesce(F.col(text_col), F.lit(""))
        t = docs.select(F.col(id_col).cast("long").alias("_doc"), text.alias("text"),
                        F.unhex(F.md5(text.cast("binary"))).alias("_n"))
        # only texts that may be wanted are shuffled
        t = t.filter(maybe_among(want.select(F.xxhash64("node").alias("k")), "k")(F.xxhash64("_n")))
        got = t.join(want, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_n") == F.col("node")))
        return got.groupBy("node").agg(F.first("text").alias("text")).withColumn("n_chars", F.length("text"))

    labels = link_classes(nodes.select("node", "bands"), texts, threshold)
    named = nodes.join(labels, "node", "left").select("node", "head", "n", F.coalesce("label", "node").alias("label"))
    classes = named.groupBy("label").agg(F.min("head").alias("class_head"), F.sum("n").alias("class_size"))
    classes = written(classes, "classes")
    heads = written(named.join(classes, "label").select("node", "class_head", "class_size"), "nodeclass")
    return sig.drop("bands").join(heads, "node").select(
        "doc_id", F.col("class_head.doc_id").alias("class_id"), "class_size",
        (F.col("rid") == F.col("class_head.rid")).alias("kept"), "node")


def distinct_documents(docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One document of each class, with all its columns."""
    verdict = near_dedup(docs, threshold, id_col, text_col).withColumnRenamed("node", "digest")
    node = F.unhex(F.md5(F.coalesce(F.col(f"_doc.{text_col}"), F.lit("")).cast("binary")))
    return drop_marked(docs, verdict, F.col(f"_doc.{id_col}"), node)


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    return near_dedup(read_table(spark, sf_dir, "documents")).drop("node")
