"""BM25 search with exact block pruning.

``bm25_index`` tokenises a corpus once into rows of ``BLOCK_DOCS`` documents, each with
its own inverted index (terms, postings, lengths); it does not depend on the queries and
may be written and used again. ``bm25_search`` goes over these rows with a chunk
of queries of bounded size:

1. document frequencies of the chunk's terms (summed over tasks);
2. a block's bound for a query is the sum over its terms of idf times the largest weight the
   term has in the block. Each task scores, per query, the blocks that raise its best
   bound so far; the k-th best score of all tasks is a lower bound of the true k-th score;
3. every block whose bound reaches that score, or the task's own k-th score where
   that is higher, is scored; others cannot hold a result. A task returns at most k
   documents a query.

No row exists for a (query, document) or (query, block) pair before the final at most
k rows per query and task. Scores are compared in units of 1e-6, ties by smaller document id, so
the answer does not depend on the layout of the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from ..plans.ranking import global_cumsum
from ..session import ensure_checkpoint_dir

BLOCK_DOCS = 128
BLOCK_WORDS = 100_000    # words of a block that holds more than one document
ROW_GROUP = 4 << 20      # bytes and rows of a row group: Spark decodes one at a time, each of its rows a whole block
ROW_GROUP_BLOCKS = 16
CHUNK_TERMS = 1_000_000  # (query, term) pairs broadcast at once


def bm25_terms(text: Column | str) -> Column:
    """Lower-cased letter/digit runs."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start..start+size-1 of each run, one after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def bm25_index(corpus: DataFrame, *, d_id: str, text: str, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per block: docs (ids, ascending), len (terms of each), n_null (texts that are null: they have no
    terms and no part in the mean length), terms, and for each term its postings (doc: place in docs, tf)
    from start[i] to start[i + 1]. A null id is an error."""
    kind = corpus.schema[d_id].dataType.simpleString()
    schema = (f"docs array<{kind}>, len array<int>, n_null int, terms array<string>, start array<int>, doc array<int>, tf array<int>")

    def one(ids: pa.Array, lists: pa.Array) -> pa.RecordBatch:
        order = pc.sort_indices(ids)
        ids, lists = ids.take(order), lists.take(order)
        n_null = lists.null_count
        lists = pc.fill_null(lists, []) if n_null else lists
        size = np.diff(lists.offsets.to_numpy())
        coded = lists.flatten().dictionary_encode()
        doc = np.repeat(np.arange(len(ids)), size)
        cell, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(ids) + doc, return_counts=True)
        start = np.searchsorted(cell, np.arange(len(coded.dictionary) + 1) * len(ids))
        row = lambda x, t: pa.array([x], pa.list_(t))
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), row(size, pa.int32()), pa.array([n_null], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary),
            row(start, pa.int32()), row(cell % max(len(ids), 1), pa.int32()), row(tf, pa.int32())],
            ["docs", "len", "n_null", "terms", "start", "doc", "tf"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.column(0).null_count:
                raise ValueError("a document without an id cannot be found again")
            size = pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy().tolist()
            lo = words = 0
            for i, n in enumerate(size):
                if i > lo and (i - lo == block_docs or words + n > BLOCK_WORDS):
                    yield one(b.column(0).slice(lo, i - lo), b.column(1).slice(lo, i - lo))
                    lo, words = i, 0
                words += n
            if size:
                yield one(b.column(0).slice(lo), b.column(1).slice(lo))
            pa.default_memory_pool().release_unused()

    return corpus.select(F.col(d_id).alias("d"), bm25_terms(text).alias("t")).mapInArrow(build, schema)


def write_index(index: DataFrame) -> DataFrame:
    """The index written under the checkpoint folder and read back, so that its passes don't tokenise again. Row groups
    are small: a task that writes holds one, a task that reads decodes one at a time, and a row is a whole block."""
    import uuid
    spark = index.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bm25-{uuid.uuid4().hex}"
    blocks = "docs" in index.columns
    small = {"parquet.block.size": ROW_GROUP, "parquet.block.row.count.limit": ROW_GROUP_BLOCKS, "parquet.page.size.row.check.min": 1}
    index.write.options(**(small if blocks else {})).parquet(path)
    return spark.read.schema(index.schema).parquet(path)


class _Block:
    """Postings of a block for a chunk's vocabulary."""

    def __init__(self, row: pa.RecordBatch, i: int, vocabulary: pa.Array):
        known = pc.fill_null(pc.index_in(row["terms"][i].values, value_set=vocabulary), -1).to_numpy()
        here = np.flatnonzero(known >= 0)
        start = row["start"][i].values.to_numpy()
        self.term, self.n = known[here], (start[here + 1] - start[here]).astype(np.int64)
        self.docs = row["docs"][i].values
        self.cut = np.concatenate(([0], np.cumsum(self.n)))
        at = _runs(start[here].astype(np.int64), self.n)
        self.doc, self.tf = row["doc"][i].values.to_numpy()[at], row["tf"][i].values.to_numpy()[at]
        self.len = row["len"][i].values.to_numpy()

    def weigh(self, k1: float, b: float, mean_len: float) -> None:
        self.weight = self.tf * (k1 + 1) / (self.tf + k1 * (1 - b + b * self.len[self.doc] / mean_len))


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary: pa.Array) -> Iterator[_Block]:
    for row in batches:
        for i in range(row.num_rows):
            yield _Block(row, i, vocabulary)


def _micro(score: np.ndarray) -> np.ndarray:
    return np.floor(score * 1e6 + 0.5).astype(np.int64)


class _Scorer:
    """Best k documents of each query of a chunk over the blocks of one task."""

    def __init__(self, chunk, k: int, floor: np.ndarray):
        self.vocabulary, self.q_term, self.q_start, self.idf, self.k1, self.b, self.mean_len = chunk
        self.k = k
        self.floor = floor.copy()      # a score (1e-6) below it cannot be a result
        self.best: dict[int, list[tuple[int, object, float]]] = {}

    def bounds(self, block: _Block) -> np.ndarray:
        top = np.zeros(len(self.vocabulary))
        if len(block.term):
            top[block.term] = np.maximum.reduceat(block.weight, block.cut[:-1]) * self.idf[block.term]
        # the sum below adds in another order than the scores do
        return np.add.reduceat(top[self.q_term], self.q_start[:-1]) * (1 + 1e-12)

    def score(self, block: _Block, query: int, place: np.ndarray) -> None:
        """``place``: each vocabulary term's index in the block, or -1."""
        terms = self.q_term[self.q_start[query]:self.q_start[query + 1]]
        at = place[terms]
        at, terms = at[at >= 0], terms[at >= 0]
        rows = _runs(block.cut[at], block.n[at])
        sums = np.bincount(block.doc[rows], block.weight[rows] * np.repeat(self.idf[terms], block.n[at]), len(block.docs))
        micro = _micro(sums)
        found = np.flatnonzero((sums > 0) & (micro >= self.floor[query]))
        if not len(found):
            return
        found = found[np.argsort(-micro[found], kind="stable")[:self.k]]  # places are in the order of ids
        new = [(-int(micro[x]), block.docs[int(x)].as_py(), float(sums[x])) for x in found]
        best = self.best[query] = sorted(self.best.get(query, []) + new)[:self.k]
        if len(best) == self.k:
            self.floor[query] = max(self.floor[query], -best[-1][0])

    def visit(self, block: _Block, wanted) -> None:
        block.weigh(self.k1, self.b, self.mean_len)
        bound = self.bounds(block)
        queries = np.flatnonzero((bound > 0) & wanted(bound))
        if len(queries):
            place = np.full(len(self.vocabulary), -1, np.int64)
            place[block.term] = np.arange(len(block.term))
            for q in queries.tolist():
                self.score(block, q, place)

    def rows(self, names: pa.Array, kind: pa.DataType) -> pa.RecordBatch:
        out = [(q, m, d, s) for q, best in self.best.items() for m, d, s in best]
        return pa.RecordBatch.from_arrays([
            names.take(pa.array([x[0] for x in out], pa.int64())), pa.array([-x[1] for x in out], pa.int64()),
            pa.array([x[2] for x in out], kind), pa.array([x[3] for x in out], pa.float64())], ["qid", "micro", "doc", "score"])


def _search_chunk(index: DataFrame, pairs: pa.Table, n_docs: int, mean_len: float, k: int, k1: float, b: float) -> DataFrame:
    """``pairs``: distinct (qid, term), at most some CHUNK_TERMS rows. qid, micro, doc, score: k rows per query and task."""
    spark = index.sparkSession
    sc = spark.sparkContext
    pairs = pairs.sort_by("qid")
    ids, terms = pairs["qid"].combine_chunks(), pairs["term"].combine_chunks().dictionary_encode()
    names = ids.unique()
    q_of = pc.index_in(ids, value_set=names).to_numpy()
    q_start = np.searchsorted(q_of, np.arange(len(names) + 1))
    vocabulary, q_term = terms.dictionary, terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    shared_words = sc.broadcast(vocabulary)

    def frequencies(batches):
        words = shared_words.value
        df = np.zeros(len(words), np.int64)
        for block in _blocks(batches, words):
            df[block.term] += block.n
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df)), pa.array(df[df > 0])], ["t", "n"])

    df = np.zeros(len(vocabulary))
    for r in index.mapInArrow(frequencies, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
        df[r["t"]] = r["n"]
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    chunk = sc.broadcast((vocabulary, q_term, q_start, idf, k1, b, mean_len))
    shared_names = sc.broadcast(names)
    doc_kind = index.schema["docs"].dataType.elementType
    schema = f"qid {spark_type(names.type)}, micro long, doc {doc_kind.simpleString()}, score double"
    nothing = np.zeros(len(names), np.int64)

    def seed(batches):
        s, raised = _Scorer(chunk.value, k, nothing), np.zeros(len(nothing))

        def higher(bound):
            new = bound > raised
            np.maximum(raised, bound, out=raised)
            return new

        kind = None
        for block in _blocks(batches, s.vocabulary):
            kind = block.docs.type
            s.visit(block, higher)
        if kind is not None:
            yield s.rows(shared_names.value, kind)

    w = W.partitionBy("qid").orderBy(F.desc("micro"), "doc")
    kth = index.mapInArrow(seed, schema).withColumn("r", F.row_number().over(w)).filter(F.col("r") == k)
    floor = nothing.copy()
    where = {v: i for i, v in enumerate(names.to_pylist())}
    for r in kth.select("qid", "micro").collect():  # a row per query of the chunk
        floor[where[r["qid"]]] = r["micro"]
    shared_floor = sc.broadcast(floor)

    def search(batches):
        s, kind = _Scorer(chunk.value, k, shared_floor.value), None
        for block in _blocks(batches, s.vocabulary):
            kind = block.docs.type
            s.visit(block, lambda bound: _micro(bound + 1e-9) >= s.floor)
        if kind is not None:
            yield s.rows(shared_names.value, kind)

    return index.mapInArrow(search, schema)


def spark_type(t: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type
    return from_arrow_type(t).simpleString()


def bm25_search(queries: DataFrame, index: DataFrame, k: int, *, q_id: str, q_text: str, d_id: str, k1: float = 0.9, b: float = 0.4,
                chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """(q_id, rank, d_id, score): top k documents per query over its distinct terms;
    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); fewer rows when fewer documents match. Queries with equal ids
    count as one query with the terms of all. ``index`` is read three times per chunk: give a written one."""
    if k < 1:
        raise ValueError("k must be at least 1")
    total = index.agg(F.sum(F.size("docs")).alias("n"), F.sum(F.aggregate("len", F.lit(0).cast("long"), lambda a, x: a + x)).alias("len"),
                      F.sum("n_null").alias("none")).first()
    n_docs, with_text = total["n"] or 0, (total["n"] or 0) - (total["none"] or 0)
    mean_len = (total["len"] or 0) / with_text if with_text else 0.0
    pairs = queries.select(F.col(q_id).alias("qid"), F.explode(bm25_terms(q_text)).alias("term")).distinct()
    out = None
    if mean_len > 0:
        for part in _chunks(pairs, chunk_terms):
            if part.num_rows:
                got = _search_chunk(index, part, n_docs, mean_len, k, k1, b)
                out = got if out is None else out.unionByName(got)
    spark: SparkSession = queries.sparkSession
    if out is None:
        schema = T.StructType([T.StructField("qid", queries.schema[q_id].dataType), T.StructField("micro", T.LongType()),
                               T.StructField("doc", index.schema["docs"].dataType.elementType), T.StructField("score", T.DoubleType())])
        out = spark.createDataFrame([], schema)
    w = W.partitionBy("qid").orderBy(F.desc("micro"), "doc")
    top = out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(F.col("qid").alias(q_id), "rank", F.col("doc").alias(d_id), "score")


def _chunks(pairs: DataFrame, chunk_terms: int) -> Iterator[pa.Table]:
    """The pairs in pieces of whole queries, each of at most ``chunk_terms`` pairs or one query."""
    path = write_index(pairs)
    n = path.count()
    if n <= chunk_terms:
        yield path.toArrow()
        return
    per = path.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    upto = global_cumsum(per, ["qid"], "n", "upto")
    # a query lies in the chunk in which its last pair falls: at most chunk_terms pairs and the rest of one query
    of = write_index(upto.select("qid", F.floor((F.col("upto") - 1) / chunk_terms).alias("c")))
    for r in of.select("c").distinct().orderBy("c").collect():
        yield path.join(of.filter(F.col("c") == r["c"]), "qid").select("qid", "term").toArrow()
