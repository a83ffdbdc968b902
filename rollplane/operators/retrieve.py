"""Retrieval for agentic rollouts.

* Dense top-k: queries and corpus are cut into blocks of bounded size, every
  pair of blocks keeps its own top-k per query (numpy matmul), and a
  final ``row_number`` per query picks the global top-k.
* BM25: a block index searched with exact pruning (``operators.bm25``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .bm25 import bm25_index, bm25_search, write_index

# Rows per block of queries and of corpus, and corpus rows per matmul.
QUERY_BLOCK, CORPUS_BLOCK, SLICE = 1024, 32768, 2048


def l2_normalize(v: Column | str) -> Column:
    from ..functions.text import let
    c = F.col(v) if isinstance(v, str) else v
    return let(lambda b: F.transform(b["v"], lambda x: x / b["norm"]),
               v=c, norm=F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)))


def mean_vectors(df: DataFrame, *, key: str, vec: str, normalize: bool = True) -> DataFrame:
    """Element-wise mean vector per key (e.g. class centroids)."""
    ex = df.select(key, F.posexplode(l2_normalize(vec) if normalize else F.col(vec)).alias("_p", "_x"))
    per = ex.groupBy(key, "_p").agg(F.avg("_x").alias("_x"))
    return (per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_p", "_x"))).alias("_s"))
               .select(key, F.transform("_s", lambda e: e["_x"]).alias(vec)))


def dense_topk(queries: DataFrame, corpus: DataFrame, k: int, *, q_id: str, q_vec: str, d_id: str, d_vec: str,
               normalize: bool = True) -> DataFrame:
    """Top-k corpus rows per query by inner product (after L2
    normalisation).  Returns (q_id, rank, d_id, score).

    Scores are compared in units of 1e-6, ties by smaller doc id: one total
    order, used inside the blocks and for the final rank, so the answer does
    not depend on the layout.  Queries and corpus are cut into hashed blocks of
    bounded size; every pair of blocks is one group (one matmul per slice
    with a running top-k), and k rows per query and corpus block remain."""
    q = queries.select(F.col(q_id).alias("qid"), (l2_normalize(q_vec) if normalize else F.col(q_vec)).alias("v"))
    c = corpus.select(F.col(d_id).alias("did"), (l2_normalize(d_vec) if normalize else F.col(d_vec)).alias("v"))
    n_q = max(1, -(-queries.count() // QUERY_BLOCK))
    n_c = max(1, -(-corpus.count() // CORPUS_BLOCK))

    def blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(n_q)).cast("int")).withColumn("cb", blocks(n_c))
    c = c.withColumn("cb", F.pmod(F.xxhash64("did"), F.lit(n_c)).cast("int")).withColumn("qb", blocks(n_q))
    cand = (q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb"))
             .applyInPandas(_block_topk(k), _cand_schema(q.schema["qid"].dataType, c.schema["did"].dataType)))
    w = W.partitionBy("qid").orderBy(F.col("micro").desc(), F.col("did"))
    ranked = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select(F.col("qid").alias(q_id), "rank", F.col("did").alias(d_id), "score")


def _cand_schema(qid: T.DataType, did: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("qid", qid), T.StructField("did", did), T.StructField("score", T.DoubleType()),
                         T.StructField("micro", T.LongType())])


def _block_topk(k: int):
    def run(qs: pd.DataFrame, ds: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(qs) and len(ds):
            ds = ds.sort_values("did", kind="stable")  # position order = id order
            qmat, dids = np.stack(qs["v"].to_numpy()).astype(np.float64), ds["did"].to_numpy()
            vecs = ds["v"].to_numpy()
            at = np.zeros((len(qmat), 0), np.int64)
            score, micro = np.zeros((len(qmat), 0)), np.zeros((len(qmat), 0), np.int64)
            for lo in range(0, len(vecs), SLICE):
                new = qmat @ np.stack(vecs[lo:lo + SLICE]).astype(np.float64).T
                score = np.hstack([score, new])
                micro = np.hstack([micro, np.floor(new * 1e6 + 0.5).astype(np.int64)])
                at = np.hstack([at, np.tile(np.arange(lo, lo + new.shape[1]), (len(qmat), 1))])
                best = np.lexsort((at, -micro), axis=1)[:, :k]
                score, micro, at = (np.take_along_axis(x, best, 1) for x in (score, micro, at))
            rows = np.repeat(np.arange(len(qmat)), at.shape[1])
            out.append(pd.DataFrame({"qid": qs["qid"].to_numpy()[rows], "did": dids[at.ravel()],
                                     "score": score.ravel(), "micro": micro.ravel()}))
        return out[0] if out else pd.DataFrame({"qid": [], "did": [], "score": [], "micro": []})
    return run


# BM25 -----------------------------------------------------------------------
def bm25_topk(queries: DataFrame, corpus: DataFrame, k: int, *, q_id: str, q_text: str, d_id: str, d_text: str,
              k1: float = 0.9, b: float = 0.4) -> DataFrame:
    """Top-k documents per query by BM25: the corpus is tokenised once into a written block index, which
    is searched with pruning. Returns (q_id, rank, d_id, score)."""
    index = write_index(bm25_index(corpus, d_id=d_id, text=d_text))
    return bm25_search(queries, index, k, q_id=q_id, q_text=q_text, d_id=d_id, k1=k1, b=b)


# D5 / A12 / B20 ----------------------------------------------------------------
def read_corpus(df: DataFrame, *, id_col: str, contents_col: str) -> DataFrame:
    """contents = 'title\\ntext' -> title (first line, quotes stripped), text."""
    c = F.col(contents_col)
    title = F.regexp_replace(F.substring_index(c, "\n", 1), r'^"+|"+$', "")
    text = F.when(F.instr(c, "\n") > 0, F.substring(c, F.instr(c, "\n") + 1, F.length(c))).otherwise(F.lit(""))
    return df.select(F.col(id_col).alias("id"), title.alias("title"), text.alias("text"), c.alias("contents"))


def doc_lookup(hits: DataFrame, corpus: DataFrame, *, d_id: str, corpus_id: str = "id") -> DataFrame:
    """Attach documents to ranked hits (rank order kept in the rank column)."""
    return hits.join(corpus.withColumnRenamed(corpus_id, d_id), d_id)


def passages_to_text(hits_with_docs: DataFrame, *, q_id: str, rank: str = "rank") -> DataFrame:
    """'Doc i(Title: t) text\\n' concatenated over a query's ranked hits (k
    rows per query)."""
    g = hits_with_docs.groupBy(q_id).agg(F.array_sort(F.collect_list(F.struct(rank, "title", "text"))).alias("_h"))
    return g.select(q_id, F.array_join(F.transform("_h", lambda e, i: F.concat(
        F.lit("Doc "), (i + 1).cast("string"), F.lit("(Title: "), e["title"], F.lit(") "), e["text"], F.lit("\n"))),
        "").alias("reference"))


# D7 -------------------------------------------------------------------------
def answer_in_passage(passage: Column, answers: Column) -> Column:
    """True when any normalised golden answer is a substring of the normalised passage."""
    from ..functions.text import let, normalize_answer
    return let(lambda v: F.exists(v["a"], lambda a: F.instr(v["p"], a) > 0),
               p=normalize_answer(passage), a=F.transform(answers, normalize_answer))


def answer_in_passages(hits: DataFrame, questions: DataFrame, *, q_id: str, passage: str, answers: str) -> DataFrame:
    """(q_id, hit) of every question: whether one of its hits holds one of its answers. Each hit is judged on
    its own row; no question's passages are gathered."""
    per = (hits.join(questions.select(q_id, answers), q_id)
               .groupBy(q_id).agg(F.bool_or(answer_in_passage(F.col(passage), F.col(answers))).alias("_hit")))
    return questions.select(q_id).join(per, q_id, "left").select(q_id, F.coalesce("_hit", F.lit(False)).alias("hit"))


# C7 -------------------------------------------------------------------------
# Link extensions that are fetched.
PAGE_EXTENSIONS = ["", ".html", ".htm", ".shtml"]


def link_extension(url: Column | str) -> Column:
    """Extension of the last path component (leading dots ignored)."""
    c = F.col(url) if isinstance(url, str) else url
    base = F.regexp_replace(F.substring_index(c, "/", -1), r"^\.+", "")
    return F.when(F.instr(base, ".") > 0, F.concat(F.lit("."), F.substring_index(base, ".", -1))).otherwise(F.lit(""))


def link_filter(df: DataFrame, *, url: str, mime: str | None = None) -> DataFrame:
    keep = link_extension(url).isin(*PAGE_EXTENSIONS)
    if mime:
        keep = keep & F.col(mime).isNull()
    return df.filter(keep)
