"""Queries: retrieval.

Dense queries are the class centroids of ``embeddings`` (derived by Spark
from the table), searched against every embedding; lexical queries are
the whole ``benchmark`` texts searched against every ``documents`` text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import retrieve as R
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W
from ..sources.tables import read_table
from .registry import r6, register

WORDS_RE = "'[^\\pL\\pN]+'"


def terms_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), {WORDS_RE}), lambda w: w <> '')"


# D3 -------------------------------------------------------------------------
_DENSE_SQL = """
, nv AS (SELECT vec_id, label,
                list_transform(embedding, lambda x: x / sqrt(list_sum(list_transform(embedding, lambda y: y * y)))) AS v
         FROM vectors),
ex AS (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS p FROM nv),
cen AS (SELECT label, list(x ORDER BY p) AS c FROM (SELECT label, p, avg(x) AS x FROM ex GROUP BY label, p) g GROUP BY label),
cn AS (SELECT label, list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)))) AS q FROM cen),
sc AS (SELECT cn.label, nv.vec_id, list_inner_product(cn.q, nv.v) AS score FROM cn, nv)
SELECT label, CAST("rank" AS INTEGER) AS "rank", vec_id, round(score, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(score, 6) DESC, vec_id) AS "rank" FROM sc) r
WHERE "rank" <= 3"""


@register("dense_topk", W(_DENSE_SQL, "vectors"))
def q_dense_topk(spark, sf):
    v = FX.vectors(spark, sf)
    cent = R.mean_vectors(v, key="label", vec="embedding")
    top = R.dense_topk(cent, v, 3, q_id="label", q_vec="embedding", d_id="vec_id", d_vec="embedding")
    return top.select(F.col("label").cast("int"), "rank", "vec_id", r6("score").alias("score"))


# D4 -------------------------------------------------------------------------
def _bm25_sql(k: int) -> str:
    return f"""
, dt AS (SELECT doc_id AS doc, {terms_sql('text')} AS t FROM documents),
dl AS (SELECT doc, len(t) AS dl FROM dt),
post AS (SELECT term, doc, count(*) AS tf FROM (SELECT doc, unnest(t) AS term FROM dt) u GROUP BY term, doc),
dfq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
st AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM dl),
qt AS (SELECT DISTINCT qid, term FROM (SELECT item_id AS qid, unnest({terms_sql('text')}) AS term FROM benchmark) u),
c AS (SELECT qid, post.doc,
             ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 1.9 / (tf + 0.9 * (1 - 0.4 + 0.4 * dl / avgdl)) AS s
      FROM qt JOIN dfq USING (term) JOIN post USING (term) JOIN dl USING (doc), st),
sc AS (SELECT qid, doc, sum(s) AS score FROM c GROUP BY qid, doc),
top AS (SELECT qid AS item_id, CAST("rank" AS INTEGER) AS "rank", doc AS doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, doc) AS "rank" FROM sc) r
        WHERE "rank" <= {k})
"""


def _bm25(spark, sf, k):
    b = read_table(spark, sf, "benchmark")
    d = read_table(spark, sf, "documents")
    return R.bm25_topk(b, d, k, q_id="item_id", q_text="text", d_id="doc_id", d_text="text")


@register("bm25_topk", _bm25_sql(5).replace("\n, dt AS", "WITH dt AS", 1) +
          "SELECT item_id, \"rank\", doc_id, round(score, 6) AS score FROM top")
def q_bm25_topk(spark, sf):
    return _bm25(spark, sf, 5).select("item_id", "rank", "doc_id", r6("score").alias("score"))


# D5 -------------------------------------------------------------------------
_TITLE_SQL = "regexp_replace(split_part(text, chr(10), 1), '^\"+|\"+$', '', 'g')"


@register("doc_lookup", _bm25_sql(5).replace("\n, dt AS", "WITH dt AS", 1) + f"""
SELECT top.item_id, top."rank", top.doc_id, {_TITLE_SQL} AS title, round(top.score, 6) AS score
FROM top JOIN documents ON top.doc_id = documents.doc_id""")
def q_doc_lookup(spark, sf):
    corpus = R.read_corpus(read_table(spark, sf, "documents"), id_col="doc_id", contents_col="text")
    hits = R.doc_lookup(_bm25(spark, sf, 5), corpus.select("id", "title"), d_id="doc_id")
    return hits.select("item_id", "rank", "doc_id", "title", r6("score").alias("score"))


# B20 ------------------------------------------------------------------------
@register("passages_to_text", _bm25_sql(3).replace("\n, dt AS", "WITH dt AS", 1) + f"""
SELECT item_id, md5(string_agg('Doc ' || CAST("rank" AS VARCHAR) || '(Title: ' || {_TITLE_SQL} || ') ' ||
                               CASE WHEN instr(text, chr(10)) > 0 THEN substring(text, instr(text, chr(10)) + 1) ELSE '' END
                               || chr(10), '' ORDER BY "rank")) AS reference_md5
FROM top JOIN documents USING (doc_id) GROUP BY item_id""")
def q_passages_to_text(spark, sf):
    corpus = R.read_corpus(read_table(spark, sf, "documents"), id_col="doc_id", contents_col="text")
    hits = R.doc_lookup(_bm25(spark, sf, 3), corpus.select("id", "title", "text"), d_id="doc_id")
    p = R.passages_to_text(hits, q_id="item_id")
    return p.select("item_id", F.md5("reference").alias("reference_md5"))


# D7 -------------------------------------------------------------------------
def _norm_sql(x: str) -> str:
    from .q_grading import norm_sql
    return norm_sql(x)


@register("answer_in_passages", _bm25_sql(5).replace("\n, dt AS", "WITH dt AS", 1) + f"""
, ans AS (SELECT item_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]'), lambda s: {_norm_sql('s')}),
                                      lambda a: a <> '') AS a FROM benchmark),
pas AS (SELECT item_id, list({_norm_sql('d.text')}) AS p FROM top JOIN documents d USING (doc_id) GROUP BY item_id)
SELECT b.item_id, coalesce(len(list_filter(p, lambda x: len(list_filter(a, lambda y: instr(x, y) > 0)) > 0)) > 0, false) AS hit
FROM benchmark b JOIN ans USING (item_id) LEFT JOIN pas USING (item_id)""")
def q_answer_in_passages(spark, sf):
    b = read_table(spark, sf, "benchmark")
    d = read_table(spark, sf, "documents").select("doc_id", F.col("text").alias("dtext"))
    answers = F.filter(F.split("text", "[.!?]"), lambda s: TX.normalize_answer(s) != "")
    hits = R.doc_lookup(_bm25(spark, sf, 5), d, d_id="doc_id", corpus_id="doc_id")
    return R.answer_in_passages(hits, b.select("item_id", answers.alias("answers")), q_id="item_id", passage="dtext",
                                answers="answers")


# A12 ------------------------------------------------------------------------
@register("read_corpus", f"""
SELECT doc_id AS id, {_TITLE_SQL} AS title,
       CAST(CASE WHEN instr(text, chr(10)) > 0 THEN length(text) - instr(text, chr(10)) ELSE 0 END AS INTEGER) AS text_len
FROM documents""")
def q_read_corpus(spark, sf):
    c = R.read_corpus(read_table(spark, sf, "documents"), id_col="doc_id", contents_col="text")
    return c.select("id", "title", F.length("text").alias("text_len"))


# C7 -------------------------------------------------------------------------
@register("link_filter", """
SELECT page_id, url FROM (
  SELECT page_id, url, regexp_replace(string_split(url, '/')[-1], '^\\.+', '') AS b FROM pages) x
WHERE (CASE WHEN instr(b, '.') > 0 THEN '.' || string_split(b, '.')[-1] ELSE '' END) IN ('', '.html', '.htm', '.shtml')""")
def q_link_filter(spark, sf):
    p = read_table(spark, sf, "pages").select("page_id", "url")
    return R.link_filter(p, url="url")
