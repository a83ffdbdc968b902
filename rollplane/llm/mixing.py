"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a token target; a source with target t and size s takes
floor(t / s) whole copies of all its documents and one more copy of those whose
hash lies below the source's threshold. The threshold comes from histograms
over hash buckets with only the boundary bucket refined
(``common.weighted_cuts``); documents are then filtered, never sorted, and a
larger budget only adds documents (nested thresholds).

Defined cases: null and empty text have size 0 and are taken 0 words (their
source's whole copies still hold them); a null source is a source of its own,
last in order; repeated rows share a hash and are separated by row; an empty
table gives no rows; columns other than id, text and source are ignored;
texts of any length are counted whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import global_index
from .common import below_cut, n_words, weighted_cuts, written


def mix_hash(id_col: Column, text: Column) -> Column:
    """60 bits of the MD5 of ``id:text`` as a long."""
    h = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, max_epochs: float) -> DataFrame:
    """(source, source_size) -> with ``target``. Sources in code-point order
    (null last) weigh ``weights`` in turn and share ``budget`` * all sizes; a
    target stops at ``max_epochs`` * its source's size and the excess is reshared
    by weight until none is above. Each resharing is a one-row aggregate."""
    ranked = global_index(sizes, [F.col("source").asc_nulls_last()], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = written(ranked.select("source", "source_size", w.alias("weight"),
                                (F.col("source_size") * float(max_epochs)).alias("cap")), "mixsrc")
    total = (src.agg(F.sum("source_size")).first()[0] or 0) * float(budget)
    level, n_capped = None, -1
    while True:
        # capped: at the current level the weight's share would pass the cap
        capped = F.lit(False) if level is None else F.col("cap") <= F.lit(level) * F.col("weight")
        r = src.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).alias("c"),
                    F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("w"),
                    F.sum(capped.cast("int")).alias("n")).first()
        if (r["n"] or 0) == n_capped or not r["w"]:
            if not r["w"]:
                level = float("inf") if r["n"] else 0.0
            break
        n_capped, level = r["n"] or 0, (total - r["c"]) / r["w"]
    share = F.col("cap") if level == float("inf") else F.least(F.col("cap"), F.lit(float(level)) * F.col("weight"))
    return src.select("source", "source_size", share.cast("double").alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[float], budget: float = 1.5, max_epochs: float = 2.0,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """(rows, plan): the narrow written rows (doc_id, source, size, u, rid) and
    the small plan by source: source_size, target, copies, cut (c0, c1)."""
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               n_words(F.col(text_col)).alias("size"),
                               mix_hash(F.col(id_col), F.col(text_col)).alias("u"))
                       .withColumn("rid", F.monotonically_increasing_id()), "mixrows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, budget, max_epochs)
    copies = F.when(F.col("source_size") > 0,
                    F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(int(max_epochs)))).otherwise(0)
    plan = (targets.withColumn("copies", copies.cast("int"))
                   .withColumn("g", F.xxhash64(F.col("source").isNull(), "source"))
                   .withColumn("extra", F.col("target") - F.col("copies") * F.col("source_size")))
    plan = written(plan, "mixplan")
    keyed = rows.filter("size > 0").withColumn("g", F.xxhash64(F.col("source").isNull(), "source"))
    cuts = weighted_cuts(keyed.select("g", "u", "rid", "size"),
                         plan.filter("extra > 0").select("g", F.col("extra").alias("target")), ["u", "rid"], "size")
    return rows, written(plan.join(cuts, "g", "left"), "mixplan")


def _copies() -> Column:
    extra = F.col("c0").isNotNull() & (F.col("size") > 0) & below_cut(["u", "rid"], ["c0", "c1"])
    return F.col("copies") + F.coalesce(extra, F.lit(False)).cast("int")


def mix(docs: DataFrame, weights: Sequence[float], **kw) -> DataFrame:
    """doc_id, size, source_size, target, copies_taken, taken for every document."""
    rows, plan = mix_plan(docs, weights, **kw)
    out = rows.join(plan.withColumnRenamed("source", "_src"), F.col("source").eqNullSafe(F.col("_src")))
    return (out.withColumn("copies_taken", _copies())
               .select("doc_id", "size", "source_size", "target", "copies_taken",
                       (F.col("size") * F.col("copies_taken")).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **kw) -> DataFrame:
    """The documents themselves, each repeated as often as the mix takes it.
    Thresholds are compared in the row, so texts are not shuffled. Exact repeats
    of one row share a hash; the boundary then falls before or after all of them."""
    _, plan = mix_plan(docs, weights, id_col=id_col, text_col=text_col, source_col=source_col, **kw)
    p = plan.select(F.col("source").alias("_src"), "copies", "c0", "c1")
    d = docs.select(F.struct("*").alias("_doc"))
    marked = d.withColumn("_u", mix_hash(F.col(f"_doc.{id_col}"), F.col(f"_doc.{text_col}")))
    # tied on the hash: copies of one row stay together, counted in when the cut lies among them
    extra = F.col("c0").isNotNull() & ((F.col("_u") < F.col("c0")) | ((F.col("_u") == F.col("c0")) & (F.col("c1") > 0)))
    n = (F.col("copies") + F.coalesce(extra, F.lit(False)).cast("int"))
    out = marked.join(p, F.col(f"_doc.{source_col}").eqNullSafe(F.col("_src")))
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), n))).select("_doc.*")


WEIGHTS = (3, 1, 2)


def op2_mix(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    out = mix(read_table(spark, sf_dir, "documents"), WEIGHTS, budget=1.5, max_epochs=2.0)
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, ''))[1:15])::BIGINT AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
-- water level: sources in the order in which they reach their cap
o AS (
  SELECT *, 2.0 * source_size AS cap, 1.5 * sum(source_size) OVER () AS budget,
    coalesce(sum(2.0 * source_size) OVER b, 0) AS capped_before, sum(w) OVER a AS w_left
  FROM s WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                a AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min((budget - capped_before) / w_left, source_size / w) AS level FROM o WHERE cap > (budget - capped_before) / w_left * w),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM l), 0) * w)::DOUBLE AS target FROM o),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2)::INT ELSE 0 END AS copies FROM t),
c AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS extra,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY u, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  (size * (copies + CASE WHEN size > 0 AND extra > 0 AND
     (upto <= extra OR (upto - size <= extra AND 2 * (extra - (upto - size)) >= size)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
