"""Quality classifier: document evidence with hierarchical empirical-Bayes site priors.

A logistic model over text statistics gives each document its own evidence. Sites
(host: the source; path below it: the language section) add what is known about
them: good and bad counts of all their documents (labels where there are any, the
model's probability elsewhere), shrunk path -> host -> whole corpus by
Beta-binomial priors whose strength is estimated from the spread between
sites. Grouped sums combine before the shuffle, so a hot host is one row per
task; documents meet only their path's few numbers.

Defined cases: null text counts as empty; a null host or path is a site of its
own; labels of unknown documents and null labels are ignored, several labels of
one document are averaged (a tie is bad); without usable labels every
document gets the prior 0.5 and is kept; repeated rows are judged alike; an
empty table gives no rows; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from math import log

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, written

# Bound of the labelled rows the driver fits the document model on (a share of
# the ids by hash). Everything else counts all documents.
MAX_FIT_ROWS = 20_000

FEATURES = ["log_words", "word_chars", "symbols", "capitals", "shouts", "digits", "repeated_lines", "variety"]


def _share(text: Column, kept: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide((F.length(text) - F.length(kept)).cast("double"), whole), F.lit(0.0))


def with_features(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Add ``out``, the statistics FEATURES of the whole text (all 0 for an empty
    one). Words and lines are columns of their own, split once."""
    d = df.withColumn("_t", F.coalesce(text, F.lit("")))
    d = d.withColumn("_w", F.split(F.trim(F.translate("_t", SPACES, " " * len(SPACES))), " +"))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda s: F.trim(s) != ""))
    t, words, lines = F.col("_t"), F.col("_w"), F.col("_l")
    d = d.withColumn("_c", F.length(F.translate(t, SPACES, "")).cast("double"))
    d = d.withColumn("_n", F.when(F.col("_c") > 0, F.size(words)).otherwise(0).cast("double"))
    n, chars = F.col("_n"), F.col("_c")
    x = [F.log1p(n), F.coalesce(F.try_divide(chars, n), F.lit(0.0)) / 10,
         _share(t, F.translate(t, "#*$%&|<>{}[]=_~^\\/@", ""), chars),
         _share(t, F.regexp_replace(t, r"\p{Lu}", ""), chars),
         _share(t, F.translate(t, "!", ""), chars),
         _share(t, F.translate(t, "0123456789", ""), chars),
         1 - F.coalesce(F.try_divide(F.size(F.array_distinct(lines)).cast("double"), F.size(lines)), F.lit(1.0)),
         F.coalesce(F.try_divide(F.when(n > 0, F.size(F.array_distinct(words))).cast("double"), n), F.lit(0.0))]
    return d.withColumn(out, F.array(*x)).drop("_t", "_w", "_l", "_c", "_n")


def _expand(x: np.ndarray) -> np.ndarray:
    """Features and their squares, with a constant."""
    return np.hstack([np.ones((len(x), 1)), x, x * x])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 60):
    """Ridge logistic regression by Newton steps over standardised features:
    (weights, means, scales)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = _expand((x - mean) / scale)
    w = np.zeros(z.shape[1])
    pen = np.full(len(w), ridge)
    pen[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + pen * w
        h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(pen)
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w, mean, scale


def document_logit(model, features: list[Column]) -> Column:
    """The model's log odds as one native expression."""
    w, mean, scale = model
    k = len(mean)
    out = F.lit(float(w[0]))
    for i, f in enumerate(features):
        z = (f - float(mean[i])) / float(scale[i])
        out = out + z * float(w[1 + i]) + z * z * float(w[1 + k + i])
    return F.greatest(F.lit(-20.0), F.least(F.lit(20.0), out))


def clean_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    good = (F.avg(F.col(label_col).cast("double")) > 0.5).cast("int")
    return (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
                  .groupBy(F.col(id_col).alias("_label_id")).agg(good.alias("y")))


def fit_document_model(rows: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS):
    """rows: doc_id, x (array of FEATURES). None if a class is missing."""
    n = labels.count()
    share = 1.0 if n <= max_rows else 0.95 * max_rows / n  # 0.95: the hash's share varies by far less
    chosen = labels.filter(F.expr("pmod(xxhash64(_label_id), 1000000)") < F.lit(int(share * 1_000_000)))
    sample = rows.join(chosen, F.col("doc_id") == F.col("_label_id")).select("doc_id", "x", "y").collect()
    sample.sort(key=lambda r: (r["doc_id"], r["x"]))
    y = np.array([r["y"] for r in sample], float)
    if len(y) < 2 or y.min() == y.max():
        return None
    return fit_logistic(np.array([r["x"] for r in sample], float), y)


def strength(sites: DataFrame, n: str, good: str, mean: Column) -> float:
    """Prior strength kappa of a Beta prior by moments: how many documents the
    parent's rate is worth, from the spread of site rates beyond sampling noise."""
    rate = F.col(good) / F.col(n)
    r = (sites.filter(F.col(n) >= 2).withColumn("m", mean).agg(
        F.sum(F.col(n) * (rate - F.col("m")) * (rate - F.col("m"))).alias("ss"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("noise"),
        F.sum(F.col("m") * (1 - F.col("m")) * (F.col(n) - 1)).alias("scale")).first())
    if not r["scale"]:
        return 1e4
    # E[ss] = noise + rho * scale with rho = 1 / (kappa + 1)
    rho = ((r["ss"] or 0.0) - r["noise"]) / r["scale"]
    return float(min(1e4, max(1.0, 1 / rho - 1))) if rho > 0 else 1e4


def site_posteriors(judged: DataFrame) -> tuple[DataFrame, float]:
    """judged: host, path, r (soft label), all documents. Per (host, path):
    n, good, host_rate, kappa_path; and the corpus's rate."""
    paths = written(judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hgood").alias("g")).first()
    rate = (total["g"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    hosts = written(hosts, "hosts")
    k_host = strength(hosts, "hn", "hgood", F.lit(rate))
    hosts = hosts.select(F.col("host").alias("_h"), ((F.col("hgood") + k_host * rate) / (F.col("hn") + k_host)).alias("host_rate"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    k_path = strength(both, "n", "good", F.col("host_rate"))
    return written(both.withColumn("kappa", F.lit(k_path)), "sites"), rate


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_fit_rows: int = MAX_FIT_ROWS,
             id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang",
             label_col: str = "quality"):
    """(model, sites, rate): what a document is judged by; see ``posterior``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"),
                       F.col(text_col).alias("text"))
    rows = written(with_features(rows, F.col("text"), "x").drop("text"), "features")
    y = clean_labels(labels, "doc_id", label_col)
    model = fit_document_model(rows, y, max_fit_rows)
    if model is None:
        return rows, None, None, 0.5
    p = 1 / (1 + F.exp(-document_logit(model, [F.get("x", F.lit(i)) for i in range(len(FEATURES))])))
    judged = rows.join(y, F.col("doc_id") == F.col("_label_id"), "left").select(
        "host", "path", F.coalesce(F.col("y").cast("double"), p).alias("r"))
    sites, rate = site_posteriors(judged)
    return rows, model, sites, rate


def posterior(logit: Column, rate: float, own: Column) -> Column:
    """P(good): the document's evidence (log odds less the corpus's) on top of its
    path's posterior, from which its own contribution is taken out."""
    n, good = F.col("n") - 1, F.greatest(F.col("good") - own, F.lit(0.0))
    site = (good + F.col("kappa") * F.col("host_rate")) / (n + F.col("kappa"))
    site = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), site))
    return 1 / (1 + F.exp(-(logit - log(rate / (1 - rate)) + F.log(site / (1 - site)))))


def _site_join(df: DataFrame, sites: DataFrame, host: Column, path: Column) -> DataFrame:
    s = sites.withColumnsRenamed({"host": "_sh", "path": "_sp"})
    return df.join(s, host.eqNullSafe(F.col("_sh")) & path.eqNullSafe(F.col("_sp")))


def quality_table(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    """doc_id, document_score, host_rate, path_rate, posterior, kept for every row."""
    rows, model, sites, rate = classify(docs, labels, **kw)
    if model is None:
        half = F.lit(0.5)
        return rows.select("doc_id", half.alias("document_score"), half.alias("host_rate"), half.alias("path_rate"),
                           half.alias("posterior"), F.lit(True).alias("kept"))
    logit = document_logit(model, [F.get("x", F.lit(i)) for i in range(len(FEATURES))])
    d = rows.withColumn("logit", logit).withColumn("document_score", 1 / (1 + F.exp(-F.col("logit"))))
    d = _site_join(d, sites, F.col("host"), F.col("path"))
    d = d.withColumn("posterior", posterior(F.col("logit"), rate, F.col("document_score")))
    path_rate = (F.col("good") + F.col("kappa") * F.col("host_rate")) / (F.col("n") + F.col("kappa"))
    return d.select("doc_id", "document_score", "host_rate", path_rate.alias("path_rate"), "posterior",
                    (F.col("posterior") >= threshold).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
                   text_col: str = "text", host_col: str = "source", path_col: str = "lang", **kw) -> DataFrame:
    """The documents that the classifier keeps, with all their columns. Judged in
    the row: only the few site numbers are joined, texts are not shuffled."""
    _, model, sites, rate = classify(docs, labels, id_col=id_col, text_col=text_col, host_col=host_col,
                                     path_col=path_col, **kw)
    if model is None:
        return docs
    d = docs.select(F.struct("*").alias("_doc"))
    d = with_features(d, F.col(f"_doc.{text_col}"), "_x")
    d = d.withColumn("_logit", document_logit(model, [F.get("_x", F.lit(i)) for i in range(len(FEATURES))]))
    d = _site_join(d, sites, F.col(f"_doc.{host_col}"), F.col(f"_doc.{path_col}"))
    own = 1 / (1 + F.exp(-F.col("_logit")))
    return d.filter(posterior(F.col("_logit"), rate, own) >= threshold).select("_doc.*")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    out = quality_table(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", *[F.round(c, 6).alias(c) for c in ("document_score", "host_rate", "path_rate", "posterior")],
                      "kept")
