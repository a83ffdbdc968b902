"""Quality rules by weak supervision (DataFrame functions only).

Each rule votes good (1), bad (0) or abstains (null) on statistics of the whole
text. Expectation-maximisation over all documents estimates each rule's
accuracy on good and on bad documents; a document is kept if its posterior
probability of being good reaches ``threshold``. EM runs on counts of distinct
vote patterns (at most 3^rules rows whatever the table's size), one small
aggregation per step.

Defined cases: null text counts as empty and has 0 of everything; a document on
which all rules abstain gets the prior; repeated rows count as often as they
stand; texts of any length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, WORD, written

SYMBOLS = "#*$%&|<>"

# name: (votes bad if, votes good if); neither: abstains. Defects that go together
# share one rule, since EM takes rules as independent within good and bad documents.
RULES = {
    "length": ("n_words < 20", "n_words >= 60"),
    "word_length": ("mean_word_chars < 2.5 or mean_word_chars > 14", "mean_word_chars between 3 and 10"),
    "symbols": ("symbol_ratio > 0.06", "symbol_ratio < 0.02"),
    "repetition": ("dup_line_ratio > 0.5 or repeat_ratio > 0.4", "dup_line_ratio < 0.05 and repeat_ratio < 0.2"),
    "shouting": ("upper_ratio > 0.3 or shout_ratio > 0.1", "upper_ratio < 0.1 and shout_ratio < 0.02"),
    "sentence_ends": ("stop_ratio < 0.002", "stop_ratio > 0.005"),
}
# A rule is written to vote bad on at most this share of good documents. Without
# the bound EM may call the commonest kind of junk "bad" and the other kinds "good".
MAX_FALSE_ALARM = 0.005


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice. Windows are
    compared by 64-bit hash; a text without a repeated hash skips the sort."""
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return windows


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of each text, in one projection chain over the scan."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.select("doc_id", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
                 F.filter(F.split("text", "\n"), lambda s: F.translate(s, SPACES, "") != "").alias("lines"))
    text = F.col("text")
    t = t.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))).cast("long").alias("n_upper"),
        _count_of(text, "!").cast("long").alias("n_shouts"),
        _count_of(text, ".?。").cast("long").alias("n_stops"),
        repeated_words(F.col("words")).alias("h"))
    stats = [c for c in t.columns if c != "h"]
    # positions of repeated windows, in order: sort (hash, position), keep neighbours with equal hashes
    t = t.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.array_sort(F.transform(
        "h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(
            F.expr("array(cast(null as struct<h: bigint, i: int>))")))
    t = t.select(*stats, F.when(F.get("s", F.lit(0)).isNotNull(), F.array_sort(F.transform(F.filter(
        "s", lambda x, k: F.coalesce((x["h"] == F.get("s", k + 1)["h"]) | F.lit(False), F.lit(False))
        | F.coalesce((k > 0) & (x["h"] == F.get("s", F.greatest(k - 1, F.lit(0)))["h"]), F.lit(False))),
        lambda x: x["i"]))).otherwise(F.expr("array(cast(null as int))")).alias("p"))
    covered = F.aggregate(F.transform("p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("p", k + 1) - x, F.lit(3)))),
                          F.lit(0), lambda a, x: a + x)
    return t.select(*stats, F.when(F.get("p", F.lit(0)).isNotNull(), covered).otherwise(0).cast("long")
                    .alias("n_repeat_words"))


def ratios(stats: DataFrame) -> DataFrame:
    d = {"mean_word_chars": "word_chars / n_words", "symbol_ratio": "n_symbols / word_chars",
         "dup_line_ratio": "n_dup_lines / n_lines", "repeat_ratio": "n_repeat_words / n_words",
         "upper_ratio": "n_upper / word_chars", "shout_ratio": "n_shouts / word_chars",
         "stop_ratio": "n_stops / word_chars"}
    return stats.withColumns({k: F.expr(f"try_divide({v.split(' / ')[0]}, {v.split(' / ')[1]})") for k, v in d.items()})


def votes(stats: DataFrame, rules: dict = RULES) -> DataFrame:
    """Add v_<rule>: 1 good, 0 bad, null abstains."""
    out = {}
    for name, (bad, good) in rules.items():
        out[f"v_{name}"] = F.expr(f"case when {bad} then 0 when {good} then 1 end")
    return ratios(stats).withColumns(out)


def posterior(model: dict, names: list[str]) -> Column:
    """P(good | votes) under the fitted accuracies; abstentions say nothing."""
    z = F.lit(log(model["prior"] / (1 - model["prior"])))
    for n in names:
        a, b = model["good"][n], model["bad"][n]
        z = z + F.when(F.col(f"v_{n}") == 1, log(a / (1 - b))).when(F.col(f"v_{n}") == 0, log((1 - a) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def fit(voted: DataFrame, names: list[str], max_steps: int = 30, tolerance: float = 1e-5) -> dict:
    """EM: P(good), and per rule P(vote good | good), P(vote bad | bad), each
    smoothed by one vote either way so that no accuracy reaches 0 or 1; the
    first is at least 1 - MAX_FALSE_ALARM."""
    cols = [f"v_{n}" for n in names]
    patterns = written(voted.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")), "patterns").coalesce(1)
    floor = 1 - MAX_FALSE_ALARM
    model = {"prior": 0.8, "good": dict.fromkeys(names, floor), "bad": dict.fromkeys(names, 0.5)}
    for _ in range(max_steps):
        p = patterns.withColumn("w", posterior(model, names) * F.col("n"))
        aggs = [F.sum("w").alias("w"), F.sum("n").alias("n")]
        for n in names:
            v, bad = F.col(f"v_{n}"), F.col("n") - F.col("w")
            aggs += [F.sum(F.when(v == 1, F.col("w"))).alias(f"g1_{n}"), F.sum(F.when(v.isNotNull(), F.col("w"))).alias(f"g_{n}"),
                     F.sum(F.when(v == 0, bad)).alias(f"b0_{n}"), F.sum(F.when(v.isNotNull(), bad)).alias(f"b_{n}")]
        r = p.agg(*aggs).first()
        if not r["n"]:
            return model
        new = {"prior": min(0.99, max(0.01, r["w"] / r["n"])),
               "good": {n: max(floor, ((r[f"g1_{n}"] or 0) + 1) / ((r[f"g_{n}"] or 0) + 2)) for n in names},
               "bad": {n: ((r[f"b0_{n}"] or 0) + 1) / ((r[f"b_{n}"] or 0) + 2) for n in names}}
        change = max([abs(new["prior"] - model["prior"])] + [abs(new[k][n] - model[k][n]) for k in ("good", "bad") for n in names])
        model = new
        if change < tolerance:
            break
    return model


def weak_quality(docs: DataFrame, rules: dict = RULES, threshold: float = 0.5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Statistics, votes, posterior and ``passes`` for every document."""
    voted = written(votes(text_stats(docs, id_col, text_col), rules), "votes")
    names = list(rules)
    post = posterior(fit(voted, names), names)
    return voted.withColumn("posterior", post).withColumn("passes", F.col("posterior") >= threshold)


def op9_weak_quality(spark, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table
    out = weak_quality(read_table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & F.col("passes")).alias("kept"),
                      F.round("posterior", 6).alias("posterior"))
