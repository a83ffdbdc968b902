"""Queries: prefix cache lookups over rendered conversations.

Cache entries are the ChatML renders of every conversation prefix ending at
an odd turn (turn t = messages 0..t), weight version = conversation id mod 7; lookups are the full renders plus the
generation prompt.  The SQL twin checks every entry against every text
(fine at test scale); the Spark job uses the block-key join."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..operators import prefix_cache as PC, prompts as P
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W_
from .registry import r6, register

_MSG = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
_CACHE_SQL = f"""
, r AS (SELECT conv_id, turn, string_agg({_MSG}, '') OVER (PARTITION BY conv_id ORDER BY turn
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix FROM chat),
cache AS (SELECT conv_id * 1000 + turn AS entry_id, conv_id % 7 AS weight_version, prefix AS entry FROM r WHERE turn % 2 = 1),
texts AS (SELECT conv_id, string_agg({_MSG}, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS txt
          FROM chat GROUP BY conv_id),
m AS (SELECT t.conv_id, max(length(c.entry)) AS match_len FROM texts t LEFT JOIN cache c ON starts_with(t.txt, c.entry)
      GROUP BY t.conv_id)
"""


def _cache_and_texts(spark, sf):
    c = FX.chat(spark, sf)
    msg = P.chatml_message(F.col("role"), F.col("text"))
    # prefix renders: running concatenation inside one conversation (bounded by its turns)
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, W.currentRow)
    pref = c.select("conv_id", "turn", F.array_join(F.collect_list(msg).over(w), "").alias("entry"))
    cache = pref.filter(F.col("turn") % 2 == 1).select((F.col("conv_id") * 1000 + F.col("turn")).alias("entry_id"),
                                                        (F.col("conv_id") % 7).alias("weight_version"), "entry")
    texts = P.render_chat(c).select("conv_id", F.col("rendered").alias("txt"))
    return cache, texts


@register("longest_prefix_join", W_(_CACHE_SQL + """
SELECT m.conv_id, c.entry_id AS match_id, CAST(coalesce(m.match_len, 0) AS INTEGER) AS match_len
FROM m LEFT JOIN cache c ON c.entry_id // 1000 = m.conv_id AND length(c.entry) = m.match_len""", "chat"))
def q_longest_prefix_join(spark, sf):
    cache, texts = _cache_and_texts(spark, sf)
    return PC.longest_prefix_join(texts, cache, text_id="conv_id", text_col="txt", entry_id="entry_id",
                                  entry_col="entry")


@register("prefix_cache_stats", W_(_CACHE_SQL + """
SELECT (SELECT count(*) FROM cache) AS entries, count(*) FILTER (WHERE match_len IS NOT NULL) AS hits,
       count(*) FILTER (WHERE match_len IS NULL) AS misses,
       round(count(*) FILTER (WHERE match_len IS NOT NULL) / count(*), 6) AS hit_rate FROM m""", "chat"))
def q_prefix_cache_stats(spark, sf):
    cache, texts = _cache_and_texts(spark, sf)
    m = PC.longest_prefix_join(texts, cache, text_id="conv_id", text_col="txt", entry_id="entry_id", entry_col="entry")
    s = PC.prefix_cache_stats(m, cache)
    return s.select("entries", "hits", "misses", r6("hit_rate").alias("hit_rate"))


# Tokens of a cached prefix. An entry's tokens are its white-space words, with made log-probs and mask by position.
_TOKENS = "list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def _words(c):
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def _with_tokens(cache):
    at = lambda f: F.transform("tokens", f)
    return (cache.withColumn("tokens", _words(F.col("entry")))
                 .withColumn("log_probs", at(lambda _, i: (i % 7) * F.lit(-0.125)))
                 .withColumn("loss_mask", at(lambda _, i: F.when(i % 3 == 1, 1).otherwise(0))))


@register("cached_tokens", W_(_CACHE_SQL + f"""
, hit AS (SELECT t.conv_id, t.txt, coalesce(c.entry, '') AS entry FROM texts t JOIN m ON m.conv_id = t.conv_id
          LEFT JOIN cache c ON c.entry_id // 1000 = m.conv_id AND length(c.entry) = m.match_len),
k AS (SELECT conv_id, len({_TOKENS.format(x='entry')}) AS n_cached,
             list_concat({_TOKENS.format(x='entry')}, {_TOKENS.format(x='substring(txt, length(entry) + 1)')}) AS tok FROM hit)
SELECT conv_id, CAST(len(tok) AS INTEGER) AS n_tokens, md5(array_to_string(tok, ' ')) AS tokens_md5,
       CAST(coalesce(list_sum(list_transform(range(n_cached), lambda i: (i % 7) * -0.125)), 0) AS DOUBLE) AS log_prob_sum,
       CAST(len(list_filter(range(n_cached), lambda i: i % 3 = 1)) AS INTEGER) AS mask_sum, CAST(len(tok) AS INTEGER) AS n_mask
FROM k""", "chat"))
def q_cached_tokens(spark, sf):
    cache, texts = _cache_and_texts(spark, sf)
    t = PC.cached_tokens(texts, _with_tokens(cache), _words, text_id="conv_id", text_col="txt", entry_id="entry_id", entry_col="entry")
    total = lambda c, zero: F.aggregate(c, zero, lambda a, x: a + x)
    return t.select("conv_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
                    total("log_probs", F.lit(0.0)).alias("log_prob_sum"), total("loss_mask", F.lit(0)).alias("mask_sum"),
                    F.size("loss_mask").alias("n_mask"))


@register("version_gc", W_(_CACHE_SQL + """
SELECT c.entry_id FROM cache c
WHERE NOT EXISTS (SELECT 1 FROM cache o WHERE o.weight_version <= 3 AND starts_with(c.entry, o.entry))""", "chat"))
def q_version_gc(spark, sf):
    cache, _ = _cache_and_texts(spark, sf)
    return PC.version_gc(cache, current_version=6, keep_versions=3).select("entry_id")


def _gc_by_size_sql(limit: int) -> str:
    return f"""
SELECT 'over {limit}' AS trigger, c.entry_id FROM sized c
WHERE (SELECT sum(n_tokens) FROM sized) <= {limit}
   OR NOT EXISTS (SELECT 1 FROM cache o WHERE o.weight_version <= 3 AND starts_with(c.entry, o.entry))"""


# one limit that the tokens of any test table exceed, and one that none reaches
_LIMITS = (1000, 10**12)


@register("version_gc_by_size", W_(_CACHE_SQL + f"""
, sized AS (SELECT *, len({_TOKENS.format(x='entry')}) AS n_tokens FROM cache)
{' UNION ALL '.join(map(_gc_by_size_sql, _LIMITS))}""", "chat"))
def q_version_gc_by_size(spark, sf):
    cache, _ = _cache_and_texts(spark, sf)
    sized = cache.withColumn("n_tokens", F.size(_words(F.col("entry"))))
    parts = [PC.version_gc(sized, current_version=6, keep_versions=3, max_size=n, size_col="n_tokens")
               .select(F.lit(f"over {n}").alias("trigger"), "entry_id") for n in _LIMITS]
    return parts[0].unionByName(parts[1])
