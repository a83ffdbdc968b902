"""Nulls, empty and very long texts, ties, repeated rows, clashing column names, empty tables."""

import math
from collections import Counter

import public_tokenizers as P
import pytest
from llm_fixtures import WORD, nothing, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F
from rollplane.llm import bpe, chat, common, exact_dedup, katz, license_scan, mixing, near_dedup, quality_classifier, quality_rules, sharding
from test_brute_force import tiktoken_rows

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
DIMS = lambda: [sharding.string_dim(F.col("source")), sharding.string_dim(F.col("lang")), sharding.long_dim(F.col("doc_id"))]
LABELS = "doc_id long, quality int, toxic int"


def key(rows):
    return sorted(map(repr, rows))


def some_labels(spark):
    return spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(100, 140)] + [(None, 1, 0), (5, None, 0), (999, 0, 0),
                                                                                    (101, 0, 1), (6, 1, 0)], LABELS)


def test_every_operator_on_no_rows(spark, nothing):
    labels = some_labels(spark).limit(0)
    assert sharding.kd_shards(nothing, DIMS(), n_shards=24).count() == 0
    assert sharding.kd_shards(nothing, DIMS(), target_bytes=100).count() == 0
    assert mixing.mix(nothing, mixing.WEIGHTS).count() == 0
    assert mixing.mixed_documents(nothing, mixing.WEIGHTS).count() == 0
    assert quality_classifier.quality_table(nothing, labels).count() == 0
    assert quality_classifier.good_documents(nothing, some_labels(spark)).count() == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(empty)).count() == 0
    assert license_scan.scan_licenses(nothing).count() == 0
    assert katz.katz_scores(nothing, F.lit(True)).count() == 0
    assert exact_dedup.exact_dedup(nothing, exact_dedup.arrived_later()).count() == 0
    assert exact_dedup.distinct_documents(nothing).count() == 0
    assert near_dedup.near_dedup(nothing).count() == 0
    assert near_dedup.distinct_documents(nothing).count() == 0
    assert quality_rules.weak_quality(nothing).count() == 0
    assert bpe.tokenized(nothing, RANKS, P.PATTERN).count() == 0


def test_sharding(odd, odd_rows):
    rows = sharding.kd_shards(odd, DIMS(), n_shards=5).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_sharding_splits_repeated_rows(spark):
    same = spark.range(240).select(F.lit(1).cast("long").alias("doc_id"), F.lit("abc").alias("text"),
                                   F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"))
    load = Counter(r.shard for r in sharding.kd_shards(same, DIMS(), n_shards=24).collect())
    assert set(load.values()) == {10}


def test_mixing(odd, odd_rows):
    rows = mixing.mix(odd, mixing.WEIGHTS).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    assert all(0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-6 for r in rows)
    assert key(rows) == key(mixing.mix(odd, mixing.WEIGHTS).collect())
    out = mixing.mixed_documents(odd, mixing.WEIGHTS)
    assert out.columns == odd.columns
    copies = Counter(r.doc_id for r in out.collect())
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += r.copies_taken
    assert all(copies[i] == taken[i] for i in taken if i not in (None, 5, 7) and i > 100)


def test_mixing_budgets_are_nested(odd):
    small = {(r.doc_id, r.size): r.taken for r in mixing.mix(odd, (1,), budget=0.4).collect()}
    large = {(r.doc_id, r.size): r.taken for r in mixing.mix(odd, (1,), budget=0.7).collect()}
    assert all(large[k] >= small[k] for k in small if k[0] is not None and k[0] >= 100)


def test_weighted_cuts_against_sort(spark):
    import random
    rnd = random.Random(5)
    rows = [(g, rnd.randint(-50, 50) * 10**k, rnd.randint(0, 3), i, rnd.randint(0, 9))
            for k, g in enumerate((1, 2, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "g long, k long, t long, r long, w long")
    for share in (0.0, 0.3, 0.5, 0.99, 1.0):
        total = {g: sum(r[4] for r in rows if r[0] == g) for g in (1, 2, 3)}
        targets = spark.createDataFrame([(g, t * share) for g, t in total.items()], "g long, target double")
        for c in common.weighted_cuts(df, targets, ["k", "t", "r"], "w", buckets=16).collect():
            mine = sum(r[4] for r in rows if r[0] == c.g and r[1:4] < (c.c0, c.c1, c.c2))
            best, upto = math.inf, 0
            for r in [(0, 0, 0, 0, 0)] + sorted(x for x in rows if x[0] == c.g):
                upto += r[4]
                best = min(best, abs(upto - total[c.g] * share))
            assert abs(mine - total[c.g] * share) <= best + 1e-6


def test_classifier(spark, odd, odd_rows):
    labels = some_labels(spark)
    rows = quality_classifier.quality_table(odd, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    assert all(0 <= r.posterior <= 1 for r in rows)
    kept = quality_classifier.good_documents(odd, labels)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)
    assert quality_classifier.good_documents(odd, labels.limit(0)).count() == len(odd_rows)


def test_classifier_shrinks_sparse_sites(spark):
    judged = spark.createDataFrame([("big", "p", 0.0)] * 300 + [("rest", "q", 1.0)] * 700 + [("one", "p", 0.0)], "host string, path string, r double")
    sites, rate = quality_classifier.site_posteriors(judged)
    got = {r.host: r.host_rate for r in sites.collect()}
    assert got["big"] < 0.05 and got["rest"] > 0.95 and abs(got["one"] - rate) < abs(got["big"] - rate)


def test_chat(spark):
    rows = [(None, 0, "user", "x"), (1, None, "a\nb", None), (1, 2, "assistant", "</s>"), (1, 2, "assistant", "</s>"), (1, 2, None, "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    out = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert out[None].n_turns == 1 and out[1].n_turns == 4 and out[1].loss_chars == 8


def test_licences(odd, odd_rows):
    rows = license_scan.scan_licenses(odd).collect()
    assert len(rows) == len(odd_rows)
    assert {r.doc_id for r in rows if r.licensed} == {11}


def test_katz(odd, odd_rows):
    rows = katz.katz_scores(odd, F.col("doc_id") % 5 != 1).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r[0], len(WORD.findall(r[1] or "")) + 1) for r in odd_rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    none = katz.katz_scores(odd, F.lit(False)).collect()
    assert all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in none)


@pytest.mark.parametrize("batch", ["mixed", "none", "all"])
def test_exact_dedup(odd, odd_rows, batch):
    part = {"mixed": exact_dedup.arrived_later(), "none": F.lit(False), "all": F.lit(True)}[batch]
    rows = exact_dedup.exact_dedup(odd, part, keys_per_filter=5).collect()
    best, size = {}, Counter()
    for i, t, *_ in odd_rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
        size[t or ""] += 1
    want = Counter((i, best[t or ""], size[t or ""]) for i, t, *_ in odd_rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(size)
    out = exact_dedup.distinct_documents(odd)
    assert out.columns == odd.columns
    assert Counter((r.doc_id, r.text or "") for r in out.collect()) == Counter((b, t) for t, b in best.items())


def test_near_dedup(odd, odd_rows):
    rows = near_dedup.near_dedup(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.class_id)
    assert by[1] == by[2] == {1} and by[3] == {3} and by[5] == by[6] == {5}
    out = near_dedup.distinct_documents(odd)
    assert out.columns == odd.columns and out.count() == sum(r.kept for r in rows) == len({(r.class_id, r.class_size) for r in rows if r.kept})


def test_quality_rules(odd, odd_rows):
    rows = quality_rules.weak_quality(odd).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in odd_rows)
    long = next(r for r in rows if r.doc_id == 9)
    assert long.n_repeat_words == 60_000
    assert all(0 <= r.posterior <= 1 for r in rows)


def test_bpe(odd, odd_rows):
    rows = bpe.tokenized(odd, RANKS, P.PATTERN, block_words=1000).drop("ids").collect()
    assert key(map(tuple, rows)) == key(tiktoken_rows([(r[0], r[1]) for r in odd_rows]))
