"""Collocations: SQL twin (whole query), brute force, tries, screens that let too much through, shards, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import documents, nothing, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F
from rollplane.llm import collocations as C


def brute(rows, max_words=3, min_count=10, share=50, per_lang=2000):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[(lang, *w[i:i + k])] += 1
    held = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    drop = set()
    for p, a in held.items():
        for m in range(2, len(p) - 1):
            for i in range(1, len(p) - m + 1):
                part = (p[0], *p[i:i + m])
                if 100 * a >= share * f[part]:
                    drop.add(part)
    out = {}
    for p, a in held.items():
        if p in drop:
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k, f[p[:k + 1]], f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1)]
        score, _, left, right = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, i, ph.decode(), -a, left, right, n[lang], -s) for lang, ps in out.items()
                  for i, (s, a, ph, left, right) in enumerate(sorted(ps)[:per_lang], 1))


def got(df):
    return sorted(map(tuple, df.collect()))


def some_rows(rnd, n=120):
    words = [f"w{i}" for i in range(12)] + ["É", "ß", "aB", "a_b", "\x1cq", "x\xa0y"]
    seps = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "!?", "\x0b", "\r\n"]
    return [(rnd.choice(["en", "de", None, "und"]), "".join(rnd.choice(words) + rnd.choice(seps) for _ in range(rnd.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("kw", [{}, {"max_words": 2}, {"max_words": 5, "min_count": 4, "share": 30}, {"per_lang": 7}, {"min_count": 1, "max_words": 4}])
def test_against_brute_force(spark, kw):
    rows = some_rows(random.Random(str(kw)))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert got(C.collocations(df, block_bytes=2000, **kw)) == brute(rows, **kw)


def test_shards_and_blocks_do_not_matter(spark):
    rows = some_rows(random.Random(5))
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    want = brute(rows, min_count=3)
    assert got(C.collocations(df, min_count=3, shard_phrases=40)) == want
    assert got(C.collocations(df, min_count=3, shard_bytes=500, block_bytes=1)) == want


def test_screens_that_let_everything_through(spark, monkeypatch):
    monkeypatch.setattr(C.Bitmap, "test", lambda self, keys: np.ones(len(keys), bool))
    rows = some_rows(random.Random(6), 40)
    assert got(C.collocations(spark.createDataFrame(rows, "lang string, text string"), min_count=3)) == brute(rows, min_count=3)


def test_phrases_of_one_hash_are_kept_apart(spark, monkeypatch):
    # every phrase of a block gets the same key
    def keys(self, lang, words, at, k):
        live = np.flatnonzero(at[:len(at) - k + 1] > 0)
        for j in range(1, k):
            live = live[at[live + j] > 0]
        return live, np.zeros(len(live), np.uint64)
    monkeypatch.setattr(C.Screen, "keys", keys)
    rows = some_rows(random.Random(8), 40)
    assert got(C.collocations(spark.createDataFrame(rows, "lang string, text string"), min_count=3)) == brute(rows, min_count=3)


def test_double_array_holds_its_phrases_only():
    rnd = random.Random(9)
    for n in (1, 5, 400, 3000):
        held = sorted({(rnd.choice("ab"), " ".join(f"v{int(rnd.paretovariate(0.6)) % 200}" for _ in range(rnd.randint(2, 4)))) for _ in range(n)})
        trie = C.Trie(pa.array([x[0] for x in held]), pa.array([x[1] for x in held]))
        langs = [x for x, n in zip(trie.langs.to_pylist(), trie.n_words.tolist()) for _ in range(n)]
        code = {x: i for i, x in enumerate(zip(langs, trie.words.to_pylist()), 1)}
        base, check, states = trie.base, trie.check, trie.state
        assert len(set(states.tolist())) == len(held)

        def walk(lang, phrase):
            s = 0
            for w in phrase.split(" "):
                c = code.get((lang, w), 0)
                t = base[s] + c
                if not c or check[t] != s:
                    return None
                s = t
            return s

        assert [walk(*p) for p in held] == states.tolist()
        beginnings = {(lang, *ph.split(" ")[:k]) for lang, ph in held for k in range(1, 5)}
        for _ in range(2000):
            lang, ph = rnd.choice("ab"), [f"v{int(rnd.paretovariate(0.6)) % 200}" for _ in range(rnd.randint(1, 4))]
            assert (walk(lang, " ".join(ph)) is not None) == ((lang, *ph) in beginnings)


def test_exact_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a b", 3_000_000_000_000), ("en", "c d", 10**15)], "lang string, phrase string, a long")
    words = spark.createDataFrame([("en", "a", 3_000_000_000_001), ("en", "b", 4_000_000_000_000), ("en", "c", 10**16), ("en", "d", 10**18)],
                                  "lang string, phrase string, a long")
    r = {x.phrase: x.score for x in C.scored(phrases, words, 3).collect()}
    assert r["a b"] == 10**6 * 9 * 10**24 // (3_000_000_000_001 * 4_000_000_000_000)
    assert r["c d"] == 10**6 * 10**30 // 10**34


def test_whole_table(spark, documents):
    assert got(C.collocations(documents)) == brute([(r.lang, r.text) for r in documents.collect()])


def test_odd_rows(odd, odd_rows, nothing):
    assert got(C.collocations(odd)) == brute([(r[2], r[1]) for r in odd_rows])
    assert C.collocations(nothing).count() == 0
    blank = odd.withColumn("text", F.lit(" \n"))
    assert C.collocations(blank).count() == 0


def test_no_more_passes_with_more_shards(spark, monkeypatch):
    # the blocks were gone through once for every two tries
    written, n = C.Scratch.written, []
    monkeypatch.setattr(C.Scratch, "written", lambda self, df: n.append(1) or written(self, df))
    rows = some_rows(random.Random(11), 60)
    df, want, tables = spark.createDataFrame(rows, "lang string, text string").coalesce(2), brute(rows, min_count=2), []
    for shard_phrases in (250_000, 3):
        n.clear()
        assert got(C.collocations(df, min_count=2, shard_phrases=shard_phrases)) == want
        tables.append(len(n))
    assert tables[0] == tables[1]


def test_what_tasks_hold_does_not_matter(spark, monkeypatch):
    monkeypatch.setattr(C, "HELD", 50)
    monkeypatch.setattr(C, "RANK_PARTS", 3)
    rows = some_rows(random.Random(12))
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    assert got(C.collocations(df, block_bytes=300, min_count=3, max_words=4, per_lang=30)) == brute(rows, 4, 3, per_lang=30)


@pytest.mark.parametrize("top", [3, 1 << 30])
def test_distinct_rows(top):
    rnd = np.random.default_rng(13)
    cols, n = [rnd.choice([0, 1, top], 500) for _ in range(4)], rnd.integers(1, 9, 500)
    want = Counter()
    for *row, a in zip(*(c.tolist() for c in cols), n.tolist()):
        want[tuple(row)] += a
    some, a = C._distinct(cols, n)
    assert list(zip(zip(*(c.tolist() for c in some)), a.tolist())) == sorted(want.items())


def test_counts_of_beginnings():
    # two languages, words in other orders, windows that come twice and begin others
    words = [pa.array(["a", "b", "c"]), pa.array(["c", "a"]), pa.array(["a", "b"])]
    tables = [np.array([[1, 2, 3], [1, 2, 0], [2, 3, 0]], np.int32), np.array([[2, 1, 2]], np.int32), np.array([[1, 2, 0], [2, 1, 1]], np.int32)]
    langs, n = ["en", "en", "de"], [4, 3, 10**13, 2, 7, 1]
    trie, table = C.Trie.of_windows(langs, words, tables)
    want = Counter()
    for (lang, row), a in zip([(x, r) for x, w, t in zip(langs, words, tables) for r in [[w[i - 1].as_py() for i in r if i] for r in t.tolist()]], n):
        for k in range(1, len(row) + 1):
            want[(lang, *row[:k])] += a
    lang_of = np.repeat(trie.langs.to_pylist(), trie.n_words)
    found = {}
    for k, (row, total) in enumerate(trie.counts(table, np.array(n)), 1):
        for r, a in zip(row.tolist(), total.tolist()):
            code = table[r, :k] - 1
            found[(str(lang_of[code[0]]), *(trie.words[int(c)].as_py() for c in code))] = a
    assert found == want
