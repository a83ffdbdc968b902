"""Runs against trying every period, the screen, the query's rule, odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from llm_fixtures import SF, WORD, documents, nothing, odd, odd_rows  # noqa: F401
from rollplane.llm import periodic_runs as P
from rollplane.llm.queries import QUERIES


def brute_runs(words, min_length=24, min_exponent=3):
    """All maximal stretches of each period, then those whose period is the smallest of the stretch."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            s, length = i - q, j - i + q
            smaller = any(all(words[k] == words[k - p] for k in range(s + p, j)) for p in range(1, q))
            if length >= max(min_length, min_exponent * q) and not smaller:
                out.append((s, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rnd):
    out = []
    while len(out) < rnd.choice([5, 60, 200]):
        piece = [rnd.choice("abcd") for _ in range(rnd.randint(1, rnd.choice([2, 4, 12])))]
        out += piece * rnd.choice([1, 1, 2, 3, 4, 9, 30])
        if rnd.random() < 0.4:
            out += out[-rnd.randint(1, 40):]
        if rnd.random() < 0.3:
            out += [f"x{rnd.randint(0, 999)}" for _ in range(rnd.randint(1, 8))]
    return out


@pytest.mark.parametrize("least, power", [(24, 3), (2, 2), (9, 4), (12, 2)])
def test_automaton_finds_every_run(least, power):
    rnd = random.Random(least)
    for _ in range(150):
        words = some_words(rnd)
        number = {}
        assert P.runs_of([number.setdefault(w, len(number)) for w in words], least, power) == brute_runs(words, least, power)


@pytest.mark.parametrize("least, power", [(24, 3), (2, 2), (9, 4)])
def test_operator_equals_brute_force(spark, least, power):
    rnd = random.Random(7)
    texts = [some_words(rnd) for _ in range(120)] + [["a"] * 500, [f"w{i}" for i in range(300)], ["a", "b", "c"] * 8, ["a"] * 23]
    seps = [" ", "\n", "  ", "\t \r\n"]
    df = spark.createDataFrame([(i, rnd.choice(seps).join(w)) for i, w in enumerate(texts)], "doc_id long, text string").coalesce(2)
    for r in P.periodic_runs(df, min_length=least, min_exponent=power).collect():
        want = brute_runs(texts[r.doc_id], least, power)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(texts[r.doc_id])
        assert r.collapsed == brute_collapsed(texts[r.doc_id], want)


def test_screen_passes_few_words_of_plain_text():
    rnd = random.Random(3)
    h = np.array([rnd.getrandbits(63) for _ in range(500)], np.uint64)
    plain = np.concatenate([h, h])  # a passage that comes twice is no run
    lo, hi = P.suspects(plain, np.array([0, 1000]), 24, 3)
    assert len(lo) == 0
    lo, hi = P.suspects(np.concatenate([h, np.tile(h[:10], 5), h]), np.array([0, 1050]), 24, 3)
    assert len(lo) == 1 and lo[0] < 500 and hi[0] > 550 and hi[0] - lo[0] < 200


def test_query_equals_brute_force(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    rows = documents.collect()
    assert set(got) == {r.doc_id for r in rows}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    looped = 0
    for r in rows:
        words = WORD.findall(r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            looped += 1
        if n > 3000:  # the brute force is quadratic; the words of these stay compared
            assert got[r.doc_id].n_runs >= 0
            continue
        runs = brute_runs(words)
        top = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        want = (r.doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(brute_collapsed(words, runs)))
        assert tuple(got[r.doc_id]) == want
    assert looped > 5


def test_odd_rows(odd, odd_rows, nothing):
    rows = P.periodic_runs(odd).collect()
    want = sorted((repr(i), len(WORD.findall(t or ""))) for i, t, *_ in odd_rows)
    assert sorted((repr(r.doc_id), r.n_words) for r in rows) == want
    long = next(r for r in rows if r.doc_id == 9)
    assert [tuple(x) for x in long.runs] == [(0, 60_000, 977)] and len(long.collapsed.split()) == 977
    plain = next(t for i, t, *_ in odd_rows if i == 10)
    assert next(r for r in rows if r.doc_id == 10).collapsed == " ".join(WORD.findall(plain))
    assert P.periodic_runs(nothing).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(odd, min_exponent=1)


def test_ties_of_the_strongest_run(spark):
    df = spark.sql("select array(named_struct('start', 9L, 'length', 30L, 'period', 10L), named_struct('start', 3L, 'length', 60L, "
                   "'period', 20L), named_struct('start', 3L, 'length', 33L, 'period', 11L)) runs union all "
                   "select array() union all select null")
    assert [r[0] and tuple(r[0]) for r in df.select(P.strongest(df.runs)).collect()] == [(3, 33, 11), None, None]
