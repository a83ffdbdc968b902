"""Prefix lookups against trying every entry; equal hashes; tokens; eviction by size and version over a stream."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T
from rollplane.operators import prefix_cache as PC

BY = dict(text_id="tid", text_col="t", entry_id="eid", entry_col="e")


def brute(texts, entries):
    out = []
    for tid, t in texts:
        hits = [(-len(e), eid) for eid, e in entries if e is not None and t is not None and t.startswith(e)]
        best = min(hits, default=(0, None))
        out.append((tid, best[1], -best[0]))
    return sorted(out)


def some(seed):
    rnd = random.Random(seed)
    shared = "You are a helpful assistant. été 😀 " * 6
    def chain(n):
        return rnd.choice(["", shared, shared[:63], shared[:64]]) + "".join(rnd.choice("abé😀\n") for _ in range(n))
    texts = [chain(rnd.randint(0, 300)) for _ in range(80)] + ["", "a" * 64, "a" * 128, "a" * 65, None]
    entries = [t[:rnd.randint(0, len(t))] for t in texts if t for _ in range(4)] + ["a" * n for n in (1, 63, 64, 65, 128)] + ["", None, "zz"]
    return list(enumerate(texts)), [(10_000 - i, e) for i, e in enumerate(entries)]


@pytest.mark.parametrize("hashes", ["right", "all equal"])
def test_longest_prefix(spark, monkeypatch, hashes):
    if hashes == "all equal":  # the whole text decides
        monkeypatch.setattr(PC, "prefix_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    texts, entries = some(3)
    t, e = spark.createDataFrame(texts, "tid long, t string").repartition(3), spark.createDataFrame(entries, "eid long, e string").repartition(3)
    got = sorted((r.tid, r.match_id, r.match_len) for r in PC.longest_prefix_join(t, e, **BY).collect())
    want = brute(texts, entries)
    if hashes == "right":
        assert got == want
    else:  # equal tails under equal hashes stand for one entry, so only lengths of true matches are sure
        assert all(m is None or dict(texts)[i].startswith(dict(entries)[m]) for i, m, _ in got)


def test_string_ids_payload_and_no_rows(spark):
    t = spark.createDataFrame([("x", "hello world"), ("y", "bye")], "tid string, t string")
    e = spark.createDataFrame([("b", "hello", [1, 2]), ("a", "hello", [3])], "eid string, e string, tokens array<int>")
    rows = {r.tid: r for r in PC.longest_prefix_join(t, e, payload=["tokens"], **BY).collect()}
    assert (rows["x"].match_id, rows["x"].match_len, rows["x"].tokens) == ("a", 5, [3]) and rows["y"].match_id is None
    assert {r.match_len for r in PC.longest_prefix_join(t, e.limit(0), **BY).collect()} == {0}
    assert PC.longest_prefix_join(t.limit(0), e, **BY).count() == 0


def test_cached_tokens(spark):
    t = spark.createDataFrame([(1, "a b c d"), (2, "q r"), (3, "a b"), (4, None), (5, "bad one")], "tid long, t string")
    e = spark.createDataFrame([(7, "a b", [11, 12], [-1.0, -2.0], [0, 1]), (8, "bad", [9], [-1.0, -1.0], None), (9, "q", [5], None, None)],
                              "eid long, e string, tokens array<int>, log_probs array<double>, loss_mask array<int>")
    tok = lambda c: F.transform(F.filter(F.split(c, " "), lambda w: w != ""), lambda w: F.ascii(w))
    got = {r.tid: (r.match_id, r.tokens, r.log_probs, r.loss_mask) for r in PC.cached_tokens(t, e, tok, **BY).collect()}
    assert got[1] == (7, [11, 12, 99, 100], [-1.0, -2.0, 0.0, 0.0], [0, 1, 0, 0])
    assert got[2] == (9, [5, 114], [0.0, 0.0], [0, 0]) and got[3] == (7, [11, 12], [-1.0, -2.0], [0, 1])
    assert got[4] == (None, [], [], []) and got[5] == (None, [98, 111], [0.0, 0.0], [0, 0])


SCHEMA = T.StructType([T.StructField("entry_id", T.LongType()), T.StructField("entry", T.StringType()),
                       T.StructField("n_tokens", T.LongType()), T.StructField("weight_version", T.LongType())])


def simulate(batches, max_size, keep):
    live = {}
    for rows in batches:
        for i, e, n, v in sorted(rows):
            if e and n > 0 and all(e != x[0] for x in live.values()):
                live[i] = (e, n, v)
        if sum(x[1] for x in live.values()) > max_size:
            now = max(r[3] for r in rows)
            old = [e for e, _, v in live.values() if v <= now - keep]
            live = {i: x for i, x in live.items() if not any(x[0].startswith(o) for o in old)}
    return sorted((i, *x) for i, x in live.items())


def test_streaming_cache(spark, tmp_path):
    import os
    rnd = random.Random(2)
    batches, i = [], 0
    for v in range(6):
        rows = []
        for _ in range(25):
            base = rnd.choice([r[1] for b in batches for r in b] or ["x"])
            i += 1
            rows.append((i % 90, base + rnd.choice(["", "y", "zz" * 40]), rnd.randint(0, 9), v))
        seen, out = set(), []
        for r in rows:  # ids are unique within a batch
            if r[0] not in seen:
                seen.add(r[0])
                out.append(r)
        batches.append(out)
    live_ids: set = set()
    for k, rows in enumerate(batches):
        # an id comes again only once its entry is gone
        live_ids = {r[0] for r in simulate(batches[:k], 150, 2)}
        batches[k] = [r for r in rows if r[0] not in live_ids]
    src = tmp_path / "in"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(src / f"part{k}"))
    cache = PC.StreamingCache(spark, SCHEMA, max_size=150, keep_versions=2)
    for k in range(len(batches)):
        cache.add(spark.read.parquet(str(src / f"part{k}")), k)
        assert sorted(map(tuple, cache.entries().collect())) == simulate(batches[:k + 1], 150, 2)
    before = sorted(map(tuple, cache.entries().collect()))
    cache.add(spark.read.parquet(str(src / "part5")), 5)  # a replayed batch
    assert sorted(map(tuple, cache.entries().collect())) == before and os.path.isdir(src)
    other = PC.StreamingCache(spark, SCHEMA, max_size=10**9, keep_versions=2)
    stream = spark.readStream.schema(SCHEMA).parquet(str(src / "part0"))
    assert sorted(map(tuple, other.run(stream).collect())) == simulate(batches[:1], 10**9, 2)
