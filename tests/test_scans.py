"""Suffix sums and advantages against plain loops, in one row and cut into segments."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rollplane.operators import scans as S


def plain(x, w):
    out, run = [0.0] * len(x), 0.0
    for i in range(len(x) - 1, -1, -1):
        run = x[i] + w * run
        out[i] = run
    return out


def plain_gae(r, v, gamma, lambd):
    d = [r[i] + gamma * (v[i + 1] if i + 1 < len(v) else 0.0) - v[i] for i in range(len(r))]
    a = plain(d, gamma * lambd)
    return a, [x + y for x, y in zip(a, v)]


@pytest.mark.parametrize("w", [0.0, 0.5, 0.99, 1.0])
def test_discounted_sums(spark, w):
    rnd = random.Random(1)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 255, 256, 257, 4096, 4097, 20_000])] + [(99, None)]
    got = {r.i: r.y for r in spark.createDataFrame(rows, "i long, x array<double>").withColumn("y", S.discounted_sums("x", w)).collect()}
    assert got[99] is None
    for i, x in rows[:-1]:
        assert np.allclose(got[i], plain(x, w), atol=1e-9)


def test_gae(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(n)], [rnd.uniform(-1, 1) for _ in range(n)]) for i, n in enumerate([0, 1, 7, 300, 5000])]
    df = spark.createDataFrame(rows + [(50, None, [1.0]), (51, [1.0], None)], "i long, r array<double>, v array<double>").coalesce(1)
    got = {x.i: x.g for x in df.withColumn("g", S.gae("r", "v", 0.99, 0.95)).collect()}
    for i, r, v in rows:
        a, b = plain_gae(r, v, 0.99, 0.95)
        assert np.allclose(got[i].advantages, a, atol=1e-9) and np.allclose(got[i].returns, b, atol=1e-9)
    assert got[50].advantages is None and got[51].returns is None


def test_a_trajectory_over_many_rows(spark):
    rnd = random.Random(3)
    whole = {k: ([rnd.uniform(-1, 1) for _ in range(n)], [rnd.uniform(-1, 1) for _ in range(n)]) for k, n in (("a", 60_000), ("b", 5), (None, 900))}
    rows = []
    for k, (r, v) in whole.items():
        at, seg = 0, 0
        while at < len(r):
            n = rnd.choice([0, 1, 700, 5000])
            rows.append((k, seg, r[at:at + n], v[at:at + n], "extra"))
            at, seg = at + n, seg + rnd.randint(1, 3)
    rows.append(("b", 10_000, [], [], "extra"))
    df = spark.createDataFrame(rows, "key string, seg long, r array<double>, v array<double>, s string").repartition(6)
    got = S.segmented_sums(df, keys=["key"], segment="seg", x="r", out="y", w=0.98)
    assert got.columns == [*df.columns, "y"]
    for k, (r, _) in whole.items():
        y = [t for row in sorted((x for x in got.collect() if x.key == k), key=lambda x: x.seg) for t in row.y]
        assert np.allclose(y, plain(r, 0.98), atol=1e-8)
    named = df.na.fill({"key": "none"})
    adv = S.segmented_gae(named, keys=["key"], segment="seg", rewards="r", values="v", gamma=0.99, lambd=0.95).collect()
    for k, (r, v) in whole.items():
        mine = sorted((x for x in adv if x.key == (k or "none")), key=lambda x: x.seg)
        a, b = plain_gae(r, v, 0.99, 0.95)
        assert np.allclose([t for x in mine for t in x.advantages], a, atol=1e-8)
        assert np.allclose([t for x in mine for t in x.returns], b, atol=1e-8)


def test_only_the_array_goes_to_python(spark):
    df = spark.range(3).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("x"), F.lit("wide").alias("s"))
    text = df.withColumn("y", S.discounted_sums("x", 0.5)).select("y")._jdf.queryExecution().optimizedPlan().toString()
    assert "wide" not in text


def test_token_arrays_follow_their_rules(spark):
    from rollplane.sources import fixtures as FX
    rows = [(5, 1, 7), (5, 2, 0), (5, 3, -2), (-7, 4, 3), (None, 0, 3), (2, None, 2), (3, 3, None), (10**15, 6, 40)]
    df = spark.createDataFrame(rows, "group_index long, idx_in_group long, response_length long")
    got = df.select("*", *[FX._token_array(c).alias(c) for c in FX._TOKEN_ARRAYS]).collect()
    rem = lambda x, m: abs(x) % m * (1 if x >= 0 else -1)
    for r in got:
        g, i, n = r.group_index, r.idx_in_group, r.response_length
        if n is None:
            assert r.log_probs is None and r.loss_mask is None
            continue
        at = range(n) if n > 0 else range(0, n - 2, -1)
        if g is None or i is None:
            assert r.tokens == [None] * len(at) and r.loss_mask == [1] + [0] * (len(at) - 1)
            continue
        assert r.loss_mask == [int(t == 0 or rem(g + i + t, 5) != 0) for t in at]
        assert r.rollout_log_probs == [-rem(g * 31 + i * 17 + t * 7 + 3, 97) / 50 for t in at]
        assert r["values"] == [(rem(g * 7 + i * 3 + t, 21) - 10) / 10 for t in at]
        assert r.tokens == [rem(g * 7 + i * 3 + t * 11, 1000) + 1 for t in at]


def test_shared_weights_equal_those_of_each_field(spark):
    from rollplane.functions import arrays as A
    from rollplane.operators import tokens as TK
    df = spark.createDataFrame([([0.1, -3.0, 2.0], [0.0, 0.0, 0.5], [1, 1, 0]), ([], [], []), (None, None, None)],
                               "a array<double>, b array<double>, loss_mask array<int>")
    for kind in (dict(level="token", mode="truncate"), dict(level="geometric", mode="mask"), dict(level="sequence", mode="clip")):
        want = df.select(A.mis_weights("a", "b", "loss_mask", **kind).alias("w")).collect()
        out = TK.with_mis_weights(df, "w", "a", "b", **kind)
        assert out.select("w").collect() == want
        plan = out.select("w.weights", "w.frac_low", "w.frac_high")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("EXP(") == 1
