"""Lazy ranks and selections against sorting."""

import random

import pytest
from pyspark.sql import functions as F
from rollplane.plans import ranking as R


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "b", "hot", "hot", "hot"]), rnd.choice([None, 1.5, -2.0, 7.25]), i, rnd.randint(-5, 5)) for i in range(3000)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "s string, x double, id long, v long").repartition(5), rows


def order(r):
    return (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0.0, r[2])


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_global_index_and_running_sum(table):
    df, rows = table
    want = sorted(rows, key=order)
    idx = R.global_index(df, ["s", "x", "id"])
    assert [r.id for r in sorted(idx.collect(), key=lambda r: r.row_idx)] == [r[2] for r in want]
    assert idx.columns == ["s", "x", "id", "v", "row_idx"] and "ExistingRDD" not in plan(idx).replace("LogicalRDD", "")
    total, sums = 0, {}
    for r in want:
        total += r[3]
        sums[r[2]] = total
    assert {r.id: r["cumsum"] for r in R.global_cumsum(df, ["s", "x", "id"], "v").collect()} == sums
    assert R.global_index(df.limit(0), ["id"]).count() == 0


def test_index_within_group(table):
    df, rows = table
    at, want = {}, {}
    for r in sorted(rows, key=order):
        want[r[2]] = at.get(r[0], 0)
        at[r[0]] = want[r[2]] + 1
    assert {r.id: r.idx_in_group for r in R.index_within_group(df, ["s"], ["x", "id"]).collect()} == want


@pytest.mark.parametrize("top_n", [100_000, 40])
@pytest.mark.parametrize("lo, hi", [(0, 0), (0, 3000), (10, 2500), (2990, 4000), (3000, 3001), (-3, 2)])
def test_rows_between(table, monkeypatch, top_n, lo, hi):
    monkeypatch.setattr(R, "TOP_N", top_n)
    df, rows = table
    want = [r[2] for r in sorted(rows, key=order)]
    got = R.rows_between(df, ["s", "x", "id"], lo, hi, "n").collect()
    assert sorted((r.n, r.id) for r in got) == list(enumerate(want))[max(lo, 0):hi]
    assert sorted(r.id for r in R.rows_between(df, ["s", "x", "id"], lo, hi).collect()) == sorted(want[max(lo, 0):hi])


@pytest.mark.parametrize("top_n", [100_000, 40])
@pytest.mark.parametrize("lo, hi", [(0, 1300), (100, 1300), (600, 601), (550, 2900)])
def test_rows_that_share_a_key(table, monkeypatch, top_n, lo, hi):
    monkeypatch.setattr(R, "TOP_N", top_n)
    df, rows = table
    want = sorted((r[0] is not None, r[0] or "") for r in rows)[lo:hi]
    got = R.rows_between(df, ["s"], lo, hi).collect()
    assert sorted((r.s is not None, r.s or "") for r in got) == want and len({r.id for r in got}) == len(want)


@pytest.mark.parametrize("m", [0, 1, 700, 2999, 3000, 4000])
def test_without_last(table, m):
    df, rows = table
    for cols, key in ((["s", "x", "id"], order), (["s"], lambda r: order(r)[:2])):
        got = [r[:4] for r in R.without_last(df, cols, m).collect()]
        assert sorted(map(key, got)) == sorted(map(key, rows))[:max(len(rows) - m, 0)] and len(set(got)) == len(got)


def test_few_rows_need_no_sort_of_the_table(table):
    df, _ = table
    text = R.first_rows(df, ["id"], 7)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text
    assert R.first_rows(df, [F.col("v") * -1, "id"], 1).collect()[0].v == 5
