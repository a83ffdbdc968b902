"""The pipeline's stages one after another on nulls, empty and long texts, ties, repeated rows, clashing names, no rows."""

import corpus_pipeline
from llm_fixtures import SF, nothing, odd, odd_rows  # noqa: F401
from test_brute_force import tiktoken_rows


def staged(spark, docs):
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SF).checkpoint())
    return seen


def test_odd_rows_through_all_stages(spark, odd, odd_rows):
    docs, good, exact, near, mixed, ids = staged(spark, odd)
    assert docs.columns == good.columns == exact.columns == near.columns == mixed.columns
    given = {(i, t) for i, t, *_ in odd_rows}
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    assert set(rows(good)) <= given
    # one row of each text, of the largest id that had it
    want = {}
    for i, t in rows(good):
        best = want.get(t or "")
        want[t or ""] = i if best is None else max(best, i if i is not None else best)
    assert sorted(map(repr, ((i, t or "") for i, t in rows(exact)))) == sorted(map(repr, ((i, t) for t, i in want.items())))
    kept = rows(near)
    assert set(kept) <= set(rows(exact)) and len(kept) == len(set(kept))
    taken = rows(mixed)
    assert set(taken) <= set(kept) and max(map(taken.count, taken)) <= 2
    got = sorted(map(repr, (tuple(r) for r in ids.drop("ids").collect())))
    assert got == sorted(map(repr, tiktoken_rows(taken)))


def test_no_rows_through_all_stages(spark, nothing):
    assert [df.count() for df in staged(spark, nothing)] == [0] * 6
