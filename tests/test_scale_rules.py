"""Ties, hot keys and replays: results that must not depend on the layout."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollplane.functions import agents as AG
from rollplane.operators import prefix_cache as PC, prompts as P, retrieve as R, tokens as TK
from rollplane.sources import io
from rollplane.streaming import buffer as SB


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_ties_do_not_depend_on_partitions(spark, monkeypatch, parts):
    monkeypatch.setattr(R, "CORPUS_BLOCK", 7)
    docs = spark.createDataFrame([(i, [1.0, 1e-9 * i]) for i in range(40)], "id long, v array<double>").repartition(parts)
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "q long, v array<double>")
    top = R.dense_topk(q, docs, 3, q_id="q", q_vec="v", d_id="id", d_vec="v")
    got = sorted((r.q, r.rank, r.id) for r in top.collect())
    assert got == [(k, i + 1, i) for k in (0, 1) for i in range(3)]


def test_dense_topk_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, v array<double>")
    one = spark.createDataFrame([(0, [1.0])], "q long, v array<double>")
    assert R.dense_topk(one, empty, 3, q_id="q", q_vec="v", d_id="id", d_vec="v").count() == 0


def test_short_prefixes_make_no_cross_product(spark):
    texts = spark.createDataFrame([(i, f"text {i} of many") for i in range(300)], "t long, x string")
    cache = spark.createDataFrame([(i, f"entry {i}") for i in range(300)] + [(300, "text 7 of"), (301, "text 7"), (302, "")],
                                  "e long, y string")
    got = {r.t: (r.match_id, r.match_len) for r in PC.longest_prefix_join(
        texts, cache, text_id="t", text_col="x", entry_id="e", entry_col="y").collect()}
    assert got[7] == (300, 9) and got[70] == (301, 6) and got[1] == (302, 0)


def test_prefix_of_several_blocks(spark):
    long = "a" * 150 + "b"
    texts = spark.createDataFrame([(1, long + "tail"), (2, "a" * 149)], "t long, x string")
    cache = spark.createDataFrame([(1, long), (2, "a" * 64), (3, "a" * 150), (4, "a" * 300)], "e long, y string")
    got = {r.t: r.match_id for r in PC.longest_prefix_join(
        texts, cache, text_id="t", text_col="x", entry_id="e", entry_col="y").collect()}
    assert got == {1: 1, 2: 2}


def test_replayed_micro_batch_replaces_its_output(spark, tmp_path):
    df = spark.range(5)
    for batch in (0, 1, 1):
        SB._put(df, str(tmp_path), batch)
    out = SB._written(spark, str(tmp_path), df.schema)
    assert out.count() == 10 and out.drop(SB._BATCH).columns == ["id"]


def test_row_ranges():
    assert io.split_row_range("a.jsonl@[2:-1]") == ("a.jsonl", (2, -1))
    assert io.split_row_range("a@[:].parquet@[:5]") == ("a@[:].parquet", (None, 5))
    for p in ("a.jsonl", "a@[1]", "a@[x:1]", "a@[1:2", "a@[1:2:3]"):
        assert io.split_row_range(p) == (p, None)


def test_subsample_of_a_small_key_fails(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "k long, i long")
    with pytest.raises(PySparkException):
        io.subsample_ends_by(df, 0.5, key_cols=["k"], order_cols=["i"]).collect()


def test_eval_config_has_all_keys(spark):
    df = io.eval_config_table(spark, [{"name": "a", "label_key": "l", "metadata_overrides": {"x": "1"}}])
    r = df.first()
    assert r.label_key == "l" and r.metadata_overrides == {"x": "1"}


def test_turn_log_probs_must_match(spark):
    df = spark.createDataFrame([([("assistant", "a b", [0.5])],)], "m array<struct<role:string,content:string,log_probs:array<double>>>")
    with pytest.raises(PySparkException):
        df.select(P.append_turns("m", log_probs=True)).collect()


def test_suffix_scan_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, []), (3, None), (4, [5.0])], "i long, x array<double>")
    got = {r.i: r.y for r in TK.suffix_scan_rows(df, "x", "y", 0.5).collect()}
    assert got == {1: [2.75, 3.5, 3.0], 2: [], 3: None, 4: [5.0]}


def test_snippet_paragraphs(spark):
    doc = "first line here\nthe quick brown fox jumps over it\nand the lazy dog sleeps on\nend"
    rows = [("brown fox jumps over it and the lazy", "the quick brown fox jumps over it\nand the lazy dog sleeps on"),
            ("the quick brown fox jumps over ... quick brown fox jumps over it", "the quick brown fox jumps over it"),
            ("too short", ""), ("six words that are not there", "")]
    df = spark.createDataFrame(rows, "s string, want string")
    assert [(r.c, r.want) for r in df.select("want", AG.snippet_context("s", F.lit(doc)).alias("c")).collect()] == \
        [(w, w) for _, w in rows]


def test_tool_text_goldens(spark):
    rows = [("x Answer: \\boxed{a{b}c} <code>z</code>", "answer", "a{b}c"), ("<code> p(1) </code>", "code", "p(1)"),
            ('<tool_call>{"name":"code_interpreter","arguments":{"code":" "}}</tool_call><code>q</code>', "code", "q"),
            ('<tool_call>{"name":"other"}</tool_call>', None, ""), ("```python\nk\n```", "code", "k"), ("none", None, "")]
    df = spark.createDataFrame(rows, "x string, a string, c string")
    got = [(r.x, r.t.action, r.t.content) for r in df.select("x", AG.extract_tool_action("x").alias("t")).collect()]
    assert got == rows
