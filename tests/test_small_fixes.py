"""Tails, boundaries, replays and digits of operators that had gaps."""

import random

import pytest
from pyspark.sql import functions as F
from rollplane.functions import text as TX
from rollplane.operators import balance as B, packing as PK, prompts as P, tokens as TK
from rollplane.sources import io


def plain_braces(x):
    """The normaliser's fraction rule by pieces; an IndexError stands for a failed step."""
    pieces = x.split("\\frac")
    out = pieces[0]
    for p in pieces[1:]:
        if p == "":
            return None
        if p[0] == "{":
            out += "\\frac" + p
        elif len(p) < 2:
            return x
        else:
            out += "\\frac{" + p[0] + "}" + (p[1:] if p[1] == "{" else "{" + p[1] + "}" + p[2:])
    return out


def test_first_cramped_fraction_decides(spark):
    rnd = random.Random(1)
    xs = ["".join(rnd.choice(["\\frac", "\\frac", "1", "2", "{3}", "{", "x", "\\pi"]) for _ in range(rnd.randint(0, 6))) for _ in range(600)]
    rows = spark.createDataFrame([(x,) for x in xs], "x string").select("x", TX._brace_fractions(F.col("x")).alias("y")).collect()
    assert [r.y for r in rows] == [plain_braces(r.x) for r in rows]


def test_roots(spark):
    df = spark.createDataFrame([("\\sqrt3+\\sqrt{5}",), ("\\sqrt",), ("\\sqrt\\sqrt2",), ("4",)], "x string")
    assert [r[0] for r in df.select(TX._brace_roots(F.col("x"))).collect()] == ["\\sqrt{3}+\\sqrt{5}", None, None, "4"]


@pytest.mark.parametrize("n, k", [(7, 3), (1, 4), (9, 3), (23, 8)])
def test_parts_of_a_tail_differ_by_one_item(n, k):
    rnd = random.Random(n)
    lengths = [rnd.randint(0, 50) for _ in range(n)]
    parts = B.largest_differencing(lengths, k, True)
    assert sorted(i for p in parts for i in p) == list(range(n))
    counts = [len(p) for p in parts] + [0] * (k - len(parts))
    assert max(counts) - min(counts) <= 1


def test_rank_with_fewer_rows_than_micro_batches(spark):
    df = spark.createDataFrame([(i, 90) for i in range(5)], "i long, n long")
    got = B.microbatch_schedule(df, order_col="i", length_col="n", global_batch=8, dp_size=2, max_tokens=100).collect()
    assert sorted(r.i for r in got) == list(range(5)) and {r.num_microbatches for r in got} == {3}


def test_padding_as_a_sequence_of_its_own(spark):
    df = spark.createDataFrame([([1, 2, 3], [0, 2, 3]), ([1, 2, 3, 4], [0, 4])], "tokens array<int>, cu_seqlens array<int>")
    rows = PK.pad_to_multiple(df, 4, arrays=["tokens"], new_boundary=True).collect()
    assert [(r.tokens, r.cu_seqlens, r.pad_length) for r in rows] == [([1, 2, 3, 0], [0, 2, 3, 4], 1), ([1, 2, 3, 4], [0, 4], 0)]


def test_total_lengths(spark):
    df = spark.createDataFrame([([1, 2, 3], 2, 1.0, "completed", "kept")], "tokens array<int>, response_length long, reward double, status string, extra string")
    r = P.to_train_columns(df, reward=F.col("reward")).first()
    assert (r.total_lengths, r.loss_masks, r.extra) == (3, [1, 1], "kept")


def test_repeated_writes_replace(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, 0.25)], "step long, loss double")
    for prefix in ("train/", "eval/", "train/"):
        io.metrics_sink(df, str(tmp_path / "m"), step_col="step", prefix=prefix)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 4
    for offset in (3, 3, 5):
        io.cursor_save(spark, str(tmp_path / "c"), rollout_id=7, sample_offset=offset, epoch_id=0, sample_group_index=1, sample_index=2)
    io.cursor_save(spark, str(tmp_path / "c"), rollout_id=6, sample_offset=1, epoch_id=0, sample_group_index=1, sample_index=2)
    assert [r.sample_offset for r in io.cursor_load(spark, str(tmp_path / "c")).collect()] == [5]


def test_whitening_keeps_its_digits(spark):
    xs = [1e9 + i for i in range(8)]
    df = spark.createDataFrame([(xs, [1] * 8)], "x array<double>, loss_mask array<int>")
    got = TK.masked_whiten(df, "x", eps=0.0).first().x
    mean, var = sum(xs) / 8, sum((x - sum(xs) / 8) ** 2 for x in xs) / 7
    assert all(abs(a - (b - mean) / var ** 0.5) < 1e-6 for a, b in zip(got, xs))


def test_choice_by_number_and_by_metadata(spark):
    rows = [("The answer is B", None, 1, None, None, 1.0), ("The answer is B", None, 2, None, None, 0.0), ("it is the green house", "x", None, "Green House!", None, 1.0),
            ("it is the green house", "x", None, None, "the GREEN house", 1.0), ("it is the blue house", "x", None, "Green House", "green", 0.0),
            ("The answer is B", None, 99, None, None, 0.0)]
    df = spark.createDataFrame(rows, "resp string, label string, idx int, ca string, at string, want double")
    got = df.select("want", TX.choice_grade("resp", "label", label_index=F.col("idx"), correct_answer=F.col("ca"), answer_text=F.col("at")).alias("g")).collect()
    assert [r.g for r in got] == [r.want for r in got]


def test_parts_come_from_the_token_budget(spark):
    df = spark.createDataFrame([(b, i, n) for b, ns in enumerate([[5, 5, 5], [100], [3, 9, 4, 8]]) for i, n in enumerate(ns)], "b long, i long, n long")
    got = B.balanced_partitions(df, batch_cols=["b"], item_col="i", length_col="n", max_tokens=10).collect()
    parts = {b: len({r.part for r in got if r.b == b}) for b in range(3)}
    assert parts == {0: 2, 1: 1, 2: 3}
    with pytest.raises(ValueError):
        B.balanced_partitions(df, batch_cols=["b"], item_col="i", length_col="n")


def test_tool_call_message(spark):
    rows = [(1, 'ok <tool_call>{"name":"f","arguments":{"a":1}}</tool_call>'), (2, '<tool_call>{"name":"f","arguments":"x"}</tool_call> <tool_call>{"arguments":{}}</tool_call>'),
            (3, "plain"), (4, None), (5, "<tool_call>no json</tool_call>")]
    got = {r.i: r.m for r in spark.createDataFrame(rows, "i long, t string").select("i", P.tool_call_message("t").alias("m")).collect()}
    m = got[1].message
    assert (m.role, m.content, [(c.id, c.type, c.function.name, c.function.arguments) for c in m.tool_calls]) == \
        ("assistant", "ok ", [("call_0_f", "function", "f", '{"a":1}')])
    assert (got[1].action.name, got[1].action.kwargs) == ("f", '{"a":1}')
    assert got[2].message.content is None and [c.id for c in got[2].message.tool_calls] == ["call_0_f", "call_1_unknown"]
    assert got[2].action.name == "respond" and got[3].message.tool_calls is None and got[3].action.kwargs == '{"content":"plain"}'
    assert got[4] is None and got[5].action.name == "respond"


def test_repetition_and_truncation_fractions(spark):
    import random
    from rollplane.operators import metrics as M
    rnd = random.Random(1)
    noise = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(12_000))
    rows = [(1, "ab" * 6000, "truncated"), (1, noise, "completed"), (1, None, None), (1, "short", "truncated"), (2, "x" * 20_000, "completed")]
    df = spark.createDataFrame(rows, "rollout long, response string, status string")
    got = {r.rollout: (r.n_samples, r.repetition_frac, r.truncated_ratio) for r in M.repetition_truncation(df, keys=["rollout"]).collect()}
    assert got == {1: (4, 0.25, 0.5), 2: (1, 1.0, 0.0)}
    r = M.repetition_truncation(df).first()
    assert (r.n_samples, r.repetition_frac, r.truncated_ratio) == (5, 0.4, 0.4)
    assert M.repetition_truncation(df.limit(0), keys=["rollout"]).count() == 0


def test_shuffle_keys_of_very_large_ids(spark):
    from rollplane.operators import sampling as SM
    ids = [0, 1, 2**31 - 1, 2**31, 10**12, 2**62, -5]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(SM.shuffle_key("i", 3, 4)).collect()]
    assert got == [(i * SM.LCG_A + 7 * 7919 + SM.LCG_C) % SM.LCG_M for i in ids]


def test_metrics_of_many_steps_share_folders(spark, tmp_path):
    path = str(tmp_path / "m")
    steps = spark.range(0, 3000).selectExpr("id as step", "cast(id as double) as loss")
    io.metrics_sink(steps, path, step_col="step", prefix="train/")
    io.metrics_sink(spark.createDataFrame([(7, -1.0), (None, 5.0), (1 << 20, 6.0)], "step long, loss double"), path, step_col="step", prefix="train/")
    io.metrics_sink(spark.createDataFrame([(None, 8.0)], "step long, loss double"), path, step_col="step", prefix="train/")
    got = {r.step: r.value for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == 3002 and len(got) == 3002
    assert (got[7], got[8], got[None], got[1 << 20]) == (-1.0, 8.0, 8.0, 6.0)
    assert len(list((tmp_path / "m" / "section=train").iterdir())) == 3
