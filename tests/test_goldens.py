"""Hand-computed goldens (FIXTURES.md) for the operators' quirks."""

import math

import pytest
from pyspark.sql import functions as F

from rollplane.functions import arrays as A, text as TX
from rollplane.operators import balance as B, metrics as M, prompts as P, tokens as TK


def one(spark, col, schema_sql="x int", rows=((1,),)):
    return spark.createDataFrame(list(rows), schema_sql).select(col.alias("v")).first()["v"]


def test_masked_mean_goldens(spark):
    df = spark.createDataFrame([([.1, .2], [1, 1]), ([.1, .2, .3, .4, .5], [1] * 5), ([.6], [1])],
                               "x array<double>, m array<int>")
    r = TK.masked_mean_report(df, "x", "m").first()
    assert r["sample_mean"] == pytest.approx(0.35)
    assert r["sum_of_sample_mean"] == pytest.approx(1.05)
    assert r["token_mean"] == pytest.approx(0.3)


def test_first_fit_goldens(spark):
    assert one(spark, B.first_fit_count(F.array(*[F.lit(x) for x in (100, 200, 300)]), 300)) == 2
    assert one(spark, B.first_fit_count(F.array(F.lit(400)), 300)) == 1
    loads = one(spark, B.first_fit_loads(F.array(*[F.lit(x) for x in (100, 200, 300)]), 300))
    assert loads == [300, 300]


def test_greedy_golden(spark):
    assert one(spark, B.greedy_assign(F.array(*[F.lit(x) for x in (5, 4, 3)]), 2)) == [0, 1, 1]


def test_pass_at_k_golden(spark):
    df = spark.createDataFrame([(1, float(r)) for r in (1, 1, 0, 0)], "g int, reward double")
    out = {r["k"]: r["pass_at_k"] for r in M.pass_at_k(df, group_cols=["g"], n=4).collect()}
    assert out[1] == pytest.approx(0.5)
    assert out[2] == pytest.approx(5 / 6)
    assert out[4] == pytest.approx(1.0)


def test_pass_at_k_uneven_fails(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (2, 1.0)], "g int, reward double")
    with pytest.raises(Exception):
        M.pass_at_k(df, group_cols=["g"], n=2).collect()


def test_gae_golden(spark):
    g = one(spark, A.gae(F.array(F.lit(0.0), F.lit(1.0)), F.array(F.lit(.5), F.lit(.5)), 1.0, 1.0))
    assert g["advantages"] == pytest.approx([.5, .5])
    assert g["returns"] == pytest.approx([1.0, 1.0])


def test_chunked_gae_matches_fold():
    import numpy as np
    rng = np.random.default_rng(0)
    r, v = rng.normal(size=1000), rng.normal(size=1000)
    a_chunk, _ = TK._chunked_gae_np(r, v, 0.99, 0.95, 128)
    a = np.zeros(1000)
    last = 0.0
    for t in range(999, -1, -1):
        nv = v[t + 1] if t < 999 else 0.0
        last = r[t] + 0.99 * nv - v[t] + 0.99 * 0.95 * last
        a[t] = last
    assert np.max(np.abs(a - a_chunk)) < 1e-5


def test_rpp_golden(spark):
    ret = one(spark, A.rpp_returns(F.lit(1.0), F.array(*[F.lit(0.0)] * 3), F.array(F.lit(1), F.lit(1), F.lit(0)),
                                   0.0, 0.5))
    assert ret == pytest.approx([.5, 1.0, 0.0])


def test_ppo_clip_golden(spark):
    r = one(spark, A.ppo_clip_loss(F.array(F.lit(0.0)), F.array(F.lit(1.0)), 0.2, 0.2))
    assert r["pg_loss"] == pytest.approx([-1.0])
    assert r["clipfrac"] == [0.0]


def test_mis_truncate_golden(spark):
    w = one(spark, A.mis_weights(F.array(F.lit(math.log(4.0))), F.array(F.lit(0.0)), F.array(F.lit(1)),
                                 level="token", mode="truncate", upper=2.0))
    assert w["weights"] == pytest.approx([2.0])
    assert w["frac_high"] == [1.0]


def test_f1_goldens(spark):
    r = one(spark, TX.f1_grade(F.lit("the cat sat"), F.lit("cat")))
    assert (r["precision"], r["recall"], r["f1"]) == pytest.approx((0.5, 1.0, 2 / 3))
    assert one(spark, TX.f1_grade(F.lit("yes"), F.lit("yes indeed")))["f1"] == 0.0


def test_boxed_goldens(spark):
    assert one(spark, TX.last_boxed(F.lit(r"x \boxed{\frac{1}{2}} y"))) == r"\boxed{\frac{1}{2}}"
    assert one(spark, TX.last_boxed(F.lit(r"x \boxed{\frac{1}{2} y"))) is None
    assert one(spark, TX.boxed_content(F.lit(r"a \boxed{1} b \boxed{22}"))) == "22"


def test_dapo_golden(spark):
    r = one(spark, TX.dapo_grade(F.lit("so\nAnswer: 1,234"), F.lit("1234")))
    assert r["score"] == 1.0 and r["acc"] is True and r["pred"] == "1234"
    assert one(spark, TX.dapo_normalize(F.lit(r"x = \boxed{12} dollars"))) == "12"


def test_tool_reward_golden(spark):
    assert one(spark, TX.tool_reward_shaping(F.lit(-1.0), F.lit(4))) == pytest.approx(-0.9)
    assert one(spark, TX.tool_reward_shaping(F.lit(1.0), F.lit(4))) == 1.0


def test_response_span_goldens(spark):
    r = one(spark, P.response_span(F.array(*[F.lit(x) for x in (0, 0, 1, 0, 1)])))
    assert r["response_length"] == 3 and r["loss_mask"] == [1, 0, 1]
    assert one(spark, P.response_span(F.array(F.lit(0), F.lit(0))))["response_length"] == 0


def test_choice_grade(spark):
    assert one(spark, TX.choice_grade(F.lit("After checking, the answer is (B)"), F.lit("B"))) == 1.0
    assert one(spark, TX.choice_grade(F.lit("The final answer: C"), F.lit("B"))) == 0.0
    assert one(spark, TX.choice_grade(F.lit("it is the red fox"), F.lit("Red fox"))) == 1.0


def test_grade_dispatch_unknown_fails(spark):
    df = spark.createDataFrame([("zzz", "a", "b")], "t string, r string, l string")
    with pytest.raises(Exception):
        df.select(TX.grade_dispatch("t", "r", "l")).collect()


def test_subsample_ends(spark, tmp_path):
    from rollplane.sources import io
    df = spark.range(10).withColumnRenamed("id", "i")
    kept = sorted(r["i"] for r in io.subsample_ends(df, 0.5, order_cols=["i"]).collect())
    assert kept == [0, 1, 7, 8, 9]
    with pytest.raises(ValueError):
        io.subsample_ends(df, 0.01, order_cols=["i"])


def test_read_prompts_jsonl_and_slice(spark, tmp_path):
    from rollplane.sources import io
    p = tmp_path / "p.jsonl"
    p.write_text("\n".join('{"id": %d, "text": "t%d", "label": %d}' % (i, i, i) for i in range(10)))
    df = io.read_prompts(spark, str(p) + "@[2:-3]", order_cols=["id"])
    assert sorted(r["id"] for r in df.collect()) == [2, 3, 4, 5, 6]
    assert dict(df.dtypes)["label"] == "string"
    with pytest.raises(ValueError):
        io.read_prompts(spark, str(tmp_path / "x.csv"))


def test_repetition_flag_matches_python(spark):
    import zlib

    import pyarrow.parquet as pq

    from conftest import SF_SMALL
    from rollplane.operators.metrics import has_repetition

    docs = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()

    def expect(t):
        if len(t) <= 10000:
            return False
        raw = t[-10000:].encode("utf-8")
        return len(raw) / len(zlib.compress(raw, 9)) > 10

    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["doc_id"]: r["rep"] for r in df.select("doc_id", has_repetition("text").alias("rep")).collect()}
    assert got == {d["doc_id"]: expect(d["text"]) for d in docs}


def test_group_reward_hook(spark):
    from rollplane.operators import hooks as H
    df = spark.createDataFrame([(1, 5), (1, 3), (1, 5), (2, 7)], "g int, x int")

    def rank_reward(pdf):
        s = pdf.groupby("g")["x"]
        return s.rank(method="min") / s.transform("size")

    got = sorted((r["g"], r["x"], r["reward"]) for r in H.group_reward(df, rank_reward, group_cols=["g"]).collect())
    assert got == [(1, 3, 1 / 3), (1, 5, 2 / 3), (1, 5, 2 / 3), (2, 7, 1.0)]


def test_code_safety(spark):
    df = spark.createDataFrame([("import os\nx=1",), ("import math\nfrom numpy import x",), ("y = 2",),
                                ("x.__class__",)], "code string")
    got = [(r["safe"], r["reason"]) for r in TX.code_safety_filter(df, "code").collect()]
    assert got[0] == (False, r"Code contains dangerous pattern: import\s+os")
    assert got[1] == (False, "Import of 'x' is not allowed")
    assert got[2] == (True, "Code is safe")
    assert got[3][0] is False


def test_search_format_reasons(spark):
    df = spark.createDataFrame([
        ("<|im_start|>assistant\n<think>a</think>\n<answer>b</answer>",),
        ("<|im_start|>assistant\n<think>a</think> stray <answer>b</answer>",),
        ("<|im_start|>assistant\n<think>a<answer>b</answer>",),
        ("<think>a</think><answer>b</answer>",),
        ("<|im_start|>assistant\n<think>a</think><search>q</search>",),
    ], "t string")
    got = [(r["v"]["valid"], r["v"]["reason"]) for r in df.select(TX.search_format_valid("t").alias("v")).collect()]
    assert got[0] == (True, "valid")
    assert got[1] == (False, "text outside of tags after after_think: stray")
    assert got[2] == (False, "<think> is opened 1 times, closed 0")
    assert got[3] == (False, "no assistant turn")
    assert got[4] == (False, "stops after after_search")


def test_remote_reward_with_fake_client(spark):
    from rollplane.operators import hooks as H
    calls = {"n": 0}

    def flaky(rows):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("transient")
        return [float(len(r["response"])) for r in rows]

    df = spark.createDataFrame([("ab",), ("abcd",)], "response string").coalesce(1)
    got = sorted(r["reward"] for r in H.remote_reward(df, flaky, cols=["response"]).collect())
    assert got == [2.0, 4.0]


def test_generator_and_loss_hooks(spark):
    from rollplane.operators import groups as G, hooks as H
    assert H.generator_hook("unknown", "is_valid_group") is G.valid_group
    H.register_generator("math", is_valid_group=lambda df, **kw: df)
    assert H.generator_hook("math", "is_valid_group")(1) == 1
    v = spark.range(1).select(H.loss_column("ppo_clip", F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("l")).first()
    assert v["l"] == [-1.0]


def test_eval_config_table(spark):
    from rollplane.sources import io
    cfg = io.eval_config_table(spark, {"aime": {"rm_type": "dapo", "n_samples_per_eval_prompt": 16},
                                       "gpqa": {"rm_type": "gpqa"}},
                               defaults={"n_samples_per_eval_prompt": 4, "top_p": 0.7}, run_level={"top_p": 1.0,
                                                                                                   "max_response_len": 512})
    got = {r["name"]: (r["rm_type"], r["n_samples_per_eval_prompt"], r["top_p"], r["max_response_len"])
           for r in cfg.collect()}
    assert got == {"aime": ("dapo", 16, 0.7, 512), "gpqa": ("gpqa", 4, 0.7, 512)}
    with pytest.raises(ValueError):
        io.eval_config_table(spark, [{"name": "x", "bogus": 1}])


MATHD_CASES = [("\\frac12", "\\frac{1}{2}"), ("\\frac1{72}", "\\frac{1}{72}"), ("\\dfrac{3}{4}", "\\frac{3}{4}"),
               ("0.5", "\\frac{1}{2}"), ("1/2", "\\frac{1}{2}"), (" .5", "\\frac{1}{2}"), ("\\text{ 12 }", "12"),
               ("x = 3", "3"), ("\\sqrt3", "\\sqrt{3}"), ("10\\%", "10"), ("5\\text{ cm}", "5"),
               ("\\left( 1, 2 \\right)", "(1,2)"), ("\\frac", "\\frac"), ("\\frac1", "\\frac1"), ("3^\\circ", "3"),
               ("k=\\frac{1}{2}", "\\frac{1}{2}"), ("01/2", "01/2")]


def test_mathd_normalize(spark):
    df = spark.createDataFrame(MATHD_CASES, "a string, want string")
    got = [(r["want"], r["n"]) for r in df.select("want", TX.mathd_normalize("a").alias("n")).collect()]
    assert all(w == n for w, n in got), got
    r = spark.range(1).select(TX.mathd_grade(F.lit("0.5"), F.lit("\\frac{1}{2}")).alias("g"),
                              TX.grade_dispatch(F.lit("math"), F.lit("so \\boxed{1/2}"), F.lit("0.5")).alias("d")).first()
    assert r["g"] == 1.0 and r["d"] == 1.0


def test_deepscaler_and_math_grade(spark):
    r = spark.range(1).select(
        TX.deepscaler_grade(F.lit("<think>x</think> so \\boxed{\\frac12}"), F.lit("0.5")).alias("a"),
        TX.deepscaler_grade(F.lit("no think \\boxed{1}"), F.lit("1")).alias("b"),
        TX.deepscaler_grade(F.lit("###Response the \\boxed{3}"), F.lit("\\boxed{3}")).alias("c"),
        TX.math_grade(F.lit("\\boxed{2}"), F.lit("")).alias("d")).first()
    assert (r["a"], r["b"], r["c"], r["d"]) == (1.0, 0.0, 1.0, 0.0)


def test_math_grade_by_value(spark):
    from rollplane.functions import text as TX
    rows = [("\\boxed{1,000}", "1000", 1.0), ("\\boxed{(1,2)}", "(1, 2.0)", 1.0), ("\\boxed{2.50}", "5/2", 1.0),
            ("\\boxed{12 cm}", "12", 1.0), ("\\boxed{1\\frac{1}{2}}", "1.5", 1.0), ("\\boxed{3}", "3.0", 1.0),
            ("\\boxed{2/4}", "1/2", 0.0), ("\\boxed{(1,2)}", "[1,2]", 0.0), ("\\boxed{(1,2)}", "(1,2,3)", 0.0),
            ("\\boxed{5}", "2+3", 0.0), ("\\boxed{50\\%}", "50", 1.0), ("no box", "1", 0.0)]
    df = spark.createDataFrame(rows, "r string, l string, want double")
    assert [(r.r, r.g) for r in df.select("r", TX.math_grade("r", "l").alias("g")).collect()] == [(r, w) for r, _, w in rows]
