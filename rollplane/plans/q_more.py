"""Queries: tool-agent text (T13-T15, T17, T28), formal-math data (C5, B9,
B10), speculative decoding and timers (B16, E9, E17), importance-weight report
(H16), task export (A13), math grading (T7), hooks (X3, X5-X10), cursors (A10),
tools (B4), dumps (A3) and checkable reports of the balancers (G10, G12, G14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import agents as AG, arrays as A, text as TX
from ..operators import balance as B, groups as G, hooks as H, metrics as M, prompts as P, tokens as TK
from ..sources import fixtures as FX, io
from ..sources.fixtures import with_fixtures as W
from ..sources.tables import read_table
from ..streaming.buffer import run_dir
from . import q_balance
from .q_extra import MONTH_SQL, _month
from .registry import r6, register

KEY = ["group_index", "idx_in_group"]

# T13-T15 tool variants: the graded responses, some in other shapes ----------------
_TOOL_SQL = r"""
, tx AS (SELECT group_index, idx_in_group, CASE kind
    WHEN 0 THEN response || ' Answer: \boxed{ x_{' || label || '} } done'
    WHEN 3 THEN '<code> print("' || p_name || '") </code> tail'
    WHEN 5 THEN '```python' || chr(10) || 'x = 1' || chr(10) || '``` rest ' || response ELSE response END AS x FROM graded),
m AS (SELECT *, regexp_extract(x, '(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>', 1) AS call,
    regexp_matches(x, '(?s)Answer:\s*\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}') AS ans FROM tx)
"""


def _tool_texts(spark, sf):
    g = FX.graded(spark, sf)
    x = (F.when(F.col("kind") == 0, F.concat("response", F.lit(" Answer: \\boxed{ x_{"), "label", F.lit("} } done")))
          .when(F.col("kind") == 3, F.concat(F.lit('<code> print("'), "p_name", F.lit('") </code> tail')))
          .when(F.col("kind") == 5, F.concat(F.lit("```python\nx = 1\n``` rest "), "response")).otherwise(F.col("response")))
    return g.select(*KEY, x.alias("x"))


@register("extract_tool_action", W(_TOOL_SQL + r"""
SELECT group_index, idx_in_group,
  CASE WHEN ans THEN 'answer' WHEN call <> '' OR contains(x, '</code>') OR contains(x, '```python') THEN 'code' END AS action,
  CASE WHEN ans THEN trim(regexp_extract(x, '(?s)Answer:\s*\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}', 1))
       WHEN call <> '' THEN json_extract_string(call, '$.arguments.code')
       WHEN contains(x, '</code>') THEN trim(regexp_extract(x, '(?s)<code>(.*?)</code>', 1))
       WHEN contains(x, '```python') THEN regexp_extract(x, '(?s)```python\s*(.*?)\s*```', 1) ELSE '' END AS content
FROM m""", "graded"))
def q_extract_tool_action(spark, sf):
    t = _tool_texts(spark, sf).withColumn("a", AG.extract_tool_action("x"))
    return t.select(*KEY, "a.action", "a.content")


@register("truncate_after_tool", W(_TOOL_SQL + r"""
SELECT group_index, idx_in_group,
  CASE WHEN call <> '' THEN regexp_extract(x, '(?s)^.*</tool_call>')
       WHEN contains(x, '</code>') THEN string_split(x, '</code>')[1] || '</code>'
       WHEN contains(x, '```python') THEN regexp_extract(x, '(?s)^.*```')
       WHEN ans THEN regexp_extract(x, '(?s)^.*Answer:\s*\\boxed\{(?:[^{}]|\{[^{}]*\})*\}') ELSE x END AS cut
FROM m""", "graded"))
def q_truncate_after_tool(spark, sf):
    return _tool_texts(spark, sf).select(*KEY, AG.truncate_after_tool("x").alias("cut"))


@register("observation_text", W(_TOOL_SQL + r"""
SELECT group_index, idx_in_group,
  CASE WHEN ans THEN '' WHEN call <> '' OR contains(x, '</code>') OR contains(x, '```python')
       THEN chr(10) || chr(10) || '<interpreter>' || chr(10) || 'ok ' || idx_in_group || chr(10) || '</interpreter>' || chr(10) || chr(10)
       ELSE chr(10) || 'My previous action is invalid. If I want to execute code, I should put the code between <code> and </code>. If I want to give the final answer, I should use the format ''Answer: \boxed{answer}''. Let me try again.' || chr(10) END AS obs,
  ans AS done
FROM m""", "graded"))
def q_observation_text(spark, sf):
    t = _tool_texts(spark, sf).withColumn("a", AG.extract_tool_action("x"))
    o = AG.tool_observation("a.action", "a.content", F.concat(F.lit("ok "), F.col("idx_in_group").cast("string")))
    return t.withColumn("o", o).select(*KEY, F.col("o.text").alias("obs"), "o.done")


# A theorem per part ---------------------------------------------
TEMPLATE = "Prove this:\n```lean\n{}\n```\n"
PREFIX = "Complete this Lean code:\n"
_THEOREMS = """
, th AS (SELECT p_partkey, p_name AS statement, p_size AS difficulty,
  'import X' || chr(10) || repeat('theorem t' || p_partkey || ' : 1 = 1 := by' || chr(10), CAST(1 + p_partkey % 2 AS INTEGER)) AS code,
  'theorem t' || p_partkey || ' : a = a :=' AS one FROM part)
"""


def _theorems(spark, sf):
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey").cast("string")
    line = F.concat(F.lit("theorem t"), k, F.lit(" : 1 = 1 := by\n"))
    return p.select("p_partkey", F.col("p_name").alias("statement"), F.col("p_size").alias("difficulty"),
                    F.concat(F.lit("import X\n"), F.repeat(line, (1 + F.col("p_partkey") % 2).cast("int"))).alias("code"),
                    F.concat(F.lit("theorem t"), k, F.lit(" : a = a :=")).alias("one"))


@register("theorem_filter", "WITH " + _THEOREMS.strip()[2:] + """
SELECT p_partkey FROM th WHERE len(string_split(code, 'theorem ')) = 2 AND difficulty = 7""")
def q_theorem_filter(spark, sf):
    return AG.theorem_filter(_theorems(spark, sf), code="code", difficulty="difficulty", wanted=7).select("p_partkey")


@register("theorem_prompt", "WITH " + _THEOREMS.strip()[2:] + """
SELECT p_partkey, 'Prove this:' || chr(10) || '```lean' || chr(10) || '/- ' || statement || ' -/' || chr(10) || 'theorem t' || p_partkey
  || ' : a = a := by' || chr(10) || '  sorry' || chr(10) || '```' || chr(10) AS prompt FROM th""")
def q_theorem_prompt(spark, sf):
    return _theorems(spark, sf).select("p_partkey", AG.theorem_prompt("statement", "one", TEMPLATE).alias("prompt"))


@register("sft_pairs", "WITH " + _THEOREMS.strip()[2:] + """
SELECT p_partkey, 'Prove this:' || chr(10) || '```lean' || chr(10) || 'theorem t' || p_partkey || ' : a = a := by' || chr(10)
  || '  sorry' || chr(10) || '```' || chr(10) AS user_text, '```lean' || chr(10) || statement AS assistant_text FROM th""")
def q_sft_pairs(spark, sf):
    t = _theorems(spark, sf)
    m = AG.sft_pair(F.concat(F.lit(PREFIX), "one"), "statement", PREFIX, TEMPLATE)
    return t.withColumn("m", m).select("p_partkey", F.get("m", F.lit(0))["content"].alias("user_text"),
                                       F.get("m", F.lit(1))["content"].alias("assistant_text"))


@register("code_block_assemble", "WITH " + _THEOREMS.strip()[2:] + """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'theorem t' || p_partkey || ' : a = a := rfl' || chr(10)
    ELSE 'theorem t' || p_partkey || ' : a = a := by' || chr(10) || statement || chr(10) END AS code,
  CASE WHEN p_partkey % 3 = 0 THEN 'no_code' END AS error FROM th""")
def q_code_block_assemble(spark, sf):
    t = _theorems(spark, sf)
    k = F.col("p_partkey") % 3
    response = (F.when(k == 0, F.col("statement"))
                 .when(k == 1, F.lit("```\nold\n``` then ```lean4\ntheorem x : b := rfl\n```"))
                 .otherwise(F.concat(F.lit("```lean4\n"), "statement", F.lit("\n```"))))
    c = AG.code_block_assemble(F.concat(F.lit("```lean\n"), "one", F.lit(" sorry\n```")), response)
    return t.withColumn("c", c).select("p_partkey", "c.code", "c.error")


# T28 ------------------------------------------------------------------------
@register("snippet_context", r"""
WITH d AS (SELECT doc_id, text, trim(string_split(text, chr(10))[2]) AS line FROM documents),
s AS (SELECT *, array_to_string(list_filter(regexp_split_to_array(line, '\s+'), lambda w: w <> '')[1:8], ' ') AS seg FROM d),
f AS (SELECT *, instr(translate(text, chr(10), ' '), trim(seg)) AS pos FROM s)
SELECT doc_id, CASE WHEN len(list_filter(regexp_split_to_array(trim(seg), '\s+'), lambda w: w <> '')) > 5 AND pos > 0 THEN
  trim(regexp_extract(text[1:pos], '[^\n]*$') || text[pos + 1:pos - 1 + length(trim(seg))] || string_split(text[pos + length(trim(seg)):], chr(10))[1],
       ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) ELSE '' END AS context
FROM f""")
def q_snippet_context(spark, sf):
    d = read_table(spark, sf, "documents")
    line = F.trim(F.coalesce(F.get(F.split("text", "\n"), F.lit(1)), F.lit("")))
    words = F.filter(F.split(line, r"\s+"), lambda w: w != "")
    seg = F.array_join(F.slice(words, 1, 8), " ")
    return d.select("doc_id", AG.snippet_context(seg, "text").alias("context"))


# T7 -------------------------------------------------------------------------
@register("math_grade", W(r"""
SELECT group_index, idx_in_group, CASE WHEN q = CAST(l AS VARCHAR) THEN 1.0::DOUBLE ELSE 0.0 END AS reward
FROM (SELECT group_index, idx_in_group, CAST(response_length AS VARCHAR) AS q,
             response_length + CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS l FROM samples)""", "samples"))
def q_math_grade(spark, sf):
    """Boxed answers in five spellings of one number against labels that are right or one off."""
    s = FX.samples(spark, sf)
    q, k = F.col("response_length").cast("string"), F.col("l_partkey") % 5
    shown = (F.when(k == 0, F.concat(q, F.lit(".0"))).when(k == 1, F.concat(q, F.lit(" cm")))
              .when(k == 2, F.concat(F.lit("\\text{"), q, F.lit("}"))).when(k == 3, F.concat(F.lit("$"), q, F.lit("\\%")))
              .otherwise(q))
    label = (F.col("response_length") + F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(0)).cast("string")
    return s.select(*KEY, TX.math_grade(F.concat(F.lit("so \\boxed{"), shown, F.lit("}")), label).alias("reward"))


@register("math_verdict", W(r"""
SELECT group_index, idx_in_group, CASE WHEN k < 5 AND NOT off THEN 1.0::DOUBLE ELSE 0.0 END AS reward, k = 5 AS undecided
FROM (SELECT group_index, idx_in_group, l_partkey % 7 AS k, l_partkey % 3 = 0 AS off FROM samples)""", "samples"))
def q_math_verdict(spark, sf):
    """Halves as a fraction, a mixed number, a sum with a power, a quotient and in a tuple against decimals that are right or one
    off; a root is left undecided, text with three unknowns is wrong."""
    s = FX.samples(spark, sf)
    n, k = F.col("response_length"), F.col("l_partkey") % 7
    q = n.cast("string")
    odd = (2 * n + 1).cast("string")
    shown = (F.when(k == 0, F.concat(odd, F.lit("/2"))).when(k == 1, F.concat(q, F.lit("\\frac{1}{2}")))
              .when(k == 2, F.concat(q, F.lit("+2^3-7.5"))).when(k == 3, F.concat(odd, F.lit("*3/6")))
              .when(k == 4, F.concat(F.lit("("), odd, F.lit("/2, 10.25)")))
              .when(k == 5, F.concat(F.lit("\\sqrt{"), q, F.lit(".5}"))).otherwise(F.concat(F.lit("x+y+z+"), q)))
    value = F.concat((n + F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(0)).cast("string"), F.lit(".5"))
    label = F.when(k == 4, F.concat(F.lit("("), value, F.lit(",41/4)"))).otherwise(value)
    v = TX.math_verdict(F.concat(F.lit("so \\boxed{"), shown, F.lit("}")), label)
    return s.select(*KEY, F.inline(F.array(v)))  # a struct read twice would be graded twice


# B16 / E9 / E17 ------------------------------------------------------------------
_SPEC = """
, sp AS (SELECT group_index, idx_in_group, sum(l_partkey % 40) AS accept_tokens, sum(l_partkey % 50) AS draft_tokens,
                sum(l_linenumber % 3) AS verify_ct, max(response_length) AS response_length FROM samples GROUP BY ALL),
r AS (SELECT *, CASE WHEN draft_tokens > 0 THEN accept_tokens / draft_tokens ELSE 0.0 END AS rate,
             CASE WHEN verify_ct > 0 THEN response_length / verify_ct ELSE 0.0 END AS len FROM sp)
"""


def _spec(spark, sf):
    s = FX.samples(spark, sf).withColumns({"acc": F.col("l_partkey") % 40, "dr": F.col("l_partkey") % 50,
                                           "ver": F.col("l_linenumber") % 3})
    return P.spec_info_rollup(s, keys=KEY, accept="acc", draft="dr", verify="ver", response_length="response_length")


@register("spec_info_rollup", W(_SPEC + """
SELECT group_index, idx_in_group, round(rate, 6) AS spec_accept_rate, round(len, 6) AS spec_accept_length FROM r""", "samples"))
def q_spec_info_rollup(spark, sf):
    return _spec(spark, sf).select(*KEY, r6("spec_accept_rate").alias("spec_accept_rate"),
                                   r6("spec_accept_length").alias("spec_accept_length"))


@register("spec_metrics", W(_SPEC + """
SELECT round(avg(rate), 6) AS spec_accept_rate, round(avg(len), 6) AS spec_accept_length FROM r""", "samples"))
def q_spec_metrics(spark, sf):
    m = M.spec_metrics(_spec(spark, sf))
    return m.select(r6("spec_accept_rate").alias("spec_accept_rate"), r6("spec_accept_length").alias("spec_accept_length"))


@register("timer_perf", """
WITH t AS (SELECT user_id % 50 AS rollout_id, event_id, CASE event_id % 5 WHEN 0 THEN 'actor_train' WHEN 1 THEN 'log_probs'
             WHEN 2 THEN 'ref_log_probs' WHEN 3 THEN 'train_wait' ELSE 'train' END AS name, value AS s FROM events),
w AS (SELECT rollout_id, sum(s) FILTER (name = 'actor_train') AS a, sum(s) FILTER (name = 'log_probs') AS lp,
             sum(s) FILTER (name = 'ref_log_probs') AS rl, sum(s) FILTER (name = 'train_wait') AS tw,
             sum(s) FILTER (name = 'train') AS tr, count(*) * 2.5 AS f, sum(event_id % 100) AS tok FROM t GROUP BY 1)
SELECT rollout_id, round(CASE WHEN a IS NOT NULL AND lp > 0 THEN f / lp END, 6) AS log_probs_tflops,
       round(CASE WHEN a > 0 THEN 3 * f / a END, 6) AS actor_train_tflops, round(CASE WHEN a > 0 THEN tok / a END, 6) AS tok_per_s,
       round(CASE WHEN tw + tr > 0 THEN tw + tr END, 4) AS step_time, round(CASE WHEN tw + tr > 0 THEN tw / (tw + tr) END, 6) AS wait_ratio
FROM w""")
def q_timer_perf(spark, sf):
    e = read_table(spark, sf, "events").select((F.col("user_id") % 50).alias("rollout_id"), "event_id", F.col("value").alias("seconds"))
    k = F.col("event_id") % 5
    timers = e.withColumn("name", F.when(k == 0, "actor_train").when(k == 1, "log_probs").when(k == 2, "ref_log_probs")
                          .when(k == 3, "train_wait").otherwise("train"))
    work = e.groupBy("rollout_id").agg((F.count(F.lit(1)) * 2.5).alias("fwd_flops"), F.sum(F.col("event_id") % 100).alias("tokens"))
    m = M.timer_perf(timers, work, keys=["rollout_id"])
    return m.select("rollout_id", r6("log_probs_tflops").alias("log_probs_tflops"), r6("actor_train_tflops").alias("actor_train_tflops"),
                    r6("actor_train_tok_per_s").alias("tok_per_s"), F.round("step_time", 4).alias("step_time"),
                    r6("wait_time_ratio").alias("wait_ratio"))


# H16 ------------------------------------------------------------------------
@register("mis_metrics_report", W("""
, x AS (SELECT *, exp(least(greatest(lp - olp, -20), 20)) AS w0, CASE WHEN (lp - olp) < ln(0.2) AND m <> 0 THEN 1.0 ELSE 0.0 END AS cat FROM tok),
p AS (SELECT group_index, idx_in_group, greatest(sum(m), 1) AS n, sum(w0 * m) AS b, sum(least(greatest(w0, 0), 2.0) * m * m) AS a,
             sum(CASE WHEN w0 > 2.0 THEN 1.0 ELSE 0.0 END * m) AS hi, sum(cat * m) AS ct, max(cat) * sum(m) AS cs FROM x GROUP BY ALL)
SELECT round(avg(b / n), 6) AS weight_before, round(avg(a / n), 6) AS weight_after, round(avg(hi / n), 6) AS fraction_high,
       round(avg(ct / n), 6) AS catastrophic_token, round(avg(cs / n), 6) AS catastrophic_seq FROM p""", "tok"))
def q_mis_metrics_report(spark, sf):
    r = TK.mis_metrics_report(FX.token_rows(spark, sf), veto_threshold=0.2)
    return r.select(r6("mis_mean_is_weight_before_clip").alias("weight_before"), r6("mis_mean_is_weight_after_clip").alias("weight_after"),
                    r6("mis_truncate_fraction_high").alias("fraction_high"),
                    r6("mis_catastrophic_token_fraction").alias("catastrophic_token"),
                    r6("mis_catastrophic_seq_fraction").alias("catastrophic_seq"))


# C10 ------------------------------------------------------------------------
@register("log_prob_gate", W("""
SELECT avg(lp) > -1.5 AND avg(lp) < 0 AS log_probs_ok, avg(-v) > -1 AND avg(-v) < 1 AS entropy_ok, abs(avg(lp) - avg(rlp)) < 1e-8 AS same_as_ref
FROM tok""", "tok"))
def q_log_prob_gate(spark, sf):
    t = FX.token_rows(spark, sf).withColumn("entropy", F.transform("values", lambda v: -v))
    return M.log_prob_gate(t, ref_log_probs="ref_log_probs", entropy="entropy", entropy_range=(-1.0, 1.0), log_prob_range=(-1.5, 0.0))


# A13 / A3 / A10 / B4 ---------------------------------------------------------------
@register("export_tasks", """
SELECT lang AS env, source AS split, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1 AS "index", doc_id FROM documents""")
def q_export_tasks(spark, sf):
    d = read_table(spark, sf, "documents")
    rows = io.task_rows(d, env="lang", split="source", order_cols=["doc_id"], fields=["doc_id", "n_chars"])
    path = run_dir(spark, "tasks")
    io.export_tasks(rows, path)
    back = spark.read.schema("index long, metadata string, env string, split string").json(path)
    return back.select("env", "split", "index", F.get_json_object("metadata", "$.doc_id").cast("long").alias("doc_id"))


@register("dump_samples", W(f"""
SELECT CASE WHEN idx_in_group = 0 THEN 'eval' ELSE 'train' END AS category, CAST({MONTH_SQL} AS INTEGER) AS rollout_id,
       count(*) AS n, round(sum(reward), 6) AS reward FROM samples GROUP BY ALL""", "samples"))
def q_dump_samples(spark, sf):
    s = FX.samples(spark, sf).select(*KEY, "reward", _month().alias("rollout_id"),
                                     F.when(F.col("idx_in_group") == 0, "eval").otherwise("train").alias("category"))
    path = run_dir(spark, "dumped")
    io.dump_samples(s, path)
    return (spark.read.parquet(path).groupBy("category", F.col("rollout_id").cast("int").alias("rollout_id"))
                 .agg(F.count(F.lit(1)).alias("n"), r6(F.sum("reward")).alias("reward")))


@register("cursor_checkpoint", "SELECT 3::BIGINT AS rollout_id, count(*) AS sample_offset, count(DISTINCT lang) AS epoch_id FROM documents")
def q_cursor_checkpoint(spark, sf):
    """The cursor after reading all documents, saved among earlier ones and restored."""
    d = read_table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lang").alias("e")).first()
    path = run_dir(spark, "cursor")
    for rollout, n in ((1, 0), (2, d["n"] // 2), (3, d["n"])):
        io.cursor_save(spark, path, rollout_id=rollout, sample_offset=n, epoch_id=d["e"], sample_group_index=0, sample_index=0)
    return io.cursor_load(spark, path).select(F.col("rollout_id").cast("long"), "sample_offset", "epoch_id")


@register("normalize_tools", """
SELECT p_partkey, p_name AS name, CAST(1 + p_partkey % 2 AS INTEGER) AS n FROM part""")
def q_normalize_tools(spark, sf):
    p = read_table(spark, sf, "part")
    tool = F.struct(F.lit("function").alias("type"), F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("description"),
                                                              F.lit("{}").alias("parameters")).alias("function"))
    js = F.to_json(F.array_repeat(tool, (1 + F.col("p_partkey") % 2).cast("int")))
    t = p.select("p_partkey", P.normalize_tools(js).alias("t"))
    return t.select("p_partkey", F.get("t", F.lit(0))["function"]["name"].alias("name"), F.size("t").alias("n"))


# X3, X5-X10 -----------------------------------------------------------------------
def _word_count_client(rows):
    """Stands for a scoring service: a reward per row from its response."""
    return [float(len(r["response"].split())) for r in rows]


@register("remote_reward", W(r"""
SELECT group_index, idx_in_group, CAST(len(list_filter(regexp_split_to_array(response, '\s+'), lambda w: w <> '')) AS DOUBLE) AS reward
FROM graded""", "graded"))
def q_remote_reward(spark, sf):
    g = FX.graded(spark, sf).select(*KEY, "response")
    return H.remote_reward(g, _word_count_client, cols=["response"]).select(*KEY, "reward")


@register("custom_buffer_select", W("""
, f AS (SELECT instance_id FROM buffer_items GROUP BY instance_id ORDER BY min(ts), instance_id LIMIT 20)
SELECT uid, instance_id FROM buffer_items WHERE instance_id IN (SELECT instance_id FROM f)""", "buffer_items"))
def q_custom_buffer_select(spark, sf):
    return H.select_from_buffer(FX.buffer_items(spark, sf), 20).select("uid", "instance_id")


@register("custom_reward_postprocess", W("""
SELECT group_index, idx_in_group, reward AS raw_reward, round(reward - 0.5, 6) AS reward FROM samples""", "samples"))
def q_custom_reward_postprocess(spark, sf):
    out = H.apply_frame_hook(FX.samples(spark, sf), lambda df: df.withColumn("raw_reward", F.col("reward"))
                             .withColumn("reward", r6(F.col("reward") - 0.5)))
    return out.select(*KEY, "raw_reward", "reward")


@register("custom_generate", W("""
SELECT group_index, idx_in_group, k, response_length + k AS length FROM samples, (SELECT unnest(range(idx_in_group % 3)) AS k)""", "samples"))
def q_custom_generate(spark, sf):
    """One sample in, zero to two samples out."""
    def expand(pdf):
        out = pdf.loc[pdf.index.repeat(pdf["idx_in_group"] % 3)]
        k = out.groupby(["group_index", "idx_in_group"]).cumcount()
        return out.assign(k=k, length=out["response_length"] + k)[["group_index", "idx_in_group", "k", "length"]]

    s = FX.samples(spark, sf).select(*KEY, "response_length")
    return H.custom_generate(s, expand, "group_index long, idx_in_group long, k long, length long")


@register("custom_loss", W("""
SELECT group_index, idx_in_group, round(sum(greatest(-exp(-(lp - rlp)) * v, -least(greatest(exp(-(lp - rlp)), 0.8), 1.2) * v) * 0.7071067811865476), 6) AS loss
FROM tok GROUP BY ALL""", "tok"))
def q_custom_loss(spark, sf):
    """A registered loss builder over the policy KL and the values as advantages."""
    t = FX.token_rows(spark, sf)
    kl = A.approx_kl("log_probs", "ref_log_probs", "k1")
    loss = H.loss_column("ppo_clip", kl, F.col("values"))
    return t.select(*KEY, r6(A.asum(loss) * 0.7071067811865476).alias("loss"))


@register("generator_plugin", W("""
SELECT count(*) AS total_samples, count(DISTINCT instance_id) AS num_groups FROM buffer_items WHERE reward >= 0.5""", "buffer_items"))
def q_generator_plugin(spark, sf):
    """A task type's own group transform, then the default statistics."""
    H.register_generator("half", transform_group=lambda df, **_: df.filter(F.col("reward") >= 0.5))
    t = H.generator_hook("half", "transform_group")(FX.buffer_items(spark, sf))
    return H.generator_hook("half", "meta_info")(t).select("total_samples", "num_groups")


@register("custom_rollout_data", W("""
SELECT group_index, idx_in_group, CAST(list_sum(loss_mask) AS BIGINT) AS n_loss FROM token_rows""", "token_rows"))
def q_custom_rollout_data(spark, sf):
    def post(df):
        return df.withColumn("n_loss", F.aggregate("loss_mask", F.lit(0).cast("long"), lambda a, m: a + m))
    return H.apply_frame_hook(FX.token_rows(spark, sf), post).select(*KEY, "n_loss")


# What every right assignment has in common --------------------------
_STEPS = """
, o AS (SELECT response_length AS l, row_number() OVER (ORDER BY group_index, idx_in_group) - 1 AS i FROM samples)
"""


@register("balanced_partitions_report", W(_STEPS + """
SELECT i // 256 AS batch, count(*) AS n, CAST(sum(l) AS BIGINT) AS total, CAST(least(count(*), 8) AS BIGINT) AS parts, true AS even
FROM o GROUP BY 1""", "samples"))
def q_balanced_partitions_report(spark, sf):
    """Per batch: items, tokens, non-empty parts, and whether part sums differ by no more than one item."""
    g = q_balance._ordered(spark, sf)
    p = B.balanced_partitions(g, batch_cols=["batch"], item_col="row_idx", length_col="response_length", k=8)
    per = p.join(g, ["batch", "row_idx"]).groupBy("batch", "part").agg(
        F.count(F.lit(1)).alias("c"), F.sum("response_length").alias("s"), F.max("response_length").alias("m"))
    return per.groupBy("batch").agg(F.sum("c").alias("n"), F.sum("s").alias("total"), F.count(F.lit(1)).alias("parts"),
                                    (F.max("s") - F.min("s") <= F.max("m")).alias("even"))


@register("group_balance_report", W("""
, g AS (SELECT group_index, count(*) AS c, sum(response_length) AS l FROM samples GROUP BY 1),
n AS (SELECT *, row_number() OVER (ORDER BY group_index) - 1 AS i, count(*) OVER () AS total FROM g)
SELECT i // 64 AS batch, CAST(sum(c) AS BIGINT) AS n, CAST(sum(l) AS BIGINT) AS total, 4::BIGINT AS ranks, true AS same_count
FROM n WHERE i < total // 64 * 64 GROUP BY 1""", "samples"))
def q_group_balance_report(spark, sf):
    """Per batch of 64 groups: samples, tokens, ranks, and whether all ranks have the same number of groups."""
    out = q_balance.q_group_balance_shard(spark, sf).join(FX.samples(spark, sf).select(*KEY, "response_length"), KEY)
    per = out.groupBy("batch", "dp_rank").agg(F.count(F.lit(1)).alias("c"), F.sum("response_length").alias("s"),
                                              F.count_distinct("group_index").alias("g"))
    return per.groupBy("batch").agg(F.sum("c").alias("n"), F.sum("s").alias("total"), F.count(F.lit(1)).alias("ranks"),
                                    (F.max("g") == F.min("g")).alias("same_count"))


@register("microbatch_report", W(_STEPS + """
, t AS (SELECT i // 512 AS step, i % 4 AS dp_rank, l FROM o WHERE i < (SELECT count(*) FROM o) // 512 * 512)
SELECT step, CAST(dp_rank AS INTEGER) AS dp_rank, count(*) AS n, CAST(sum(l) AS BIGINT) AS total, true AS all_used FROM t GROUP BY 1, 2""", "samples"))
def q_microbatch_report(spark, sf):
    """Per step and rank: rows, tokens, and whether every micro-batch of the step is used."""
    m = q_balance.q_microbatch_schedule(spark, sf)
    g = q_balance._ordered(spark, sf).select("row_idx", "response_length")
    return m.join(g, "row_idx").groupBy("step", "dp_rank").agg(
        F.count(F.lit(1)).alias("n"), F.sum("response_length").alias("total"),
        (F.count_distinct("microbatch") == F.max("num_microbatches")).alias("all_used"))


# The importance weight is a hook, too
@register("custom_is_weight", W("""
SELECT group_index, idx_in_group, round(sum(least(greatest(exp(lp - olp), 0.9), 1.05) * m) / greatest(sum(m), 1), 6) AS weight
FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_custom_is_weight(spark, sf):
    from ..operators import hooks
    t = FX.token_rows(spark, sf)
    w = hooks.loss_column("clipped_ratio", F.col("log_probs"), F.col("rollout_log_probs"), low=0.9, high=1.05)
    return t.select(*KEY, w.alias("w"), "loss_mask").select(*KEY, r6(A.mmean("w", "loss_mask")).alias("weight"))


# The message struct and the action of a response with tool calls
_CALL = "regexp_extract(response, '(?s)<tool_call>(.*?)</tool_call>', 1)"


@register("tool_call_struct", W(f"""
, c AS (SELECT *, {_CALL} AS call, regexp_replace(response, '(?s)<tool_call>(.*?)</tool_call>', '', 'g') AS rest FROM graded)
SELECT group_index, idx_in_group, 'assistant' AS role, CASE WHEN call <> '' AND trim(rest) = '' THEN NULL ELSE rest END AS content,
       CASE WHEN call <> '' THEN 'call_0_' || json_extract_string(call, '$.name') END AS call_id,
       CASE WHEN call <> '' THEN json_extract_string(call, '$.name') END AS function_name,
       CASE WHEN call <> '' THEN CAST(json_extract(call, '$.arguments') AS VARCHAR) END AS arguments,
       CASE WHEN call <> '' THEN json_extract_string(call, '$.name') ELSE 'respond' END AS action,
       CASE WHEN call <> '' THEN CAST(json_extract(call, '$.arguments') AS VARCHAR) ELSE CAST(json_object('content', response) AS VARCHAR) END AS kwargs
FROM c""", "graded"))
def q_tool_call_struct(spark, sf):
    from ..operators import prompts
    m = FX.graded(spark, sf).select(*KEY, prompts.tool_call_message("response").alias("x"))
    first = F.get(F.col("x.message.tool_calls"), F.lit(0))
    return m.select(*KEY, "x.message.role", "x.message.content", first["id"].alias("call_id"), first["function"]["name"].alias("function_name"),
                    first["function"]["arguments"].alias("arguments"), F.col("x.action.name").alias("action"), F.col("x.action.kwargs").alias("kwargs"))
