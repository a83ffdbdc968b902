"""Derived inputs (FIXTURES.md) built by Spark from the driver tables.

Each fixture has a Spark builder ``name(spark, sf_dir)`` and an ANSI SQL
twin in ``FIXTURE_SQL`` so that the DuckDB oracle sees the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from .tables import read_table

# ---------------------------------------------------------------- F1 samples
# lineitem -> one sample per line; group = order (TPC-H bounds an order to 7
# lines, so the per-order window below sorts at most 7 rows per key).
_F1_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    w = W.partitionBy("l_orderkey").orderBy(*_F1_ORDER)
    return li.select(
        F.col("l_orderkey").alias("group_index"),
        (F.row_number().over(w) - 1).cast("bigint").alias("idx_in_group"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).cast("double").alias("reward"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A"), "truncated")
         .when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7), "aborted")
         .otherwise("completed").alias("status"),
        F.col("l_quantity").cast("bigint").alias("response_length"),
        F.col("l_discount").alias("dense_reward"),
        F.col("l_shipdate").alias("finished_at"),
        F.col("l_partkey"), F.col("l_linenumber"),
    )


# ------------------------------------------------------------- F2 token rows
def _remainder(g: int, i: int, t: int, plus: int, m: int):
    """(g * group + i * index + t * position + plus) % m, with the sign of the dividend as in SQL."""
    return lambda group, index, at: np.fmod(g * group + i * index + t * at + plus, m)


# The arrays of a token row: the value at each position, from its group and its index there.
_TOKEN_ARRAYS = {
    "loss_mask": (T.IntegerType(), lambda g, i, t: ((t == 0) | (_remainder(1, 1, 1, 0, 5)(g, i, t) != 0)).astype(np.int32)),
    "log_probs": (T.DoubleType(), lambda g, i, t: -_remainder(31, 17, 7, 0, 97)(g, i, t).astype(float) / 50),
    "rollout_log_probs": (T.DoubleType(), lambda g, i, t: -_remainder(31, 17, 7, 3, 97)(g, i, t).astype(float) / 50),
    "ref_log_probs": (T.DoubleType(), lambda g, i, t: -_remainder(13, 11, 5, 0, 89)(g, i, t).astype(float) / 50),
    "values": (T.DoubleType(), lambda g, i, t: (_remainder(7, 3, 1, 0, 21)(g, i, t) - 10).astype(float) / 10),
    "tokens": (T.IntegerType(), lambda g, i, t: (_remainder(7, 3, 11, 0, 1000)(g, i, t) + 1).astype(np.int32)),
}


def _token_array(name: str) -> Column:
    """One array of a token row, a batch of rows at a time: positions 0 .. length - 1 (downwards to -1 and so on for a
    length below 1, as ``sequence`` has it). No length: no array; no group or index: null values, and a loss mask of 1 at 0
    only, where the rule needs neither."""
    kind, rule = _TOKEN_ARRAYS[name]

    def build(group: pa.Array, index: pa.Array, length: pa.Array) -> pa.Array:
        unknown = pa.compute.or_(group.is_null(), index.is_null()).to_numpy(zero_copy_only=False)
        g, i, n = (x.fill_null(1).to_numpy(zero_copy_only=False) for x in (group, index, length))
        size = np.where(n > 0, n, 2 - n)
        size[length.is_null().to_numpy(zero_copy_only=False)] = 0
        off = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(off[-1]) - np.repeat(off[:-1], size)
        if (n <= 0).any():
            at = np.where(np.repeat(n <= 0, size), -at, at)
        if max(np.abs(g).max(initial=0), np.abs(i).max(initial=0), np.abs(at).max(initial=0)) > 1 << 56:
            raise OverflowError("group, index or position too large for the rules of the token arrays")
        values, missing = rule(np.repeat(g, size), np.repeat(i, size), at), np.repeat(unknown, size)
        if name == "loss_mask":  # an unknown remainder is not "other than 0"
            values, missing = np.where(missing & (at != 0), 0, values).astype(np.int32), None
        flat = pa.array(values, mask=missing)
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), flat, mask=length.is_null())

    from ..operators.scans import _arrow
    return _arrow(build, T.ArrayType(kind))(F.col("group_index"), F.col("idx_in_group"), F.col("response_length"))


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    return s.select("group_index", "idx_in_group", "reward", "status", "response_length", "dense_reward",
                    *[_token_array(c).alias(c) for c in _TOKEN_ARRAYS])


# --------------------------------------------------------------- F3 prompts
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    return (d.join(lab.select("doc_id", "quality"), "doc_id", "left")
             .select(F.col("doc_id").alias("question_id"), F.col("text").alias("prompt"),
                     F.col("quality").cast("string").alias("label"), "lang", "source"))


# ------------------------------------------------------------------ F4 chat
def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", "role", "text",
                    F.when(F.col("turn") % 6 == 3, 0).otherwise(1).alias("step_loss_mask"))


# ---------------------------------------------------------- F5 buffer items
def buffer_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("uid"), F.col("user_id").alias("instance_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") / 500).alias("reward"),
        F.when(F.col("event_type") == "error", "abort").when(F.col("event_type") == "view", "length")
         .otherwise("stop").alias("finish_reason"),
        "event_type")


# ----------------------------------------------------------- F6 graded
def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthesised responses with labels and grader types (6 kinds by line
    number; every third part key gets a wrong label)."""
    s = samples(spark, sf_dir)
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    j = s.join(part, "l_partkey")
    q = F.col("response_length").cast("string")
    kind = F.col("l_linenumber") % 6
    wrong = (F.col("l_partkey") % 3) == 0
    letter = F.char(F.lit(65) + F.col("l_partkey") % 4)
    other = F.char(F.lit(65) + (F.col("l_partkey") + 1) % 4)
    boxed = F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit("\\frac{"), q, F.lit("}{1}"))).otherwise(q)
    resp = (F.when(kind == 0, F.concat(F.lit("<think>compute "), F.col("p_name"), F.lit("</think> so x = \\boxed{"), boxed, F.lit("}")))
             .when(kind == 1, F.concat(F.lit("Working: "), F.col("p_name"), F.lit("\nAnswer: "), q, F.lit(",000")))
             .when(kind == 2, F.concat(F.lit("After checking, the answer is ("), F.when(wrong, other).otherwise(letter), F.lit(")")))
             .when(kind == 3, F.concat(F.lit("<search>"), F.col("p_name"), F.lit("</search>")))
             .when(kind == 4, F.concat(F.lit('<tool_call>{"name":"code_interpreter","arguments":{"code":"print('), q,
                                       F.lit(')"}}</tool_call>')))
             .otherwise(F.concat(F.lit("The "), F.col("p_name"))))
    qn = F.col("response_length") + F.when(wrong, 1).otherwise(0)
    label = (F.when(kind.isin(0, 4), qn.cast("string"))
              .when(kind == 1, (qn * 1000).cast("string"))
              .when(kind == 2, letter)
              .otherwise(F.when(wrong, F.col("p_brand")).otherwise(F.col("p_name"))))
    rm = (F.when(kind == 0, "boxed_f1").when(kind.isin(1, 4), "dapo").when(kind == 2, "gpqa").otherwise("f1"))
    return j.select("group_index", "idx_in_group", kind.alias("kind"), resp.alias("response"), label.alias("label"),
                    rm.alias("rm_type"), "p_name")


# ------------------------------------------------------- search transcripts
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search-agent transcript per conversation, built from all its
    turns in four shapes by conv_id mod 4 (valid direct answer, valid
    search round, stray text between tags, unbalanced think). The first turn
    is thought, the second searched or answered, the rest is what was found
    (or thought as well)."""
    c = read_table(spark, sf_dir, "conversations")
    first = [F.max(F.when(F.col("turn") == i, F.col("text"))).alias(f"t{i}") for i in range(2)]
    rest = F.array_sort(F.collect_list(F.when(F.col("turn") >= 2, F.struct("turn", "text"))))
    t = c.groupBy("conv_id").agg(*first, F.array_join(F.transform(rest, lambda x: x["text"]), "\n").alias("t2"))
    t1, t2 = F.coalesce(F.col("t1"), F.lit("")), F.coalesce(F.col("t2"), F.lit(""))
    t0 = F.when(F.col("conv_id") % 4 == 1, F.col("t0")).otherwise(F.concat(F.col("t0"), F.lit("\n"), t2))
    k = F.col("conv_id") % 4
    body = (F.when(k == 0, F.concat(F.lit("<think>"), t0, F.lit("</think>\n<answer>"), t1, F.lit("</answer>")))
             .when(k == 1, F.concat(F.lit("<think>"), t0, F.lit("</think><search>"), t1, F.lit("</search>\n<information>"),
                                    t2, F.lit("</information><think>ok</think><answer>"), t1, F.lit("</answer>")))
             .when(k == 2, F.concat(F.lit("<think>"), t0, F.lit("</think> stray "), F.lit("<answer>"), t1, F.lit("</answer>")))
             .otherwise(F.concat(F.lit("<think>"), t0, F.lit("<answer>"), t1, F.lit("</answer>"))))
    return t.select("conv_id", F.concat(F.lit("<|im_start|>assistant\n"), body).alias("transcript"))


# -------------------------------------------------------------- F7 vectors
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")


# --------------------------------------------------------------- SQL twins
FIXTURE_SQL: dict[str, str] = {
    "samples": """
SELECT l_orderkey AS group_index,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                               l_quantity, l_extendedprice, l_shipdate) - 1 AS BIGINT) AS idx_in_group,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS reward,
       CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'truncated'
            WHEN l_linestatus = 'F' AND l_returnflag = 'N' AND l_linenumber = 7 THEN 'aborted'
            ELSE 'completed' END AS status,
       CAST(l_quantity AS BIGINT) AS response_length,
       l_discount AS dense_reward,
       l_shipdate AS finished_at,
       l_partkey, l_linenumber
FROM lineitem""",
    "token_rows": """
SELECT group_index, idx_in_group, reward, status, response_length, dense_reward,
  list_transform(range(response_length), lambda t: CASE WHEN t = 0 OR (group_index + idx_in_group + t) % 5 <> 0 THEN 1 ELSE 0 END) AS loss_mask,
  list_transform(range(response_length), lambda t: -CAST((group_index * 31 + idx_in_group * 17 + t * 7) % 97 AS DOUBLE) / 50) AS log_probs,
  list_transform(range(response_length), lambda t: -CAST((group_index * 31 + idx_in_group * 17 + t * 7 + 3) % 97 AS DOUBLE) / 50) AS rollout_log_probs,
  list_transform(range(response_length), lambda t: -CAST((group_index * 13 + idx_in_group * 11 + t * 5) % 89 AS DOUBLE) / 50) AS ref_log_probs,
  list_transform(range(response_length), lambda t: CAST((group_index * 7 + idx_in_group * 3 + t) % 21 - 10 AS DOUBLE) / 10) AS "values",
  list_transform(range(response_length), lambda t: CAST((group_index * 7 + idx_in_group * 3 + t * 11) % 1000 + 1 AS INTEGER)) AS tokens
FROM samples""",
    "prompts": """
SELECT d.doc_id AS question_id, d.text AS prompt, CAST(l.quality AS VARCHAR) AS label, d.lang, d.source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "chat": """
SELECT conv_id, turn, role, text, CASE WHEN turn % 6 = 3 THEN 0 ELSE 1 END AS step_loss_mask
FROM conversations""",
    "buffer_items": """
SELECT event_id AS uid, user_id AS instance_id, ts, value / 500 AS reward,
       CASE WHEN event_type = 'error' THEN 'abort' WHEN event_type = 'view' THEN 'length' ELSE 'stop' END AS finish_reason,
       event_type
FROM events""",
    "tok": """
SELECT group_index, idx_in_group, reward, response_length,
       unnest(range(response_length)) AS t, unnest(loss_mask) AS m, unnest(log_probs) AS lp,
       unnest(rollout_log_probs) AS olp, unnest(ref_log_probs) AS rlp, unnest("values") AS v,
       unnest(tokens) AS tk
FROM token_rows""",
    "chat_msgs": r"""
SELECT conv_id, turn, role, text, step_loss_mask,
       list_filter(regexp_split_to_array('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '\s+'),
                   lambda w: w <> '') AS words
FROM chat""",
    "graded": r"""
SELECT group_index, idx_in_group, kind,
       CASE kind WHEN 0 THEN '<think>compute ' || p_name || '</think> so x = \boxed{' ||
                             (CASE WHEN l_partkey % 5 = 0 THEN '\frac{' || q || '}{1}' ELSE q END) || '}'
                 WHEN 1 THEN 'Working: ' || p_name || chr(10) || 'Answer: ' || q || ',000'
                 WHEN 2 THEN 'After checking, the answer is (' || (CASE WHEN wrong THEN other ELSE letter END) || ')'
                 WHEN 3 THEN '<search>' || p_name || '</search>'
                 WHEN 4 THEN '<tool_call>{"name":"code_interpreter","arguments":{"code":"print(' || q || ')"}}</tool_call>'
                 ELSE 'The ' || p_name END AS response,
       CASE WHEN kind IN (0, 4) THEN CAST(qn AS VARCHAR) WHEN kind = 1 THEN CAST(qn * 1000 AS VARCHAR)
            WHEN kind = 2 THEN letter WHEN wrong THEN p_brand ELSE p_name END AS label,
       CASE WHEN kind = 0 THEN 'boxed_f1' WHEN kind IN (1, 4) THEN 'dapo' WHEN kind = 2 THEN 'gpqa' ELSE 'f1' END AS rm_type,
       p_name
FROM (SELECT s.*, p.p_name, p.p_brand, s.l_linenumber % 6 AS kind, CAST(s.response_length AS VARCHAR) AS q,
             s.l_partkey % 3 = 0 AS wrong, chr(CAST(65 + s.l_partkey % 4 AS INTEGER)) AS letter,
             chr(CAST(65 + (s.l_partkey + 1) % 4 AS INTEGER)) AS other,
             s.response_length + CASE WHEN s.l_partkey % 3 = 0 THEN 1 ELSE 0 END AS qn
      FROM samples s JOIN part p ON s.l_partkey = p.p_partkey) x""",
    "transcripts": r"""
SELECT conv_id, '<|im_start|>assistant' || chr(10) ||
  CASE conv_id % 4
    WHEN 0 THEN '<think>' || t0 || '</think>' || chr(10) || '<answer>' || t1 || '</answer>'
    WHEN 1 THEN '<think>' || t0 || '</think><search>' || t1 || '</search>' || chr(10) || '<information>' || t2 ||
                '</information><think>ok</think><answer>' || t1 || '</answer>'
    WHEN 2 THEN '<think>' || t0 || '</think> stray <answer>' || t1 || '</answer>'
    ELSE '<think>' || t0 || '<answer>' || t1 || '</answer>' END AS transcript
FROM (SELECT conv_id, CASE WHEN conv_id % 4 = 1 THEN f ELSE f || chr(10) || t2 END AS t0, t1, t2 FROM (
  SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS f, coalesce(max(CASE WHEN turn = 1 THEN text END), '') AS t1,
         coalesce(string_agg(text, chr(10) ORDER BY turn, text) FILTER (turn >= 2), '') AS t2
  FROM conversations GROUP BY conv_id) y) x""",
    "vectors": """
SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings""",
}

# Fixture dependencies (a fixture's CTE must precede its users).
FIXTURE_DEPS: dict[str, tuple[str, ...]] = {
    "token_rows": ("samples",),
    "tok": ("token_rows",),
    "chat_msgs": ("chat",),
    "graded": ("samples",),
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of the named fixtures (and their deps)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in FIXTURE_DEPS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in order)
    return f"WITH {ctes}\n{sql}"
