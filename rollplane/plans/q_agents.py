"""Queries: multi-agent episodes (T18, D9, T20), forward FLOPs (E18) and
the streaming dynamic filter (U6).

An episode is a conversation: its assistant turns are the rewriters'
candidate solutions (reward 1 when the turn number is odd), and the
selector answers 'Judgment: k' with k = conv_id mod (candidates + 1) + 1,
so some judgments point past the candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import groups as G, metrics as M
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W
from ..streaming import buffer as SB
from .registry import r6, register

_EPISODE_SQL = """
, cand AS (SELECT conv_id, turn, text, CAST(CASE WHEN turn % 4 = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS reward,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k
           FROM chat WHERE role = 'assistant'),
sel AS (SELECT conv_id, 'Judgment: ' || CAST(conv_id % (count(*) + 1) + 1 AS VARCHAR) AS response, count(*) AS n
        FROM cand GROUP BY conv_id),
pick AS (SELECT conv_id, CASE WHEN CAST(regexp_extract(response, 'Judgment:\\s*(\\d+)', 1) AS INTEGER) - 1 BETWEEN 0 AND n - 1
                              THEN CAST(regexp_extract(response, 'Judgment:\\s*(\\d+)', 1) AS INTEGER) - 1 END AS idx FROM sel),
chosen AS (SELECT p.conv_id, c.text AS selected FROM pick p LEFT JOIN cand c ON c.conv_id = p.conv_id AND c.k = p.idx + 1),
sr AS (SELECT ch.conv_id, coalesce(min_by(c.reward, c.turn), 0.0) AS selector_reward
       FROM chosen ch LEFT JOIN cand c ON c.conv_id = ch.conv_id AND ch.selected IS NOT NULL AND instr(c.text, ch.selected) > 0
       GROUP BY ch.conv_id)
"""


def _episodes(spark, sf):
    c = FX.chat(spark, sf).filter(F.col("role") == "assistant")
    cand = c.select("conv_id", "turn", "text", F.when(F.col("turn") % 4 == 1, 1.0).otherwise(0.0).alias("reward"))
    n = cand.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"),
                                    F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("_c"))
    sel = n.select("conv_id", "n", "_c", F.concat(F.lit("Judgment: "), (F.col("conv_id") % (F.col("n") + 1) + 1)
                                                  .cast("string")).alias("response"))
    idx = TX.parse_judgment("response", F.col("n"))
    sel = sel.select("conv_id", idx.alias("idx"), F.get(F.col("_c"), idx)["text"].alias("selected"))
    return cand, sel


@register("parse_judgment", W(_EPISODE_SQL + "SELECT conv_id, CAST(idx AS INTEGER) AS idx FROM pick", "chat"))
def q_parse_judgment(spark, sf):
    _, sel = _episodes(spark, sf)
    return sel.select("conv_id", F.col("idx").cast("int"))


@register("selector_reward_join", W(_EPISODE_SQL + "SELECT conv_id, round(selector_reward, 6) AS selector_reward FROM sr",
                                    "chat"))
def q_selector_reward_join(spark, sf):
    cand, sel = _episodes(spark, sf)
    sr = G.selector_reward_join(sel, cand, key="conv_id", order_col="turn", text_col="text", reward_col="reward",
                                selected_col="selected")
    return sr.select("conv_id", r6("selector_reward").alias("selector_reward"))


@register("team_reward_adjust", W(_EPISODE_SQL + """
SELECT c.conv_id, c.turn, round(c.reward * CASE WHEN sr.selector_reward = 1 THEN 1.2 ELSE 0.8 END, 6) AS reward
FROM cand c JOIN sr USING (conv_id)""", "chat"))
def q_team_reward_adjust(spark, sf):
    cand, sel = _episodes(spark, sf)
    sr = G.selector_reward_join(sel, cand, key="conv_id", order_col="turn", text_col="text", reward_col="reward",
                                selected_col="selected")
    out = G.team_reward_adjust(cand, sr, key="conv_id")
    return out.select("conv_id", "turn", r6("reward").alias("reward"))


# E18 ------------------------------------------------------------------------
# The model shape of this estimate (a 32-layer dense model).
MODEL = dict(hidden=4096, heads=32, kv_groups=8, ffn=11008, layers=32, vocab=151936)


def _flops_sql(s: str) -> str:
    h, nh, g, f, L, V = (MODEL[k] for k in ("hidden", "heads", "kv_groups", "ffn", "layers", "vocab"))
    d = h // nh
    layer = f"({2 * h * d * (nh + 2 * g)} * {s} + {4 * nh * d} * {s} * {s} + {2 * h * h} * {s} + {6 * h * f} * {s})"
    return f"({layer} * {L} + {2 * h * V} * {s})"


@register("flops_estimate", W(f"""
SELECT CAST(year(finished_at) AS INTEGER) AS rollout_id, CAST(sum({_flops_sql('CAST(response_length AS BIGINT)')}) AS BIGINT) AS fwd_flops
FROM samples GROUP BY 1""", "samples"))
def q_flops_estimate(spark, sf):
    s = FX.samples(spark, sf)
    fl = M.forward_flops(F.col("response_length"), **MODEL)
    return s.groupBy(F.year("finished_at").alias("rollout_id")).agg(F.sum(fl).cast("bigint").alias("fwd_flops"))


# U6 -------------------------------------------------------------------------
@register("stream_filter_refill", W("""
SELECT instance_id, uid FROM buffer_items
WHERE instance_id IN (SELECT instance_id FROM buffer_items GROUP BY instance_id
                      HAVING count(*) >= 8 AND max(reward) > min(reward))""", "buffer_items"))
def q_stream_filter_refill(spark, sf):
    kept, _ = SB.filter_groups_stream(SB.assemble_groups(SB.event_stream(spark, sf), group_size=8).filter("reason = 'complete'"), spark)
    return kept.select("instance_id", "uid")
