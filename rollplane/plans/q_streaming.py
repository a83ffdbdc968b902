"""Queries: the streaming buffer (U1-U3, U8) run with ``availableNow`` over
the ``events`` table of ``sf_dir`` as a file stream; results are read back
from their sinks as batch DataFrames.  With the whole table arriving in
one trigger, the batch twins below describe the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.fixtures import with_fixtures as W
from ..streaming import buffer as SB
from .registry import r6, register


# One trigger sees the whole table: a key's items make one group, numbered by its first item's time.
_GROUPS = """
, g AS (SELECT instance_id, count(*) AS n, epoch_us(min(ts)) // 1000 AS group_seq, epoch_us(max(ts)) // 1000 AS last FROM buffer_items GROUP BY instance_id),
m AS (SELECT epoch_us(max(ts)) // 1000 AS top FROM buffer_items)
SELECT b.instance_id, g.group_seq, b.uid, CAST(g.n AS INTEGER) AS group_size, CASE WHEN g.n >= 8 THEN 'complete' ELSE 'timeout' END AS reason
FROM buffer_items b JOIN g ON g.instance_id = b.instance_id, m
"""


@register("group_assembler", W(_GROUPS + "WHERE g.n >= 8", "buffer_items"))
def q_group_assembler(spark, sf):
    out = SB.run_to_table(SB.assemble_groups(SB.event_stream(spark, sf), group_size=8), spark, "group_assembler")
    return out.filter("reason = 'complete'").select("instance_id", "group_seq", "uid", "group_size", "reason")


# the last trigger's watermark is a day behind the newest item; a group is late when its own day had passed by then
@register("group_timeout", W(_GROUPS + "WHERE g.n >= 8 OR g.last + 86400000 < m.top - 86400000", "buffer_items"))
def q_group_timeout(spark, sf):
    out = SB.run_to_table(SB.assemble_groups(SB.event_stream(spark, sf), group_size=8, timeout="1 day"),
                          spark, "group_timeout")
    return out.select("instance_id", "group_seq", "uid", "group_size", "reason")


@register("poll_stats", W("""
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS total_samples, count(DISTINCT instance_id) AS num_groups,
       round(count(*) / count(DISTINCT instance_id), 6) AS avg_group_size, round(avg(reward), 6) AS avg_reward
FROM buffer_items""", "buffer_items"))
def q_poll_stats(spark, sf):
    s = SB.poll_stats(SB.event_stream(spark, sf), spark)
    return s.select("batch_id", "total_samples", "num_groups", r6("avg_group_size").alias("avg_group_size"),
                    r6("avg_reward").alias("avg_reward"))


@register("stream_metrics", W("""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_samples,
       round(avg(reward), 6) AS reward_mean,
       round(avg(CASE WHEN finish_reason = 'length' THEN 1.0 ELSE 0.0 END), 6) AS truncated_ratio
FROM buffer_items GROUP BY 1""", "buffer_items"))
def q_stream_metrics(spark, sf):
    m = SB.stream_metrics(SB.event_stream(spark, sf), spark)
    return m.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n_samples",
                    r6("reward_mean").alias("reward_mean"), r6("truncated_ratio").alias("truncated_ratio"))


@register("partial_recycle", W("""
SELECT instance_id, uid, CAST(0 AS BIGINT) AS start_rollout_id FROM buffer_items
WHERE instance_id IN (SELECT instance_id FROM buffer_items GROUP BY instance_id
                      HAVING count(*) >= 8 AND bool_or(finish_reason = 'abort'))""", "buffer_items"))
def q_partial_recycle(spark, sf):
    groups = SB.assemble_groups(SB.event_stream(spark, sf), group_size=8).filter("reason = 'complete'")
    buffer = SB.PartialRollouts(spark, groups.schema).run(groups).buffer()
    return buffer.select("instance_id", "uid", "start_rollout_id")


@register("collect_until_target", W("""
, g AS (SELECT instance_id, max(ts) AS done_at FROM buffer_items GROUP BY instance_id HAVING count(*) >= 8),
r AS (SELECT instance_id, row_number() OVER (ORDER BY done_at, instance_id) - 1 AS r FROM g)
SELECT b.instance_id, b.uid FROM buffer_items b JOIN r ON b.instance_id = r.instance_id WHERE r.r < 50""", "buffer_items"))
def q_collect_until_target(spark, sf):
    groups = SB.assemble_groups(SB.event_stream(spark, sf), group_size=8).filter("reason = 'complete'")
    taken, _ = SB.collect_until_target(groups, spark, 50)
    return taken.select("instance_id", "uid")
