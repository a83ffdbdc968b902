"""Streaming buffer over a multi-file event stream (one file per day =
one poll) against a plain-Python simulation of the polls."""

import datetime as dt
import os
from collections import defaultdict

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from rollplane.streaming import buffer as SB


@pytest.fixture(scope="module")
def day_files(tmp_path_factory):
    d = tmp_path_factory.mktemp("events")
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    days = pc.day(t["ts"])
    for day in sorted(set(days.to_pylist())):
        f = d / f"events_{day:02d}.parquet"
        pq.write_table(t.filter(pc.equal(days, day)), f)
        # the file source orders new files by modification time: one day per second
        os.utime(f, (1_700_000_000 + day, 1_700_000_000 + day))
    return str(d), t.to_pylist()


LONG = {"timeout": "400 days", "counter_ttl": "400 days"}  # nothing times out


def ms(ts):
    return int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def simulate(rows, group_size):
    by_day = defaultdict(list)
    for r in rows:
        by_day[r["ts"].day].append(r)
    buf, seq, out = defaultdict(list), {}, set()
    for day in sorted(by_day):
        fresh = set()
        for r in sorted(by_day[day], key=lambda r: (r["ts"], r["event_id"])):
            if not buf[r["user_id"]] and r["user_id"] not in fresh:
                seq[r["user_id"]] = max(seq.get(r["user_id"], -1) + 1, ms(r["ts"]))
            fresh.add(r["user_id"])
            buf[r["user_id"]].append(r["event_id"])
        for k in list(buf):
            if len(buf[k]) >= group_size:
                out |= {(k, seq[k], u) for u in buf[k]}
                buf[k] = []
    return out


def test_assembler_matches_polls(spark, day_files):
    path, rows = day_files
    s = SB.event_stream(spark, path, max_files_per_trigger=1)
    got = SB.run_to_table(SB.assemble_groups(s, group_size=8, **LONG), spark, "t_assemble")
    got = {(r["instance_id"], r["group_seq"], r["uid"]) for r in got.collect()}
    assert got == simulate(rows, 8)


def test_timeout_emits_stale_groups_once(spark, day_files):
    path, rows = day_files
    s = SB.event_stream(spark, path, max_files_per_trigger=1)
    got = SB.run_to_table(SB.assemble_groups(s, group_size=10_000, timeout="6 hours", watermark="1 hour"),
                          spark, "t_timeout").collect()
    assert got, "no group timed out"
    assert {r["reason"] for r in got} == {"timeout"}
    uids = [r["uid"] for r in got]
    assert len(uids) == len(set(uids))
    last_event = max(r["ts"] for r in rows)
    by_group = defaultdict(list)
    for r in got:
        by_group[(r["instance_id"], r["group_seq"])].append(r["ts"])
    for ts in by_group.values():
        # a group times out only after the watermark (max ts - 1 h) passed its last event + 6 h
        assert max(ts) + dt.timedelta(hours=7) <= last_event + dt.timedelta(seconds=1)
    keys = [(r["instance_id"], r["group_seq"]) for r in got]
    assert len(set(keys)) == len(by_group)


def test_poll_stats_per_trigger(spark, day_files):
    path, rows = day_files
    stats = SB.poll_stats(SB.event_stream(spark, path, max_files_per_trigger=1), spark).collect()
    assert sum(r["total_samples"] for r in stats) == len(rows)
    assert len(stats) == len({r["ts"].day for r in rows})


def test_collect_until_target_over_polls(spark, day_files):
    path, rows = day_files
    s = SB.event_stream(spark, path, max_files_per_trigger=1)
    taken, kept = SB.collect_until_target(SB.assemble_groups(s, group_size=8, **LONG), spark, 20)
    t = {(r["instance_id"], r["group_seq"]) for r in taken.collect()}
    k = {(r["instance_id"], r["group_seq"]) for r in kept.collect()}
    emitted = {(i, q) for i, q, _ in simulate(rows, 8)}
    assert len(t) == 20 and not (t & k) and (t | k) == emitted


def event_files(tmp_path, triggers):
    """One event file per trigger: rows (uid, instance, day, event type); returns the folder."""
    import pyarrow as pa
    d = tmp_path / "ev"
    d.mkdir()
    for i, rows in enumerate(triggers):
        t = pa.table({"event_id": pa.array([r[0] for r in rows], pa.int64()),
                      "ts": pa.array([dt.datetime(2024, 1, 1) + dt.timedelta(days=r[2]) for r in rows], pa.timestamp("us")),
                      "user_id": pa.array([r[1] for r in rows], pa.int64()), "event_type": [r[3] for r in rows],
                      "value": [float(r[0]) for r in rows], "props": [""] * len(rows)})
        pq.write_table(t, d / f"events_{i:02d}.parquet")
        os.utime(d / f"events_{i:02d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(d)


def test_group_numbers_rise_over_an_eviction(spark, tmp_path):
    # instance 1 fills a group, is idle far beyond the counter's time, and comes back twice; instance 2 keeps the clock going
    triggers = [[(1, 1, 0, "click"), (2, 1, 0, "click")], [(3, 2, 20, "click")], [(4, 2, 40, "click")], [(5, 2, 41, "click")],
                [(6, 1, 41.5, "click"), (7, 1, 41.5, "click")], [(8, 1, 41.5, "click"), (9, 1, 41.5, "click")], [(10, 2, 60, "click")]]
    s = SB.event_stream(spark, event_files(tmp_path, triggers), max_files_per_trigger=1)
    got = SB.run_to_table(SB.assemble_groups(s, group_size=2, timeout="1 day", counter_ttl="4 days"), spark, "t_evict").collect()
    mine = sorted({(r.group_seq, r.reason, tuple(sorted(x.uid for x in got if x.instance_id == 1 and x.group_seq == r.group_seq)))
                   for r in got if r.instance_id == 1})
    day = 86_400_000
    t0 = ms(dt.datetime(2024, 1, 1))
    assert mine == [(t0, "complete", (1, 2)), (t0 + int(41.5 * day), "complete", (6, 7)), (t0 + int(41.5 * day) + 1, "complete", (8, 9))]


def rollouts(batches, n, heal):
    """Plain version of PartialRollouts: batches of {key: [(uid, ts, reason)]}."""
    buf, done = [], {}
    for b, groups in enumerate(batches):
        waiting = sorted(buf, key=lambda g: (g["put"], max(x[1] for x in g["items"]), g["key"]))
        new = sorted(({"key": k, "items": v, "start": None} for k, v in groups.items()), key=lambda g: (max(x[1] for x in g["items"]), g["key"]))
        old = waiting[:n]
        take, rest = old + new[:n - len(old)], new[n - len(old):]
        buf = waiting[n:] + [g | {"put": b} for g in rest]
        for g in take:
            items = [(u, t, "stop" if r == "abort" and heal(u, b) else r) for u, t, r in g["items"]]
            if any(r == "abort" for *_, r in items):
                buf.append({"key": g["key"], "items": items, "start": b if g["start"] is None else g["start"], "put": b})
            else:
                done |= {(g["key"], u): (r, g["start"], b) for u, _, r in items}
    return done, {(g["key"], u): (r, g["start"]) for g in buf for u, _, r in g["items"]}


def test_recycled_groups_come_first_and_finish(spark, tmp_path):
    from pyspark.sql import functions as F
    uid, triggers = 0, []
    for b in range(5):
        rows = []
        for k in range(4):
            for _ in range(2):
                uid += 1
                rows.append((uid, 10 * b + k, b + uid / 1000, "error" if uid % 3 == 0 else "click"))
        triggers.append(rows)
    # an aborted item is finished by the rollout whose number it has modulo 3
    heal = lambda u, b: (u + b) % 3 == 2

    def generate(members, b):
        good = (F.col("finish_reason") == "abort") & ((F.col("uid") + b) % 3 == 2)
        return members.withColumn("finish_reason", F.when(good, "stop").otherwise(F.col("finish_reason")))

    s = SB.event_stream(spark, event_files(tmp_path, triggers), max_files_per_trigger=1)
    groups = SB.assemble_groups(s, group_size=2, **LONG)
    p = SB.PartialRollouts(spark, groups.schema, n=3, generate=generate).run(groups)
    first = {10 * b + k: ms(dt.datetime(2024, 1, 1) + dt.timedelta(days=min(r[2] for r in triggers[b] if r[1] == 10 * b + k)))
             for b in range(5) for k in range(4)}
    batches = [{(r[1], first[r[1]]): [(x[0], x[2], "abort" if x[3] == "error" else "stop") for x in rows if x[1] == r[1]] for r in rows}
               for rows in triggers]
    n_batches = 1 + max(int(f.split("=")[1]) for f in os.listdir(p.base.removeprefix("file:") + "/put") if "=" in f)
    batches += [{}] * (n_batches - len(batches))  # a trigger that only moved the watermark is a rollout, too
    done, left = rollouts(batches, 3, heal)
    def state():
        return ({((r.instance_id, r.group_seq), r.uid): (r.finish_reason, r.start_rollout_id, r.rollout_id) for r in p.done().collect()},
                {((r.instance_id, r.group_seq), r.uid): (r.finish_reason, r.start_rollout_id) for r in p.buffer().collect()})
    assert state() == (done, left)
    assert any(start is not None and start < b for _, start, b in done.values())  # a group came back and finished
    # a replayed last batch changes nothing
    last = spark.createDataFrame([(k, q, u, dt.datetime(2024, 1, 1) + dt.timedelta(days=t), float(u), r, 2, "complete")
                                  for (k, q), items in batches[-1].items() for u, t, r in items], groups.schema)
    p.rollout(last, n_batches - 1)
    assert state() == (done, left)
