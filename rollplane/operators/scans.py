"""Discounted suffix sums y_t = x_t + w * y_{t+1} over array columns, and over trajectories cut into segments.

``discounted_sums`` and ``gae`` are Arrow functions: only the arrays they need go to Python, whole batches
at a time. Short arrays of a batch advance together, one position from the end after another; a long array
is a matrix of chunks, multiplied by the triangle of powers, whose rows are joined by a carried value.

``segmented_sums`` joins a trajectory that lies in many rows (and tasks): over a segment of n tokens the scan is the affine map
carry -> y_first + w^n * carry. One row per segment (its n and y_first) makes the carry table; the segments
are scanned again with their carries, each in its own row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

CHUNK, LONG = 256, 4096


def _arrow(fn, kind):
    """An Arrow function that stays a column of its own: a deterministic one would be moved into the lambdas that
    read it, where it cannot run. Its inputs are named twice: an input used once is moved into the call, and Spark does
    not extract a call whose arguments hold nested lambdas (equal arguments are sent once)."""
    call = F.arrow_udf(lambda *args: fn(*args[:len(args) // 2]), kind).asNondeterministic()
    return lambda *columns: call(*columns, *columns)


def _triangle(w: float) -> np.ndarray:
    power = np.arange(CHUNK)[None, :] - np.arange(CHUNK)[:, None]
    return np.where(power >= 0, np.power(w, np.clip(power, 0, None).astype(float)), 0.0)


def _long_sums(x: np.ndarray, w: float, carry: float = 0.0) -> np.ndarray:
    rows = -(-len(x) // CHUNK)
    padded = np.zeros(rows * CHUNK)
    padded[rows * CHUNK - len(x):] = x
    y = padded.reshape(rows, CHUNK) @ _triangle(w).T
    step, carries = w ** CHUNK, np.empty(rows)
    for r in range(rows - 1, -1, -1):
        carries[r] = carry
        carry = y[r, 0] + step * carry
    y += carries[:, None] * np.power(w, np.arange(CHUNK, 0, -1).astype(float))
    return y.reshape(-1)[rows * CHUNK - len(x):]


def sums_of_runs(x: np.ndarray, off: np.ndarray, w: float, carry: np.ndarray | None = None) -> np.ndarray:
    """The suffix sums inside each of the runs off[i]:off[i+1]; ``carry``: each run's y behind its end."""
    lens = np.diff(off)
    carry = np.zeros(len(lens)) if carry is None else carry
    y = np.empty(len(x))
    for i in np.flatnonzero(lens > LONG).tolist():
        y[off[i]:off[i + 1]] = _long_sums(x[off[i]:off[i + 1]], w, carry[i])
    short = np.flatnonzero(lens <= LONG)
    longest_first = short[np.argsort(-lens[short], kind="stable")]
    ends, n, run = off[1:][longest_first], lens[longest_first], carry[longest_first].astype(float)
    active = len(n)
    for back in range(1, int(n[0]) + 1 if len(n) else 0):
        while active and n[active - 1] < back:
            active -= 1
        at = ends[:active] - back
        run[:active] = x[at] + w * run[:active]
        y[at] = run[:active]
    return y


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values as doubles and offsets from 0."""
    off = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(off[0], off[-1] - off[0]).to_numpy(zero_copy_only=False).astype(np.float64), off - off[0]


def _lists(off: np.ndarray, y: np.ndarray, null: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(y), mask=null)


def discounted_sums(x: Column | str, w: float) -> Column:
    """array<double> of the suffix sums of an array (null stays null)."""
    def run(lists: pa.Array) -> pa.Array:
        flat, off = _flat(lists)
        return _lists(off, sums_of_runs(flat, off, w), lists.is_null())
    return _arrow(run, T.ArrayType(T.DoubleType()))(x)


def gae(rewards: Column | str, values: Column | str, gamma: float, lambd: float) -> Column:
    """struct(advantages, returns): delta_t = r_t + gamma * V_{t+1} - V_t (V behind the end = 0), A_t = delta_t + gamma * lambda * A_{t+1},
    R = A + V. A null array gives nulls; arrays of different lengths are an error."""
    def run(r: pa.Array, v: pa.Array) -> pa.Array:
        null = pa.compute.or_(r.is_null(), v.is_null())
        r, v = (pa.compute.if_else(null, pa.scalar([], x.type), x) if null.true_count else x for x in (r, v))
        (reward, off), (value, other) = _flat(r), _flat(v)
        if (off != other).any():
            raise ValueError("rewards and values have different lengths")
        after = np.append(value[1:], 0.0)[:len(value)]
        last = off[1:][np.diff(off) > 0] - 1
        after[last] = 0.0
        adv = sums_of_runs(reward + gamma * after - value, off, gamma * lambd)
        return pa.StructArray.from_arrays([_lists(off, adv, null), _lists(off, adv + value, null)], ["advantages", "returns"])
    kind = T.StructType([T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("advantages", "returns")])
    return _arrow(run, kind)(rewards, values)


def segmented_sums(df: DataFrame, *, keys: Sequence[str], segment: str, x: str, out: str, w: float) -> DataFrame:
    """Add ``out``: the suffix sums of each trajectory (``keys``), whose tokens lie in rows numbered by ``segment`` (ascending, any
    gaps). A null or empty segment has no tokens. The carry table has a row per segment; a trajectory's rows of it are folded
    in one place (its tokens / its segment size)."""
    keys = list(keys)
    y = discounted_sums(x, w)
    part = df.select(*keys, F.col(segment).alias("_seg"), F.coalesce(F.size(x), F.lit(0)).alias("_n"), y.alias("_y"))
    part = part.select(*keys, "_seg", F.greatest("_n", F.lit(0)).alias("_n"), F.coalesce(F.get("_y", F.lit(0)), F.lit(0.0)).alias("_first"))

    def fold(segments: pa.Array) -> pa.Array:
        """Carries of the segments of each trajectory, in order."""
        flat = segments.flatten()
        n, first = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("_n", "_first"))
        off = segments.offsets.to_numpy() - segments.offsets[0].as_py()
        carry = np.zeros(len(n))
        for a, b in zip(off.tolist(), off[1:].tolist()):
            run = 0.0
            for i in range(b - 1, a - 1, -1):
                carry[i] = run
                run = first[i] + w ** float(n[i]) * run
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(carry))

    per = part.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_seg", "_n", "_first"))).alias("_s"))
    per = per.withColumn("_c", _arrow(fold, T.ArrayType(T.DoubleType()))("_s"))
    names = [f"_k{i}" for i in range(len(keys))]
    carries = (per.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.explode(F.arrays_zip(F.col("_s._seg").alias("s"), F.col("_c").alias("c"))).alias("_z"))
                  .select(*names, F.col("_z.s").alias("_seg"), F.col("_z.c").alias("_carry")))
    on = F.col(segment).eqNullSafe(F.col("_seg"))
    for k, n in zip(keys, names):
        on = on & F.col(k).eqNullSafe(F.col(n))

    def scan(lists: pa.Array, carry: pa.Array) -> pa.Array:
        flat, off = _flat(lists)
        return _lists(off, sums_of_runs(flat, off, w, carry.to_numpy(zero_copy_only=False)), lists.is_null())

    return (df.join(carries, on).withColumn(out, _arrow(scan, T.ArrayType(T.DoubleType()))(x, "_carry"))
              .drop("_seg", "_carry", *names))


def segmented_gae(df: DataFrame, *, keys: Sequence[str], segment: str, rewards: str, values: str, gamma: float, lambd: float) -> DataFrame:
    """Add ``advantages`` and ``returns`` of trajectories whose tokens lie in several rows: a segment's last delta takes the first
    value of the next segment that has tokens."""
    from pyspark.sql import Window as W
    tail = W.partitionBy(*keys).orderBy(segment).rowsBetween(1, W.unboundedFollowing)
    # one number per segment is moved to the segment before
    small = df.select(*keys, segment, F.get(values, F.lit(0)).alias("_v0"))
    after = small.withColumn("_after", F.coalesce(F.first("_v0", ignorenulls=True).over(tail), F.lit(0.0))).drop("_v0")
    j = df.join(after, [*keys, segment])

    def deltas(r: pa.Array, v: pa.Array, nxt: pa.Array) -> pa.Array:
        (reward, off), (value, _) = _flat(r), _flat(v)
        ahead = np.append(value[1:], 0.0)[:len(value)]
        full = np.diff(off) > 0
        ahead[off[1:][full] - 1] = nxt.to_numpy(zero_copy_only=False)[full]
        return _lists(off, reward + gamma * ahead - value, r.is_null())

    d = j.withColumn("_d", _arrow(deltas, T.ArrayType(T.DoubleType()))(rewards, values, "_after"))
    d = segmented_sums(d, keys=keys, segment=segment, x="_d", out="advantages", w=gamma * lambd)
    return d.withColumn("returns", F.zip_with("advantages", values, lambda a, b: a + b)).drop("_d", "_after")
