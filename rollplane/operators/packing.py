"""Sequence packing (G15-G18): one row per pack with flat token arrays and
``cu_seqlens``; the inverse; padding; zigzag context-parallel shards.

A pack is bounded by the token budget per device, so collecting its
members is a bounded group; the pack assignment itself comes from the
balancing operators (G10-G14) or any part column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _prefix_offsets(lengths: Column) -> Column:
    """[0, l0, l0+l1, ...] (cu_seqlens) of an int array."""
    return F.aggregate(lengths, F.array(F.lit(0)),
                       lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def _field(name: str):
    return lambda e: e[name]


def pack_sequences(df: DataFrame, *, part_cols: Sequence[str], order_col: str, tokens: str = "tokens",
                   loss_mask: str = "loss_mask", per_token: Sequence[str] = (),
                   per_sample: Sequence[str] = ("reward", "response_length")) -> DataFrame:
    """Concatenate the members of each part in ``order_col`` order: tokens,
    position ids (0..len-1 per member), loss masks, ``cu_seqlens``, the
    response-aligned arrays in ``per_token`` and per-sample lists."""
    fields = [order_col, tokens, loss_mask, *per_token, *per_sample]
    st = F.struct(*[F.col(c) for c in dict.fromkeys(fields)])
    g = df.groupBy(*part_cols).agg(F.array_sort(F.collect_list(st)).alias("_m"))
    m = F.col("_m")
    lens = F.transform(m, lambda e: F.size(e[tokens]))
    cols = [*part_cols,
            F.transform(m, lambda e: e[order_col]).alias("members"),
            F.flatten(F.transform(m, lambda e: e[tokens])).alias("tokens"),
            F.flatten(F.transform(m, lambda e: F.sequence(F.lit(0), F.size(e[tokens]) - 1))).alias("position_ids"),
            F.flatten(F.transform(m, lambda e: e[loss_mask])).alias("loss_masks"),
            _prefix_offsets(lens).alias("cu_seqlens")]
    cols += [F.flatten(F.transform(m, _field(c))).alias(c) for c in per_token]
    cols += [F.transform(m, _field(c)).alias(c + "_list") for c in per_sample]
    return g.select(*cols)


def unpack_sequences(packs: DataFrame, *, part_cols: Sequence[str], order_alias: str = "member",
                     per_token: Sequence[str] = (), response_lengths: str = "response_length_list") -> DataFrame:
    """Inverse of ``pack_sequences``: one row per member; tokens and position
    ids sliced by ``cu_seqlens``; response-aligned arrays (masks and
    ``per_token``) sliced by cumulative response lengths."""
    rl = F.col(response_lengths)
    ex = packs.select("*", F.posexplode("members").alias("_i", order_alias))
    i = F.col("_i")
    start = F.element_at("cu_seqlens", i + 1)
    end = F.element_at("cu_seqlens", i + 2)
    rstart = F.aggregate(F.slice(rl, 1, i), F.lit(0).cast("bigint"), lambda a, x: a + x)
    rlen = F.element_at(rl, i + 1)
    out = [*[F.col(c) for c in part_cols], F.col(order_alias),
           F.slice("tokens", start + 1, end - start).alias("tokens"),
           F.slice("position_ids", start + 1, end - start).alias("position_ids"),
           F.slice("loss_masks", (rstart + 1).cast("int"), rlen.cast("int")).alias("loss_mask"),
           rlen.alias("response_length")]
    out += [F.slice(c, (rstart + 1).cast("int"), rlen.cast("int")).alias(c) for c in per_token]
    return ex.select(*out)


def pad_to_multiple(packs: DataFrame, multiple: int, *, arrays: Sequence[str] = ("tokens", "position_ids", "loss_masks"),
                    length_of: str = "tokens", new_boundary: bool = False) -> DataFrame:
    """Pad flat arrays with 0 to a multiple of ``multiple``; the last
    ``cu_seqlens`` entry absorbs the padding, or with ``new_boundary`` the padding (if any) is a
    sequence of its own with an entry of its own."""
    n = F.size(length_of)
    pad = (F.lit(multiple) - n % multiple) % multiple
    out = packs.withColumn("_pad", pad)
    for c in arrays:
        out = out.withColumn(c, F.concat(F.col(c), F.array_repeat(F.lit(0), F.col("_pad"))))
    cu = F.col("cu_seqlens")
    end = F.array(F.element_at(cu, -1) + F.col("_pad"))
    if new_boundary:
        out = out.withColumn("cu_seqlens", F.when(F.col("_pad") > 0, F.concat(cu, end)).otherwise(cu))
    else:
        out = out.withColumn("cu_seqlens", F.concat(F.slice(cu, 1, F.size(cu) - 1), end))
    return out.withColumnRenamed("_pad", "pad_length")


def zigzag_shard(df: DataFrame, *, tokens: str, cp_size: int, keep: Sequence[str] = ()) -> DataFrame:
    """Pad to 2*cp chunks; shard r holds chunks r and 2*cp-1-r."""
    n = F.size(tokens)
    chunk = F.ceil(n / (2 * cp_size)).cast("int")
    padded = F.concat(F.col(tokens), F.array_repeat(F.lit(0), chunk * (2 * cp_size) - n))
    ex = df.select(*keep, padded.alias("_p"), chunk.alias("_c"),
                   F.explode(F.sequence(F.lit(0), F.lit(cp_size - 1))).alias("cp_rank"))
    r, c = F.col("cp_rank"), F.col("_c")
    first = F.slice("_p", r * c + 1, c)
    second = F.slice("_p", (F.lit(2 * cp_size - 1) - r) * c + 1, c)
    return ex.select(*keep, "cp_rank", F.concat(first, second).alias("shard"), c.alias("chunk_len"))


def zigzag_offsets(df: DataFrame, *, total_length: str, response_length: str, cp_size: int, keep: Sequence[str] = ()) -> DataFrame:
    """Per context-parallel rank its two chunks of the sequence, and of each the positions whose logits predict
    response tokens and those tokens (half-open, from the start of the prompt; 0 to 0 where a chunk has none).
    The logit before a token predicts it, so the logits are those from the last prompt position to the last but one."""
    total, prompt = F.col(total_length), F.col(total_length) - F.col(response_length)
    chunk = F.ceil(total / (2 * cp_size)).cast("int")
    rank = F.col("cp_rank")

    def part(number: Column, i: int) -> list[Column]:
        start, end = number * chunk, (number + 1) * chunk
        first, last = F.greatest(start, (prompt - 1).cast("int")), F.least(end, (total - 1).cast("int"))
        some = first < last
        at = lambda c: F.when(some, c).otherwise(0)
        return [start.alias(f"chunk{i}_start"), end.alias(f"chunk{i}_end"), at(first).alias(f"logits{i}_start"), at(last).alias(f"logits{i}_end"),
                at(first + 1).alias(f"tokens{i}_start"), at(last + 1).alias(f"tokens{i}_end")]

    ranks = df.select(*keep, total_length, response_length, F.explode(F.sequence(F.lit(0), F.lit(cp_size - 1))).alias("cp_rank"))
    return ranks.select(*keep, "cp_rank", chunk.alias("chunk_len"), *part(rank, 0), *part(F.lit(2 * cp_size - 1) - rank, 1))


def zigzag_gather(shards: DataFrame, *, keys: Sequence[str], cp_size: int, total_len: str) -> DataFrame:
    """Inverse of ``zigzag_shard``: reassemble and cut the padding."""
    g = shards.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("cp_rank", "shard", "chunk_len"))).alias("_s"),
                                  F.first(total_len).alias(total_len))
    firsts = F.flatten(F.transform("_s", lambda e: F.slice(e["shard"], 1, e["chunk_len"])))
    seconds = F.flatten(F.reverse(F.transform("_s", lambda e: F.slice(e["shard"], e["chunk_len"] + 1, e["chunk_len"]))))
    return g.select(*keys, F.slice(F.concat(firsts, seconds), 1, F.col(total_len)).alias("tokens"))
