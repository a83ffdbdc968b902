"""K-d tree sharding by bytes over document metadata (DataFrame functions only).

Every tree level is a handful of aggregations over a narrow, written metadata
table: the widest dimension of each node (range relative to the whole table),
then the weighted median along it by histograms (``common.weighted_cuts``).
The driver holds nothing; a node with s shards splits s//2 : s - s//2, so any
shard count works and the leaves hold equal bytes up to one row and ``slack``.

Defined cases: null text weighs ``row_overhead`` and has checksum 0; a null
dimension sorts below all values; ties on a dimension are broken by a hash of
(id, size, checksum), then by row, so repeated rows split too; fewer rows than
shards leave shards empty; an empty table gives no rows; other columns of the
input are ignored; texts of any length are measured whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import index_within_group
from .common import below_cut, weighted_cuts, written

# Share of a node's target that its boundary histogram bucket may weigh before it is refined no further.
SLACK = 0.0005


def string_dim(c: Column) -> Column:
    """Order-preserving long of a short metadata string (its first 7 UTF-8
    bytes; longer ones tie and the tie keys decide). Null: -1."""
    h = F.rpad(F.hex(F.substring(F.encode(c, "utf-8"), 1, 7)), 14, "0")
    return F.coalesce(F.conv(h, 16, 10).cast("long"), F.lit(-1).cast("long"))


def long_dim(c: Column) -> Column:
    """Long within +-2^61 in the same order (neighbours may tie). Null: lowest."""
    return F.coalesce(F.shiftright(c.cast("long"), 2), F.lit(-(1 << 61)).cast("long"))


def metadata(docs: DataFrame, dims: Sequence[Column], id_col: str = "doc_id", text_col: str = "text",
             row_overhead: int = 8) -> DataFrame:
    """The only pass over the texts: id, size, checksum and the dimensions as
    longs, written once. ``rid`` makes every row unique and is stable once written."""
    text = F.col(text_col)
    cols = [F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + row_overhead).cast("long").alias("size"),
            F.coalesce(F.crc32(F.encode(text, "utf-8")), F.lit(0)).cast("long").alias("text_crc32")]
    cols += [d.cast("long").alias(f"d{i}") for i, d in enumerate(dims)]
    m = docs.select(*cols)
    return written(m.withColumn("tie", F.shiftright(F.xxhash64("doc_id", "size", "text_crc32"), 2))
                    .withColumn("rid", F.monotonically_increasing_id()), "shardmeta")


def _halve(nodes: dict[int, int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for first, n in nodes.items():
        if n == 1:
            out[first] = 1
        else:
            out[first], out[first + n // 2] = n // 2, n - n // 2
    return out


def kd_assign(meta: DataFrame, n_dims: int, n_shards: int) -> DataFrame:
    """Add ``g``, the shard. A node is named by its first shard; ``n`` is how
    many shards it still holds."""
    rows = meta.withColumn("g", F.lit(0)).withColumn("n", F.lit(n_shards))
    ranges = [f(f"d{i}").alias(f"{a}{i}") for i in range(n_dims) for a, f in (("lo", F.min), ("hi", F.max))]
    whole = meta.agg(*ranges).first()
    spans = [max(1, (whole[f"hi{i}"] or 0) - (whole[f"lo{i}"] or 0)) for i in range(n_dims)]
    nodes = {0: n_shards}
    while max(nodes.values()) > 1:
        open_rows = rows.filter("n > 1")
        node = open_rows.groupBy("g", "n").agg(F.sum("size").alias("total"), *ranges)
        spread = [((F.col(f"hi{i}").cast("double") - F.col(f"lo{i}")) / F.lit(float(spans[i]))).alias(f"s{i}")
                  for i in range(n_dims)]
        node = node.select("g", "n", (F.col("total") * F.expr("n div 2") / F.col("n")).alias("target"), *spread)
        widest = F.greatest(*[f"s{i}" for i in range(n_dims)]) if n_dims > 1 else F.col("s0")
        dim = F.coalesce(*[F.when(F.col(f"s{i}") == widest, F.lit(i)) for i in range(n_dims)])
        node = written(node.select("g", "target", dim.alias("dim")), "kdnode")
        key = F.coalesce(*[F.when(F.col("dim") == i, F.col(f"d{i}")) for i in range(n_dims)])
        keyed = open_rows.join(node.select("g", "dim"), "g").withColumn("k", key)
        cuts = weighted_cuts(keyed, node.select("g", "target"), ["k", "tie", "rid"], "size", slack=SLACK)
        cut = node.select("g", "dim").join(cuts, "g")
        left = F.expr("n div 2")
        above = F.col("c0").isNotNull() & ~below_cut([key, "tie", "rid"], ["c0", "c1", "c2"])
        rows = (rows.join(written(cut, "kdcut"), "g", "left")
                    .withColumn("_l", left)
                    .withColumn("_up", F.coalesce(above, F.lit(False)))
                    .withColumn("g", F.when(F.col("_up"), F.col("g") + F.col("_l")).otherwise(F.col("g")))
                    .withColumn("n", F.when(F.col("n") == 1, 1).when(F.col("_up"), F.col("n") - F.col("_l"))
                                .otherwise(F.col("_l")))
                    .drop("dim", "c0", "c1", "c2", "_l", "_up"))
        nodes = _halve(nodes)
    return rows.drop("n")


def kd_shards(docs: DataFrame, dims: Sequence[Column], n_shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (0.. within the shard, by id). Give
    ``n_shards``, or ``target_bytes`` and the tree splits until leaves reach it."""
    meta = metadata(docs, dims, id_col, text_col)
    if n_shards is None:
        total = meta.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, -(-total // int(target_bytes)))
    shards = kd_assign(meta, len(dims), n_shards).select(
        "doc_id", "size", "text_crc32", F.col("g").cast("int").alias("shard"), "rid")
    return index_within_group(shards, ["shard"], [F.col("doc_id").asc_nulls_first(), F.col("rid")], "slot").drop("rid")


def op1_kd_shards(spark, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of near-equal bytes."""
    from ..sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents")
    dims = [string_dim(F.col("source")), string_dim(F.col("lang")), long_dim(F.col("n_chars")), long_dim(F.col("doc_id"))]
    out = kd_shards(docs, dims, n_shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
