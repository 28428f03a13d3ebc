"""Sharding by proportional stratified interleaving.

Within each source rows are shuffled by a seeded hash and ranked; the row of rank r among n has the fractional rank
(2 r - 1) / (2 n). All rows are then ordered by fractional rank, and the order is cut into shards of equal counts (at most one
apart), so each shard has every source in the mixture of the whole.

Ranks come without a global sort or one task for a source: the hash (and later the fractional rank) is cut into slices, slices
are counted, a running sum over the counts gives the rows before each slice, and rows are numbered inside a slice only.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import unused, written

#: Rows that a slice has on average, at least; in large tables the square root of all rows, so that counts stay few.
SLICE = 5000


def numbered(rows: DataFrame, strata: list[str], slice_of: Column, order: list[Column], number: str, total: str) -> DataFrame:
    """rows with number (1, 2, ... in each stratum, by slice and then by order) and total (rows of the stratum)."""
    cut = rows.withColumn("__slice", slice_of)
    counts = cut.groupBy(*strata, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*strata).orderBy("__slice")
    ahead = counts.select(
        *strata,
        "__slice",
        (F.sum("__n").over(before) - F.col("__n")).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*strata)).alias(total),
    )
    inside = cut.withColumn("__at", F.row_number().over(Window.partitionBy(*strata, "__slice").orderBy(*order)))
    return inside.join(ahead, [*strata, "__slice"]).withColumn(number, F.col("__at") + F.col("__before")).drop("__slice", "__at", "__before", "__n")


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: int = 11) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (its place in the shard, gapless from 0, in fractional-rank order) for each row.

    The law is `rows`: counts differ by one at most. docs has doc_id, text and source. A null source is a source of its own. Rows are ordered
    within a source by the md5 of seed, id and the text's CRC; rows that share both take their places in any order. Equal texts
    aren't kept together: they are dealt like other rows. Columns of docs named shard or slot are replaced. A very long text is a row
    like any other. An empty table gives an empty table.

    The rows are written to the shared folder once with a number each; places are found on a few bytes a row, and the rows are moved
    once, to their places.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    row, crc, size = (unused(name, docs.columns) for name in ("row", "crc", "size"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(docs.select(*(F.col(f"`{c}`") for c in kept), F.monotonically_increasing_id().alias(row), F.crc32(text.cast("binary")).alias(crc), (F.octet_length(text) + 1).cast("long").alias(size)))
    light = rows.select(F.col(row).alias("row"), "doc_id", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"), F.col(crc).alias("text_crc32"), F.col(size).alias("size"))
    placed = places(light, shards, seed).select(F.col("row").alias(row), "shard", "slot")
    return rows.join(placed, row).select(*(F.col(f"`{c}`") for c in kept), "shard", "slot")


def places(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """(row, shard, slot) of rows (row, doc_id, source, text_crc32, size)."""
    total = rows.count()
    slices = max(1, total // max(SLICE, isqrt(total)))
    hashed = lambda *of: F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in of)).cast("binary"))
    rows = rows.withColumn("__hash", hashed("doc_id", "text_crc32"))
    # the hash's first 32 bits as a share of their range, cut into slices
    by_hash = F.floor(F.conv(F.substring("__hash", 1, 8), 16, 10).cast("long") * slices / 2**32)
    ranked = numbered(rows, ["source"], by_hash, [F.col("__hash"), F.col("doc_id"), F.col("size")], "__rank", "__rows")
    twice = F.col("__rank") * 2 - 1
    # whole-number arithmetic, so that equal fractions stay equal: the slice of (2 r - 1) / (2 n)
    by_share = F.floor(twice * slices / (F.col("__rows") * 2))
    order = [twice / (F.col("__rows") * 2), hashed("source"), F.col("__hash"), F.col("doc_id"), F.col("size")]
    ranked = written(ranked.withColumn("__all", F.lit(0)))
    placed = numbered(ranked, ["__all"], by_share, order, "__place", "__total")
    at = F.col("__place") - 1
    shard = F.expr(f"(__place * {shards} - 1) div __total").cast("int")
    # shard k begins at the first place p (from 0) with ((p + 1) * shards - 1) div total = k
    begin = F.expr(f"(shard * __total + {shards}) div {shards} - 1")
    found = placed.withColumn("shard", shard)
    return found.select("row", "shard", (at - F.when(F.col("shard") == 0, 0).otherwise(begin)).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One directory for each shard (shard=...), its files' rows in order of their slots. Every task writes what it has of each shard."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
