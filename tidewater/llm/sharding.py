"""Sampled-splitter sharding: size-weighted key samples, range partitions, split ranges."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import cut

#: Samples drawn for each range; the expected sample is bounded by ranges * this.
SAMPLES_PER_RANGE = 32
#: Rows that a range should hold at most, so that one task can sort it.
ROWS_PER_RANGE = 200_000
#: Ranges are never fewer than this many to a shard.
RANGES_PER_SHARD = 16
#: Ranges are never more than this; beyond it ranges grow and are subdivided.
MAX_RANGES = 60_000


def assign_shards(
    docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``bytes``: shards cover equal shares of the summed size along one total
    order, so their sizes differ by about one document. The order's key is a hash
    of the text, so equal texts are neighbours and share a shard unless a
    boundary falls among them.

    1. A digest row (id, size, checksum, key) is made of each document; only
       digests are shuffled, never texts.
    2. Keys are drawn with probability proportional to size; quantiles of that
       bounded sample are the splitters.
    3. A range that holds more than twice its share (a hot key, such as copies of
       one text) is subdivided by a hash of the id.
    4. Each range is sorted by itself; range totals give every document its exact
       place in the whole order, hence its shard and slot.

    Null texts count as empty with size 8; null ids are kept and sort first;
    repeated rows get a slot each; an empty table gives an empty result; other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        )
    )
    total, rows = digest.agg(F.sum("size"), F.count("*")).first()
    if not rows:
        total = 1
    ranges = min(MAX_RANGES, max(RANGES_PER_SHARD * n_shards, math.ceil(rows / ROWS_PER_RANGE)))
    splitters = _splitters(digest, total, ranges)
    ranged = digest.withColumn("range", _range_of(F.col("key"), splitters))

    # Ranges and their subdivisions are bounded by MAX_RANGES and by total / share.
    share = max(1, total // ranges)
    parts = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("range_size"))
        .select(
            "range",
            F.when(F.col("range_size") > 2 * share, F.ceil(F.col("range_size") / share))
            .otherwise(1)
            .cast("int")
            .alias("parts"),
        )
    )
    placed = ranged.join(F.broadcast(parts), "range").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("parts")).cast("int")
    )
    order = W.orderBy("range", "part")
    starts = (
        placed.groupBy("range", "part")
        .agg(F.sum("size").alias("part_size"), F.count("*").alias("part_rows"))
        .select(
            "range",
            "part",
            (F.sum("part_size").over(order) - F.col("part_size")).alias("bytes_before"),
            (F.sum("part_rows").over(order) - F.col("part_rows")).alias("rows_before"),
        )
    )
    within = W.partitionBy("range", "part").orderBy("key", "doc_id", "size", "text_crc32")
    ranked = (
        placed.withColumn("run", F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(starts), ["range", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            # The middle of the document's stretch of bytes decides.
            F.expr(
                f"cast(least({n_shards - 1}, ((bytes_before + run) * 2 - size) * {n_shards} div {2 * total}) as int)"
            ).alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("rank"),
        )
    )
    ranked = cut(ranked)
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _splitters(digest: DataFrame, total: int, ranges: int) -> list[int]:
    """At most ranges - 1 ascending keys, quantiles of a size-weighted sample."""
    wanted = ranges * SAMPLES_PER_RANGE
    draw = F.pmod(F.xxhash64("key", "doc_id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    drawn = [
        r[0]
        for r in digest.where(draw < F.col("size") * (wanted / total)).select("key").collect()
    ]
    drawn.sort()
    return sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []


def _range_of(key, splitters: list[int]):
    """Number of splitters at or below the key: a binary search unrolled over cells.

    The key's top bits name a cell; a literal array holds, for each cell, the
    splitters that fall into it, so a row is compared with a few of them only.
    """
    bits = 16 if len(splitters) > 4096 else 10
    shift, half = 64 - bits, 1 << (bits - 1)
    cells: list[list[int]] = [[] for _ in range(2 * half)]
    for s in splitters:
        cells[(s >> shift) + half].append(s)
    before, running = [], 0
    for c in cells:
        before.append(running)
        running += len(c)
    flat = ",".join(
        f"struct({b} as n, array({','.join(f'{s}L' if s != -(1 << 63) else f'(-{(1 << 63) - 1}L - 1L)' for s in c)}) as s)"
        if c
        else f"struct({b} as n, cast(array() as array<bigint>) as s)"
        for b, c in zip(before, cells, strict=True)
    )
    cell = F.get(F.expr(f"array({flat})"), F.shiftright(key, shift) + half)
    return F.transform(
        F.array(cell), lambda c: c["n"] + F.size(F.filter(c["s"], lambda s: s <= key))
    )[0].cast("int")
