"""SimHash near-duplicates by a segment-popcount embedding and a Manhattan grid join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, connected_components, cut, small

SEED = 42
SHINGLE = 3
RADIUS = 2
#: Distinct fingerprints of a grid cell that are still compared pair by pair.
CELL_LIMIT = 64
#: Hashes expanded to bits at a time; bounds a worker's memory for very long texts.
HASHES_AT_ONCE = 65_536

_LOW = 0x5555555555555555
_BLOCKS = 4
_ALL = (1 << 64) - 1


def fingerprint(text: str | None) -> int:
    """Majority fingerprint of a text's word shingles, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = min(SHINGLE, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    last = len(words) - n + 1
    count = np.zeros(64, np.int64)
    for at in range(0, last, HASHES_AT_ONCE):
        to = min(last, at + HASHES_AT_ONCE)
        spans = zip(starts[at:to].tolist(), ends[at + n - 1 : to + n - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, to - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits(2 * count > last, bitorder="little")
    return int(on.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, *carry): the fingerprint as a signed long. A null text has none: zero."""

    def batches(it):
        for batch in it:
            found = [fingerprint(t.as_py()) for t in batch.column(1)]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps, *batch.columns[2:]], ["doc_id", "fp", *carry])

    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carry)
    more = "".join(f", {c} {slim.schema[c].dataType.simpleString()}" for c in carry)
    return slim.mapInArrow(batches, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp long{more}")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embed(fp: Column) -> Column:
    """Popcounts of the 32 two-bit segments, each in unary (0, 1, 11), in one long.

    The Manhattan distance of two such vectors is bit_count(a ^ b), and it never
    exceeds the Hamming distance of the fingerprints.
    """
    low, high = fp.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def near_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within RADIUS bits.

    ``fps`` has distinct ``fp``. Two vectors within Manhattan distance 2 differ in
    at most two of four blocks of segments, so they agree on some two blocks: the
    six projections on two blocks are grids whose cells hold every such pair.
    Cells of up to CELL_LIMIT vectors are joined with themselves: the Manhattan
    bound first, then the exact distance. In a larger cell each fingerprint is
    put under itself and its 64 one-bit neighbours instead; fingerprints at
    distance 2 or less meet under one of them, under which at most 65 can meet.
    That takes 65 rows a fingerprint, whatever the cell's size, and loses no link.
    """
    points = fps.select("fp", embed(F.col("fp")).alias("vector"))
    masks = [
        _signed(sum(0xFFFF << (16 * k) for k in (i, j)))
        for i in range(_BLOCKS)
        for j in range(i + 1, _BLOCKS)
    ]
    grid = points.select(
        "fp",
        "vector",
        F.posexplode(F.array(*[F.col("vector").bitwiseAND(F.lit(m)) for m in masks])).alias("grid", "cell"),
    )
    sizes = grid.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    crowded = cut(grid.join(sizes, ["grid", "cell"]))
    small = crowded.where(F.col("n") <= CELL_LIMIT).select("grid", "cell", "fp", "vector")
    other = small.select("grid", "cell", F.col("fp").alias("fp2"), F.col("vector").alias("vector2"))
    pairs = (
        small.join(other, ["grid", "cell"])
        .where("fp < fp2")
        .where(F.bit_count(F.col("vector").bitwiseXOR(F.col("vector2"))) <= RADIUS)
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS)
        .select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    )
    flips = F.array(*[F.lit(_signed(1 << i)) for i in range(64)], F.lit(0))
    balls = (
        crowded.where(F.col("n") > CELL_LIMIT)
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("centre"))
    )
    low = balls.groupBy("centre").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z")
    stars = balls.join(low, "centre").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    Equal fingerprints are one node; only distinct ones are compared. Documents
    without a word (null, empty or blank) have fingerprint zero and are linked
    like any other. Repeated rows come out as often as they went in; an empty
    table gives an empty result; other columns are ignored.
    """
    marked = cut(fingerprints(docs, id_col, text_col))
    classes = _classes(cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"))))
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "class").select("fp", "component_id")
    return marked.join(small(named), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(nodes: DataFrame) -> DataFrame:
    """The rows of ``nodes``, one a fingerprint, with the class that links put it into."""
    joined = connected_components(near_links(nodes.select("fp")), "a", "b")
    return nodes.join(joined, nodes.fp == joined.node, "left").select(*nodes.columns, F.coalesce("component", "fp").alias("class"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of linked fingerprints: that with the smallest doc_id, then text hash.

    Rows are told apart by doc_id and a 128-bit key of the text; of rows equal in both
    one stays. Rows without an id take part and come last in a component. Columns pass
    through whatever their names; an empty table gives an empty result.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = F.struct(
        F.isnull("row.doc_id").alias("none"), F.col("row.doc_id").alias("doc_id"),
        F.xxhash64("row.text").alias("x"), F.xxhash64(F.lit("text"), "row.text").alias("y"),
    )
    rows = rows.withColumn("own", own)
    marked = cut(fingerprints(rows, "row.doc_id", "row.text", ("own",)))
    classes = _classes(cut(marked.groupBy("fp").agg(F.min("own").alias("own"))))
    keep = cut(classes.groupBy("class").agg(F.min("own").alias("own")).select("own"))
    kept = rows.join(small(keep), "own", "left_semi")
    again = small(marked.groupBy("own").agg(F.count("*").alias("n")).where("n > 1").select("own"))
    if again.isEmpty():
        return kept.select("row.*")
    once, twice = kept.join(again, "own", "left_anti"), kept.join(again, "own", "left_semi")
    return once.union(twice.dropDuplicates(["own"])).select("row.*")
