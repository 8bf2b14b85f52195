"""Benchmark decontamination by winnowing: k-gram minima, fingerprint join, extension of hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, cut, let

WINDOW = 13
#: Words of a k-gram. A span of WINDOW words has WINDOW - GRAM + 1 of them, and the
#: minimum of every so many neighbours is kept, so each such span keeps one.
GRAM = 9
NEIGHBOURS = WINDOW - GRAM + 1
#: Benchmark fingerprints up to this count are compared inside the scan; more are joined.
INLINE_LIMIT = 100_000
#: Rows of the benchmark index up to which it may be broadcast (about 300 bytes each).
BROADCAST_LIMIT = 50_000

NON_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of a-z, 0-9 and characters beyond ASCII. Null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD)
    return F.filter(parts, lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    """Hash of the n-gram that starts at each position."""
    return F.when(
        F.size(words) >= n,
        F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n))),
    ).otherwise(F.array().cast("array<bigint>"))


def _minima(grams: Column, neighbours: int) -> Column:
    """The minimum of every run of ``neighbours`` hashes."""
    if neighbours == 1:
        return grams
    return F.when(
        F.size(grams) >= neighbours,
        F.transform(
            F.sequence(F.lit(1), F.size(grams) - (neighbours - 1)),
            lambda i: F.array_min(F.slice(grams, i, neighbours)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _kept(grams: Column, minima: Column, at: Column, neighbours: int) -> Column:
    """Whether winnowing keeps the hash at zero-based ``at``: it is the minimum of a run that holds it."""
    first = F.greatest(F.lit(0), at - (neighbours - 1))
    return F.array_contains(F.slice(minima, first + 1, at - first + 1), F.get(grams, at))


def _all_places(grams: Column) -> Column:
    return F.when(F.size(grams) > 0, F.sequence(F.lit(0), F.size(grams) - 1)).otherwise(F.array().cast("array<int>"))


def _context(words: Column, at: Column, n: int, reach: int) -> Column:
    """The n-gram at zero-based ``at`` with up to ``reach`` words each side; the left ones nearest first."""
    left = F.least(at, F.lit(reach))
    return F.struct(
        at.alias("at"),
        F.reverse(F.slice(words, at - left + 1, left)).alias("left"),
        F.slice(words, at + 1, n).alias("gram"),
        F.slice(words, at + 1 + n, reach).alias("right"),
    )


def _matching(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    n = F.least(F.size(a), F.size(b))
    differ = F.filter(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.get(a, i) != F.get(b, i),
    )
    return F.coalesce(F.get(differ, F.lit(0)), n)


def _covered(spans: Column) -> Column:
    """Words inside the union of (start, end) spans, ends exclusive."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["start"]))).cast("long").alias("n"),
            F.greatest(s["end"], x["end"]).cast("long").alias("end"),
        ),
        lambda s: s["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document.

    Items of WINDOW words or more are indexed by the k-grams that winnowing may
    keep (every one of theirs, so that either side's choice is met); a document
    offers the minima of its own k-grams, which include one of every shared span.
    Only k-grams that meet are carried on, with their neighbourhood of words; the
    match is extended word by word on both sides, and stretches of WINDOW words
    or more are hits. Shorter items are one window each, looked up whole (a gram
    as long as the item and no neighbours, for each such length that occurs).

    Null, empty and wordless documents have zeros; such items have no window. Every
    row of ``docs`` is judged by itself, whether its doc_id is null or repeats or not.
    Repeated items count once by item_id; all items without an id count as one, which
    is not named in the digest. Empty tables on either side give zeros or no rows;
    other columns are ignored.
    """
    items = cut(
        benchmark.select(F.struct(F.col("item_id").cast("string").alias("id")).alias("item"), words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .distinct()
    )
    lengths = sorted(
        r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect()
    )  # 13 values at most
    plans = [(n, *((GRAM, NEIGHBOURS, WINDOW - GRAM) if n == WINDOW else (n, 1, 0))) for n in lengths]

    base = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words")).select(
        "row", "doc_id", "words", F.size("words").cast("long").alias("n_words")
    )
    kept, found, is_cut = ["row", "doc_id", "n_words"], [], False
    for n, gram, neighbours, reach in plans:
        own = items.where(F.size("words") >= n) if n == WINDOW else items.where(F.size("words") == n)
        index = (
            own.select("item", "words", F.posexplode(_grams(F.col("words"), gram)).alias("at", "h"))
            .select("item", "h", _context(F.col("words"), F.col("at"), gram, reach).alias("c"))
            .groupBy("h", "c.left", "c.gram", "c.right")
            .agg(F.collect_set("item").alias("items"))
        )
        index = cut(index)
        size = index.count()
        keys = index.select("h").distinct()
        name = f"hits{n}"
        if size <= INLINE_LIMIT:
            known = [r[0] for r in keys.collect()]
            base = base.withColumn(name, _inline_hits(known, gram, neighbours, reach))
        else:
            if not is_cut:  # rows are named once
                base, is_cut = cut(base), True
            base = _joined_hits(base, keys, name, gram, neighbours, reach)
        kept.append(name)
        found.append((name, n, gram, index, size))
    base = cut(base.select(*kept))

    spans = None
    for name, n, gram, index, size in found:
        small = F.broadcast(index) if size <= BROADCAST_LIMIT else index
        meets = base.select("row", F.explode(name).alias("d")).select("row", "d.*").alias("d")
        each = (
            meets.join(small.alias("b"), F.col("d.h") == F.col("b.h"))
            .where(F.col("d.gram") == F.col("b.gram"))
            .select(
                "row",
                "items",
                (F.col("at") - _matching(F.col("d.left"), F.col("b.left"))).cast("long").alias("start"),
                (F.col("at") + gram + _matching(F.col("d.right"), F.col("b.right"))).cast("long").alias("end"),
            )
            .where(F.col("end") - F.col("start") >= n)
        )
        spans = each if spans is None else spans.union(each)
    if spans is None:
        judged = base.select("row", F.lit(0).cast("long").alias("hit"), F.array().cast("array<struct<id:string>>").alias("met")).limit(0)
    else:
        judged = spans.groupBy("row").agg(
            _covered(F.collect_set(F.struct("start", "end"))).alias("hit"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("met"),
        )
    hit = F.coalesce("hit", F.lit(0)).cast("long")
    ids = F.array_sort(F.array_compact(F.transform("met", lambda x: x["id"])))
    return base.select("row", "doc_id", "n_words").join(judged, "row", "left").select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.coalesce(F.size("met"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(ids, ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def _neighbourhoods(grams: Column, at: Column, gram: int, reach: int) -> Column:
    """The hash at each of the places, with the words around it."""
    return F.transform(
        at, lambda i: F.struct(F.get(grams, i).alias("h"), *_context_fields(F.col("words"), i, gram, reach))
    )


def _context_fields(words: Column, at: Column, n: int, reach: int) -> list[Column]:
    c = _context(words, at, n, reach)
    return [c[f].alias(f) for f in ("at", "left", "gram", "right")]


_HIT = "array<struct<h:bigint,at:int,left:array<string>,gram:array<string>,right:array<string>>>"


def _inline_hits(known: list[int], gram: int, neighbours: int, reach: int) -> Column:
    """Kept hashes that are known. Minima are only worked out for texts with a known hash."""
    none = F.array().cast(_HIT)

    def of(grams):
        def winnowed(at):
            kept = let(_minima(grams, neighbours), lambda m: F.filter(at, lambda i: _kept(grams, m, i, neighbours)))
            return F.when(F.size(at) > 0, let(kept, lambda k: _neighbourhoods(grams, k, gram, reach))).otherwise(none).cast(_HIT)

        return let(F.filter(_all_places(grams), lambda i: F.get(grams, i).isin(known)), winnowed)

    return let(_grams(F.col("words"), gram), of) if known else none


def _joined_hits(base: DataFrame, keys: DataFrame, name: str, gram: int, neighbours: int, reach: int) -> DataFrame:
    """The same hits when the index is too large to be held in an expression: two equi-joins."""
    def offers(grams):
        kept = let(_minima(grams, neighbours), lambda m: F.filter(_all_places(grams), lambda i: _kept(grams, m, i, neighbours)))
        return let(kept, lambda at: F.transform(at, lambda i: F.struct(F.get(grams, i).alias("h"), i.alias("at"))))

    offered = base.select("row", F.explode(let(_grams(F.col("words"), gram), offers)).alias("o")).select("row", "o.*")
    met = offered.join(keys, "h", "left_semi").groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("met"))
    hits = let(_grams(F.col("words"), gram), lambda g: _neighbourhoods(g, F.col("met"), gram, reach))
    return base.join(met, "row", "left").withColumn(name, F.when(F.col("met").isNotNull(), hits).otherwise(F.array()).cast(_HIT)).drop("met")
