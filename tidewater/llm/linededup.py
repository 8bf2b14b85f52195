"""Fuzzy line deduplication by MinHash banding, exact Jaccard checks and distributed union-find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import connected_components, kept, let, small, written

#: Characters of a shingle, and the Jaccard similarity from which lines are alike.
SHINGLE, SIMILARITY = 8, 0.8
#: Bands and minima of a band.
BANDS, ROWS = 8, 4
#: Where the bins of one permutation begin on the ring of 64-bit hashes.
MARKS = [k * ((1 << 64) // (BANDS * ROWS)) - (1 << 63) + 1 for k in range(BANDS * ROWS)]
#: Lines outside a bucket's main component that are compared with all of it in the
#: first round; the second takes all that are still outside.
LEADERS = 32
#: 64-bit words of a line's sketch.
SKETCH = 32
#: Words of it that are compared before all of them are.
FIRST_WORDS = 8
#: Links up to which the driver finds components by itself; 16 bytes a link.
LOCAL_LINKS = 250_000
#: Rows of drops that may be broadcast, counted in lines.
BROADCAST_LINES = 1_000_000


def _normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def shingle_hashes(line: Column) -> Column:
    """64-bit hashes of the character shingles at every place, in UTF-16; of shorter lines that of the line."""

    def each(charset: str, width: int, body) -> Column:
        # Every character is of one width, so that a place is found without reading up to it.
        starts = F.sequence(F.lit(1), width * F.greatest(F.length(line) - SHINGLE, F.lit(0)) + 1, F.lit(width))
        return let(
            F.encode(line, charset),
            lambda text: F.transform(starts, lambda at: F.xxhash64(body(F.substring(text, at, F.lit(width * SHINGLE))))),
        )

    plain = each("UTF-16BE", 2, lambda part: part)
    # With surrogate pairs places are found in UTF-32; a shingle without them has the same hash in any line.
    pairs = each("UTF-32", 4, lambda part: F.encode(F.decode(part, "UTF-32"), "UTF-16BE"))
    wide = (F.octet_length(line) >= F.length(line) + 3) & line.rlike(r"[^\x{0}-\x{FFFF}]")
    return F.when(wide, pairs).otherwise(plain)


def _parts(docs: DataFrame) -> DataFrame:
    """One row a line: its place and its text as it stands."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("doc_key"))
    # Any limit below 1 is none. As the split refers to the key, that is made once a text; else it would be made at every line.
    limit = F.when(F.col("doc_key") == 0, F.lit(-2)).otherwise(F.lit(-1))
    parts = keyed.select("doc_id", "doc_key", F.posexplode(F.split("text", "\n", limit)).alias("nth", "raw"))
    return parts.select(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "doc_key", "nth").alias("place"), "raw")


def _keys(line: Column) -> tuple[Column, Column]:
    return F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b")


def _lines(docs: DataFrame) -> DataFrame:
    """One row a line that isn't blank: its place, its text and a 128-bit key of it."""
    # Most lines show by their first character that they aren't blank.
    filled = F.ascii(F.trim("raw")).between(33, 126) | F.col("raw").rlike(r"[^\s\x85\p{Z}]")
    return _parts(docs).where(filled).select("place", _normal(F.col("raw")).alias("line")).select("*", *_keys(F.col("line")))


def _bands(lines: DataFrame) -> DataFrame:
    """The columns of ``lines`` and ``bands``: MinHash of one permutation, ROWS minima a band.

    The hashes of a line's shingles lie on a ring; the minimum of a bin is the first one
    from the bin's mark on, so that an empty bin borrows from the next. One sort serves
    all minima: the marks are merged in to find their places. Repeated shingles count
    once. A band's marks lie a quarter of the ring apart, or as ROWS has it.
    """
    rows = lines.withColumn("sorted", F.sort_array(shingle_hashes(F.col("line"))))
    merged = rows.withColumn("merged", F.sort_array(F.concat("sorted", F.array(*[F.lit(m) for m in MARKS]))))
    first = [F.get("sorted", (F.array_position("merged", F.lit(m)).cast("int") - (k + 1)) % F.size("sorted")) for k, m in enumerate(MARKS)]
    bands = F.array(*[F.xxhash64(F.lit(k), *first[k::BANDS]) for k in range(BANDS)])
    # A projection with a lambda is compiled by itself, in short methods; in the stage's one
    # long method it would be interpreted. The condition is always true.
    return merged.select(*lines.columns, F.when(F.exists(F.array(F.size("sorted")), lambda n: n > 0), bands).alias("bands"))


def _classes(lines: DataFrame) -> DataFrame:
    """One row a distinct line: key (a, b), where first, whether repeated, and its bands."""
    found = lines.groupBy("a", "b").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.first("bands").alias("bands"))
    return found.select("a", "b", "first", (F.col("first") != F.col("last")).alias("repeated"), "bands")


def _texts(docs: DataFrame, keys: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, line, n) of the keys (a): text and number of shingles; only documents that have such a line first are read."""
    wanted = kept(classes.join(keys, "a").select("a", "b", "first"))
    owners = small(wanted.select("first.doc_id", F.col("first.doc_key").alias("key")).distinct())
    at = F.struct("doc_id", F.xxhash64("text").alias("key"))
    found = _parts(docs.join(owners.select(F.struct("doc_id", "key").alias("at")), at.eqNullSafe(F.col("at")), "left_semi"))
    # Joined by place first, so that only these lines are lower-cased and hashed.
    own = found.join(small(wanted.select("a", "b", F.col("first").alias("place"))), "place").select("a", "b", _normal(F.col("raw")).alias("line"))
    a, b = _keys(F.col("line"))
    return own.where((F.col("a") == a) & (F.col("b") == b)).dropDuplicates(["a", "b"]).select("a", "b", "line", F.size(F.array_distinct(shingle_hashes(F.col("line")))).alias("n"))


def _sketches(texts: DataFrame) -> DataFrame:
    """(a, s0, s1, ...): one bit a class of shingle hashes, set if the line has an odd number of distinct ones in it.

    Sets that differ in d shingles have sketches that differ in d bits at most.
    """
    hashes = texts.select("a", F.explode(F.array_distinct(shingle_hashes(F.col("line")))).alias("h"))
    placed = hashes.select("a", F.expr(f"(h >>> 6) & {SKETCH - 1}").alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    return kept(placed.groupBy("a").agg(*[F.bit_xor(F.when(F.col("word") == k, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SKETCH)]))


def _can_be_alike(m: Column, n: Column, one: str, other: str) -> Column:
    """False only for sets that can't be similar enough, by their sizes and sketches (columns ``one``0, ``other``0, ...).

    The sketches' first words come first: their bits that differ are some of all, and rule most pairs out.
    """

    def differ(words: int) -> Column:
        each = [F.bit_count(F.col(f"{one}{k}").bitwiseXOR(F.col(f"{other}{k}"))) for k in range(words)]
        return sum(each[1:], each[0])

    most = F.lit((1 - SIMILARITY) / (1 + SIMILARITY)) * (m + n) + F.lit(1e-6)  # shingles that are in one set only
    return (F.least(m, n) >= SIMILARITY * F.greatest(m, n)) & (differ(FIRST_WORDS) <= most) & (differ(SKETCH) <= most)


def _likely(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, a2) whose set sizes don't rule out that they are similar enough."""
    sizes = pairs.join(texts.select("a", F.col("n").alias("m")), "a").join(texts.select(F.col("a").alias("a2"), "n"), "a2")
    return kept(sizes.where(F.least("m", "n") >= SIMILARITY * F.greatest("m", "n")).select("a", "a2"))


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b, a2, b2) of the pairs (a, a2) whose shingle sets are similar enough, by the sets themselves."""
    left = texts.select("a", "b", F.col("n").alias("m"), F.col("line").alias("x"))
    right = texts.select(F.col("a").alias("a2"), F.col("b").alias("b2"), "n", F.col("line").alias("y"))
    both = pairs.join(left, "a").join(right, "a2").select("a", "b", "a2", "b2", "m", "n", F.size(F.array_intersect(shingle_hashes(F.col("x")), shingle_hashes(F.col("y")))).alias("common"))
    # Written before the filter, which would else be pushed below the sets and make them anew.
    return kept(both).where(F.col("common") >= SIMILARITY * (F.col("m") + F.col("n") - F.col("common"))).select("a", "b", "a2", "b2")


def _members(links: DataFrame) -> DataFrame:
    """(a, b, component) for every line of a link."""
    # Lines of links get one long as their name; it is checked to be one to one.
    ends = links.select("a", "b").union(links.select("a2", "b2")).distinct()
    named = kept(ends.select("a", "b", F.xxhash64("a", "b", F.lit("name")).alias("node")))
    n, different = named.agg(F.count("*"), F.count_distinct("node")).first()
    if n != different:
        raise RuntimeError("two lines have one name")
    edges = links.select(F.xxhash64("a", "b", F.lit("name")).alias("node"), F.xxhash64("a2", "b2", F.lit("name")).alias("node2"))
    parts = connected_components(edges, "node", "node2", local=LOCAL_LINKS)
    return kept(named.join(parts, "node").select("a", "b", "component"))


def _across(large: DataFrame, members: DataFrame, sketches: DataFrame, leaders: int | None) -> tuple[DataFrame, DataFrame]:
    """Pairs of lines of a bucket that no component joins yet, and the rows (bucket, a) that have still to be paired.

    In each bucket so many of the lines outside its largest component (None: all) are
    compared with all lines of the bucket that are in other components, by size and
    sketch in the join, and paired with those that can be alike; after that they have
    met all there is to meet.
    """
    parts = members.groupBy("a").agg(F.min("component").alias("component"))
    sides = kept(large.join(parts, "a", "left"))
    counts = sides.where("component is not null").groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    outside = sides.join(main, "bucket", "left").where("component is null or component <> main")
    nth = F.row_number().over(W.partitionBy("bucket").orderBy(F.xxhash64("a", "bucket"), "a"))
    chosen = kept(outside.select("bucket", F.col("a").alias("a2"), F.col("component").alias("component2"), F.col("n").alias("n2"), nth.alias("nth")))
    first = chosen if leaders is None else chosen.where(F.col("nth") <= leaders)
    other = sketches.select(F.col("a").alias("a2"), *[F.col(f"s{k}").alias(f"t{k}") for k in range(SKETCH)])
    pairs = (
        sides.join(sketches, "a")
        .join(first.join(other, "a2"), "bucket")
        .where("a <> a2 and a2 <> least and a <> least")  # the least one has been compared with all
        .where("component is null or component2 is null or component <> component2")
        .where(_can_be_alike(F.col("n"), F.col("n2"), "s", "t"))
        .select(F.least("a", "a2").alias("a"), F.greatest("a", "a2").alias("a2"))
        .distinct()
    )
    pairs = kept(pairs)
    if leaders is None:
        return pairs, large.limit(0)
    rest = large.join(first.select("bucket", F.col("a2").alias("a")), ["bucket", "a"], "left_anti")
    more = chosen.where(F.col("nth") > leaders).select("bucket").distinct()
    return pairs, kept(rest.join(more, "bucket", "left_semi"))


def _linked(classes: DataFrame, texts_of) -> DataFrame:
    """(a, b, component) of distinct lines that are linked; ``texts_of(keys)`` gives ``_texts`` of keys (a).

    Every line of a bucket is compared with the bucket's least one; that is all there
    is to do in buckets of two. In larger ones, lines that are outside of the bucket's
    largest component are then compared with all lines of the bucket that the links so
    far don't join, be it over other buckets. So the components are those of
    all pairs of all buckets, but the pairs within a group of like lines aren't made.
    """
    buckets = classes.select("a", F.explode("bands").alias("bucket"))
    own = W.partitionBy("bucket")
    counted = buckets.withColumns({"size": F.count("*").over(own), "least": F.min("a").over(own), "most": F.max("a").over(own)})
    crowded = kept(counted.where("least < most").select("bucket", "a", "least", "size"))
    pairs = kept(crowded.where("a <> least").select("least", "a").toDF("a", "a2").distinct())
    texts = kept(texts_of(small(pairs.select("a").union(pairs.select("a2")).distinct())))
    links = kept(_alike(_likely(pairs, texts), texts))
    large = kept(crowded.where("size > 2").select("bucket", "a", "least").join(texts.select("a", "n"), "a"))
    members, leaders, sketches = _members(links), LEADERS, None
    while large.take(1):
        sketches = sketches or _sketches(texts.join(small(large.select("a").distinct()), "a", "left_semi"))
        pairs, large = _across(large, members, sketches, leaders)
        more = kept(_alike(pairs, texts))
        if more.take(1):
            links = kept(links.union(more))
            members = _members(links)
        leaders = None
    return members


def doubles(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_key, drop): the places of lines that repeat an earlier kept line."""
    lines = written(_bands(_lines(docs)).drop("line"), "lines")
    classes = kept(_classes(lines))
    member = _linked(classes, lambda keys: _texts(docs, keys, classes))
    joined = member.join(classes.select("a", "b", "first"), ["a", "b"])
    keeper = joined.groupBy("component").agg(F.min("first").alias("keep"))
    fuzzy = kept(joined.join(keeper, "component").select("a", "b", "keep"))
    exact = (
        classes.where("repeated").join(small(fuzzy.select("a", "b")), ["a", "b"], "left_anti").select("a", "b", F.col("first").alias("keep"))
    )
    table = fuzzy.union(exact)
    return (
        lines.select("place", "a", "b")
        .join(small(table), ["a", "b"])
        .where("place <> keep")
        .groupBy("place.doc_id", "place.doc_key")
        .agg(F.collect_set("place.nth").alias("drop"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with repeated lines taken out of ``text``, and n_lines, n_dropped.

    Lines are compared lower-cased and trimmed; blank ones stay. Of all lines that
    are equal or linked by similarity, whatever their length, the one that comes
    first by (doc_id, place) stays; rows without an id come last, in the order of a
    hash of the text. Documents stay even when nothing is left of them. Null texts
    stay null; rows equal in id and text count as one and stay alike; empty tables
    give an empty result. Other columns pass through; n_lines and n_dropped take
    the place of input columns of these names.
    """
    drops = kept(doubles(docs.select("doc_id", "text").where("text is not null")))
    n = drops.agg(F.sum(F.size("drop"))).first()[0]
    marks = drops.select(F.struct("doc_id", "doc_key").alias("at"), "drop")
    marks = F.broadcast(marks) if (n or 0) <= BROADCAST_LINES else marks
    # The input's columns travel in a struct, so that no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    here = F.struct(F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("doc_key"))
    joined = rows.join(marks, here.eqNullSafe(F.col("at")), "left")
    text, drop = F.col("row.text"), F.col("drop")
    parts = F.split(text, "\n")
    remaining = let(
        parts,
        lambda p: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), drop), lambda i: F.get(p, i)), "\n"),
    )
    own = {"text": F.when(drop.isNull(), text).otherwise(remaining)}
    return joined.select(
        *[own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"),
    )
