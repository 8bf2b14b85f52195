"""Best-fit packing by a grouping genetic algorithm on islands with elite migration."""

from __future__ import annotations

import math
import re
import struct
import unicodedata
import zlib
from bisect import bisect_left, bisect_right, insort
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, cut

CAPACITY = 4096
END_ID = 1
#: Bytes of remembered words, and of remembered chunks, that a task may hold.
MEMO_BYTES = 88 << 20
#: By number of ids: what packs so many.
_PACKS = [struct.Struct(f"<{n}I").pack for n in range(33)]
#: Fixed value: how the tokenizer divides a text, "'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in its
#: file, as it is for signs below LATIN_END, of which ``\w`` are letters, numbers and the underscore.
LATIN_PARTS = re.compile(r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|[\d\xb2\xb3\xb9\xbc-\xbe]|'(?:s|t|re|ve|m|ll|d)|(?:[^\s\w]|_)+").findall
LATIN_END = "\u0250"
#: For Latin-1 texts: dots and commas, other signs that go with them in a part, and all the rest.
_KINDS = bytes(b"."[0] if chr(b) in ".," else b"a"[0] if chr(b).isspace() or chr(b).isalnum() else b"!"[0] for b in range(256))
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHER = [b for b in range(256) if b not in set(_PRINTABLE)]
#: The character that stands for each byte in a byte-level vocabulary.
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(0x100 + k) for k, b in enumerate(_OTHER)}
#: Pieces of a block, and islands that evolve each block.
BLOCK, ISLANDS = 1500, 2
POPULATION, GENERATIONS, EPOCHS = 4, 4, 2
#: Rounds in which the worst bins of all blocks are packed anew together.
ROUNDS = 3
FULL_ENOUGH = 0.995


class _Memo(dict):
    """Computes what it doesn't hold; empties itself when it holds MEMO_BYTES."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.held = compute, 0

    def __missing__(self, key):
        value = self.compute(key)
        self.held += 2 * len(key) + len(value) + 210  # with both headers and the place in the table
        if self.held > MEMO_BYTES:
            self.clear()
            self.held = 0
        if len(key) < 1000:
            self[key] = value
        return value


@cache
def _tokenizer(path: str):
    """One a process, without memos: some 10 MB."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _whole(tokenizer, text: str) -> bytes:
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _word(tokenize, word: str) -> bytes:
    if not (word.isascii() and word.isprintable()):
        word = "".join([_BYTE_CHARS[b] for b in word.encode()])
    return _packed([t.id for t in tokenize(word)])


def _packed(ids: list[int]) -> bytes:
    return _PACKS[len(ids)](*ids) if len(ids) < len(_PACKS) else np.array(ids, "<u4").tobytes()


def _chunk(tokenizer, tokenize, words: _Memo, chunk: str) -> bytes:
    if chunk.isalpha() and chunk.isascii():  # most are
        return _packed([t.id for t in tokenize(chunk)])
    if not chunk.isascii() and max(chunk) >= LATIN_END:
        return _whole(tokenizer, chunk)
    if chunk.isalpha():
        return _word(tokenize, chunk)
    return b"".join([words[w] for w in LATIN_PARTS(chunk)])


class ChunkEncoder:
    """Ids as little-endian uint32 bytes, equal to the tokenizer's on the whole text.

    The tokenizer's pre-tokens never cross white space, so a text's ids are those
    of its white-space chunks in order, and a chunk's those of its words and
    runs of other signs. Distinct chunks are remembered, and words of those that aren't
    one word; a word's ids come from the library's model. Where no dot or comma has
    another sign beside it, each is a part by itself, and is made a chunk, for fewer
    distinct ones. Where the split isn't sure (the tokenizer's special strings,
    separators that only Python takes for white space, signs beyond the Latin
    ones) the library encodes the chunk or the whole text.

    The memos' functions don't refer to the encoder: nothing here is in a cycle, so that
    an encoder and its memos go when their task ends and don't wait for the collector,
    which counts neither the library's memory nor the memos'. Only the tokenizer itself stays.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        tokenize = self.tokenizer.model.tokenize
        self.words = _Memo(partial(_word, tokenize))
        self.chunks = _Memo(partial(_chunk, self.tokenizer, tokenize, self.words))

    def whole(self, text: str) -> bytes:
        return _whole(self.tokenizer, text)

    def encode(self, text: str) -> bytes:
        if not text.isascii():
            if any(c in text for c in "\u03a3\u0130"):  # lower-cased by context
                return self.whole(text)
            text = unicodedata.normalize("NFC", text)
        if any(s in text for s in self.specials) or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.whole(text)
        text = text.lower()
        try:
            kinds = text.encode("latin-1").translate(_KINDS)
        except UnicodeEncodeError:
            kinds = b".."  # not known
        if not any(x in kinds for x in (b"..", b".!", b"!.")):
            text = text.replace(".", " . ").replace(",", " , ")
        return b"".join(map(self.chunks.__getitem__, text.split()))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, copy, piece, start, length, ids_crc32[, ids]) for every document.

    A document's ids are followed by END_ID; documents longer than ``capacity``
    are cut into pieces of that length, the last one shorter. Null and empty texts
    have END_ID alone. ``copy`` tells rows with one doc_id apart.
    """
    schema = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "copy", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def batches(it):
        encoder = ChunkEncoder(tokenizer_path)  # goes with the task
        end = np.array([END_ID], "<u4").tobytes()
        for b in it:
            rows, out = [], [[] for _ in range(6)]
            for i, t in enumerate(b.column(1)):
                ids = encoder.encode(t.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append(i)
                    for c, v in zip(out, (k, at // 4, len(own) // 4, zlib.crc32(own), own), strict=False):
                        c.append(v)
            ids = [pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in out[4]], pa.list_(pa.int32()))] * keep_ids
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int32())), b.column(2).take(pa.array(rows, pa.int32())), pa.array(out[0], pa.int32()), *(pa.array(c, pa.int64()) for c in out[1:4]), *ids],
                names,
            )

    bound_batches(docs.sparkSession)
    slim = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("copy"))
    return slim.mapInArrow(
        batches,
        f"doc_id {schema}, copy long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids,
    )


class _Bins:
    """A packing under construction: bins by free space, best fit by bisection."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free, self.order = capacity, [], [], []

    def add_bin(self, items: list[int], size: int) -> None:
        if self.capacity > size:
            insort(self.order, (self.capacity - size, len(self.bins)))
        self.bins.append(items)
        self.free.append(self.capacity - size)

    def best_fit(self, items, sizes) -> None:
        for i in items:
            s = sizes[i]
            at = bisect_left(self.order, (s, -1))
            if at == len(self.order):
                self.add_bin([i], s)
                continue
            left, b = self.order.pop(at)
            self.bins[b].append(i)
            self.free[b] = left - s
            if left > s:
                insort(self.order, (left - s, b))


def _fitness(bins: list[list[int]], sizes, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then the unevenness that lets the next crossover empty a bin."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def _swap(packed: _Bins, loose: list[int], sizes) -> None:
    """Fill bins up: an item of a bin gives way to the largest displaced one that fits in its place."""
    loose.sort(key=lambda i: sizes[i])
    known = [sizes[i] for i in loose]
    for b in range(len(packed.bins)):
        own = packed.bins[b]
        for k in range(len(own)):
            if not packed.free[b]:
                break
            s = sizes[own[k]]
            at = bisect_right(known, s + packed.free[b]) - 1
            if at >= 0 and known[at] > s:
                packed.free[b] -= known[at] - s
                out, own[k] = own[k], loose.pop(at)
                known.pop(at)
                to = bisect_left(known, s)
                known.insert(to, s)
                loose.insert(to, out)
    packed.order = sorted((f, b) for b, f in enumerate(packed.free) if f and packed.bins[b])


def _cross(left, right, sizes, capacity: int, rng) -> list[list[int]]:
    """Whole well-filled bins of ``left`` go into ``right``; what that displaces is best-fitted."""
    fill = np.array([sum(sizes[i] for i in b) for b in left])
    good = np.argsort(-(fill + rng.random(len(fill)) * 0.02 * capacity))[: max(1, int(len(left) * rng.uniform(0.3, 0.7)))]
    injected = [left[k] for k in good]
    taken = {i for b in injected for i in b}
    packed, loose = _Bins(capacity), []
    for b in injected:
        packed.add_bin(list(b), sum(sizes[i] for i in b))
    for b in right:
        if taken.isdisjoint(b):
            packed.add_bin(list(b), sum(sizes[i] for i in b))
        else:  # holds a duplicate: the bin goes, its other documents are displaced
            loose += [i for i in b if i not in taken]
    _mutate(packed, loose, sizes, rng)
    _swap(packed, loose, sizes)
    loose.sort(key=lambda i: -sizes[i])
    packed.best_fit(loose, sizes)
    return [b for b in packed.bins if b]


def _mutate(packed: _Bins, loose: list[int], sizes, rng) -> None:
    """Empty a few of the least filled bins into ``loose``."""
    worst = sorted(range(len(packed.bins)), key=lambda b: -packed.free[b])[: 2 + int(rng.integers(0, 4))]
    for b in worst:
        loose += packed.bins[b]
        packed.bins[b] = []
    gone = set(worst)
    packed.order = [x for x in packed.order if x[1] not in gone]


def evolve(sizes: list[int], start: list[list[list[int]]], capacity: int, seed: int, generations: int = GENERATIONS) -> list[list[list[int]]]:
    """Some generations on one island; the population, best first.

    The first people are best-fit packings in random orders, far from the best; it is
    crossover, swaps and selection that bring the number of bins down. An island rests
    once its best meets the bound of the summed size.
    """
    rng = np.random.default_rng(seed)
    bound = math.ceil(sum(sizes) / capacity)
    people = list(start)
    while len(people) < POPULATION:
        packed = _Bins(capacity)
        packed.best_fit(rng.permutation(len(sizes)).tolist(), sizes)
        people.append(packed.bins)
    people.sort(key=lambda p: _fitness(p, sizes, capacity))
    for _ in range(generations):
        if len(people[0]) <= bound:
            break
        a, b = rng.choice(len(people), 2, replace=False)
        young = [_cross(people[a], people[b], sizes, capacity, rng), _cross(people[b], people[a], sizes, capacity, rng)]
        people = sorted([*people, *young], key=lambda p: _fitness(p, sizes, capacity))[:POPULATION]
    return people


def _bins_of(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def _lists(of: np.ndarray) -> list[list[int]]:
    order = np.argsort(of, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)]


def _epoch(items: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One epoch of every island. In: block, island, nth, length, elites (bins by population place).

    After it, each island's elite is also the migrant of the next one in a ring.
    """

    def run(key, table):
        table = table.sort_by("nth")
        sizes = table["length"].to_pylist()
        past = np.array(table["elites"].to_pylist(), np.int32).reshape(len(sizes), -1)
        people = [_lists(past[:, k]) for k in range(past.shape[1])]
        block, island = (k.as_py() for k in key)
        people = evolve(sizes, people, capacity, zlib.crc32(f"{block} {island} {epoch}".encode()))
        best = _bins_of(people[0], len(sizes))
        return table.select(["block", "island", "nth", "length"]).append_column(
            "elites", pa.array([[int(x)] for x in best], pa.list_(pa.int32()))
        ).append_column("used", pa.array(np.full(len(sizes), len(people[0]), np.int32)))

    return items.groupBy("block", "island").applyInArrow(
        run, "block long, island int, nth int, length int, elites array<int>, used int"
    )


def _pack_blocks(items: DataFrame, capacity: int) -> DataFrame:
    """(block, nth, bin): the best island's packing of each block. In: block, nth, length."""
    world = items.select(
        "block",
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        "nth",
        F.col("length").cast("int").alias("length"),
        F.array().cast("array<int>").alias("elites"),
    )
    for epoch in range(EPOCHS):
        world = cut(_epoch(world, capacity, epoch))
        if epoch + 1 < EPOCHS:
            migrants = world.select(
                "block", ((F.col("island") + 1) % ISLANDS).alias("island"), "nth", F.col("elites").alias("migrant")
            )
            world = world.join(migrants, ["block", "island", "nth"]).select(
                "block", "island", "nth", "length", F.concat("elites", "migrant").alias("elites")
            )
    best = world.groupBy("block").agg(F.min(F.struct("used", "island")).alias("b")).select("block", "b.island")
    return world.join(best, ["block", "island"]).select("block", "nth", F.col("elites")[0].alias("bin"))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` rows with sequence_id and offset.

    Full pieces are sequences of their own. The others are dealt by a hash into
    blocks of about BLOCK pieces; on ISLANDS islands each block's packing evolves,
    elites migrate between epochs, and the best is kept. Bins that are not
    FULL_ENOUGH are opened and their pieces packed again in fewer blocks, ROUNDS
    times in all, so that what a block leaves over is filled from others. A sequence's
    number is made of round, block and bin, that of a full piece of its row: no two are equal.
    No step holds more than a block in one task.
    """
    found = cut(found)
    rest = found.where(F.col("length") < capacity).select("doc_id", "copy", "piece", "length")
    done = found.where(F.col("length") >= capacity).select(
        "copy", "piece", (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id")
    )
    keys = ["copy", "piece"]  # a copy is one row of the input; ids may be null or repeat
    for turn in range(ROUNDS):
        n = rest.count()
        if not n:
            break
        blocks = max(1, math.ceil(n / BLOCK))
        dealt = cut(
            rest.withColumn("block", F.pmod(F.xxhash64("copy", "piece", "doc_id", F.lit(turn)), F.lit(blocks)))
            .groupBy("block")
            .agg(F.array_sort(F.collect_list(F.struct("copy", "piece", "doc_id", "length"))).alias("items"))
            .select("block", F.posexplode("items").alias("nth", "item"))
            .select("block", "nth", "item.*")
        )
        packed = dealt.join(_pack_blocks(dealt, capacity), ["block", "nth"])
        if turn + 1 < ROUNDS and blocks > 1:
            fill = packed.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
            packed = cut(packed.join(fill, ["block", "bin"]))
            again = packed.where(F.col("fill") < FULL_ENOUGH * capacity)
            packed = packed.where(F.col("fill") >= FULL_ENOUGH * capacity)
        else:
            again = None
        done = done.unionByName(
            packed.select(*keys, (F.lit(turn << 58) + F.shiftleft("block", 20) + F.col("bin")).alias("sequence_id"))
        )
        if again is None:
            break
        rest = again.select("doc_id", "copy", "piece", "length")
    placed = found.join(done, keys)
    from pyspark.sql import Window as W

    order = W.partitionBy("sequence_id").orderBy("copy", "piece", "doc_id")
    before = F.sum("length").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("length")
    return placed.withColumn("offset", before)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts give one piece of one id. Repeated rows and equal ids of
    different documents are packed one by one. An empty table gives an empty
    result; other columns are ignored. Very long texts are cut, never shortened.
    """
    return pack(pieces(docs, tokenizer_path, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
