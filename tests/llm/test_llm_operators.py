"""Every operator on small and awkward inputs, against brute force where there is one."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm import (
    common,
    decontamination,
    langid,
    licenses,
    linededup,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    toxicity,
)

UPPER = {i: i + 32 for i in range(65, 91)}
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
#: Null, empty and blank texts, ties, repeated rows, a very long text, odd characters.
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "same text here"), (5, "same text here"), (5, "same text here"),
    (6, LONG), (7, "É ñ 中文 😀 MIT License\nmit license"), (8, "a b a b a b a b"), (9, "One\n\nOne\n \nTwo"), (None, "no id"),
]


def lower_words(text):
    return ALNUM.findall((text or "").translate(UPPER))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if (i or 0) % 2 else None, None, len(t or ""), "clash") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, words string").withColumn("shard", F.lit("x"))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def components(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(1000 + i, 1001 + i) for i in range(80)]
    got = common.connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    real = [x for x in links if x[0] != x[1]]
    assert {r.node: r.component for r in got.collect()} == components({n for x in real for n in x}, real)


def test_sharding(docs, empty, spark):
    out = sharding.assign_shards(docs, 3).collect()
    assert len(out) == len(TEXTS)
    want = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    for s in {r.shard for r in out}:
        own = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sharding.assign_shards(empty, 3).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot" * 50).otherwise(F.repeat(F.lit("x"), (F.col("id") % 90).cast("int"))).alias("text"))
    sizes = sharding.assign_shards(many, 24).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(sizes) == 24 and max(r.s for r in sizes) - min(r.s for r in sizes) <= 400


def test_simhash(docs, empty, spark, monkeypatch):
    def brute(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]
        n = min(3, len(words))
        h = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    out = simhash.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.fingerprint) for r in out) == collections.Counter((i, f"{brute(t):016x}") for i, t in TEXTS)
    assert {r.doc_id: r.component_id for r in out}[2] == 1 and {r.doc_id: r.component_id for r in out}[5] == 4
    assert simhash.near_duplicates(empty).count() == 0
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    fps = set(base)
    for b in base:
        for _ in range(6):
            fps.add(b ^ (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63))))
            fps.add(b ^ (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63))))
    fps = sorted(fps)
    want = components(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2])
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    for limit in (64, 1):
        monkeypatch.setattr(simhash, "CELL_LIMIT", limit)
        got = {r.node: r.component for r in common.connected_components(simhash.near_links(frame), "a", "b").collect()}
        assert {x: got.get(x, x) for x in fps} == want


def test_decontamination(docs, empty, spark, monkeypatch):
    bench = [(1, " ".join(f"W{i}" for i in range(20, 40))), (2, "same text here"), (2, "same text here"), (3, None), (4, ""), (10, "a b a"), (5, " ".join(f"w{i}" for i in range(25, 45)))]
    items = spark.createDataFrame(bench, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in bench:
        w = lower_words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    want = {}
    for i, t in TEXTS:
        w, hit, found = lower_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if x := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= x
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want[i] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    for limit in (100_000, 0):
        monkeypatch.setattr(decontamination, "INLINE_LIMIT", limit)
        got = decontamination.contamination(docs, items).collect()
        assert len(got) == len(TEXTS)
        assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert decontamination.contamination(empty, items).count() == 0
    none = decontamination.contamination(docs, items.limit(0)).collect()
    assert len(none) == len(TEXTS) and all(r.n_hit == 0 and not r.contaminated for r in none)


def test_quality(docs, empty, spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, labels).collect()
    assert len(got) == len(TEXTS)
    rows = {r.doc_id: r for r in got}
    for i, t in TEXTS:
        t = t or ""
        w = SPACED.findall(t)
        c = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = {p for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        want = (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w))
        assert tuple(rows[i])[1:7] == want
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_risk_bound(spark):
    from math import comb

    df = spark.createDataFrame([(n, k) for n in (5, 60, 400) for k in (0, 1, 3) if k <= n], "n long, k long")
    for r in df.withColumn("t", quality._log_tail("n", "k", 0.02)).collect():
        exact = sum(comb(r.n, j) * 0.02**j * 0.98 ** (r.n - j) for j in range(r.k + 1))
        assert abs(np.exp(r.t) - exact) < 1e-9
    rows = [(i, i % 400 == 0 and 0.2 or 0.0) for i in range(2000)]
    measured = spark.createDataFrame(rows, "doc_id long, s double").selectExpr(
        "doc_id", "'en' as lang", "false as base_failed", "100L as n_words", "500L as word_chars", "cast(500 * s as long) as n_symbols",
        "10L as n_lines", "0L as n_dup_lines", "0L as n_repeat_words")
    labels = measured.selectExpr("doc_id", "1 as quality")
    cut = {r.rule: r.cutoff_step for r in quality.thresholds(measured, labels).collect()}
    assert cut["symbols"] == 16 and cut["dup_lines"] == 0  # the least at which none of 2,000 exceeds it


def test_licenses(docs, empty, spark):
    extra = spark.createDataFrame([
        (20, "SPDX-License-Identifier: Apache-2.0."), (21, "Licensed under the MIT License."), (22, "mit license " * 300),
        (23, "general public license MIT LICENSE, Apache  license"), (24, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan(docs.select("doc_id", "text").union(extra)).collect()}
    for r in [*docs.collect(), *extra.collect()]:
        w, at, labels = lower_words(r.text), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            own = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            at += own
            labels |= {label} if own else set()
        got = rows[r.doc_id]
        assert (got.n_words, got.n_base, got.first_word, got.last_word, got.base_labels) == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert set(got.base_labels.split(",")) <= set(got.labels.split(",")) | {""} and 0 <= got.score <= 1
    assert rows[20].labels == "apache-2.0" and rows[24].labels == "cc-by-nc-4.0" and rows[2].score == 0
    kept = [r for r in licenses.detect(extra).collect() if r.doc_id == 21]
    assert [(r.label, r.priority) for r in kept] == [("mit", 40)]  # the bare name inside it is suppressed
    assert licenses.scan(empty).count() == 0
    assert 200 <= len(licenses.rules()) and all(re.compile(x) for *_, x in licenses.rules())


def spelled(parsed):
    """All texts that a parsed pattern of literals, branches, classes and optional parts allows."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            own = [chr(arg)]
        elif op == "IN":
            own = [chr(c) for _, c in arg]
        elif op == "BRANCH":
            own = [x for b in arg[1] for x in spelled(b)]
        elif op == "SUBPATTERN":
            own = spelled(arg[3])
        else:
            assert op == "MAX_REPEAT" and arg[:2] == (0, 1), op
            own = ["", *spelled(arg[2])]
        out = [a + b for a in out for b in own]
    return out


def test_license_keywords_are_in_all_that_their_rules_match(spark):
    for label, keyword, name, _ in licenses.FAMILIES:
        assert all(keyword in x for x in spelled(re._parser.parse(name))), (label, name)
    holder = "the very long name of a university department " * 5
    want = {
        "Zero-Clause BSD License": "0bsd", "zero-clause BSD": "0bsd", "Licensed under GPL-2.0": "gpl-2.0", "under LGPL-2.1": "lgpl-2.1",
        "under AGPL-3.0": "agpl-3.0", "under MPL-2.0": "mpl-2.0", "GPL v 3": "gpl-3.0", "GPLv3": "gpl-3.0",
        f"Neither the name of {holder} nor the names of its contributors": "bsd-3-clause"}
    rows = by_id(licenses.scan(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")))
    for i, (text, label) in enumerate(want.items()):
        assert label in rows[i].labels.split(","), (text, rows[i].labels)


def shingle_set(line):
    return {line[i : i + linededup.SHINGLE] for i in range(max(1, len(line) - linededup.SHINGLE + 1))}


def alike(x, y):
    return len(x & y) >= linededup.SIMILARITY * len(x | y)


def brute_drops(rows):
    """(id, text, nth) of every line that goes, by comparing all pairs of lines; those that equal another apart."""
    places, lines = [], {}
    for i, t in {(i, t) for i, t in rows if t is not None}:
        key = xxhash.xxh64_intdigest(t.encode(), 42)
        key -= (key >> 63) << 64
        for nth, raw in enumerate(t.split("\n")):
            line = raw.strip(" ").lower()
            if re.search(r"[^\s\x85]", line):
                places.append(((i is None, i or 0, key, nth), i, t, line))
                lines.setdefault(line, len(lines))
    sets = [shingle_set(x) for x in lines]
    part = components(range(len(sets)), [(i, j) for i, u in enumerate(sets) for j in range(i) if alike(u, sets[j])])
    first, exact, same = {}, {}, set()
    for place, i, t, line in sorted(places, key=lambda x: x[0]):
        first.setdefault(part[lines[line]], (i, t, place[3]))
        if exact.setdefault(line, place) is not place:
            same.add((i, t, place[3]))
    return {(i, t, p[3]) for p, i, t, line in places if first[part[lines[line]]] != (i, t, p[3])}, same


def dropped(df, rows):
    key = {(i, k - ((k >> 63) << 64)): t for i, t in rows if t is not None for k in [xxhash.xxh64_intdigest(t.encode(), 42)]}
    return {(r.doc_id, key[r.doc_id, r.doc_key], nth) for r in linededup.doubles(df).collect() for nth in r.drop}


def test_line_dedup(docs, empty, spark):
    out = linededup.dedup_lines(docs)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == len(TEXTS)
    assert linededup.dedup_lines(empty).count() == 0
    base = [f"word{i} " + " ".join(f"t{(i * 7 + k) % 53}x{k}" for k in range(40)) for i in range(8)]
    rows = [(i, f"{b}\nshort line\nown {i} a b c d e f") for i, b in enumerate(base)]
    rows += [(100 + i, b.replace("x7", "y7").upper() + "\nshort line") for i, b in enumerate(base)]
    rows += [(200 + k, base[0] + f" tail{k}\nunlike {k}") for k in range(60)]
    got = by_id(linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, t in rows:
        own = t.split("\n")
        want = own if i == 0 else own[::2] if i < 100 else [] if i < 200 else own[1:]
        assert got[i].text == "\n".join(want), (i, got[i].text)
    assert got[100].n_dropped == 2 and got[100].n_lines == 2 and got[0].n_dropped == 0


def test_line_dedup_against_all_pairs(docs, spark):
    r = np.random.default_rng(11)
    odd = [(i, t) for i, t in TEXTS if t != LONG]
    odd += [(None, "no id\nof its own, whatever"), (7, "two texts of one id\nof its own, whatever"), (70, "x" * 50_000), (71, "x" * 49_000 + "\n\n \nA  b"), (72, "ab " * 900), (73, "ab " * 950)]
    base = ["".join(r.choice(list("abcdefg hij "), n)) for n in r.integers(20, 400, 60)]
    for k in range(240):  # copies with a few letters changed
        x = list(base[k % 60])
        for at in r.integers(0, len(x), int(r.integers(0, 1 + len(x) // 60))):
            x[at] = "z"
        odd.append((1000 + k, "".join(x) + f"\nown line of {k} {k * k}"))
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    table = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    for df, rows in ((frame, odd), (spark.createDataFrame(table, "doc_id long, text string"), table)):
        want, same = brute_drops(rows)
        got = dropped(df, rows)
        assert same <= got <= want  # exact repeats all go, and nothing goes that is like no other line
        assert len(got - same) >= 0.95 * len(want - same) > 0
    clash = frame.withColumns({c: F.lit("clash") for c in ("_id", "_key", "_drop", "row", "at", "drop", "n_lines", "a.b")})
    out = linededup.dedup_lines(clash)
    assert out.count() == len(odd) and out.columns == [c for c in clash.columns if c != "n_lines"] + ["n_lines", "n_dropped"]


def test_line_dedup_covers_large_buckets(spark, monkeypatch):
    """Chains of windows, a family and lone lines, all in one bucket."""
    chain = [" ".join(f"q{c}word{i}" for i in range(4 * k, 4 * k + 60)) for c in range(2) for k in range(30)]
    family = [" ".join(f"fam{i}" for i in range(60)) + f" tail{k}" for k in range(25)]
    texts = [*chain, *family, *[" ".join(f"lone{k}x{i}" for i in range(30)) for k in range(5)]]
    lines = spark.createDataFrame([(i, -i, t) for i, t in enumerate(texts)], "a long, b long, line string")
    bands = lines.select("a", "b", F.array(F.lit(7)).alias("bands"))
    shingles = lines.withColumn("n", F.size(F.array_distinct(linededup.shingle_hashes(F.col("line")))))
    sets = [shingle_set(t) for t in texts]
    want = components(range(len(texts)), [(i, j) for i, u in enumerate(sets) for j in range(i) if alike(u, sets[j])])
    for leaders in (4, 1000):
        monkeypatch.setattr(linededup, "LEADERS", leaders)
        got = collections.defaultdict(set)
        for r in linededup._linked(bands, lambda keys: shingles.join(keys, "a")).collect():
            got[r.component].add(r.a)
        own = {i: min(g) for g in got.values() for i in g}
        assert {i: own.get(i, i) for i in range(len(texts))} == want


def test_line_dedup_takes_lines_of_all_scripts_and_lengths(spark):
    long = ["".join(chr(0x4E00 + i * 7 % 997) for i in range(500)), "这是一个重复的句子没有空格", "one\ttwo\tthree\tfour\tfive", "aa\u00a0bb\u00a0cc\u00a0dd\u00a0ee", "x" * 30 + "-" + "y" * 30, "标题", "s", "😀 a"]
    blank = ["", "\t" * 60, "\u00a0" * 60]
    rows = [(i, "\n".join([*long, *blank])) for i in range(3)]
    got = by_id(linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[0].text == rows[0][1]
    for i in (1, 2):
        assert got[i].text.split("\n") == blank and got[i].n_dropped == len(long)


def test_line_bands_find_pairs_at_the_bound(spark):
    import random

    r = random.Random(1)
    rows = []
    while len(rows) < 400:
        words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(34)]
        x = " ".join(words)
        at = r.sample([i for i in range(len(x)) if x[i] != " "], 2)
        y = "".join("0" if i in at else c for i, c in enumerate(x))
        assert alike(shingle_set(x), shingle_set(y))
        rows += [(2 * len(rows), x), (2 * len(rows) + 1, y)]
    gone = sum(v.n_dropped for v in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert 0.97 * len(rows) / 2 <= gone <= len(rows) / 2


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    out = packing.pack_documents(docs, path, 512).collect()
    want = collections.Counter()
    for i, t in TEXTS:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 512):
            own = ids[k : k + 512]
            want[i, k // 512, k, len(own), zlib.crc32(own.tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in out) == want
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 512
    assert len(by) <= -(-sum(r.length for r in out) // 512) + 1
    assert packing.pack_documents(empty, path).count() == 0


def test_chunk_encoder():
    import random

    e = packing.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(4)
    parts = [*"aAbBéÉñß12½'-_.,!<|> \t\n\x01\x1c\x85 ́中😀Σσ", "İ", "'s", "'LL", "<|endoftext|>", "don't"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert e.encode(t) == e.whole(t), repr(t)


def test_chunk_encoder_splits_at_dots_and_commas_and_goes_with_its_last_use():
    import gc
    import random
    import weakref

    path = public_tokenizers.path("word_bpe_49k.json")
    r = random.Random(5)
    e = packing.ChunkEncoder(path)
    parts = ["a", "é", "œ", "Ⱥ", "7", "½", " ", "\xa0", "\n", ".", ".", ",", ",", "'", "'s", "'re", "!", "_", "«", "中"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert e.encode(t) == e.whole(t), repr(t)
    gone = [weakref.ref(x) for x in (e, e.words, e.chunks)]
    gc.disable()
    try:
        del e
        assert not any(x() for x in gone)  # at once, not when the collector comes by
    finally:
        gc.enable()


def test_evolution_beats_best_fit_decreasing():
    def check(sizes):
        best = packing.evolve(sizes, [], 4096, 1)[0]
        assert sorted(i for b in best for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 4096 for b in best)
        plain = packing._Bins(4096)
        plain.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes)
        return len(best), len(plain.bins)

    rng = np.random.default_rng(5)
    for n in (20, 40, 60):  # triplets that fill n sequences exactly
        pairs = np.c_[rng.integers(1400, 1900, n), rng.integers(1000, 1300, n)].tolist()
        got, plain = check([x for p in pairs for x in (*p, 4096 - sum(p))])
        assert n <= got < plain
    got, plain = check([int(x) for x in rng.integers(800, 1800, 200)])
    assert got < plain
    got, plain = check([int(x) for x in rng.integers(30, 3000, 300)])
    assert got <= plain


def test_memo_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_BYTES", 2000)
    memo = packing._Memo(lambda k: k.encode())
    assert [memo[str(i)] for i in range(100)] == [str(i).encode() for i in range(100)]
    assert len(memo) < 10 and memo["x" * 5000] == b"x" * 5000 and "x" * 5000 not in memo


def test_rows_with_null_and_repeated_ids_are_judged_by_themselves(spark):
    item = " ".join(f"b{i}" for i in range(13))
    rows = [
        (1, "four words in all"), (1, item + " and seven more words that are clean here"), (None, item), (None, "clean"), (1, item + " x"),
        (2, "nothing at all"), (2, "Licensed under CC BY-NC 4.0."), (None, "Licensed under CC BY-NC 4.0."), (2, "nothing at all"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (8, item), (9, "nothing at all")], "item_id long, text string")
    got = decontamination.contamination(df, items).collect()
    hits = {item: (13, 2), "nothing at all": (3, 1)}
    want = collections.Counter((i, len(lower_words(t)), *next((v for k, v in hits.items() if k in t), (0, 0))) for i, t in rows)
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got) == want
    assert {r.items_sha256 for r in got if r.n_hit == 13} == {hashlib.sha256(b"8").hexdigest()}
    found = collections.Counter((r.doc_id, r.labels) for r in licenses.scan(df).collect())
    assert found == collections.Counter((i, "cc-by-nc-4.0" if "CC" in t else "") for i, t in rows)
    odd = df.withColumns({"own": F.lit(1), "fp": F.lit("x"), "a.b": F.lit(2)})
    kept = simhash.one_of_each(odd).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, [rows[0], rows[1], (1, item + " x"), (None, item), (None, "clean"), rows[5], rows[6]]))
    assert simhash.one_of_each(odd.limit(0)).columns == odd.columns


def test_pii(docs, empty, spark):
    crf = pii.train(pii.training_table(n=300), rounds=60)
    right = total = 0
    for words, tags in pii.training_table(seed=99, n=150):
        got = pii.viterbi([crf.scores(words)], crf.move)[0]
        right += sum(pii.TAGS[g] == t for g, t in zip(got, tags, strict=True))
        total += len(tags)
    assert right / total > 0.98
    text = 'mail a.b@c.org, 10.0.0.256 10.0.0.1; 4845168114407329, 4845168114407328, +1 (017) 555-7713 token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'
    more = spark.createDataFrame([(50, text), (51, "1" * 5000), (52, "@" * 50 + "x@y.z")], "doc_id long, text string")
    rows = by_id(pii.scan(docs.select("doc_id", "text").union(more), crf))
    r = rows[50]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    spans = [s.split(":") for s in r.spans.split(",")]
    assert {k: text[int(a) : int(b)] for k, a, b in spans} == {
        "email": "a.b@c.org", "ip": "10.0.0.1", "card": "4845168114407329", "phone": "+1 (017) 555-7713",
        "secret": "04dbebab91ab85687d33eeaaf9ac699e1188f962"}
    assert rows[1].spans == "" and rows[1].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[52].n_email == 1
    assert pii.scan(empty, crf).count() == 0


def planted(seed, n):
    """Texts with the spans of kinds that the CRF adds, from sentences that it wasn't trained on."""
    import random

    r = random.Random(seed)
    for words, tags in pii.training_table(seed=seed, n=n):
        filler = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 9))) for _ in range(40)]
        words, tags = filler + words + filler, ["O"] * 40 + tags + ["O"] * 40
        text, want, at = " ".join(words), [], 0
        for w, t in zip(words, tags, strict=True):
            if t[0] == "B":
                want.append([t[2:], at, 0])
            if t != "O":
                want[-1][2] = at + len(w)
            at += len(w) + 1
        for x in want:
            while text[x[1]] in pii._EDGE + "=":
                x[1] += 1
            while text[x[2] - 1] in pii._EDGE:
                x[2] -= 1
        yield text, {tuple(x) for x in want}


def test_plain_words_say_what_the_general_way_has_them_say():
    import random

    r = random.Random(3)
    parts = [*"aZbéÉßÿÞªºµ×1.,", "at", "tel", "TOKEN", "key"]
    for _ in range(20_000):
        w = "".join(r.choice(parts) for _ in range(r.randint(1, 6)))
        core = w.strip(pii._EDGE)
        said = pii._about(w)
        shape = core
        for pattern, to in pii._SHAPES:
            shape = pattern.sub(to, shape)
        low = w.lower().strip("\"'`,;!?.:") or w
        assert said[:2] == (shape if len(shape) <= 12 else shape[:6] + "~" + shape[-6:], pii._CUE_OF.get(low, "-")), w
        assert said[2] == ("0" if not core else str(min(9, len(core) // 4))) and said[3] == str(min(12, sum(c.isdigit() for c in core)))


def test_pii_spans_of_planted_texts():
    decoder = pii.Decoder(pii.train(pii.training_table()))
    texts, want = zip(*planted(99, 300), strict=True)
    got = [set(x) for x in pii.crf_spans(list(texts), decoder)]
    right, found, there = (sum(map(len, x)) for x in ([g & w for g, w in zip(got, want, strict=True)], got, want))
    print("added spans: precision", right / found, "recall", right / there, "of", there)
    assert right / found > 0.95 and right / there > 0.95
    said = ["please write to jane [at] example punkt org today", "the api_key = abcdefghijklmnopqrstuvwxyzabcdefgh here"]
    assert [[k for k, _, _ in x] for x in pii.crf_spans(said, decoder)] == [["email_spelled"], ["secret"]]


def test_what_is_not_decoded_is_o_in_the_best_path():
    import random

    decoder = pii.Decoder(pii.train(pii.training_table(n=200), rounds=40))
    r, seen = random.Random(5), 0
    for text, _ in planted(7, 60):
        words = text.split()
        r.shuffle(words)
        words = words[: r.randint(0, 60)]
        e = decoder.scores(words) if words else np.zeros((0, len(pii.TAGS)), np.float32)
        assert np.allclose(e, decoder.crf.scores(words)) if words else True
        whole = pii.viterbi([e], decoder.crf.move)[0] if words else np.zeros(0, np.int8)
        own = np.zeros(len(words), np.int8)
        for first, s in pii.segments(words, decoder):
            path = pii.viterbi([s], decoder.crf.move)[0]
            own[first : first + len(path)] |= path
            seen += len(path)
        assert own.tolist() == whole.tolist()
    assert seen


def test_viterbi_is_exact():
    import itertools

    rng = np.random.default_rng(3)
    n = len(pii.TAGS)
    move = (rng.normal(size=(n, n)) + pii._allowed()).astype(np.float32)
    start = np.array([-1e4 if t[0] == "I" else 0 for t in pii.TAGS])
    scores = [rng.normal(size=(k, n)).astype(np.float32) for k in (1, 2, 3, 4)]
    for s, got in zip(scores, pii.viterbi(scores, move), strict=True):
        value = lambda p, s=s: start[p[0]] + sum(s[i, t] for i, t in enumerate(p)) + sum(move[a, b] for a, b in itertools.pairwise(p))
        assert value(list(got)) == pytest.approx(max(map(value, itertools.product(range(n), repeat=len(s)))), abs=1e-3)


def test_base_patterns_match_plain_regexes():
    import random

    r = random.Random(6)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(4000):
        t = "".join(r.choice("a1.@+ -%b2") for _ in range(50))
        assert [m.span() for m in email.finditer(t)] == pii.emails(t)
        assert [m.span() for m in ip.finditer(t)] == [m.span() for m in pii._IP.finditer(t)]


def test_toxicity(docs, empty, spark):
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400)]
    bad = ["vilewretch", "gruesome", "nastyfool"]

    def text(y):
        t = list(rng.choice(words, 60))
        return " ".join(t[:30] + (list(rng.choice(bad, 3)) if y else []) + t[30:])

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(900)]
    all_docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = by_id(toxicity.classify(all_docs, labels))
    assert len(got) == 900
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.97
    odd = toxicity.classify(docs, labels).collect()
    assert len(odd) == len(TEXTS) and all(r.score is not None for r in odd)
    assert toxicity.classify(empty, labels).count() == 0
    assert {r.predicted for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0}


def test_language(spark):
    texts = {"en": "the cat sat on the mat with this thing", "fr": "le chat est sur la table avec une chose", "de": "die katze sitzt auf der matte und schläft"}
    model = langid.fit([(k, v) for k, v in texts.items() for _ in range(20)])
    rows = []
    for k, (lang, t) in enumerate(texts.items()):
        rows += [(k * 100 + i, f"http://h{k}.example.{lang}/p{i}", f"<html lang='{lang}'><script>{texts['en']}</script><p>{t}</p></html>") for i in range(30)]
    rows += [(900, "http://h1.example.fr/x", "<html><p>12345</p></html>"), (901, None, None), (902, "", ""), (903, "http://h2.example.de/y", f"<html lang=en><p>{texts['de']}</p>"), (903, "http://h2.example.de/y", f"<html lang=en><p>{texts['de']}</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    out = langid.identify(pages, model).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r for r in out}
    langs = list(texts)
    assert all(got[k * 100 + i].lang == langs[k] for k in range(3) for i in range(30))
    assert got[900].lang == "fr" and got[903].lang == "de" and got[901].lang is not None
    assert langid.identify(pages.limit(0), model).count() == 0
    # The fusion, once more in numpy.
    parts = [(i, *langid.page_parts(u, h)) for i, u, h in rows]
    post = np.array([model.posterior(p[5]) for p in parts])
    total = post.sum(axis=0) + 1
    sums = lambda key: {v: post[[key(q) == v for q in parts]].sum(axis=0) for v in {key(p) for p in parts}}
    hosts, domains, suffixes, declared = (sums(lambda p, j=j: p[j]) for j in (1, 2, 3, 4))
    for p, own in zip(parts, post, strict=True):
        up = domains[p[2]] + langid.DOMAIN_WEIGHT * total / total.sum()
        prior = np.maximum(0, hosts[p[1]] - own) + langid.HOST_WEIGHT * up / up.sum()
        s = suffixes[p[3]]
        fused = own * prior / prior.sum() * (s + langid.EVIDENCE_WEIGHT * s.sum() / total.sum()) / (total + langid.EVIDENCE_WEIGHT)
        if p[4]:
            right = np.array([langid.DECLARED_RIGHT if x == p[4] else (1 - langid.DECLARED_RIGHT) / 3 for x in model.langs])
            fused = fused * (declared[p[4]] + langid.EVIDENCE_WEIGHT * right) / (total + langid.EVIDENCE_WEIGHT)
        assert got[p[0]].confidence == pytest.approx((fused / fused.sum()).max(), rel=1e-6)


def test_declared_language_is_looked_for_in_whole_pages(spark):
    import random

    far = "<!--" + "x" * 30_000 + "-->"
    assert langid.page_parts(None, far + "<html lang='fr'>a")[3] == "fr"
    assert langid.page_parts(None, far + "<META http-equiv=content-language content=DE>a")[3] == "de"
    open_ = "<html " * 200_000 + "<meta content-language " * 100_000 + "lang=" + " " * 100_000
    assert not langid._declared(open_, *langid._LANG) and not langid._declared(open_, *langid._META)
    plain = [r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", r"(?is)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([a-z]{2,3})\b"]
    r, seen = random.Random(8), 0
    parts = ["<html", "<meta", " ", " ", "lang", "=", "'", '"', "en", "fra", ">", "content-language", "content", "x", "<"]
    for _ in range(20_000):
        t = "".join(r.choice(parts) for _ in range(30))
        m = re.search(plain[0], t) or re.search(plain[1], t)
        seen += m is not None
        assert langid.page_parts(None, t)[3] == (m[1] if m else ""), t
    assert seen > 30
    rows = [(i, f"l{i % 40:02}", f"text {i}") for i in range(800)]
    drawn = langid.sample(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert drawn == sorted((lang, text) for _, lang, text in rows)


def test_kept_frames_are_computed_once(spark):
    """An eager checkpoint computes its last stage twice; line dedup and components keep frames as Parquet."""
    from tidewater.llm import common

    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    rows = spark.sparkContext.parallelize([(1,), (2,), (3,)], 1).map(count)
    out = common.kept(spark.createDataFrame(rows, "a long"))
    assert sorted(r.a for r in out.collect()) == [1, 2, 3] and seen.value == 3
    assert not hasattr(linededup, "cut")


def test_line_dedup_makes_few_pairs_of_unlike_lines_in_a_bucket(spark, monkeypatch):
    """Lines with one long common passage share a bucket; their sketches part them before their sets are compared."""
    r = np.random.default_rng(3)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = [f"{passage} " + " ".join(f"x{v}" for v in r.integers(0, 1 << 30, 20)) for _ in range(80)]
    texts += [t[:-4] for t in texts[:20]]
    lines = spark.createDataFrame([(i, -i, t) for i, t in enumerate(texts)], "a long, b long, line string")
    shingles = lines.withColumn("n", F.size(F.array_distinct(linededup.shingle_hashes(F.col("line")))))
    compared, plain = [], linededup._alike
    monkeypatch.setattr(linededup, "_alike", lambda pairs, texts: (compared.append(pairs.count()), plain(pairs, texts))[1])
    got = linededup._linked(lines.select("a", "b", F.array(F.lit(7)).alias("bands")), lambda keys: shingles.join(keys, "a")).collect()
    assert len(got) == 40 and all(g.a % 80 == h.a % 80 for g in got for h in got if g.component == h.component)
    assert sum(compared) <= 2 * len(texts)  # not 4,950


def test_line_sketches_lose_no_pair(spark):
    r = np.random.default_rng(4)
    base = "".join(r.choice(list("abcdefgh ij"), 2500))
    texts = [base[: int(n)] for n in r.integers(1, 2500, 30)] + ["", "a", base + base]
    for changes in (1, 5, 20, 60):
        for at in r.integers(0, 2400, (8, changes)):
            x = list(base)
            for i in at:
                x[i] = "z"
            texts.append("".join(x))
    lines = spark.createDataFrame(list(enumerate(texts)), "a long, line string")
    rows = lines.withColumn("n", F.size(F.array_distinct(linededup.shingle_hashes(F.col("line"))))).drop("line").join(linededup._sketches(lines), "a")
    other = rows.select(F.col("a").alias("a2"), F.col("n").alias("n2"), *[F.col(f"s{k}").alias(f"t{k}") for k in range(linededup.SKETCH)])
    likely = rows.crossJoin(other).where("a < a2").where(linededup._can_be_alike(F.col("n"), F.col("n2"), "s", "t"))
    sets = [shingle_set(t) for t in texts]
    want = {(i, j) for j, u in enumerate(sets) for i in range(j) if alike(u, sets[i])}
    got = {(x.a, x.a2) for x in likely.select("a", "a2").collect()}
    assert want <= got and len(got) < len(texts) * (len(texts) - 1) / 2


def test_first_words_of_sketches_rule_out_what_whole_sketches_do(spark, monkeypatch):
    import random

    r = random.Random(12)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(5, 300))) for _ in range(25)]
    texts += [t[: int(len(t) * r.uniform(0.75, 1))] + "x" * r.randint(0, 9) for t in texts]
    lines = spark.createDataFrame(list(enumerate(texts)), "a long, line string")
    rows = lines.withColumn("n", F.size(F.array_distinct(linededup.shingle_hashes(F.col("line"))))).drop("line").join(linededup._sketches(lines), "a").cache()
    other = rows.select(F.col("a").alias("a2"), F.col("n").alias("n2"), *[F.col(f"s{k}").alias(f"t{k}") for k in range(linededup.SKETCH)])
    found = []
    for words in (1, linededup.FIRST_WORDS, linededup.SKETCH):
        monkeypatch.setattr(linededup, "FIRST_WORDS", words)
        can = linededup._can_be_alike(F.col("n"), F.col("n2"), "s", "t")
        found.append({tuple(x) for x in rows.crossJoin(other).where("a < a2").where(can).select("a", "a2").collect()})
    assert linededup.SKETCH > 8 and found[0] == found[1] == found[2] and 0 < len(found[0]) < 200


def test_line_shingles_are_of_characters_with_and_without_surrogate_pairs(spark):
    texts = ["", "a", "short", "exactly8", "nine char", "é" * 9, "这是一个重复的句子没有空格", "plain ascii in front 😀 and behind it", "😀" * 12, "plain ascii in front of it"]
    got = spark.createDataFrame(list(enumerate(texts)), "a long, line string").select("a", linededup.shingle_hashes(F.col("line")).alias("h")).collect()
    for r in got:
        t = texts[r.a]
        want = [xxhash.xxh64_intdigest(t[i : i + 8].encode("utf-16-be"), 42) for i in range(max(1, len(t) - 7))]
        assert [h % (1 << 64) for h in r.h] == want, t


def test_line_dedup_hashes_a_text_once_not_at_every_line(spark):
    """The hash of the whole text must be made before the lines are dealt out: the split refers to it."""
    docs = spark.createDataFrame([(1, "a\nb\n\n")], "doc_id long, text string")
    parts = linededup._parts(docs)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "doc_key" in re.search(r"Generate posexplode\((.*?)\), \[", plan, re.S)[1]
    key = xxhash.xxh64_intdigest(b"a\nb\n\n", 42)
    assert [(r.place.doc_id, r.place.doc_key % (1 << 64), r.place.nth, r.raw) for r in parts.collect()] == [(1, key, k, x) for k, x in enumerate(["a", "b", "", ""])]


def test_components_on_the_driver_are_the_same(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(-200, 200, (150, 2))] + [(1000 + i, 1001 + i) for i in range(80)]
    frame = spark.createDataFrame(links, "a long, b long")
    here, there = ({tuple(x) for x in common.connected_components(frame, "a", "b", local=n).collect()} for n in (1000, 10))
    assert here == there and common.connected_components(frame.limit(0), "a", "b", local=9).count() == 0
