"""Toxicity by compression distance: two zstandard dictionaries, calibrated lengths.

A window is one word, lower-cased and stripped of punctuation, or a stretch of a
longer token (stretches overlap by half and cover all of it), set between two
constant carriers; the carriers lie in both dictionaries, so that a window is
always compressed and the two lengths differ by the window alone. The ordinary
dictionary holds frequent words of ordinary text; the toxic one has the same size
and differs only in its last section, which holds words that toxic training text
has many times as often. Window length and length difference select a log-odds
weight counted on other labelled rows; a logistic curve over a document's weights
gives the score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches

#: Bounds of the labelled sample that the model is fitted on.
MAX_TOXIC, MAX_ORDINARY, MAX_TEXT_BYTES = 1500, 3000, 40_000
#: Shares of toxic documents that a word of the toxic section must occur in; calibration picks one.
SHARES = (0.005, 0.01, 0.02, 0.04, 0.08)
#: Toxic text must have such a word this many times as often as ordinary text.
CONTRAST = 10
LEVEL = 11
COMMON_WORDS = 3000
MAX_SECTION_WORDS = 4000
#: Bytes of a window at most, and distinct windows whose weight a worker remembers during a task.
WINDOW, MEMO = 64, 150_000
#: Window lengths and differences are clipped to these.
MAX_LENGTH, LEAST_DIFF, MOST_DIFF = 24, -4, 12

_PUNCTUATION = bytes(
    b for b in range(0x21, 0x7F) if not (chr(b).isalnum())
)
_TO_SPACE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def windows(text: str | None) -> list[bytes]:
    words = (text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split()
    if max(map(len, words), default=0) <= WINDOW:
        return words
    step = WINDOW // 2
    return [w[k : k + WINDOW] for w in words for k in range(0, max(1, len(w) - step), step)]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    before: bytes
    after: bytes
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    curve: np.ndarray


class Scorer:
    """Applies a model; holds the compressors and remembers windows."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}
        self.pair = [self._compressor(d) for d in (model.ordinary, model.toxic)]

    @staticmethod
    def _compressor(content: bytes):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def cell(self, word: bytes) -> tuple[int, int]:
        framed = self.model.before + word + self.model.after
        a, b = (len(c(framed)) for c in self.pair)
        return min(len(word), MAX_LENGTH), max(LEAST_DIFF, min(MOST_DIFF, a - b)) - LEAST_DIFF

    def weight(self, word: bytes) -> float:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[word] = float(self.model.weights[self.cell(word)])
        return found

    def features(self, text: str | None) -> np.ndarray:
        words = windows(text)
        v = np.fromiter(map(self.weight, words), np.float64, len(words)) if words else np.zeros(1)
        high, n = v[v > 0.7], len(words) + 20
        total = high.sum()
        return np.array([v.max(), total / n**0.5, total / n, len(high) / n, np.log1p(total), np.log(n)])

    def score(self, texts) -> np.ndarray:
        m = self.model
        x = np.array([self.features(t) for t in texts]).reshape(-1, 6)
        z = ((x - m.mean) / m.scale) @ m.curve[:-1] + m.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[str, str | None, int]]) -> Model:
    """A model from (key, text, label) rows. Rows of one class alone give a constant score.

    By a hash of the key, three quarters of the rows make the dictionaries, the
    rest the weights, the choice among SHARES and the logistic curve.
    """
    part = [zlib.crc32(b"part" + str(k).encode()) % 4 for k, _, _ in rows]
    hold = [(t, y) for (_, t, y), p in zip(rows, part, strict=True) if not p]
    toxic, plain, n = Counter(), Counter(), [0, 0]
    for (_, t, y), p in zip(rows, part, strict=True):
        if p:
            (toxic if y else plain).update(set(windows(t)))
            n[bool(y)] += 1
    ranked = sorted(plain, key=lambda w: (-plain[w], w))
    common = ranked[:COMMON_WORDS][::-1]
    base = b" " + b" ".join(common) + b" "
    before = b" " + b" ".join(common[-14:]) + b" "
    after = b" " + b" ".join(common[-40:-30]) + b" "
    best, models = None, set()
    for share in SHARES:
        least = max(3, int(n[1] * share))
        section = sorted(
            (w for w in toxic if toxic[w] >= least and toxic[w] / n[1] > CONTRAST * (plain[w] + 0.5) / max(1, n[0])),
            key=lambda w: (toxic[w], w),
        )[-MAX_SECTION_WORDS:]
        if tuple(section) in models:
            continue
        models.add(tuple(section))
        extra = b" ".join(section) + b" "
        held = set(section)
        filler = b" ".join(w for w in ranked[COMMON_WORDS : COMMON_WORDS + 4 * MAX_SECTION_WORDS] if w not in held)
        filler = (filler + b" " * len(extra))[: len(extra) - 1] + b" "
        model = Model(base + filler, base + extra, before, after, *([None] * 4))
        loss = _calibrate(model, hold)
        if best is None or loss < best[0]:
            best = loss, model
    return best[1]


def _calibrate(model: Model, hold: list[tuple[str | None, int]]) -> float:
    """Set the weights and the curve; the curve's cross-validated log loss."""
    shape = (MAX_LENGTH + 1, MOST_DIFF - LEAST_DIFF + 1)
    scorer, cells = Scorer(model), {}
    counts = np.zeros((2, 2, *shape))
    half = [i % 2 for i in range(len(hold))]
    for (text, y), h in zip(hold, half, strict=True):
        for w in windows(text):
            c = cells.get(w)
            if c is None:
                c = cells[w] = scorer.cell(w)
            counts[h, int(y)][c] += 1

    def weights(c):
        odds = np.log((c[1] + 0.5) / (c[1].sum() + 10) * (c[0].sum() + 10) / (c[0] + 0.5))
        return np.where(c.sum(axis=0) < 20, np.minimum(odds, 1), odds)

    y = np.array([y for _, y in hold], float)
    x = np.zeros((len(hold), 6))
    for h in (0, 1):  # a row's features use weights that were counted on the other half
        model.weights, scorer.memo = weights(counts[1 - h]), {}
        for i in (i for i in range(len(hold)) if half[i] == h):
            x[i] = scorer.features(hold[i][0])
    model.weights = weights(counts.sum(axis=0))
    model.mean = x.mean(axis=0) if len(x) else np.zeros(6)
    model.scale = (x.std(axis=0) if len(x) else np.zeros(6)) + 1e-9
    z = np.c_[(x - model.mean) / model.scale, np.ones(len(x))]
    model.curve = w = np.zeros(7)
    if 0 < y.sum() < len(y):
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w -= np.linalg.solve((z.T * (p * (1 - p))) @ z + np.eye(7), z.T @ (p - y) + w)
    else:  # nothing to tell apart
        w[-1] = 4.0 if len(y) and y.all() else -4.0
    p = np.clip(1 / (1 + np.exp(-np.clip(z @ w, -30, 30))), 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()) if len(y) else 0.0


def held_out(id_col: Column) -> Column:
    """Rows whose label is never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[str, str | None, int]]:
    """Labelled training rows, at most MAX_TOXIC and MAX_ORDINARY, chosen by a hash of the id.

    Of conflicting labels of a document the larger counts; null labels and ids are left out.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    drawn = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(most)
        for y, most in ((1, MAX_TOXIC), (0, MAX_ORDINARY))
    ]
    rows = (
        docs.select("doc_id", "text")
        .where(F.octet_length("text") <= MAX_TEXT_BYTES)
        .join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")  # bounded by the two limits
        .select(F.col("doc_id").cast("string"), "text", "toxic")
        .dropDuplicates(["doc_id"])
        .collect()
    )
    return sorted((r[0], r[1], r[2]) for r in rows)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents' columns with ``score`` after them; whole texts, null counts as empty."""
    out = docs.schema.names

    def batches(it):
        scorer = Scorer(model)
        at = out.index("text")
        for b in it:
            s = scorer.score(t.as_py() for t in b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*out, "score"])

    bound_batches(docs.sparkSession)
    kept = docs.drop("score")
    out = kept.schema.names
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", score double"
    return kept.mapInArrow(batches, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Empty, null and wordless texts get the score of a text without evidence;
    repeated rows are scored alike; an empty table gives an empty result; with
    labels of one class or none the score is constant.
    """
    model = fit(sample(docs, labels))
    return score_documents(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
