"""Language of web pages by Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, cut, let

#: Bounds of the labelled sample: documents of each language, bytes of a document.
DOCS_PER_LANG, MAX_TEXT_BYTES = 300, 50_000
BUCKETS = 1 << 15
#: The trigrams of a page count as this many independent ones at most.
EFFECTIVE = 60
#: Weights of the parent in the host hierarchy and of the prior of evidence tables.
HOST_WEIGHT, DOMAIN_WEIGHT, EVIDENCE_WEIGHT = 4.0, 8.0, 20.0
#: Share of pages whose declared language is taken to be right before any is counted.
DECLARED_RIGHT = 0.8

_HIDDEN = re.compile(r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")
_VALUE = r"\s*+=\s*+[\"']?+\s*+([a-z]{2,3})\b"
#: Beginning of a tag and what is looked for in it, one after the other.
_LANG = [re.compile(r"(?i)<html\b"), re.compile(r"(?i)\blang" + _VALUE)]
_META = [re.compile(r"(?i)<meta\b"), re.compile(r"(?i)content-language"), re.compile(r"(?i)content" + _VALUE)]
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)


def _declared(html: str, begin: re.Pattern, *parts: re.Pattern) -> str:
    """The value in the first tag that has all parts, anywhere in the page; linear in its length."""
    m = begin.search(html)
    while m:
        # What begins later but before the same '>' can't have more parts.
        end = html.find(">", m.end())
        end = len(html) if end < 0 else end
        for part in parts:
            m = m and part.search(html, m.end(), end)
        if m:
            return m[1].lower()
        m = begin.search(html, end)
    return ""


def page_parts(url: str | None, html: str | None) -> tuple[str, str, str, str, str]:
    """host, domain, suffix, declared language and visible text; '' for what there isn't."""
    m = _HOST.match(url or "")
    host = m[1].lower().rstrip(".") if m else ""
    labels = host.split(".")
    html = html or ""
    declared = _declared(html, *_LANG) or _declared(html, *_META)
    text = unescape(_TAG.sub(" ", _HIDDEN.sub(" ", html)))
    return host, ".".join(labels[-2:]), labels[-1], declared, text


def trigrams(text: str) -> np.ndarray:
    """Bucket numbers of the character trigrams of a text, lower-cased, runs of non-letters as one space."""
    words = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    c = np.frombuffer(words.encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)
    return ((h ^ (h >> np.uint64(15))) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class TextModel:
    langs: list[str]
    logp: np.ndarray  # (BUCKETS, langs)

    def posterior(self, text: str) -> np.ndarray:
        """Under equal priors; uniform for a text without letters."""
        t = trigrams(text)
        if not len(t):
            return np.full(len(self.langs), 1 / len(self.langs))
        z = self.logp[t].sum(axis=0) * min(1.0, EFFECTIVE / len(t))
        p = np.exp(z - z.max())
        return p / p.sum()


def fit(rows: list[tuple[str, str]]) -> TextModel:
    """Smoothed trigram probabilities from (language, text) rows."""
    langs = sorted({r[0] for r in rows}) or ["und"]
    counts = np.full((BUCKETS, len(langs)), 0.1)
    for lang, text in rows:
        np.add.at(counts[:, langs.index(lang)], trigrams(text), 1)
    return TextModel(langs, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(language, text) rows for ``fit``: all labelled languages, documents of each by a hash of their id."""
    known = docs.where(
        F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("doc_id").isNotNull() & (F.octet_length("text") <= MAX_TEXT_BYTES)
    )
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id"))
    ids = known.select("lang", "doc_id").withColumn("place", place).where(F.col("place") <= DOCS_PER_LANG).select("doc_id").distinct()
    rows = known.join(F.broadcast(ids), "doc_id", "left_semi").select("lang", "text").collect()
    return sorted((r[0], r[1]) for r in rows)


def read_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, host, domain, suffix, declared, text_post): what each page says by itself."""
    bound_batches(pages.sparkSession)
    slim = pages.select("page_id", "url", "html")
    langs = set(model.langs)

    def batches(it):
        for b in it:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = [page_parts(u, h) for u, h in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                declared = [r[3] if r[3] in langs else ("other" if r[3] else "") for r in rows]
                post = [model.posterior(r[4]).tolist() for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([r[k] for r in rows], pa.string()) for k in range(3)), pa.array(declared, pa.string()), pa.array(post, pa.list_(pa.float64()))],
                    ["page_id", "host", "domain", "suffix", "declared", "text_post"],
                )

    kind = slim.schema["page_id"].dataType.simpleString()
    return slim.mapInArrow(batches, f"page_id {kind}, host string, domain string, suffix string, declared string, text_post array<double>")


def _sums(df: DataFrame, key: str, n: int) -> DataFrame:
    """Expected pages of each language by key, as an array; partial sums come before the shuffle."""
    cols = [F.sum(F.col("text_post")[k]).alias(f"c{k}") for k in range(n)]
    return df.groupBy(key).agg(*cols).select(key, F.array(*[f"c{k}" for k in range(n)]).alias("counts"))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _normal(a: Column) -> Column:
    return let(a, lambda v: F.transform(v, lambda x: x / _total(v)))


def identify(pages: DataFrame, model: TextModel) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, host for every page.

    posterior(l) ~ prior(l | host) * p(text | l) * p(declared | l) * p(suffix | l)

    The prior of a host is smoothed towards its domain's, and that towards the
    whole's; a page's own share is taken out of its host's counts, so that its
    text doesn't count twice. Tables of declared languages and suffixes are
    counted over all pages with weak priors. Counts are sums of text posteriors.

    Pages without letters rest on the other evidence; without a url they share
    the host ''; null urls and html count as empty. Ties go to the language that
    comes first. Repeated rows are judged alike; an empty table gives an empty
    result; other columns are ignored.
    """
    k = len(model.langs)
    read = cut(read_pages(pages, model))
    overall = [F.sum(F.col("text_post")[i]) for i in range(k)]
    total = [float(x or 0) + 1.0 for x in read.agg(*overall).first()]
    base = F.array(*[F.lit(x / sum(total)) for x in total])
    all_of = F.array(*[F.lit(x) for x in total])

    hosts = _sums(read.select("host", "text_post"), "host", k).withColumn(
        "domain", F.substring_index("host", ".", -2)
    ).withColumn("suffix", F.substring_index("host", ".", -1))
    hosts = cut(hosts)
    lift = lambda df, key: df.withColumnRenamed("counts", "text_post").groupBy(key).agg(
        F.array(*[F.sum(F.col("text_post")[i]) for i in range(k)]).alias("counts")
    )
    domains = lift(hosts, "domain").select(
        "domain",
        F.zip_with("counts", base, lambda c, b: c + DOMAIN_WEIGHT * b).alias("up"),
    ).select("domain", _normal(F.col("up")).alias("domain_prior"))
    # p(suffix | l): the language's pages with this suffix over all of the language's.
    suffixes = lift(hosts, "suffix").select(
        "suffix",
        F.zip_with(F.col("counts"), all_of, lambda c, t: (c + EVIDENCE_WEIGHT * _total(F.col("counts")) / sum(total)) / (t + EVIDENCE_WEIGHT)).alias("suffix_like"),
    )
    table = hosts.join(domains, "domain").join(suffixes, "suffix").select("host", "counts", "domain_prior", "suffix_like")
    declared = _sums(read.where("declared <> ''").select("declared", "text_post"), "declared", k)
    right = F.array(*[F.when(F.col("declared") == x, DECLARED_RIGHT).otherwise((1 - DECLARED_RIGHT) / max(1, k)) for x in model.langs])
    likes = declared.select(
        "declared",
        F.zip_with(
            F.zip_with("counts", right, lambda c, r: c + EVIDENCE_WEIGHT * r), all_of, lambda c, t: c / (t + EVIDENCE_WEIGHT)
        ).alias("declared_like"),
    )  # one row for each language of the model and one for others
    host_prior = F.zip_with(
        F.zip_with("counts", "text_post", lambda c, own: F.greatest(F.lit(0.0), c - own)),
        "domain_prior",
        lambda c, p: c + HOST_WEIGHT * p,
    )
    product = lambda a, b: F.zip_with(a, b, lambda x, y: x * y)
    flat = F.array(*[F.lit(1.0)] * k)
    fused = product(product(product("text_post", _normal(host_prior)), F.coalesce("declared_like", flat)), "suffix_like")
    best = lambda a: F.get(F.array(*[F.lit(x) for x in model.langs]), F.array_position(a, F.array_max(a)).cast("int") - 1)
    return (
        read.join(table, "host")
        .join(F.broadcast(likes), "declared", "left")
        .select("page_id", "host", "declared", "text_post", _normal(fused).alias("posterior"))
        .select(
            "page_id",
            best(F.col("posterior")).alias("lang"),
            F.array_max("posterior").alias("confidence"),
            best(F.col("text_post")).alias("text_lang"),
            "declared",
            "host",
        )
    )
