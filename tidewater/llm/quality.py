"""Quality rules with risk-controlled thresholds from labelled holdouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut, let

#: All rules together may reject at most this share of a stratum's good documents; each has an equal part of it ...
RISK = 0.02
#: ... and all such statements hold together with this confidence.
CONFIDENCE = 0.95
#: Cutoffs tried for each rule: k / STEPS of its largest value.
STEPS = 40
#: Rules reject what exceeds the cutoff: name, expression over the metrics, largest value.
RULES = {
    "symbols": ("n_symbols / greatest(1, word_chars)", 0.5),
    "dup_lines": ("n_dup_lines / greatest(1, n_lines)", 1.0),
    "repeats": ("n_repeat_words / greatest(1, n_words)", 1.0),
    "long_words": ("word_chars / greatest(1, n_words) / 40", 1.0),
}
#: Strata are these languages and all others together, so their number is fixed.
LANGS = ("en", "de", "fr", "es")
#: Outcomes whose label is learned from; the rest is never looked at.
MIN_WORDS = 50

SPACE = "[\\x20\\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, by sorting hashed windows with their places."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.struct(F.xxhash64(F.slice(words, i, 3)).alias("h"), i.alias("at")),
    )
    twice = lambda s: F.filter(
        s,
        lambda x, i: (x["h"] == F.get(s, i + 1)["h"]).eqNullSafe(True) | (x["h"] == F.get(s, i - 1)["h"]).eqNullSafe(True),
    )
    places = let(F.sort_array(windows), lambda s: F.sort_array(F.transform(twice(s), lambda x: x["at"])))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-9).alias("last"))
    covered = F.aggregate(
        places,
        zero,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return F.when(F.size(words) >= 4, covered).otherwise(0)


def metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` without the text, and the counts that rules are made of."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    kept = [c for c in docs.columns if c not in (text_col, "words", "lines")]
    found = docs.select(*kept, text.alias("_text"), _words(text).alias("words"), lines.alias("lines"))
    return found.select(
        *kept,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    )


def _log_tail(n: str, k: str, p: float) -> Column:
    """log P(Binomial(n, p) <= k), by a running log-sum over 0..k."""
    q = p / (1 - p)
    return F.expr(
        f"""aggregate(sequence(0L, {k}),
              named_struct('term', cast(0 as double), 'total', cast(null as double)),
              (s, j) -> named_struct(
                'term', if(j = 0, {n} * ln({1 - p}D), s.term + ln(({n} - j + 1) / j * {q}D)),
                'total', if(j = 0, {n} * ln({1 - p}D),
                  greatest(s.total, s.term + ln(({n} - j + 1) / j * {q}D))
                  + log1p(exp(-abs(s.total - (s.term + ln(({n} - j + 1) / j * {q}D))))))),
              s -> s.total)"""
    )


def _stratum(lang: str = "lang") -> Column:
    return F.when(F.col(lang).isin(*LANGS), F.col(lang)).otherwise("other")


def rule_steps() -> Column:
    """(rule, step) of each rule: the least k whose cutoff k / STEPS the value doesn't exceed."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.least(F.lit(STEPS), F.ceil(F.expr(f"({value}) / {top}D") * STEPS)).cast("int").alias("step"),
            )
            for name, (value, top) in RULES.items()
        ]
    )


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """(stratum, rule, cutoff_step): the strictest cutoffs whose false rejection is under control.

    For stratum s, rule r and cutoff c, k of the n good labelled documents exceed c.
    The hypothesis "more than risk / rules of good documents exceed c" is refused where
    P(Binomial(n, risk / rules) <= k) is at most (1 - confidence) / (strata x rules): an
    exact bound with Bonferroni's correction over strata and rules. Cutoffs are tried
    from the laxest on and k only grows, so that those of one rule are a fixed sequence
    and need no correction of their own. By the union bound the rules together reject
    more than ``risk`` of a stratum's good documents with probability 1 - confidence at most.
    Documents that fail the base rules take no part. Where no cutoff qualifies the
    rule rejects nothing in that stratum. Labelled rows are reduced to counts by
    (stratum, rule, step) before the shuffle; at most strata x rules rows return.
    """
    good = labels.where(F.col("quality") == 1).select("doc_id").distinct()
    tests, risk = (len(LANGS) + 1) * len(RULES), risk / len(RULES)
    counts = (
        measured.where("not base_failed")
        .join(good, "doc_id", "left_semi")
        .select(_stratum().alias("stratum"), F.explode(rule_steps()).alias("r"))
        .groupBy("stratum", "r.rule", "r.step")
        .agg(F.count("*").alias("c"))
    )
    tried = counts.groupBy("stratum", "rule").agg(
        F.sum("c").alias("n"), F.collect_list(F.struct("step", "c")).alias("steps")
    )
    return (
        tried.select("stratum", "rule", "n", "steps", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("cutoff"))
        .select(
            "stratum",
            "rule",
            "cutoff",
            "n",
            F.expr("aggregate(filter(steps, x -> x.step > cutoff), 0L, (a, x) -> a + x.c)").alias("k"),
        )
        .where(F.col("k") <= F.col("n") * risk)  # others can't pass
        .where(_log_tail("n", "k", risk) <= F.log(F.lit((1 - confidence) / tests)))
        .groupBy("stratum", "rule")
        .agg(F.min("cutoff").alias("cutoff_step"))
    )


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the rules that rejected, for every document.

    Null and empty texts have no words and fail. A null language is the stratum
    "other". Repeated rows are judged alike; equal labels count once. Empty tables
    give an empty result, or rules that reject nothing. Other columns are ignored.
    """
    measured = cut(metrics(docs.select("doc_id", "text", "lang")))
    cutoffs = thresholds(measured, labels).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff_step"))).alias("cutoffs")
    )  # five rows at most
    return (
        measured.withColumn("stratum", _stratum())
        .join(F.broadcast(cutoffs), "stratum", "left")
        .withColumn(
            "rejected_by",
            F.array_join(
                F.transform(
                    F.filter(rule_steps(), lambda r: (r["step"] > F.col("cutoffs")[r["rule"]]).eqNullSafe(True)),
                    lambda r: r["rule"],
                ),
                ",",
            ),
        )
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"),
            "rejected_by",
        )
    )
