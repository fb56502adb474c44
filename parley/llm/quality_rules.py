"""Quality rules as a short-circuit cascade (DataFrame functions only).

The rules are independent predicates; a document is rejected by the first one
that holds.  On a sample each rule's cost (seconds) and selectivity (rejected
rows) are measured, and the rules are put in order of rejections per second,
so that most rejected documents leave after cheap rules.  The order changes
the work, never the verdict.

Where only the verdict counts (``keep_documents``) the base is part of the
cascade and every rule computes its own statistics, so a document rejected by a
cheap rule is never searched for repeated windows.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import WORD, let, words, written

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean Column over the relation the cascade runs on;
    NULL counts as "does not reject"."""

    name: str
    rejects: Column


def repeat_words(ws: Column, window: int = WINDOW) -> Column:
    """Number of words inside some ``window``-word window that occurs twice or
    more in the text (first occurrence included).

    Windows are compared by a 64-bit hash of their words.  The usual text has
    no repeated window and is settled by one hash-set pass; otherwise
    (hash, position) pairs are sorted and the repeated positions, in order,
    cover min(window, distance to the next) words each.
    """
    n = F.size(ws)

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(ws, i + k) for k in range(window)])

    def covered(positions: Column) -> Column:
        gaps = F.transform(
            positions,
            lambda p, i: F.when(i == 0, F.lit(window)).otherwise(
                F.least(F.lit(window), p - F.get(positions, i - 1))
            ),
        )
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def repeated(pairs: Column) -> Column:
        same = lambda p, i, j: F.coalesce(F.get(pairs, j)["h"] == p["h"], F.lit(False))
        kept = F.filter(pairs, lambda p, i: same(p, i, i - 1) | same(p, i, i + 1))
        return let(F.sort_array(F.transform(kept, lambda p: p["p"])), covered)

    def from_hashes(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(pairs, repeated)
        )

    hashes = F.transform(F.sequence(F.lit(0), n - window), window_hash)
    return F.when(n <= window, F.lit(0).cast("bigint")).otherwise(let(hashes, from_hashes))


def with_word_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words) of the whole texts; NULL text counts as empty."""
    # The words are bound once: an optimiser that moves a later filter below
    # this projection repeats the expression, but never per word.
    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("bigint").alias("n_words"),
            F.length(F.concat_ws("", ws)).cast("bigint").alias("word_chars"),
            repeat_words(ws).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        n = F.size(lines)
        return F.struct(n.cast("bigint").alias("n"), (n - F.size(F.array_distinct(lines))).cast("bigint").alias("dup"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return df.select(
        F.col(id_col),
        text.alias("text"),
        let(words(F.col(text_col)), of_words).alias("w"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        let(lines, of_lines).alias("ln"),
    ).select(
        id_col,
        "text",
        "w.n_words",
        "w.word_chars",
        "n_symbols",
        F.col("ln.n").alias("n_lines"),
        F.col("ln.dup").alias("n_dup_lines"),
        "w.n_repeat_words",
    )


def base_rules(s: Mapping[str, Column]) -> list[Rule]:
    """Too short, or more than a fifth of the words in repeated windows."""
    return [
        Rule("short", s["n_words"] < 10),
        Rule("repeated_words", 100 * s["n_repeat_words"] > 20 * s["n_words"]),
    ]


def style_rules(s: Mapping[str, Column]) -> list[Rule]:
    """The other rules; all ratios are exact integer comparisons."""
    letters = F.length(F.regexp_replace(s["text"], r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(s["text"], r"[^\p{Lu}]+", ""))
    digits = F.length(F.regexp_replace(s["text"], r"[^0-9]+", ""))
    return [
        Rule("symbols", 10 * s["n_symbols"] > s["n_words"]),
        Rule("capitals", 10 * capitals > 3 * letters),
        Rule("digits", 2 * digits > s["word_chars"]),
        Rule("word_length", (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 20 * s["n_words"])),
        Rule("repeated_lines", (s["n_dup_lines"] >= 10) & (2 * s["n_dup_lines"] > s["n_lines"])),
    ]


def statistic_columns() -> dict[str, Column]:
    """The columns of ``with_word_statistics`` by name."""
    names = ("text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    return {name: F.col(name) for name in names}


def lazy_statistics(ws: Column, text: Column) -> dict[str, Column]:
    """The same statistics as expressions over a document's words and text,
    each computed where a rule asks for it."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return {
        "text": text,
        "n_words": F.size(ws),
        "word_chars": F.length(F.concat_ws("", ws)),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))),
        "n_repeat_words": repeat_words(ws),
    }


def base_failed() -> Column:
    """Whether one of the base rules rejects."""
    short, repeated = base_rules(statistic_columns())
    return short.rejects | repeated.rejects


def default_rules() -> list[Rule]:
    """The style rules over ``with_word_statistics``."""
    return style_rules(statistic_columns())


def all_rules(ws: Column, text: Column) -> list[Rule]:
    """Base and style rules over a document's words and text."""
    s = lazy_statistics(ws, text)
    return base_rules(s) + style_rules(s)


def measure_rules(sample: DataFrame, rules: list[Rule], repeat: int = 20) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule on ``sample``, whose rows
    are repeated so that the time of a job's start does not drown the rule's."""
    rows = sample.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(repeat)))).drop("__again")

    def run(condition: Column) -> tuple[float, float]:
        taken, share = [], 0.0
        for _ in range(3):
            began = time.perf_counter()
            share = rows.agg(F.avg(F.when(condition, 1.0).otherwise(0.0)).alias("r")).first()["r"] or 0.0
            taken.append(time.perf_counter() - began)
        return statistics.median(taken), share

    floor, _ = run(F.lit(False))
    out = []
    for rule in rules:
        seconds, share = run(rule.rejects)
        out.append((rule, max(seconds - floor, 1e-4), share))
    return out


def order_rules(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by rejections per second on the sample, most first."""
    measured = measure_rules(sample, rules)
    return [rule for rule, _, _ in sorted(measured, key=lambda m: (-m[2] / m[1], m[1], m[0].name))]


def bounded_sample(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of the first partitions, read by a few tasks and
    written, so that rules are timed on stored rows.  It only decides the order
    of the rules."""
    return written(df.sparkSession.createDataFrame(df.limit(rows).collect(), df.schema), "rule-sample")


def rejecting_rule(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, else NULL; later rules are not
    evaluated."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(rule.rejects, F.lit(rule.name)) for rule in rules])


def quality_cascade(df: DataFrame, rules: list[Rule], sample: DataFrame | None = None) -> DataFrame:
    """``df`` with ``rejected_by`` (NULL: kept); with a sample the rules are
    put in cascade order first.  One narrow pass, no shuffle."""
    ordered = order_rules(sample, rules) if sample is not None else rules
    return df.withColumn("rejected_by", rejecting_rule(ordered))


def ordered_default_rules(docs: DataFrame, id_col: str, text_col: str, sample_rows: int) -> list[Rule]:
    """The default rules in cascade order."""
    texts = docs.select(F.col(id_col), F.col(text_col)).where(F.col(text_col).isNotNull())
    sample = written(with_word_statistics(bounded_sample(texts, sample_rows), id_col, text_col), "rule-statistics")
    return order_rules(sample, default_rules())


def order_of_all_rules(docs: DataFrame, text_col: str, sample_rows: int) -> list[str]:
    """Names of base and style rules in cascade order, each timed with the
    statistics that it needs."""
    texts = docs.select(F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    sample = written(bounded_sample(texts, sample_rows).select(words(F.col("text")).alias("ws"), "text"), "rule-words")
    return [rule.name for rule in order_rules(sample, all_rules(F.col("ws"), F.col("text")))]


def keep_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 256
) -> DataFrame:
    """The documents that pass the base and all rules, with all their columns."""
    order = order_of_all_rules(docs, text_col, sample_rows)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def verdict(ws: Column) -> Column:
        return rejecting_rule(sorted(all_rules(ws, text), key=lambda rule: order.index(rule.name)))

    kept = let(words(F.col(text_col)), verdict).isNull()
    # A generator, not a filter: a filter would be moved and split.
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.inline(F.when(kept, F.array(doc))))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 256
) -> DataFrame:
    """Statistics and verdict per document (one row per input row).

    Returns id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept.  NULL, empty and blank texts have zero words and fail
    the base; NULL ids and repeated rows pass through; an empty table gives an
    empty result; other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col), F.col(text_col))
    rules = ordered_default_rules(docs, id_col, text_col, sample_rows)
    rows = with_word_statistics(docs, id_col, text_col).withColumn("base_failed", base_failed())
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(rejecting_rule(rules))
    return rows.select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        verdict.isNull().alias("kept"),
    )
