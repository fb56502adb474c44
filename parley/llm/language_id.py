"""Language identification of web pages by Bayesian evidence fusion.

Evidence of a page: the likelihood of its main text under character trigram
models, the language its markup declares, a language suffix in its address,
and a prior of its host.  The trigram models are fitted on a bounded sample of
documents with a known language.  Grouped aggregations of the text posteriors
over all pages give what the other evidence is worth: how often each declared
language and each suffix goes with each language, and the host priors, which
are smoothed hierarchically (host towards its domain, domain towards all
pages).  A page's own text does not count in its prior.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import written
from parley.llm.html_extract import Weights, main_text, train_weights
from parley.llm.tokens import text_slices

BUCKETS = 8192
# Trigrams of one text are not independent: beyond this many they add nothing.
EFFECTIVE_TRIGRAMS = 40.0
SMOOTHING = 8.0
# Pages that a declaration or suffix of the language itself is worth beforehand.
AGREES = 2.0


def trigram_counts(text: str) -> np.ndarray:
    """Counts of hashed trigrams of the lower-case text, white space and
    digits as one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    points[(points < 65)] = 32
    points = points[(points != 32) | np.concatenate([[True], points[:-1] != 32])]
    if len(points) < 3:
        return np.zeros(BUCKETS)
    h = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:] * np.uint64(0xC2B2AE3D)
    h ^= h >> np.uint64(17)
    return np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS).astype(float)


@dataclass
class TextModel:
    languages: list[str]
    log_p: np.ndarray  # (BUCKETS, languages)

    def log_likelihood(self, text: str) -> np.ndarray:
        """Log likelihood per language up to a constant; zeros without text."""
        counts = trigram_counts(text)
        n = counts.sum()
        return (counts @ self.log_p) * (min(n, EFFECTIVE_TRIGRAMS) / n) if n else np.zeros(len(self.languages))


def language_sample(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_rows: int
) -> tuple[list[str], DataFrame]:
    """All languages of the documents, and at most ``max_rows`` documents
    (text, lang, rank) of each, among those with text, ranked by a seeded hash
    of id and text.

    A grouped count over all documents gives the languages and the share of
    the hash's range that holds enough rows of each, so only about
    ``max_rows`` rows a language are put in order.
    """
    hashed = F.xxhash64(id_col, text_col, F.lit("language"))
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.lower(F.col(lang_col)).alias("lang"), hashed.alias("h")
    )
    with_text = F.trim("text") != ""
    counts = known.groupBy("lang").agg(
        F.count(F.when(with_text, 1)).alias("n"), F.min(F.when(with_text, F.col("h"))).alias("least")
    )
    counts = counts.collect()
    enough = max_rows + 4 * math.sqrt(max_rows) + 16
    # The row with the least hash counts in any case: equal rows have one hash.
    upto = [
        (r["lang"], max(r["least"], min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, enough / r["n"])))))
        for r in counts
        if r["n"]
    ]
    upto = docs.sparkSession.createDataFrame(upto, "l string, upto long")
    rows = known.where(with_text).join(F.broadcast(upto), (F.col("lang") == F.col("l")) & (F.col("h") <= F.col("upto")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = rows.select("text", "lang", rank.alias("rank")).where(F.col("rank") <= max_rows)
    return sorted(r["lang"] for r in counts), sample


def train_text_model(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 4000
) -> TextModel:
    """Trigram models of all languages of the documents, each from at most
    ``max_rows`` documents with text, chosen by a hash.  A language without
    any text has the mean of the others as its model."""
    languages, sample = language_sample(docs, id_col, text_col, lang_col, max_rows)
    # Dealt by rank as well, so copies of one text are spread over the tasks.
    parts = max(1, docs.sparkSession.sparkContext.defaultParallelism)
    sample = written(sample.repartition(parts, "lang", "rank"), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in text_slices(whole, 0):
                for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    sums[lang] = sums.get(lang, 0.0) + trigram_counts(text)
        names = sorted(sums)
        blobs = [sums[n].astype("<f8").tobytes() for n in names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(blobs, pa.binary())], names=["lang", "sums"])

    totals: dict[str, np.ndarray] = {}
    for r in sample.mapInArrow(count, "lang string, sums binary").collect():
        totals[r["lang"]] = totals.get(r["lang"], 0.0) + np.frombuffer(r["sums"], "<f8")
    if not languages:
        return TextModel(["und"], np.zeros((BUCKETS, 1)))
    # Smoothed towards the mean of all languages.
    shares = {n: t / t.sum() for n, t in totals.items() if t.sum()}
    mean = np.mean(list(shares.values()), axis=0) if shares else np.full(BUCKETS, 1.0 / BUCKETS)
    p = np.stack([shares.get(n, mean) for n in languages], axis=1)
    p = 0.9 * p + 0.09 * p.mean(1, keepdims=True) + 0.01 / BUCKETS
    return TextModel(languages, np.log(p))


def declared_language(html: Column) -> Column:
    """Primary subtag of the first <html lang> attribute of the whole page, ""
    if there is none."""
    tag = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1)
    return F.lower(tag)


def host_of(url: Column) -> Column:
    """Lower-case host without port, "" if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def suffix_language(url: Column, host: Column, languages: list[str]) -> Column:
    """A known language as the first path step or as the last host label."""
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:]+://[^/?#]+/([a-zA-Z]{2,3})(?:[-_/?#]|$)", 1))
    label = F.regexp_extract(host, r"\.([a-z]+)$", 1)
    return F.when(path.isin(languages), path).when(label.isin(languages), label).otherwise(F.lit(""))


def page_evidence(
    pages: DataFrame, model: TextModel, weights: Weights, id_col: str, url_col: str, html_col: str
) -> DataFrame:
    """(id, url, host, domain, declared, suffix, ll): the evidence of each page."""
    host = host_of(F.col(url_col))
    listed = [n for n in model.languages]
    rows = pages.select(
        F.col(id_col),
        F.col(html_col).alias("__html"),
        F.col(url_col),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        declared_language(F.col(html_col)).alias("declared"),
        suffix_language(F.col(url_col), host, listed).alias("suffix"),
    )
    fields = T.StructType(
        [f for f in rows.schema if f.name != "__html"] + [T.StructField("ll", T.ArrayType(T.DoubleType()))]
    )

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                ll = [model.log_likelihood(main_text(page.as_py(), weights)).tolist() for page in batch.column(1)]
                columns = [c for i, c in enumerate(batch.columns) if i != 1] + [pa.array(ll, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=fields.names)

    return rows.mapInArrow(likelihood, fields)


def softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda w: w / total)


def _sums(p: str, n: int) -> list[Column]:
    return [F.sum(F.get(p, F.lit(i))).alias(f"s{i}") for i in range(n)]


def _evidence_table(rows: DataFrame, column: str, languages: list[str]) -> Column:
    """log P(value | language) as a lookup expression over the few values; the
    table has at most languages + 2 rows (other and none)."""
    n = len(languages)
    kept = F.when(F.col(column).isin(languages), F.col(column)).when(F.col(column) == "", "").otherwise("?")
    counts = {r[0]: [r[f"s{i}"] for i in range(n)] for r in rows.groupBy(kept.alias("v")).agg(*_sums("p", n)).collect()}
    totals = [sum(c[i] for c in counts.values()) for i in range(n)]
    values = [*languages, "?", ""]
    out = F.array(*[F.lit(0.0)] * n)  # no evidence
    for v in values[:-1]:
        c = counts.get(v, [0.0] * n)
        none = counts.get("", [0.0] * n)
        logs = [
            math.log((c[i] + 0.5 + AGREES * (languages[i] == v)) / (totals[i] - none[i] + 0.5 * (n + 1) + AGREES))
            for i in range(n)
        ]
        out = F.when(kept == v, F.array(*[F.lit(x) for x in logs])).otherwise(out)
    return out


def fuse_evidence(evidence: DataFrame, languages: list[str], id_col: str, url_col: str) -> DataFrame:
    """Posterior of each page from its evidence and its host's prior."""
    n = len(languages)
    rows = evidence.withColumn("p", softmax(F.col("ll")))
    declared, suffix = _evidence_table(rows, "declared", languages), _evidence_table(rows, "suffix", languages)

    # Host priors: host -> domain -> all pages, each smoothed towards the next.
    per_host = rows.groupBy("host", "domain").agg(*_sums("p", n))
    per_host = per_host.select("host", "domain", F.array(*[F.col(f"s{i}") for i in range(n)]).alias("hs"))
    per_domain = per_host.groupBy("domain").agg(*_sums("hs", n))
    per_domain = per_domain.select(F.col("domain").alias("d"), F.array(*[F.col(f"s{i}") for i in range(n)]).alias("ds"))
    overall = per_domain.agg(*_sums("ds", n)).first()
    base = [(overall[f"s{i}"] or 0.0) + 1.0 for i in range(n)]
    share = F.array(*[F.lit(b / sum(base)) for b in base])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    priors = per_host.join(per_domain, F.col("domain") == F.col("d")).select(F.col("host").alias("h"), "hs", "ds")
    joined = rows.join(priors, F.col("host") == F.col("h"))
    without = lambda a: F.zip_with(a, F.col("p"), lambda x, p: F.greatest(x - p, F.lit(0.0)))
    joined = joined.withColumn("hs", without(F.col("hs"))).withColumn("ds", without(F.col("ds")))
    k = F.lit(SMOOTHING)
    domain = F.zip_with("ds", share, lambda x, g: (x + k * g) / (total(F.col("ds")) + k))
    joined = joined.withColumn("dp", domain)
    joined = joined.withColumn("prior", F.zip_with("hs", "dp", lambda x, d: (x + k * d) / (total(F.col("hs")) + k)))
    logs = F.zip_with("ll", "prior", lambda a, b: a + F.log(b))
    logs = F.zip_with(F.zip_with(logs, declared, lambda a, b: a + b), suffix, lambda a, b: a + b)
    names = F.array(*[F.lit(x) for x in languages])
    return (
        joined.withColumn("posterior", softmax(logs))
        .withColumn("probability", F.array_max("posterior"))
        .select(
            id_col,
            url_col,
            "host",
            "declared",
            "suffix",
            F.get(names, (F.array_position("p", F.array_max("p")) - 1).cast("int")).alias("text_lang"),
            F.get(names, (F.array_position("posterior", F.col("probability")) - 1).cast("int")).alias("lang"),
            "probability",
        )
    )


def identify_pages(
    pages: DataFrame,
    docs: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    doc_id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(id, url, host, declared, suffix, text_lang, lang, probability) per page.

    Missing evidence (NULL or empty html, no text, no declaration, NULL url)
    counts nothing, so such pages get their host's or the overall prior; ties
    go to the first language by name; repeated rows are pages of their own; an
    empty table gives an empty result; without documents of known language the
    only language is "und".
    """
    model = train_text_model(docs, doc_id_col, text_col, lang_col)
    weights = train_weights(pages, html_col)
    evidence = written(page_evidence(pages, model, weights, id_col, url_col, html_col), "page-evidence")
    return fuse_evidence(evidence, model.languages, id_col, url_col)
