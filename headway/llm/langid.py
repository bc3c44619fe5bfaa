"""Language identification by Bayesian evidence fusion.

The posterior of a page's language multiplies four kinds of evidence:

* the text's likelihood under naive Bayes models of character 3-grams, one for
  each language, fitted on a bounded sample of labelled texts;
* the language that the markup declares (the ``lang`` of the ``html`` element);
* the address suffix (the last label of the host);
* a prior for the host, smoothed towards that of its domain (the last two
  labels), which is smoothed towards that of all pages.

How much a declaration or a suffix says, and the priors, are learned from the
pages themselves: grouped sums of the posteriors that the text alone gives. A
host's prior leaves the page itself out, so no page confirms itself. Neighbouring
n-grams say much the same, so the text's log-likelihood counts with
``Settings.text_weight`` and, beyond ``most_grams`` n-grams, no more.

Texts are the markup, the title included, without tags (and what their
attributes say), scripts, styles and comments. A page without an
address has no host, one without markup no declaration; missing evidence says
nothing. Null and empty pages are judged by the rest. Rows that repeat a page id
are pages of their own. Without labelled texts there are no languages, and
``lang`` is null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.frames import batch_parts, written

#: What opens hidden text, and what closes each kind of it.
OPENS = re.compile(r"<(script|style)\b|<!--", re.I)
CLOSES = {
    "script": re.compile(r"</script\s*>", re.I), "style": re.compile(r"</style\s*>", re.I), None: re.compile("-->"),
}
TAG = re.compile(r"<[^>]*>")
GRAM_MULTIPLIER = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes of one numpy step.
STEP = 1 << 18
#: Different languages of the texts at most.
LANGUAGES = 1_000


@dataclass(frozen=True)
class Settings:
    texts_per_language: int = 400
    bits: int = 16
    text_weight: float = 0.1
    most_grams: int = 500
    host_strength: float = 5.0  # pages that the domain's prior counts as
    domain_strength: float = 20.0
    value_strength: float = 20.0  # pages of no evidence added to declarations and suffixes


def shown(html: str) -> Iterator[str]:
    """What lies outside scripts, styles and comments. What is never closed hides
    nothing; that there is no close is found out once for each kind, so broken
    pages take no longer than others."""
    at, open_for_ever = 0, set()
    for start in OPENS.finditer(html):
        kind = start.group(1) and start.group(1).lower()
        if start.start() < at or kind in open_for_ever:
            continue
        end = CLOSES[kind].search(html, start.end())
        if end is None:
            open_for_ever.add(kind)
            continue
        yield html[at : start.start()]
        at = end.end()
    yield html[at:]


def visible(html: str | None) -> str:
    """The text of a page."""
    text = " ".join(shown(html or ""))
    last = text.rfind(">") + 1  # no tag ends behind it
    return unescape(TAG.sub(" ", text[:last]) + text[last:])


def grams(text: str, bits: int) -> np.ndarray:
    """Hashed character 3-grams of the lowered text, white space as one blank."""
    points = np.frombuffer(" ".join(("", *text.lower().split(), "")).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(points) < 3:
        return np.empty(0, np.int64)
    joined = points[:-2] | points[1:-1] << np.uint64(21) | points[2:] << np.uint64(42)
    return (joined * GRAM_MULTIPLIER >> np.uint64(64 - bits)).astype(np.int64)


def _blocks(text: str) -> Iterator[str]:
    """Long texts in several parts."""
    for at in range(0, len(text), STEP):
        yield text[at : at + STEP]


def fit(texts: DataFrame, settings: Settings, lang_column: str = "lang", text_column: str = "text",
        id_column: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihoods by language and 3-gram), from at most
    ``texts_per_language`` texts of each language, by a hash of their ids."""
    own = texts.select(F.col(lang_column).alias("lang"), F.xxhash64(id_column).alias("hash"),
                       F.col(text_column).alias("text")).where("lang is not null and text is not null")
    languages = sorted(r["lang"] for r in own.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if not languages:
        return [], np.zeros((0, 1 << settings.bits), np.float32)
    if len(languages) > LANGUAGES:
        raise ValueError(f"texts of more than {LANGUAGES} languages")
    # Each task keeps the first of each language before they are dealt by language.
    by_hash = W.partitionBy("lang").orderBy("hash")
    chosen = own.select("lang", "hash").withColumn("place", F.row_number().over(by_hash)).where(
        F.col("place") <= settings.texts_per_language
    ).drop("place")
    sample = own.join(F.broadcast(chosen.distinct()), ["lang", "hash"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for block in _blocks(text):
                    own = np.bincount(grams(block, settings.bits), minlength=1 << settings.bits)
                    totals[lang] = totals.get(lang, 0) + own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.list_(pa.int64()))],
            names=["lang", "counts"],
        )

    # A task gives a row for each language.
    rows = sample.select("lang", "text").mapInArrow(count, "lang string, counts array<bigint>").select(
        "lang", F.posexplode("counts").alias("gram", "n")
    ).where("n > 0").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(languages), 1 << settings.bits))
    place = {lang: i for i, lang in enumerate(languages)}
    lang = np.array([place[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
    table[lang, rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    smooth = table + 0.5
    return languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(html: Column, table: np.ndarray, settings: Settings) -> Column:
    """Weighted log-likelihood of the text for each language."""

    @F.arrow_udf("array<double>")
    def of(pages: pa.Array) -> pa.Array:
        out = []
        for part in batch_parts(pages):
            for page in part.to_pylist():
                total, n = np.zeros(len(table)), 0
                for block in _blocks(visible(page)):
                    found = grams(block, settings.bits)
                    total += table[:, found].sum(axis=1, dtype=np.float64)
                    n += len(found)
                out.append(total * (settings.text_weight * min(1.0, settings.most_grams / max(n, 1))))
        return pa.array(out, pa.list_(pa.float64()))

    return of(html)


def host(url: Column) -> Column:
    """The host of an address, lower case; null without one."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def declared(html: Column) -> Column:
    """The language, without region, that the html element declares. No attribute
    holds an angle bracket, so broken tags are not searched again and again."""
    found = F.regexp_extract(F.lower(html), r"<html\b[^<>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)
    return F.when(found != "", found)


def _softmax(logs: Column) -> Column:
    most = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - most))
    total = _total(powers)
    return F.transform(powers, lambda x: x / total)


def _sums(rows: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """Sums of the text's posteriors by ``key``, an array for each value."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array(*[F.sum(F.col("by_text")[i]) for i in range(size)]).alias(name)
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _mixed(own: Column, base: Column, strength: float) -> Column:
    """(own + strength * base) / total: the smoothed distribution."""
    total = _total(own) + strength
    return F.zip_with(own, base, lambda x, y: (F.greatest(x, F.lit(0.0)) + strength * y) / total)


def _less(all_of: Column, some: Column) -> Column:
    return F.zip_with(all_of, some, lambda x, y: x - y)


def _plus(first: Column, second: Column) -> Column:
    return F.zip_with(first, second, lambda x, y: x + y)


def identify(pages: DataFrame, texts: DataFrame, settings: Settings = Settings(), id_column: str = "page_id",
             url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per page: id, host, declared, suffix, text_lang (by the text alone), lang
    and its posterior ``probability``. Of equally probable languages the first by
    name is taken."""
    languages, table = fit(texts, settings)
    size = len(languages)
    facts = pages.select(
        F.col(id_column).alias("id"), host(F.col(url_column)).alias("host"),
        declared(F.col(html_column)).alias("declared"), F.col(html_column).alias("html"),
    ).withColumns({
        "suffix": F.regexp_extract("host", r"([^.]+)$", 1),
        "domain": F.regexp_extract("host", r"([^.]+\.[^.]+|[^.]+)$", 1),
    })
    if not size:
        none = F.lit(None).cast("string")
        return facts.select(F.col("id").alias(id_column), "host", "declared", "suffix", none.alias("text_lang"),
                            none.alias("lang"), F.lit(None).cast("double").alias("probability"))
    evidence = written(
        facts.withColumn("evidence", text_evidence(F.col("html"), table, settings)).drop("html")
        .withColumn("by_text", _softmax(F.col("evidence"))),
        "language-evidence",
    )
    every = evidence.groupBy().agg(
        F.array(*[(F.coalesce(F.sum(F.col("by_text")[i]), F.lit(0.0)) + 1) / (F.count(F.lit(1)) + size) for i in range(size)]).alias("p")
    ).first()["p"]
    overall = F.array(*[F.lit(float(p)) for p in every])

    def likelihood(key: str) -> DataFrame:
        """(key, weight): for each value the ratio of its share among a language's
        pages to its share among all, smoothed towards 1."""
        sums = _sums(evidence, key, size, "sums").withColumn("total", _total(F.col("sums")))
        strength = settings.value_strength
        ratio = F.zip_with(
            "sums", overall, lambda x, y: F.log((x + strength * y) / ((F.col("total") + strength) * y))
        )
        return written(sums.select(key, ratio.alias(f"by_{key}")), "language-values")

    domains = _sums(evidence, "domain", size, "domain_sums")
    hosts = written(
        evidence.where("host is not null").groupBy("host").agg(
            F.first("domain").alias("domain"),
            F.array(*[F.sum(F.col("by_text")[i]) for i in range(size)]).alias("host_sums"),
        ).join(domains, "domain").drop("domain"),
        "language-hosts",
    )
    joined = (
        evidence.join(hosts, "host", "left").join(likelihood("declared"), "declared", "left")
        .join(likelihood("suffix"), "suffix", "left")
    )
    # The page itself, and its host in the domain's prior, don't count.
    own = _less(F.col("host_sums"), F.col("by_text"))
    domain = _mixed(_less(F.col("domain_sums"), F.col("host_sums")), overall, settings.domain_strength)
    prior = F.coalesce(_mixed(own, domain, settings.host_strength), overall)
    nothing = F.array_repeat(F.lit(0.0), size)
    values = _plus(F.coalesce("by_declared", nothing), F.coalesce("by_suffix", nothing))
    logs = _plus(F.zip_with("evidence", prior, lambda e, p: e + F.log(p)), values)
    names = F.array(*[F.lit(x) for x in languages])

    def top(column: str) -> Column:
        return F.element_at(names, F.array_position(column, F.array_max(column)).cast("int"))

    fused = joined.withColumn("logs", logs).withColumn("fused", _softmax(F.col("logs")))
    return fused.select(
        F.col("id").alias(id_column), "host", "declared", "suffix", top("by_text").alias("text_lang"),
        top("fused").alias("lang"), F.array_max("fused").alias("probability"),
    )
