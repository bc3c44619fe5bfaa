"""The operators as queries over a directory of tables.

Each ``opN_*`` query applies its operator, with production parameters, to whole
tables and derives the columns that the query's contract names.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bpe, decontaminate, langid, multiindex, paragraphs, periodic, quality, repeats, simhash, subspaces, tokencount,
    tokenfiles, variants,
)
from headway.llm.frames import table

#: The contract of SimHash near-dedup.
SHINGLE_WORDS, SIMHASH_BITS = 3, 3
#: The contract of exact substring removal.
REPEAT_BYTES = 200
#: Fewest words of a paragraph that is compared: all but blank lines.
PARAGRAPH_WORDS = 1
#: The contract of the quality score.
GOOD_SCORE = 0.3
#: The contract of decontamination.
WINDOW_WORDS = 10
#: The contracts of token files and of the vector search.
END_ID, QUERY_EVERY, NEIGHBOURS = 2, 20, 20
#: The contracts of runs, spelling variants and the vector join.
RUN_WORDS, RUN_PERIODS, LETTER_DROP, VARIANT_RATIO, NEAR_COSINE = 24, 3, 199, 5, 0.9
WORD_LENGTH, WORD_COUNT = 6, 5
#: The end-of-text id of word_bpe_49k.json.
END_OF_TEXT = 49407

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Folder of the public tokenizer files; they are never copied here.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return put


@register("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(
        table(spark, sf_dir, "documents"), words=SHINGLE_WORDS, distance=SIMHASH_BITS
    )


@register("op5_repeats")
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removals(table(spark, sf_dir, "documents"), length=REPEAT_BYTES)


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=GOOD_SCORE
    )


#: The contract's words and windows in SQL; a word is hit if the window that
#: starts at most nine words before it occurs in the document there.
DECONTAMINATION_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
i as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
iw as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from i where len(w) > 0)),
lens as (select distinct n from iw),
dw as (
  select doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d), lens where p + n - 1 <= len(w)),
m as (select distinct doc_id, p, iw.n as n, item_id from dw join iw on dw.win = iw.win and dw.n = iw.n),
hit as (select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(p, p + n)) as pos from m) group by doc_id),
found as (select doc_id, count(distinct item_id) as n_items,
  string_agg(distinct item_id, ',' order by item_id) as ids from m group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join hit on hit.doc_id = d.doc_id left join found on found.doc_id = d.doc_id
"""


@register("op3_decontamination", DECONTAMINATION_SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=WINDOW_WORDS
    )
    return found.drop("item_ids")


@register("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(
        table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", end_id=END_ID
    )


@register("op10_neighbours")
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multiindex.nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0, k=NEIGHBOURS)


@register("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@register("op4_paragraphs")
def op4_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.report(table(spark, sf_dir, "documents"), min_words=PARAGRAPH_WORDS)


@register("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The separator is the vocabulary's own end-of-text id."""
    return tokencount.counts_of_texts(
        table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", end_id=END_OF_TEXT
    )


def _said_again() -> Column:
    """The contract's texts: in a tenth of the documents the words from some place on
    are the first few of them, over and over."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def again(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("bigint"), n - 1)
        place = F.transform(places, lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get(words, i.cast("int"))), " "))

    # Within an array, the words are taken once and not for every place.
    split = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, F.transform(F.array(split), again)[0]).otherwise(F.col("text"))


@register("op11_periodic")
def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic.report(docs, _said_again(), least=RUN_WORDS, exponent=RUN_PERIODS)


@register("op12_variants")
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(
        table(spark, sf_dir, "documents"), min_length=WORD_LENGTH, min_count=WORD_COUNT, ratio=VARIANT_RATIO,
        altered=variants.letter_dropper(LETTER_DROP),
    )


@register("op13_subspaces")
def op13_subspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspaces.near_duplicates(table(spark, sf_dir, "embeddings"), least=NEAR_COSINE)
