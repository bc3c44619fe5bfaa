"""Benchmark decontamination with a distributed positional inverted index.

DataFrame functions only. Training texts become token arrays, stored once. Of
every different window of the test items the two rarest terms are looked up, by their
frequency over all training texts. The index keeps the postings (term,
document, position) of these terms. The list of the rarest term, moved by the distance
of the two in the window, is intersected with the other's list; where they meet
the window is a candidate. Only candidates are compared word by word, and
windows that match exactly count.

Windows are looked up, not items, so an item that says the same over and over costs one
window, and a document is split once however many candidates it has.

A proximity match lets the two lists differ by up to ``slop`` positions and
then asks that every word of the window occurs around that place.

Words: A-Z is lowered, words are runs of letters a-z, digits and all characters
beyond ASCII. A window is ``size`` consecutive words of an item; a shorter item
with words is one window. Null and empty texts have no words, items without
words match nothing. Rows that repeat a document id, null ids included, are
documents of their own; rows that repeat an item id are one item with the
windows of all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.frames import free_name, written

#: The characters of a word, before and after A-Z is lowered.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def tokens(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Stored token arrays: (row, id, text_hash, n_words, words); ``row`` is a
    number of its own for each row."""
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"),
        F.xxhash64(text_column).alias("text_hash"), words(F.col(text_column)).alias("words"),
    )
    return written(
        found.select("row", "id", "text_hash", F.size("words").cast("bigint").alias("n_words"), "words"),
        "tokens", "zstd",
    )


def items(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, words) of test items that have words."""
    found = benchmark.select(
        F.col(item_column).cast("string").alias("item_id"), words(F.col(text_column)).alias("words")
    )
    return written(found.where("size(words) > 0 and item_id is not null").distinct(), "items")


def windows(entries: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The different windows of all items, (window, words), and which items have
    them, (window, item_id)."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    cut = F.transform(starts, lambda at: F.slice("words", at, size))
    named = written(entries.select("item_id", F.explode(cut).alias("words")).distinct(), "item-windows")
    each = written(
        named.select("words").distinct().select(F.monotonically_increasing_id().alias("window"), "words"), "windows"
    )
    return each, written(named.join(each, "words").select("window", "item_id"), "window-items")


def probes(stored: DataFrame, each: DataFrame) -> DataFrame:
    """(window, length, offset, rarest, other, gap): for every window whose words all
    occur somewhere its rarest word and where it stands, the second rarest and how far behind the
    rarest it stands (the same word and 0 in a window of one word).

    Frequencies count all occurrences in all training texts.
    """
    at = each.select("window", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
    terms = written(at.select("term").distinct(), "terms")
    # Counted before the shuffle; Spark moves the semi-join below the count if the terms are few.
    counts = (
        stored.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        .join(terms, "term", "left_semi")
    )
    picked = at.join(counts, "term", "left").groupBy("window", "length").agg(
        F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))), 1, 2)
        .alias("rare")
    )
    first, second = F.col("rare")[0], F.element_at("rare", -1)
    return picked.where(first["n"] > 0).select(
        "window", "length", first["offset"].alias("offset"), first["term"].alias("rarest"),
        second["term"].alias("other"), (second["offset"] - first["offset"]).alias("gap"),
    )


def postings(stored: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, row, position): the inverted lists of the given terms."""
    return stored.select("row", F.posexplode("words").alias("position", "term")).join(terms, "term").select(
        "term", "row", "position"
    )


def candidates(stored: DataFrame, looked_up: DataFrame, slop: int = 0) -> DataFrame:
    """(row, window, length, begin): where the lists of a window's two rarest words
    meet, up to ``slop`` positions out of place; ``begin`` by the rarest word.

    Windows with the same two words at the same distance share one
    intersection, so neighbouring windows of an item and repeated ones cost one.
    """
    pairs = looked_up.select("rarest", "other", "gap").distinct()
    terms = pairs.select(F.explode(F.array("rarest", "other")).alias("term")).distinct()
    lists = written(postings(stored, terms), "postings", "zstd")
    ahead = lists.withColumnRenamed("term", "rarest").join(pairs, "rarest").select(
        "row", "position", "rarest", "other", "gap",
        F.explode(F.sequence(F.col("position") + F.col("gap") - slop, F.col("position") + F.col("gap") + slop))
        .alias("there"),
    )
    behind = lists.select("row", F.col("position").alias("there"), F.col("term").alias("other"))
    met = ahead.join(behind, ["row", "there", "other"], "left_semi").select("row", "position", "rarest", "other", "gap")
    return (met.distinct() if slop else met).join(looked_up, ["rarest", "other", "gap"]).select(
        "row", "window", "length", (F.col("position") - F.col("offset")).alias("begin")
    )


def _beside(stored: DataFrame, places: DataFrame, slop: int = 0) -> DataFrame:
    """(row, window, begin, there): the places with the words of the text from
    ``slop`` before to ``slop`` behind the window. A text is split once for all
    places in it."""
    asked = places.groupBy("row").agg(F.collect_list(F.struct("window", "length", "begin")).alias("places"))
    # Words as one text are less to shuffle than an array; within an array, they are split once.
    split = F.array(F.split("joined", " "))

    def cut(text: Column) -> Column:
        return F.transform("places", lambda p: F.struct(
            p["window"].alias("window"), p["begin"].alias("begin"),
            F.slice(text, F.greatest(p["begin"] - slop, F.lit(0)) + 1, p["length"] + 2 * slop).alias("there"),
        ))

    return stored.select("row", F.concat_ws(" ", "words").alias("joined")).join(asked, "row").select(
        "row", F.explode(F.transform(split, cut)[0]).alias("at")
    ).select("row", "at.*")


def _occurrences(stored: DataFrame, each: DataFrame) -> DataFrame:
    """(row, window, position, length): exact occurrences, each once."""
    looked_up = written(probes(stored, each), "probes")
    found = _beside(stored, candidates(stored, looked_up).where("begin >= 0"))
    same = found.withColumnRenamed("there", "words").join(each, ["window", "words"])
    return same.select("row", "window", F.col("begin").alias("position"), F.size("words").alias("length"))


def phrase_matches(stored: DataFrame, entries: DataFrame, size: int = 10) -> DataFrame:
    """(row, item_id, position, length): exact occurrences of item windows."""
    each, held = windows(entries, size)
    return _occurrences(stored, each).join(held, "window").select("row", "item_id", "position", "length").distinct()


def proximity_matches(stored: DataFrame, entries: DataFrame, size: int = 10, slop: int = 3) -> DataFrame:
    """(row, item_id, position, length): windows whose two rarest words stand
    up to ``slop`` positions out of place against each other and all of whose
    words occur within ``slop`` positions around; ``position`` is where the window
    would begin by its rarest word."""
    each, held = windows(entries, size)
    looked_up = written(probes(stored, each), "probes")
    near = _beside(stored, candidates(stored, looked_up, slop), slop)
    found = near.join(each, "window").where(F.size(F.array_except("words", "there")) == 0)
    return found.join(held, "window").select(
        "row", "item_id", F.col("begin").alias("position"), F.size("words").alias("length")
    ).distinct()


def _covered(spans: Column) -> Column:
    """Words under the union of (position, length) spans, sorted by position."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))

    def add(done: Column, span: Column) -> Column:
        stop = (span["position"] + span["length"]).cast("bigint")
        begin = F.greatest(span["position"].cast("bigint"), done["end"])
        return F.struct((done["n"] + F.greatest(stop - begin, F.lit(0))).alias("n"),
                        F.greatest(stop, done["end"]).alias("end"))

    return F.aggregate(spans, zero, add)["n"]


def _per_row(matches: DataFrame, held: DataFrame) -> DataFrame:
    """(row, n_hit, item_ids). A document's spans are fewer than its words."""
    spans = matches.groupBy("row", "position").agg(F.max("length").alias("length"))
    hits = spans.groupBy("row").agg(
        _covered(F.array_sort(F.collect_list(F.struct("position", "length")))).alias("n_hit")
    )
    named = matches.select("row", "window").distinct().join(held, "window").groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids")
    )
    return hits.join(named, "row")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_column: str = "doc_id",
                  text_column: str = "text", item_column: str = "item_id",
                  item_text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit (words under any exact window),
    n_items, item_ids (sorted), items_sha256 and contaminated."""
    stored = tokens(docs, id_column, text_column)
    each, held = windows(items(benchmark, item_column, item_text_column), size)
    # Read twice below: for the words hit and for the items.
    found = _per_row(written(_occurrences(stored, each), "occurrences"), held)
    rows = stored.select("row", "id", "n_words").join(found, "row", "left")
    named = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.select(
        F.col("id").alias(id_column), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(named).cast("bigint").alias("n_items"), named.alias("item_ids"),
        F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_column: str = "doc_id",
                  text_column: str = "text", item_column: str = "item_id",
                  item_text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without any exact window of a test item, all columns
    as they were."""
    stored = tokens(docs, id_column, text_column)
    hit = _occurrences(stored, windows(items(benchmark, item_column, item_text_column), size)[0])
    own, key = free_name(docs, "bad_id"), free_name(docs, "bad_text")
    bad = stored.join(hit.select("row").distinct(), "row", "left_semi").select(
        F.col("id").alias(own), F.col("text_hash").alias(key)
    )
    return docs.join(
        bad, docs[id_column].eqNullSafe(bad[own]) & (F.xxhash64(docs[text_column]) == bad[key]), "left_anti"
    )
