"""The operators against plain versions, with nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

tokenizers = pytest.importorskip("tokenizers")

from headway.llm import (  # noqa: E402
    bpe, components, decontaminate, langid, multiindex, paragraphs, quality, repeats, simhash, tokencount,
    tokenfiles,
)
from headway.llm.queries import QUERIES, TOKENIZERS  # noqa: E402

BYTES, WORDS = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/word_bpe_49k.json"
# Columns whose names the operators use themselves, in other letters' case too.
SCHEMA = "doc_id bigint, text string, ID int, row string, text_hash int, ranges int, simhash_print string"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    parts = ["th", "er", "on", "an", "Ré", "in", "ed", "nd", "ß", "st"]
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(words)]
    return " ".join(w + draw.choice(["", "", "", ".", ",", "\n"]) for w in made)


BODY = prose(1, 300)
TEXTS = [
    (1, BODY), (2, BODY), (3, BODY + " more"), (4, None), (5, ""), (6, "  \n "), (7, "A"), (8, "The the THE"),
    (9, prose(2, 6000)), (10, "x" * 5000), (11, prose(3, 40) + BODY[200:900] + prose(4, 40)), (12, prose(5, 80)),
    (13, prose(5, 80)), (None, "no id here at all"), (None, None), (14, "a<|endoftext|>b <|endoftext|>"),
    (2, BODY), (15, prose(6, 12)), (16, "ab" * 2000), (17, "\x1c\x85　é 漢字 😀"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "r", 2, 3, "s") for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# BPE


def test_bpe_equals_the_library():
    library, vocab = tokenizers.Tokenizer.from_file(BYTES), bpe.vocabulary(BYTES)
    draw = random.Random(5)
    texts = [t or "" for _, t in TEXTS] + ["a" * n for n in range(1, 130)] + ["-=" * n for n in range(60)]
    texts += ["".join(draw.choice("ab 'st\n\t1é漢😀<|>") for _ in range(50)) for _ in range(500)]
    for text, ids in zip(texts, vocab.encode(texts), strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert list(ids) == wanted
        assert vocab.decode(ids) == library.decode(wanted, skip_special_tokens=False) == text


def test_bpe_cache_generations_and_long_texts(monkeypatch):
    library = tokenizers.Tokenizer.from_file(BYTES)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 20)
    vocab = bpe.Vocabulary(BYTES)
    texts = [prose(s, 90) for s in range(20)]
    assert [list(i) for i in vocab.encode(texts)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_pair_check_agrees_with_merging():
    vocab = bpe.vocabulary(BYTES)
    words = [w.encode() for w in re.findall(r"\w+", prose(8, 2000))]
    assert [vocab.greedy(w) for w in words] != [vocab.merge(w) for w in words]
    assert vocab.encode_words([w.decode() for w in words]) == [vocab.merge(w) for w in words]


def test_bpe_frames(spark, docs, empty):
    library = tokenizers.Tokenizer.from_file(BYTES)
    got = rows(bpe.digests(docs, BYTES))
    wanted = []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted.append((i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(wanted, key=repr)
    assert rows(bpe.digests(empty, BYTES)) == []
    there = docs.select("text", bpe.encode(F.col("text"), BYTES).alias("ids"))
    back = there.select("text", bpe.decode(F.col("ids"), BYTES).alias("back"))
    assert all((t or "") == b for t, b in back.collect())


# SimHash


def plain_print(text, words=3):
    import xxhash

    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    parts = [" ".join(found[k : k + words]) for k in range(len(found) - words + 1)] or [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    least = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in linked:
            low = min(least[a], least[b])
            moved |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_simhash_equals_brute_force(docs, empty):
    prints = [plain_print(t) for _, t in TEXTS]
    every = range(len(TEXTS))
    linked = [(a, b) for a in every for b in every if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = plain_components(every, linked)
    names = {r: min((TEXTS[i][0] for i in every if root[i] == r and TEXTS[i][0] is not None), default=None)
             for r in root.values()}
    wanted = [(TEXTS[i][0], f"{prints[i]:016x}", names[root[i]]) for i in every]
    assert rows(simhash.near_duplicates(docs)) == sorted(wanted, key=repr)
    assert rows(simhash.near_duplicates(empty)) == []


def test_simhash_long_texts_come_in_blocks(monkeypatch):
    text = prose(9, 3000)
    monkeypatch.setattr(simhash, "TEXT_BLOCK", 100)
    got = simhash.simhash(text.encode(), 3)
    assert got & (1 << 64) - 1 == plain_print(text)


@pytest.mark.parametrize("most", [40, 256])
def test_simhash_links_keep_every_component(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", most)
    draw = random.Random(4)
    heart = draw.getrandbits(64)
    values = {draw.getrandbits(64) for _ in range(50)}
    for _ in range(150):  # a dense cluster and chains
        value = heart
        for _ in range(draw.randint(0, 5)):
            value ^= 1 << draw.randrange(64)
        values.add(value)
    values = sorted(values)
    frame = spark.createDataFrame([(simhash.signed(v),) for v in values], "print bigint")
    got = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(frame, 3, 6).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in got)
    wanted = [(a, b) for a in values for b in values if (a ^ b).bit_count() <= 3]
    assert plain_components(values, got) == plain_components(values, wanted)


def test_deduplicate_keeps_one_row_of_each_group(docs, empty):
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    found = rows(simhash.near_duplicates(docs))
    groups = {c for _, _, c in found}
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(map(repr, groups))
    assert simhash.deduplicate(empty).collect() == []


def test_components(spark):
    draw = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (300, 301), (301, 300)]
    draw.shuffle(pairs)
    frame = spark.createDataFrame([*pairs, (None, 4)], "a bigint, b bigint")
    wanted = plain_components({x for p in pairs for x in p}, pairs)
    assert dict(map(tuple, components.components(frame, "c").collect())) == wanted
    assert components.components(frame.where("a < 0"), "c").collect() == []


# Repeated substrings


def plain_removals(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((len(b), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("most, step", [(1024, 1 << 18), (2, 1 << 10)])
def test_repeats_equal_brute_force(docs, empty, monkeypatch, most, step):
    monkeypatch.setattr(repeats, "BUCKET_ROWS", most)
    monkeypatch.setattr(repeats, "STEP", step)
    plain = plain_removals([t for _, t in TEXTS], 200)
    wanted = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest())
              for (i, _), (n, gone, spans, kept) in zip(TEXTS, plain)]
    assert rows(repeats.removals(docs)) == sorted(wanted, key=repr)
    assert rows(repeats.removals(empty)) == []


def test_repeats_are_cut_out_of_the_texts(docs):
    cut = repeats.remove_repeats(docs)
    assert cut.columns == docs.columns
    plain = plain_removals([t for _, t in TEXTS], 200)
    wanted = [(i, None if t is None else kept.decode("utf-8", "ignore"))
              for (i, t), (*_, kept) in zip(TEXTS, plain)]
    assert rows(cut.select("doc_id", "text")) == sorted(wanted, key=repr)


# Decontamination


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


ITEMS = [(1, BODY[300:500]), (2, "the the the"), (3, None), (4, "!?"), (5, "A"), (6, prose(5, 80)), (1, "no id here"),
         (None, BODY), (7, "nowhere " * 15), (10, prose(6, 12))]


def test_contamination_equals_brute_force(spark, docs, empty):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id int, text string, entry string")
    wanted = []
    for i, t in TEXTS:
        words, hit, named = plain_words(t), set(), set()
        for item, text in ITEMS:
            own = plain_words(text)
            n = min(10, len(own))
            for k in range(len(own) - n + 1 if item is not None and own else 0):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == own[k : k + n]:
                        hit.update(range(p, p + n))
                        named.add(str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        wanted.append((i, len(words), len(hit), len(named), digest, bool(hit)))
    got = decontaminate.contamination(docs, items).drop("item_ids")
    assert rows(got) == sorted(wanted, key=repr)
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in clean.collect()) == sorted(repr(w[0]) for w in wanted if not w[-1])
    assert decontaminate.contamination(empty, items).collect() == []
    none = decontaminate.contamination(docs, items.where("item_id = 99"))
    assert none.where("contaminated").count() == 0 and none.count() == len(TEXTS)


def test_one_word_over_and_over(spark):
    """Documents and items of very many equal words, and a very long item."""
    long = [f"w{i}" for i in range(20000)]
    frame = spark.createDataFrame(
        [(1, "the " * 64000), (2, "the the"), (3, " ".join(long[5000:5300]) + " the end"), (4, "the " * 9 + "end")],
        "doc_id int, text string",
    )
    items = spark.createDataFrame(
        [("a", "the the the"), ("b", "The " * 20000), ("c", " ".join(long)), ("d", "the")], "item_id string, text string"
    )
    got = {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in decontaminate.contamination(frame, items).collect()}
    assert got == {1: (64000, ["a", "b", "d"]), 2: (2, ["d"]), 3: (301, ["c", "d"]), 4: (9, ["a", "d"])}


def test_proximity_finds_moved_words(spark):
    words = [f"w{i}" for i in range(12)]
    moved = words[:4] + ["extra"] + words[4:]
    frame = spark.createDataFrame([(1, " ".join(moved)), (2, " ".join(words)), (3, " ".join(words[:6]))], "doc_id int, text string")
    stored = decontaminate.tokens(frame)
    entries = decontaminate.items(spark.createDataFrame([("q", " ".join(words))], "item_id string, text string"))
    ids = {r["row"]: r["id"] for r in stored.select("row", "id").collect()}
    exact = {ids[r["row"]] for r in decontaminate.phrase_matches(stored, entries, 10).collect()}
    near = {ids[r["row"]] for r in decontaminate.proximity_matches(stored, entries, 10, slop=2).collect()}
    assert exact == {2} and near == {1, 2}


# Quality


def test_quality_learns_and_scores_alike(spark, sf_dir, empty):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.scored(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = [r["predicted"] == truth[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean(judged) > 0.95
    odd = spark.createDataFrame([(i, t, 1, "r", 2, 3, "s") for i, t in TEXTS], SCHEMA)
    marks = spark.createDataFrame([(1, 1), (12, 0), (9, None), (None, 1), (8, 7), (1, 0)], "doc_id bigint, quality int")
    assert quality.scored(odd, marks).count() == len(TEXTS)
    assert {r["score"] for r in quality.scored(odd, marks.where("false")).collect()} == {0.5}
    assert quality.scored(empty, labels).collect() == []
    assert quality.keep_good(odd, marks.where("false")).columns == odd.columns


def test_every_byte_of_a_word_counts():
    """Words and pairs that differ behind the first 64 bytes have other buckets."""

    def words(text):
        data = np.frombuffer(f" {text} ".encode(), np.uint8)
        found = quality.features(data, np.array([0]), 16)[0]
        return [set(found[(found >> 16) == kind].tolist()) for kind in (0, 3)]

    for size in (63, 64, 65, 128, 1000, 5000):
        one, other = words("x" * size + "a y"), words("x" * size + "b y")
        assert one[0] != other[0] and one[1] != other[1], size
    plain = sum(c * pow(0x100000001B3, k + 1, 1 << 64) for k, c in enumerate(b"ab" * 500)) % (1 << 64)
    assert words("ab" * 500)[0] == {plain * quality.SPREAD[0] % (1 << 64) >> 48}


def test_quality_scores_follow_the_features():
    texts = pa.array(["One two two.", None, "", "é\t\n é", "x" * 1000])
    model = quality.Model(np.random.default_rng(0).normal(size=(4 << 16, 4)), np.array([[0, 0, 0, 0], [1, 2, 3, 4.0]]),
                          np.array([0, 0.5]), 16)
    scores = model.scores(texts)
    for i in range(len(texts)):
        assert scores[i] == pytest.approx(model.scores(texts.slice(i, 1))[0])
    assert scores[1] == scores[2] == pytest.approx(1 / (1 + np.exp(-0.5)))


# Token files and counts


def plain_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library():
    library, own = tokenizers.Tokenizer.from_file(WORDS), tokenfiles.Encoder(WORDS)
    draw = random.Random(6)
    texts = [t for _, t in TEXTS] + [".,.", "Ther.", "É,", "İ.", "Σ. ας,", "<|ENDOFTEXT|>", "<|endoftext|>."]
    texts += ["".join(draw.choice("aeT' \n\t.,!1éÉ漢<|> İς́") for _ in range(40)) for _ in range(500)]
    assert own.by_chunk
    assert [np.frombuffer(i, own.dtype).tolist() for i in own.encode(texts)] == [plain_ids(library, t) for t in texts]
    whole = tokenfiles.Encoder(BYTES)
    assert not whole.by_chunk
    library = tokenizers.Tokenizer.from_file(BYTES)
    assert [np.frombuffer(i, whole.dtype).tolist() for i in whole.encode(texts)] == [plain_ids(library, t) for t in texts]


def test_token_files_round_trip(docs, empty):
    library = tokenizers.Tokenizer.from_file(WORDS)
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, wanted = 0, []
    for i, t in order:
        ids = [*plain_ids(library, t), 2]
        wanted.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows(tokenfiles.round_trip(docs, WORDS, 2)) == sorted(wanted, key=repr)
    assert rows(tokenfiles.round_trip(empty, WORDS, 2)) == []


def test_sequences_are_equal_in_length_and_random_access(docs, tmp_path):
    parts = tokenfiles.write(docs.where("doc_id is not null"), WORDS, str(tmp_path), 2, parts=1, length=16).collect()
    found = tokenfiles.Sequences(str(tmp_path / parts[0]["ids_file"]))
    flat = np.concatenate([found.ids(i)[found.mask(i)] for i in range(len(found))])
    assert len(flat) == parts[0]["ids"] and len(found) == -(-len(flat) // 16)
    assert found.mask(0).all() and len(found.ids(len(found) - 1)) == 16
    with pytest.raises(IndexError):
        found.ids(len(found))


def test_separator_scan_stitches_blocks(spark, tmp_path):
    draw = random.Random(2)
    files = {"a": [5, 5, 1, 2, 5, 3], "b": [1] * 40, "c": [5], "d": [], "e": [draw.choice([1, 2, 5]) for _ in range(500)]}
    wanted = []
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
        start = ordinal = 0
        for k, x in enumerate(ids):
            if x == 5:
                wanted.append((name, ordinal, start, k + 1 - start, True))
                start, ordinal = k + 1, ordinal + 1
        if start < len(ids):
            wanted.append((name, ordinal, start, len(ids) - start, False))
    names = spark.createDataFrame([(n,) for n in files], "file string")
    for size in (1, 3, 1000):
        assert rows(tokencount.documents(spark, str(tmp_path), names, "<u2", 5, block_ids=size)) == sorted(wanted, key=repr)
    (tmp_path / "odd").write_bytes(b"123")
    with pytest.raises(Exception, match="whole"):
        tokencount.documents(spark, str(tmp_path), spark.createDataFrame([("odd",)], "file string"), "<u2", 5).collect()


def test_token_counts_of_texts(docs, empty):
    library = tokenizers.Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    got = tokencount.counts_of_texts(docs, WORDS, 49407)
    wanted = sorted((repr(i), len(plain_ids(library, t)) + 1) for i, t in TEXTS)
    assert sorted((repr(r["doc_id"]), r["n_tokens"]) for r in got.collect()) == wanted
    assert tokencount.counts_of_texts(empty, WORDS, 49407).collect() == []


# Vectors


def test_pairs_come_in_order_of_their_sum():
    draw = np.random.default_rng(1)
    a, b = draw.normal(size=7).round(1), draw.normal(size=9).round(1)
    found = list(multiindex.pairs_by_sum(a, b))
    assert sorted(found) == [(i, j) for i in range(7) for j in range(9)]
    sums = [a[i] + b[j] for i, j in found]
    assert all(x >= y - 1e-12 for x, y in zip(sums, sums[1:]))


@pytest.mark.parametrize("most", [7, 4096])
def test_neighbours(spark, monkeypatch, most):
    monkeypatch.setattr(multiindex, "LIST_ROWS", most)
    draw = np.random.default_rng(2)
    points = draw.normal(size=(300, 8)).astype(np.float32)
    points[50:80] = points[50]
    given = [(i, p.tolist()) for i, p in enumerate(points)]
    odd = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [None] + [1.0] * 7),
           (1080, [float("inf")] * 8), (1100, [1.0] * 3), (None, [1.0] * 8), (1120, [])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in given + odd], "vec_id bigint, embedding array<float>, id int")
    got = multiindex.nearest(frame, F.col("vec_id") % 20 == 0, k=20, centroids=8).collect()
    exact = points.astype(np.float64)
    score = np.zeros((300, 300))
    for d in range(8):
        score += exact[:, d, None] * exact[:, d]
    for q in range(0, 300, 20):
        order = sorted((x for x in range(300) if x != q), key=lambda x: (-score[q, x], x))[:20]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert own == [(k + 1, x, score[q, x]) for k, x in enumerate(order)]
    assert len(got) == 15 * 20
    assert multiindex.nearest(frame.where("false"), F.lit(True)).collect() == []


def test_recall_of_the_index(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.1')}/embeddings.parquet")
    given = frame.select("vec_id", "embedding").toPandas()
    points, ids = np.stack(given.embedding).astype(np.float64), given.vec_id.to_numpy()
    got = multiindex.nearest(frame, F.col("vec_id") % 20 == 0).toPandas()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = points @ points[q]
        score[q] = -np.inf
        hits += len(set(ids[np.argsort(-score)[:20]]) & set(got.vec_id[got.query_id == ids[q]]))
        total += 20
    assert hits / total >= 0.9


# Languages


def test_language_evidence(spark, sf_dir):
    pages, texts = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "documents"))
    got = langid.identify(pages, texts).toPandas()
    assert len(got) == pages.count() and got.probability.between(0, 1.0000001).all()
    assert (got.lang == got.declared).mean() > 0.95
    odd = spark.createDataFrame(
        [(1, None, None, "x"), (1, "", "", "x"), (None, "nonsense", "<p>", "x"),
         (2, "http://a.b.example.fr/", '<html lang="fr">', "x"), (3, "https://u@A.example.fr:80", "<b>" * 5000, "x")],
        "page_id bigint, url string, html string, host string",
    )
    found = {(r["page_id"], r["host"]): r for r in langid.identify(odd, texts).collect()}
    assert len(found) == 4 and found[2, "a.b.example.fr"]["declared"] == "fr" and (3, "a.example.fr") in found
    assert langid.identify(odd.where("false"), texts).collect() == []
    assert {r["lang"] for r in langid.identify(odd, texts.where("false")).collect()} == {None}


def test_titles_are_text(spark):
    head = "<head><title>{}</title><style>le chien {{}}</style><!-- le chat --><script>le chien</script></head>"
    assert langid.visible("<html>" + head.format("A &amp; B") + "<body></body></html>").split() == ["A", "&", "B"]
    texts = spark.createDataFrame([(1, "en", "the cat and the dog " * 30), (2, "fr", "le chat et le chien " * 30)],
                                  "doc_id int, lang string, text string")
    pages = spark.createDataFrame([(1, None, head.format("the dog and the cat")), (2, None, head.format("et le chat"))],
                                  "page_id int, url string, html string")
    assert {r["page_id"]: r["text_lang"] for r in langid.identify(pages, texts).collect()} == {1: "en", 2: "fr"}


def test_host_priors_decide_pages_without_text(spark):
    texts = spark.createDataFrame([(1, "en", "the cat and the dog " * 30), (2, "fr", "le chat et le chien " * 30)],
                                  "doc_id int, lang string, text string")
    sites = [(i, f"http://h{i % 2}.org/{i}", ("the dog and the cat " if i % 2 else "le chien et le chat ") * 20) for i in range(60)]
    pages = spark.createDataFrame([*sites, (100, "http://h1.org/x", ""), (101, "http://h0.org/x", None)],
                                  "page_id int, url string, html string")
    found = {r["page_id"]: r["lang"] for r in langid.identify(pages, texts).collect()}
    assert found[100] == "en" and found[101] == "fr"


# Paragraphs


def plain_paragraph_classes(texts, min_words, size, similarity):
    def sets(words):
        parts = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if len(words) > size else [" ".join(words)]
        return frozenset(parts)

    found = []
    for row, (_, t) in enumerate(texts):
        for place, line in enumerate((t or "").split("\n")):
            words = re.sub("[A-Z]", lambda m: m.group().lower(), line).split()
            if len(words) >= min_words:
                found.append((row, place, sets(words)))
    every = range(len(found))
    linked = [(a, b) for a in every for b in every
              if len(found[a][2] & found[b][2]) >= similarity * len(found[a][2] | found[b][2])]
    return found, plain_components(every, linked)


@pytest.mark.parametrize("most", [2, 512])
def test_paragraphs_equal_brute_force(spark, monkeypatch, most, empty):
    monkeypatch.setattr(paragraphs, "BLOCK_ROWS", most)
    draw = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    lines = []
    for _ in range(40):  # a chain of near copies, so that ends are only linked through the middle
        base = [w if draw.random() > 0.02 else f"n{draw.randrange(10**6)}" for w in base]
        lines.append(" ".join(base))
    texts = [(i, line + "\n" + " ".join(f"u{i}x{k}" for k in range(30)) + "\nshort line") for i, line in enumerate(lines)]
    texts += [(100, texts[3][1]), (3, lines[7]), (None, lines[5]), (101, None), (102, ""), (103, "\n\n")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id bigint, text string, Place int")
    found, root = plain_paragraph_classes(texts, 20, 5, 0.8)
    sizes: dict[int, int] = {}
    for r in root.values():
        sizes[r] = sizes.get(r, 0) + 1
    repeated = [sum(1 for k, f in enumerate(found) if f[0] == row and sizes[root[k]] > 1) for row in range(len(texts))]
    # Bands miss a pair in 500; links of a class are many.
    got = paragraphs.report(frame, bands=40, rows=4)
    assert sorted((repr(r["doc_id"]), r["n_repeated"]) for r in got.collect()) == sorted(
        (repr(i), n) for (i, _), n in zip(texts, repeated)
    )
    classes = sum(1 for n in sizes.values() if n > 1)
    assert got.agg(F.sum("n_removed")).first()[0] == sum(n for n in sizes.values() if n > 1) - classes
    left = paragraphs.remove_repeats(frame, bands=40, rows=4)
    assert left.columns == frame.columns and left.count() == len(texts)
    assert paragraphs.report(empty).collect() == []


def paragraph_query(spark, tmp_path, texts):
    """The registered query's rows by id, with its own settings."""
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    return {r["doc_id"]: r for r in QUERIES["op4_paragraphs"](spark, str(tmp_path)).collect()}


def test_short_paragraphs_are_compared(spark, tmp_path):
    """Equal lines of any length, and near copies of short ones; a passage laid
    out in short lines."""
    licence = " ".join(f"l{i}" for i in range(12))
    near = [f"n{i}" for i in range(19)]
    passage = "\n".join(" ".join(f"p{k}x{i}" for i in range(6)) for k in range(10))
    texts = [(i, f"{licence}\nown{i} words{i}\nof.\n \n" + "a " * (5 + i)) for i in range(9)]
    texts += [(20, " ".join(near)), (21, " ".join([*near, "more"])), (22, "first\n" + passage), (23, passage + "\nlast")]
    got = paragraph_query(spark, tmp_path, texts)
    # The licence, "of." and the runs of one word, whose shingles are all the same.
    # "of." is less than a shingle: a class, but it stays.
    assert [(got[i]["n_repeated"], got[i]["n_removed"]) for i in range(9)] == [(3, 2 * (i > 0)) for i in range(9)]
    assert all(len(got[i]["classes"]) == 2 and len(got[i]["short_classes"]) == 1 for i in range(9))
    rest = [(i, f"first{i}\n\tof\n}}\n\n") for i in range(3)]
    (tmp_path / "rest").mkdir()
    left = paragraph_query(spark, tmp_path / "rest", rest)
    assert [left[i]["kept_sha256"] for i, _ in rest] == [hashlib.sha256(t.encode()).hexdigest() for _, t in rest]
    assert [(left[i]["classes"], len(left[i]["short_classes"])) for i, _ in rest] == [([], 2)] * 3
    assert [got[i]["n_removed"] for i in (20, 21, 22, 23)] == [0, 1, 0, 10]
    assert got[23]["removed"] == list(range(10))


def test_passages_inside_different_lines(spark, tmp_path):
    """Copies of 50 to 200 words between words of their own, in lines of any
    layout, are found but for a few words at their ends; nothing else is lost."""
    draw = random.Random(4)
    shared = {k: [f"p{k}x{draw.randrange(1000)}" for _ in range(draw.choice([50, 51, 69, 86, 200]))] for k in range(20)}
    texts = [(100, None), (101, "z " * 300), (102, "a b c " * 100)]
    for i in range(40):
        parts = [f"o{i}x{k}" for k in range(90)]
        parts[45:45] = shared[i % 20] if i < 35 else [f"q{i}x{k}" for k in range(60)]
        texts.append((i, "".join(w + ("\n" if i % 3 == 0 and k % 11 == 10 else " ") for k, w in enumerate(parts))))
    texts.append((7, texts[3 + 7][1]))
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = paragraph_query(spark, tmp_path, texts)
    left = {r["doc_id"]: r["text"] for r in paragraphs.remove_repeats(frame, min_words=1).collect()}
    given = dict(texts)
    for i, row in got.items():
        assert row["kept_sha256"] == hashlib.sha256((left[i] or "").encode()).hexdigest()
        assert row["n_removed"] == 0
        if i < 100:
            size, copy = len(shared[i % 20]), 20 <= i < 35
            assert size - 22 <= row["n_cut"] <= size if copy else row["n_cut"] == 0
            assert (row["n_passages"] > 0) == (i < 15 or copy) == bool(row["classes"])
            assert [w for w in given[i].split() if w[0] != "p"] == [w for w in left[i].split() if w[0] != "p"]
    # The first of a text's own copies stays whole.
    assert left[101].split() == ["z"] * len(left[101].split()) and 20 <= len(left[101].split()) < 60
    assert 20 <= len(left[102].split()) < 60 and left[100] is None


def test_recall_of_the_query(spark, tmp_path):
    """The registered query on independent pairs of similarity 0.8 and up, of 5
    to 120 words, against a plain version without a minimum of words."""
    draw = random.Random(12)
    texts = []
    for i in range(3000):
        words = [f"w{i}x{k}" for k in range(draw.choice([5, 9, 15, 19, 20, 40, 60, 120]))]
        other = list(words)
        for _ in range(draw.randrange(3)):
            other[draw.randrange(len(other))] = f"e{draw.randrange(10**9)}"
        texts += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*other, "end"] if draw.random() < 0.3 else other))]
    alike = []
    for i in range(3000):
        found, root = plain_paragraph_classes(texts[2 * i : 2 * i + 2], 1, 5, 0.8)
        alike.append(len(set(root.values())) == 1)
    got = paragraph_query(spark, tmp_path, texts)
    linked = [got[2 * i]["n_repeated"] == got[2 * i + 1]["n_repeated"] == 1 for i in range(3000)]
    assert not any(y and not x for x, y in zip(alike, linked))
    # Equal texts need no bands.
    different = [y for i, (x, y) in enumerate(zip(alike, linked)) if x and texts[2 * i][1] != texts[2 * i + 1][1]]
    assert len(different) > 300 and sum(different) >= 0.99 * len(different)


def test_recall_of_the_bands():
    assert paragraphs.recall(0.8, 12, 4) > 0.995


# Pipeline


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, before, sf_dir), name)
        assert sorted(after.columns) == sorted(docs.columns)
        assert 0 < after.count() <= before.count()
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    library = tokenizers.Tokenizer.from_file(BYTES)
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert all(r["ids"] == plain_ids(library, texts[r["doc_id"]]) for r in last.collect())
    assert isinstance(last.schema["ids"].dataType, T.ArrayType)


def test_word_encoder_equals_the_library_on_odd_texts():
    """Marks behind letters, letters of all sorts, special tokens, accents."""
    own = tokenfiles.encoder(WORDS, False)
    assert own.by_chunk and own.plain is not None
    letters = random.Random(1)
    signs = "abcXYZéÉßñÑİıŁ́'.,!?;:$%&#*+-=/@^_|~<>()[]5 \n\t"
    texts = ["".join(letters.choices(signs, k=letters.randint(0, 24))) for _ in range(3000)]
    texts += ["Über ÀÉ İstanbul ǅ ŉ ß, Straße!! Ɓ Ə ﬁ ΑΒΓ Жук, ñ;;; µm ſs ǰ Ⅷ K", "a<|endoftext|>b x|> y<|"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, own.dtype).tolist() == own._batch([text])[0], text
