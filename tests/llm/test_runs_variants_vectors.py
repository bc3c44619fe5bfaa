"""Periodic runs, spelling variants and the vector join against plain versions, with
nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

pytest.importorskip("tokenizers")

from headway.llm import periodic, subspaces, variants  # noqa: E402
from headway.llm.queries import QUERIES  # noqa: E402


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Periodic runs


def plain_runs(words, least, exponent):
    n, found = len(words), []
    for p in range(1, n // 2 + 1):
        y = 0
        while y < n - p:
            if words[y] != words[y + p]:
                y += 1
                continue
            start = y
            while y < n - p and words[y] == words[y + p]:
                y += 1
            end = y + p
            own = words[start:end]
            shorter = any(all(own[a] == own[a + q] for a in range(len(own) - q)) for q in range(1, p))
            if end - start >= max(least, exponent * p, 2 * p) and not shorter:
                found.append((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_report(text, least=24, exponent=3):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    runs = plain_runs(words, least, exponent)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, left)]
    return len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 100), st.sampled_from([(0, 2), (24, 3), (5, 2), (0, 4)]))
def test_catchers_find_all_runs(words, piece, limits):
    catchers = periodic.Catchers(*limits)
    for at in range(0, len(words), piece):
        catchers.append(np.array(words[at : at + piece]))
    assert catchers.runs() == plain_runs(words, *limits)


def test_catchers_of_long_periods_and_dense_runs():
    draw = random.Random(1)
    for _ in range(60):
        n = draw.randint(50, 400)
        words = [draw.randrange(draw.choice([2, 50])) for _ in range(n)]
        for _ in range(draw.randint(1, 3)):
            a = draw.randrange(n)
            p = 1 + (n - a) // draw.randint(2, 9)
            words[a:] = [words[a + i % p] for i in range(n - a)]
        for limits in ((0, 2), (24, 3)):
            catchers = periodic.Catchers(*limits)
            for at in range(0, n, 37):
                catchers.append(np.array(words[at : at + 37]))
            assert catchers.runs() == plain_runs(words, *limits)
    fibonacci = [[0, 1], [0]]
    while len(fibonacci[-1]) < 60_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    catchers = periodic.Catchers(24, 3)
    catchers.append(np.array(fibonacci[-1]))
    assert len(catchers.runs()) > 1_000


RUN_TEXTS = [
    (1, "go " * 40), (2, "a b c d e f g h i j " * 3 + "z"), (3, "a b " * 12), (4, "a b " * 11 + "a"), (5, None), (6, ""),
    (7, " \n\t "), (8, "x " * 30 + "y\x85 " * 30 + "x " * 30), (None, "ab\n" * 25), (8, "é　" * 9 + " 漢 字" * 20),
    (9, "start " + "one two three\n" * 9 + "end " + "one two three " * 9), (10, "word"), (10, "go " * 40),
    (11, "the cat sat on the mat " * 4000),
]


def test_run_report_and_collapse(spark):
    schema = "doc_id bigint, text string, ID int, n_runs string, start int"
    docs = spark.createDataFrame([(i, t, 1, "r", 2) for i, t in RUN_TEXTS], schema).repartition(3)
    wanted = [(i, *plain_report(t)) for i, t in RUN_TEXTS if i != 11]
    got = [r for r in rows(periodic.report(docs)) if r[0] != 11]
    assert got == sorted(wanted, key=repr)
    long = [r for r in rows(periodic.report(docs)) if r[0] == 11]
    assert [r[1:6] for r in long] == [(1, 0, 24_000, 6, 4_000_000)]
    found = [(i, *r) for i, t in RUN_TEXTS if i != 11 for r in plain_runs(re.findall("[^\x20\x09-\x0d]+", t or ""), 24, 3)]
    assert rows(periodic.periodic_runs(docs.where("not doc_id <=> 11"))) == sorted(found, key=repr)
    left = {(r.doc_id, r.text) for r in periodic.collapse(docs).collect()}
    assert {(5, None), (6, ""), (10, "word"), (10, "go"), (11, "the cat sat on the mat")} <= left
    assert periodic.collapse(docs).columns == docs.columns
    empty = docs.limit(0)
    assert rows(periodic.report(empty)) == rows(periodic.periodic_runs(empty)) == []


def test_registered_runs(spark, tmp_path):
    draw = random.Random(4)
    texts = [(i, " ".join(f"w{draw.randrange(40)}" for _ in range(draw.randint(0, 150)))) for i in range(150)]
    texts += [(None, "a " * 30), (151, None), (0, ""), (12, "b " * 30)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted, changed = [], 0
    for i, text in texts:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h = 1 if i is None else zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        wanted.append((i, *plain_report(" ".join(words))))
    assert changed > 5
    assert rows(QUERIES["op11_periodic"](spark, str(tmp_path))) == sorted(wanted, key=repr)


# Spelling variants


def plain_variants(docs, every=199):
    total = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = 1 if i is None else zlib.crc32(f"{i}:{word}".encode())
            if h % every == 0:
                place = h % len(word)
                word = word[:place] + word[place + 1 :]
            total[word] += 1
    n = {w: c for w, c in total.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close, form = {w: [v for v in n if near(w, v)] for w in n}, {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(close[w]), n.get(form.get(w))) for w in n)


def spelt(count):
    draw = random.Random(3)
    stems = ["".join(draw.choice("abé") for _ in range(draw.randint(5, 9))) for _ in range(120)]
    docs = []
    for i in range(count):
        words = []
        for _ in range(120):
            w = draw.choice(stems[: draw.randint(1, 120)])
            j = draw.randrange(len(w))
            if draw.random() < 0.4:
                w = draw.choice([w[:j] + w[j + 1 :], w[:j] + draw.choice("abcÀ×") + w[j:], w[:j] + draw.choice("abX") + w[j + 1 :]])
            words.append(w)
        docs.append((i if i % 50 else None, " ".join(words) + draw.choice(["", " 漢字abcdef3ghijkl-Éabcdef"])))
    # Chains of forms, ties, one very frequent and one very long word.
    chain = ["planet", "planets", "planetsa"]
    docs += [(1000 + k, " ".join([w] * c)) for k, (w, c) in enumerate(zip(chain, (500, 60, 9)))]
    docs += [(7, None), (8, ""), (8, "PLANET " * 30), (9, ("y" * 4000 + " ") * 30 + ("y" * 3999 + " ") * 6)]
    return docs


@pytest.mark.parametrize("most", [4_096, 30])
def test_variants_equal_plain(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(variants, "GROUP_PAIRS", most)
    docs = spelt(250)
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, WORD int")
    frame.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    wanted = plain_variants(docs)
    assert any(r[1] and r[2] != r[1] for r in wanted) and any(r[4] > 3 for r in wanted)
    assert rows(QUERIES["op12_variants"](spark, str(tmp_path))) == sorted(wanted, key=repr)


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([(1, "short words only"), (2, None)], "doc_id bigint, text string")
    assert rows(variants.spelling_variants(docs)) == rows(variants.spelling_variants(docs.limit(0))) == []


def test_letters_of_the_alphabet():
    every = "".join(map(chr, range(0x250))) + "漢😀"
    wanted = [r.encode("latin-1").lower() for r in re.findall("[A-Za-zÀ-ÿ]+", every)]
    assert variants.letter_runs(every) == wanted


# Vectors


def plain_links(vectors, least=0.9):
    good = [
        (k, np.array(v, float))
        for k, (_, v) in enumerate(vectors)
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = {k: set() for k in range(len(vectors))}
    for at, (k, v) in enumerate(good):
        for m, w in good[at + 1 :]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links[k].add(m)
                links[m].add(k)
    component = {}
    for k in links:
        if k not in component:
            seen, left = {k}, [k]
            while left:
                fresh = links[left.pop()] - seen
                seen |= fresh
                left += fresh
            ids = [vectors[x][0] for x in seen if vectors[x][0] is not None]
            component |= dict.fromkeys(seen, min(ids) if ids else None)
    return [(i, len(links[k]), component[k], i is not None and i == component[k]) for k, (i, _) in enumerate(vectors)]


def vectors():
    draw, made = np.random.default_rng(2), []
    for _ in range(12):
        base = draw.standard_normal(16)
        for _ in range(30):
            noise = draw.standard_normal(16) * draw.choice([0.05, 0.2, 0.3, 0.5])
            made.append((len(made), (draw.uniform(0.2, 5) * (base + noise)).astype(np.float32).tolist()))
    made += [(900 + i, made[0][1]) for i in range(40)] + [(7, made[5][1]), (7, made[60][1]), (None, made[1][1])]
    made += [(None, [1.0] * 16), (None, None), (4, None), (5, []), (1, [0.0] * 16), (2, [float("nan")] * 16)]
    made += [(3, [None] * 16), (3, [float("inf")] * 16), (5, [1.0, 2.0]), (6, [2.0, 4.0]), (8, [-3.0])]
    made += [(9, [1e30] * 16), (10, [1e-30] * 16)]
    return made + [(1000 + i, draw.standard_normal(16).astype(np.float32).tolist()) for i in range(150)]


@pytest.mark.parametrize("limits", [(8_192, 8_192, 32_768), (40, 20, 30)])
def test_links_equal_plain(spark, monkeypatch, limits):
    for name, value in zip(("BOX_ROWS", "HOME_PART", "VISIT_PART"), limits):
        monkeypatch.setattr(subspaces, name, value)
    made = vectors()
    schema = "vec_id bigint, embedding array<float>, VECTOR int, node string"
    frame = spark.createDataFrame([(i, v, 1, "n") for i, v in made], schema).repartition(5)
    assert rows(subspaces.near_duplicates(frame)) == sorted(plain_links(made), key=repr)
    assert rows(subspaces.near_duplicates(frame.limit(0))) == []
    wide = frame.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert rows(subspaces.near_duplicates(wide, blocks=3)) == sorted(plain_links(made), key=repr)


def test_registered_links_are_complete(spark, sf_dir):
    made = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert rows(QUERIES["op13_subspaces"](spark, sf_dir)) == sorted(plain_links(made), key=repr)


def test_boxes_cover_the_space_once():
    points = np.random.default_rng(1).standard_normal((500, 3))
    points[:250] = 0  # ties
    bounds = subspaces.boxes(points, 16)
    row, box, home = subspaces.places(points, bounds, 0.25)
    assert home.sum() == 500 and np.bincount(row[home]).max() == 1
    low, high = bounds
    inside = (points[row[home]] >= low[box[home]]) & (points[row[home]] < high[box[home]])
    assert inside.all()
