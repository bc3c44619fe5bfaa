"""Language evidence: broken pages, many languages, and the fused posterior in plain Python."""

from __future__ import annotations

import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("tokenizers")

from headway.llm import langid  # noqa: E402

HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
PIECES = ["<script>", "</script >", "<STYLE a>", "</style>", "<!--", "-->", "<p>", "<", ">", "a", " b ", "&amp;"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_visible_text_is_what_the_pattern_leaves(pieces):
    page = "".join(pieces)
    assert langid.visible(page) == langid.unescape(re.sub(r"<[^>]*>", " ", HIDDEN.sub(" ", page)))


@pytest.mark.parametrize("piece", ["<script>", "<!--", "<style ", "<", "</script", "<script></style>", "&"])
def test_broken_pages_take_linear_time(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.process_time()
    langid.visible(page)
    assert time.process_time() - start < 3


def plain(pages, languages, table, rules):
    """identify, step by step over dictionaries."""
    n = len(languages)

    def softmax(logs):
        powers = [math.exp(x - max(logs)) for x in logs]
        return [p / sum(powers) for p in powers]

    rows = []
    for page, url, html in pages:
        found = langid.grams(langid.visible(html), rules.bits)
        weight = rules.text_weight * min(1.0, rules.most_grams / max(len(found), 1))
        evidence = [weight * float(table[i, found].sum(dtype=np.float64)) for i in range(n)]
        name = re.match(r"[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", (url or "").lower())
        host = name and name.group(1)
        said = re.search(r"<html\b[^<>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", (html or "").lower())
        rows.append({
            "id": page, "evidence": evidence, "by_text": softmax(evidence), "host": host,
            "domain": host and ".".join(host.split(".")[-2:]), "suffix": host and host.split(".")[-1],
            "declared": said and said.group(1),
        })
    sums = {key: defaultdict(lambda: [0.0] * n) for key in ("host", "domain", "suffix", "declared")}
    overall = [(sum(r["by_text"][i] for r in rows) + 1) / (len(rows) + n) for i in range(n)]
    for r in rows:
        for key, of in sums.items():
            if r[key] is not None:
                of[r[key]] = [a + b for a, b in zip(of[r[key]], r["by_text"])]

    def mixed(own, base, strength):
        return [(max(x, 0) + strength * y) / (sum(own) + strength) for x, y in zip(own, base)]

    result = {}
    for r in rows:
        prior = overall
        if r["host"] is not None:
            host, domain = sums["host"][r["host"]], sums["domain"][r["domain"]]
            base = mixed([a - b for a, b in zip(domain, host)], overall, rules.domain_strength)
            prior = mixed([a - b for a, b in zip(host, r["by_text"])], base, rules.host_strength)
        logs = [e + math.log(p) for e, p in zip(r["evidence"], prior)]
        for key in ("suffix", "declared"):
            if r[key] is not None:
                own, s = sums[key][r[key]], rules.value_strength
                logs = [x + math.log((a + s * o) / ((sum(own) + s) * o)) for x, a, o in zip(logs, own, overall)]
        fused = softmax(logs)
        result[r["id"]] = (languages[fused.index(max(fused))], max(fused))
    return result


def words(lang, count, seed):
    draw = random.Random(seed)
    own = random.Random(lang)
    stems = ["".join(own.choice("abcdefghijklmnop") for _ in range(4)) for _ in range(12)]
    return " ".join(draw.choice(stems) for _ in range(count))


def sites(languages, count):
    draw, pages = random.Random(1), []
    for i in range(count):
        lang = draw.choice(languages)
        text = words(lang if draw.random() < 0.8 else draw.choice(languages), draw.choice([0, 1, 3, 60]), i)
        said = draw.choice(["", f' lang="{lang[:2]}"', " lang=zz"])
        host = draw.choice([f"www.{lang}.org", f"a.{lang}.com", "x.shared.net", f"{lang}"])
        pages.append((i, draw.choice([f"http://{host}/{i}", f"HTTPS://u@{host}:80?q", None]), f"<html{said}><p>{text}"))
    return [*pages, (count, None, None), (count + 1, "no address", "")]


@pytest.mark.parametrize("count", [3, 100])
def test_posteriors_equal_plain(spark, count):
    languages = [f"l{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(count)]
    texts = spark.createDataFrame(
        [(k, lang, words(lang, 80, k)) for k, lang in enumerate(languages)], "doc_id int, lang string, text string"
    )
    rules = langid.Settings()
    pages = sites(languages, 250)
    start = time.time()
    frame = spark.createDataFrame(pages, "page_id int, url string, html string")
    found = {r["page_id"]: (r["lang"], r["probability"]) for r in langid.identify(frame, texts, rules).collect()}
    assert time.time() - start < 120
    wanted = plain(pages, *langid.fit(texts, rules), rules)
    assert set(found) == set(wanted)
    for page, (lang, probability) in wanted.items():
        assert found[page][1] == pytest.approx(probability, rel=1e-6)
        assert found[page][0] == lang or probability < 0.5 + 1e-9


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    texts = spark.createDataFrame([(k, f"l{k}", "a b") for k in range(3)], "doc_id int, lang string, text string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.fit(texts, langid.Settings())
