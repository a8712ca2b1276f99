"""Language of pages: against the same fusion written out in plain Python, and on odd rows."""

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import language_id as L
from riskweave.llm import queries
from riskweave.llm.common import read
from tests.conftest import SMALL, TINY


@pytest.mark.parametrize(("page", "text"), [
    ("<p>One <b>two</b></p>", " one  two  "), ("a<script>x < y</script>b", "a b"), ("a<!-- <p> -->b", "a b"),
    ("a<style>p{}", "a"), ("x &amp; y", "x & y"), ("", ""), ("<scripted>a", " a"), ("a<!-- never", "a"),
    ("1 < 2", "1  "), ("<SCRIPT>a</Script >b", " b"),
])
def test_visible_text(page, text):
    assert L.visible(page).split() == text.split()


def test_trigrams_stay_in_their_text():
    texts = ["abcd", "", "ab", None, "xyz", "é"]
    offsets, keys = L.trigrams(pa.array(texts))
    assert np.diff(offsets).tolist() == [2, 0, 0, 0, 1, 0] and len(keys) == 3
    alone = L.trigrams(pa.array(["xyz"]))[1]
    assert keys[2] == alone[0] and keys.max() < L.BUCKETS


def plain(pages, model):
    """(page_id -> language, probability), written out."""
    langs = list(model)

    def shares(logs):
        top = max(logs)
        w = [math.exp(x - top) for x in logs]
        return [x / sum(w) for x in w]

    rows = []
    for page_id, url, html in pages:
        _, keys = L.trigrams(pa.array([L.visible(html or "")]))
        t = [float(model[k][keys].sum()) * min(len(keys), L.EVIDENCE) / max(len(keys), 1) for k in langs]
        host = re.match(r"\w+://([^/:?#]+)", url or "")
        host = host and host[1].lower()
        said = re.search(r'<html\b[^>]*?\blang="?([a-z]+)', html or "")
        groups = {"suffix": host and host.split(".")[-1], "domain": host and ".".join(host.split(".")[-2:]), "host": host}
        rows.append((page_id, t, shares(t), groups, said and said[1]))
    n = len(langs)
    sums = defaultdict(lambda: [0.0] * n)
    for _, _, p, groups, said in rows:
        for key in [("all",), *groups.items(), ("said", said)]:
            sums[key] = [a + b for a, b in zip(sums[key], p, strict=True)]
    out = {}
    for page_id, t, p, groups, said in rows:
        total = sums[("all",)]
        prior = [(x + 1) / (sum(total) + n) for x in total]
        for level in ("suffix", "domain", "host"):
            own = [max(a - b, 0) for a, b in zip(sums[level, groups[level]], p, strict=True)] if groups[level] else [0] * n
            prior = [(a + L.LEAN * b) / (sum(own) + L.LEAN) for a, b in zip(own, prior, strict=True)]
        logs = [a + math.log(b) for a, b in zip(t, prior, strict=True)]
        if said:
            for k in range(n):
                logs[k] += math.log((max(sums["said", said][k] - p[k], 0) + L.SMOOTHING) / (total[k] + L.LEAN))
        q = shares(logs)
        out[page_id] = langs[q.index(max(q))], max(q)
    return out


def test_matches_the_plain_fusion(spark):
    docs = read(spark, SMALL, "documents")
    model = L.frequencies(docs, 10**9)
    texts = {r.lang: r.text[:400] for r in docs.filter("length(text) > 500").collect()}
    pages = []
    for k in range(80):
        lang = sorted(texts)[k % len(texts)]
        text = texts[lang][k * 3 : k * 3 + (0 if k % 5 == 0 else 25)]
        said = f' lang="{lang if k % 7 else "en"}"' if k % 3 else ""
        url = None if k % 11 == 0 else f"https://{'www.' if k % 2 else ''}h{k % 6}.example.{'de' if lang == 'de' else 'com'}/x"
        pages.append((k, url, f"<html{said}><p>{text}</p></html>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: (r.lang, pytest.approx(r.probability, abs=1e-9)) for r in L.identify(frame, docs, 10**9).collect()}
    assert found == plain(pages, model)


def test_other_evidence_decides_where_there_is_no_text(spark):
    docs = read(spark, SMALL, "documents")
    text = {r.lang: r.text[:600] for r in docs.filter("length(text) > 700").collect()}
    pages = [(k, f"https://a.example.org/{k}", f"<html><p>{text['de']}</p></html>") for k in range(40)]
    pages += [(100 + k, f"https://b.example.net/{k}", f'<html lang="fr"><p>{text["fr"]}</p></html>') for k in range(40)]
    pages += [(200, "https://a.example.org/z", ""), (201, None, '<html lang="fr-CA"></html>')]
    found = {r.page_id: r for r in L.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert found[200].lang == "de" and found[201].lang == "fr" and found[201].declared == "fr"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "nonsense", "<html lang=>"), (3, "http://x", "<p>"), (3, "http://x", "<p>")]
    frame = spark.createDataFrame([(*r, "a", "b", 0.5) for r in rows], "page_id long, url string, html string, lang string, host string, t0 double")
    docs = read(spark, TINY, "documents")
    found = L.identify(frame, docs).collect()
    assert len(found) == 5 and all(0 < r.probability <= 1 for r in found)
    assert {r.lang for r in L.identify(frame, docs.limit(0)).collect()} == {None}
    assert L.identify(frame.limit(0), docs).count() == 0


def test_registered(spark):
    rows = {r.page_id: r for r in queries.QUERIES["op9_language_id"](spark, SMALL).collect()}
    pages = read(spark, SMALL, "pages").collect()
    assert sorted(rows) == sorted(p.page_id for p in pages)
    right = [rows[p.page_id].lang == re.search(r'lang="(\w+)"', p.html)[1] for p in pages]
    assert np.mean(right) > 0.98


def test_a_rare_language_keeps_its_model(spark):
    """However many documents the others have: the sample is bounded for each language."""
    rows = [(i, f"the quick brown fox number {i}", "en") for i in range(2_000)] + [(5_000 + i, "żółta gęś źdźbło", "pl") for i in range(2)]
    model = L.frequencies(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 20)
    assert sorted(model) == ["en", "pl"]
    pages = spark.createDataFrame([(1, None, "<p>żółta gęś</p>"), (2, None, "<p>quick brown fox</p>")], "page_id long, url string, html string")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.page_id: r.text_lang for r in L.identify(pages, docs, 20).collect()} == {1: "pl", 2: "en"}
