"""The language model: base against plain counting, scores against the model written out, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskweave.llm import language_model, queries
from riskweave.llm.language_model import CLASSES, END_CLASS, Model, Scorer
from tests.conftest import SMALL, TINY
from tests.llm.conftest import EDGES, prose
from tests.llm.test_joins import LOWER


def told(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def brute(docs):
    counts = Counter(t for i, text in docs if not held_out(i) for t in told(text))
    total = sum(counts.values())
    below = math.log10(total + 0.1 * (len(counts) + 1)) if total else -1
    return [
        (i, held_out(i), len(told(text)), sum(counts[t] > 0 for t in told(text)), total,
         pytest.approx(sum(math.log10(counts[t] + 0.1) - below for t in told(text)), abs=1e-6))
        for i, text in docs
    ]


def check(rows, docs):
    got = sorted((tuple(r)[:6] for r in rows), key=lambda r: (repr(r[0]), r[5]))
    want = sorted(brute(docs), key=lambda r: (repr(r[0]), r[5].expected))
    assert got == want
    assert all(math.isfinite(r.score) and r.score < 0 or r.train_tokens == 0 for r in rows)


@pytest.mark.parametrize("sent", [language_model.SENT, 20])
def test_base_against_plain_counts(spark, monkeypatch, sent):
    """Also when most words meet their counts in the join."""
    monkeypatch.setattr(language_model, "SENT", sent)
    docs = [(i, f"{prose(i % 37, 5 + i % 60)} only{i} ÉÀ the THE the") for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check(language_model.score(frame).collect(), docs)


def test_odd_rows(spark, edges):
    check(language_model.score(edges).collect(), EDGES)
    clash = edges.withColumn("word", edges.size).withColumn("c", edges.part).withColumn("row", edges.start)
    check(language_model.score(clash).collect(), EDGES)
    assert language_model.score(edges.limit(0)).count() == 0
    held = [(i, "some words") for i in range(200) if held_out(i)]
    rows = language_model.score(spark.createDataFrame(held, "doc_id long, text string")).collect()
    check(rows, held)
    assert all(r.base_score == 0 and r.score == 0 for r in rows)


def test_scores_are_those_of_the_model(spark, monkeypatch):
    kept = {}

    def remember(rows, mass, total, whole=language_model.trained):
        kept["model"], kept["mass"] = whole(rows, mass, total), mass
        return kept["model"]

    class Seen(language_model.Base):
        def __init__(self, *args):
            super().__init__(*args)
            kept["class"] = dict(zip(self.word.tolist(), self.place.tolist(), strict=True))

    monkeypatch.setattr(language_model, "trained", remember)
    monkeypatch.setattr(language_model, "Base", Seen)
    docs = [(i, prose(i % 50, 40)) for i in range(120)]
    rows = language_model.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    m, mass = kept["model"], kept["mass"]
    for r in rows[:12]:
        _, hashes = language_model.tokens(language_model.pa.array([docs[r.doc_id][1]]))
        classes = [kept["class"].get(int(h), language_model.REST_CLASS) for h in hashes]
        before, gain = [END_CLASS, END_CLASS], 0.0
        for c in classes:
            scores = (m.r[before[-1]] @ m.c1 + m.r[before[-2]] @ m.c2) @ m.q.T + m.b
            log_p = scores.astype(float) - np.log(np.exp(scores.astype(float)).sum())
            assert np.exp(log_p).sum() == pytest.approx(1)
            gain += log_p[c] / math.log(10) - mass[c]
            before.append(c)
        assert r.score - r.base_score == pytest.approx(gain, abs=1e-2)


def test_shares_of_all_words_add_up_to_one(spark):
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(100)], "doc_id long, text string")
    counts = language_model.counted(docs)
    word, count = language_model.frequent(counts)
    assert len(word) == counts.count()
    base = language_model.Base(word, count, int(count.sum()), len(word))
    own = 10 ** base.log_share(count)
    assert own.sum() + 10 ** base.log_share(0) == pytest.approx(1)
    assert (10**base.mass[np.isfinite(base.mass)]).sum() == pytest.approx(1)


def test_training_follows_the_gradient():
    """Contexts that decide the next class are learned; a normalised score is a probability."""
    source = np.random.default_rng(2)
    share = np.zeros(CLASSES)
    share[:20] = 1 / 20
    mass = np.log10(share, out=np.full(CLASSES, -np.inf), where=share > 0)
    model = Model.fresh(mass)
    log_noise = np.log(language_model.NOISE * np.maximum(share, 1e-30)).astype(np.float32)
    c1, c2 = source.integers(0, 20, (2, 4_096))
    word = (c1 + 1) % 20
    before = Scorer(model)(word, c1, c2).mean()
    for _ in range(150):
        model.learn(word, c1, c2, source.integers(0, 20, language_model.NOISE), log_noise)
    after = Scorer(model)(word, c1, c2).mean()
    assert before == pytest.approx(math.log10(1 / 20), abs=1e-3) and after > math.log10(0.7)


def test_registered(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.QUERIES["op11_language_model"](spark, TINY).collect(), docs)


def test_held_out_documents_gain(spark):
    rows = [r for r in queries.QUERIES["op11_language_model"](spark, SMALL).collect() if r.held_out]
    assert sum(r.score > r.base_score for r in rows) >= 0.9 * len(rows) > 50


def test_training_is_the_same_at_every_size(spark):
    """No number of tokens switches to another way of training."""
    docs = spark.createDataFrame([(i, prose(i % 50, 40)) for i in range(120)], "doc_id long, text string").coalesce(2)
    counts = language_model.counted(docs)
    word, count = language_model.frequent(counts)
    base = language_model.Base(word, count, int(count.sum()), len(word))
    rows = language_model.encoded(docs, base)
    states = [language_model.trained(rows, base.mass, total).state for total in (7_999_999, 8_000_000)]
    assert np.array_equal(*states)
