"""The pipeline, stage by stage: what each keeps, and what it changes."""

import re

import pytest

import corpus_pipeline
from riskweave.llm import queries
from riskweave.llm.common import read
from riskweave.session import materialise
from tests.conftest import SMALL, TINY
from tests.llm.conftest import EDGES, prose
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_joins import brute as groups
from tests.llm.test_surrogates import luhn


@pytest.fixture(scope="module")
def steps(spark):
    """(input, output) of every stage on the small table."""
    docs, out = read(spark, SMALL, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SMALL))
        out.append(docs)
    return [read(spark, SMALL, "documents"), *out]


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_columns(spark, steps):
    assert [s.columns for s in steps[:5]] == [["doc_id", "text", "lang", "source", "n_chars"]] * 5
    assert len(corpus_pipeline.STAGES) == 5


def test_quality_keeps_what_the_classifier_accepts(spark, steps):
    predicted = {r.doc_id for r in queries.QUERIES["op3_quality_rules"](spark, SMALL).filter("predicted = 1").collect()}
    assert set(texts(steps[1])) == predicted
    assert steps[1].exceptAll(steps[0]).count() == 0


def test_one_document_of_each_group_stays(spark, steps):
    before = texts(steps[1])
    expected = {i for i, (_, component) in groups(before.items()).items() if i == component}
    assert set(texts(steps[2])) == expected and 0 < len(expected) < len(before)


def test_contaminated_documents_go(spark, steps):
    before = texts(steps[2])
    items = [(r.item_id, r.text) for r in read(spark, SMALL, "benchmark").collect()]
    near = {i: t for i, t in before.items() if any(set(t.split()) >= set(x.split()[:8]) for _, x in items)}
    found = set(leaks(near.items(), items))
    gone = set(before) - set(texts(steps[3]))
    assert found <= gone and len(gone) < 60
    assert gone == found or gone == set(leaks([(i, before[i]) for i in gone], items))


def test_personal_data_is_replaced(spark, steps):
    before, after = texts(steps[3]), {r.doc_id: r for r in steps[4].collect()}
    assert set(before) == set(after)
    known = re.compile(r"[\w.+-]+@[\w.-]+\.\w+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b")
    for i, r in after.items():
        old = {x for x in known.findall(before[i]) if not x.isdigit() or luhn(x)}
        assert not old & set(known.findall(r.text)) and r.n_chars == len(r.text)
        if not old and not re.search(r"[0-9a-f]{16}|AKIA", before[i]):
            assert r.text == before[i]


def test_sequences_hold_every_document(spark, steps):
    kept = set(texts(steps[4]))
    rows = steps[5].select("doc_id", "start", "length", "doc_tokens", "ids").collect()
    assert {r.doc_id for r in rows} == kept
    sums = {}
    for r in rows:
        assert len(r.ids) == r.length
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.length
    assert all(sums[r.doc_id] == r.doc_tokens for r in rows)


def test_run(spark, steps):
    whole = corpus_pipeline.run(spark, TINY)
    assert whole.count() > 0 and "ids" in whole.columns


def test_stages_on_odd_rows(spark):
    rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in EDGES]
    rows += [(50, prose(1, 80) + " 10.1.2.3", "en", None, 7), (51, prose(1, 80) + " 10.1.2.3", "en", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = materialise(stage(spark, docs, TINY))
        assert docs.columns == columns, name
    left = {(r.doc_id, r.n_chars) for r in docs.collect()}
    assert {i for i, _ in left} == {i for i, _ in EDGES if i != 8} | {50}
    assert docs.filter("doc_id = 7").count() == 1 and docs.filter("doc_id is null").count() == 1
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, TINY).count() == 0


def test_rows_without_an_id_are_rows_like_others(spark):
    """A null-id copy goes before a named one, a null-id benchmark passage goes, other null-id rows stay."""
    passage = read(spark, TINY, "benchmark").filter("length(text) > 100").orderBy("item_id").first().text
    rows = [(9, prose(1, 60)), (None, prose(1, 60)), (None, prose(2, 60)), (None, prose(2, 60) + " end"), (None, passage), (None, prose(3, 60))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    once = materialise(corpus_pipeline.keep_one_of_each_group(spark, docs, TINY))
    assert once.count() == 4 and [r.doc_id for r in once.filter(once.text == prose(1, 60)).collect()] == [9]
    clean = corpus_pipeline.keep_uncontaminated(spark, once, TINY)
    assert {r.text[:40] for r in clean.collect()} == {prose(k, 60)[:40] for k in (1, 2, 3)}
