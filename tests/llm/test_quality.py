"""The rule ensemble: statistics, compiled rules, held-out accuracy, odd rows."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import quality, queries
from riskweave.llm.common import read
from tests.conftest import SMALL, TINY
from tests.llm.conftest import EDGES, prose


def test_statistics_of_known_texts():
    found = quality.statistics(pa.array(["ab ab% CD\nab ab% CD\n12", "", None, " "]))
    first = {k: v[0] for k, v in found.items()}
    assert first["log_bytes"] == pytest.approx(np.log1p(22)) and first["log_words"] == pytest.approx(np.log1p(7))
    assert first["capitals"] == pytest.approx(4 / 22) and first["digits"] == pytest.approx(2 / 22)
    assert first["signs"] == pytest.approx(2 / 22) and first["marked_words"] == pytest.approx(2 / 7)
    assert first["line_words"] == pytest.approx(7 / 3) and first["distinct_lines"] == pytest.approx(2 / 3)
    assert all(v[1] == v[2] == 0 for v in found.values())
    assert all(np.isfinite(v).all() for v in found.values())


def test_rule_and_model_columns(spark):
    rule = quality.Rule((("digits", 0.5, float("inf")), ("signs", float("-inf"), 2.0)))
    model = quality.Model(((rule, 2.0),), -1.0)
    frame = spark.createDataFrame([(0.6, 1.0), (0.5, 1.0), (0.6, 3.0)], "digits double, signs double")
    found = [r.score for r in frame.select(model.score().alias("score")).collect()]
    assert found == pytest.approx([1 / (1 + np.exp(-x)) for x in (1.0, -1.0, -1.0)])


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.QUERIES["op3_quality_rules"](spark, SMALL).collect()}


def test_held_out_accuracy(spark, scored):
    labels = read(spark, SMALL, "labels").collect()
    own = [(scored[r.doc_id], r.quality) for r in labels if scored[r.doc_id].held_out]
    assert len(own) > 100
    assert np.mean([s.predicted == q for s, q in own]) > 0.97


def test_every_row_is_scored(spark, scored):
    docs = read(spark, SMALL, "documents").select("doc_id").collect()
    assert sorted(scored) == sorted(r.doc_id for r in docs)
    for i, r in scored.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_labels_change_nothing(spark):
    docs, labels = read(spark, TINY, "documents"), read(spark, TINY, "labels")
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - labels["quality"]).otherwise(labels["quality"]))
    plain, other = (
        sorted(map(tuple, quality.score(docs, x).collect())) for x in (labels, flipped)
    )
    assert plain == other


def test_odd_rows_and_labels(spark, edges):
    labels = spark.createDataFrame(
        [(1, 0, 0), (6, 1, 0), (7, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int"
    )
    rows = quality.score(edges, labels).collect()
    assert len(rows) == len(EDGES) and all(0 < r.score < 1 for r in rows)
    only = quality.score(edges, labels.filter("quality = 1")).collect()
    assert all(r.predicted == 1 for r in only)
    none = quality.score(edges, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score(edges.limit(0), labels).count() == 0


def test_training_rows_are_bounded(spark):
    rows = [(k, prose(k, 5 + k % 7), 0) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    found = quality.measured(docs).withColumn("label", quality.F.col("doc_id") % 2)
    assert quality.fit(found, trees=2, limit=50) == quality.fit(found.repartition(7), trees=2, limit=50)


def test_a_worker_measures_little_text_at_a_time():
    """What a task holds beside its input is bounded: the executors' heaps have grown when a pipeline runs again."""
    texts = [prose(k, 700) for k in range(1_600)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    assert batch["text"].nbytes > 6 << 20
    tracemalloc.start()
    found = [b.drop_columns(["doc_id"]) for b in quality.measure(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = quality.statistics(batch["text"])
    assert peak < 60 << 20
    assert pa.Table.from_batches(found).to_pydict() == {k: v.tolist() for k, v in whole.items()}
