import math
import zlib

import numpy as np
import pytest

from lumbung.llm import quality_model
from lumbung.llm.tables import table


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3


def test_equals_plain_learner(spark, documents, labels, monkeypatch):
    """One part, one round: the same updates, row by row, with dictionaries."""
    monkeypatch.setattr(quality_model, "PARTS", 1)
    rows = [(i, f"good words number {i} and more" if i % 3 else f"buy now now now !!! {i} $$$") for i in range(40)]
    docs, marks = documents(*rows), labels(*[(i, int(i % 3 > 0), 0) for i, _ in rows])
    model = quality_model.train(docs, marks, epochs=1)
    turns = dict(quality_model.training_rows(docs, marks, 100).select("doc_id", "turn").collect())
    assert set(turns) == {i for i, _ in rows if fold(i) != 1}
    pull, square = {}, {}

    def weight(k):
        z = pull.get(k, 0.0)
        if abs(z) <= 0.1:
            return 0.0
        return -(z - math.copysign(0.1, z)) / ((1.0 + math.sqrt(square.get(k, 0.0))) / 2.0 + 0.1)

    texts = dict(rows)
    for i in sorted(turns, key=lambda i: (turns[i], i)):
        places, values = quality_model.features(texts[i])
        x = dict(zip(places.tolist(), values.tolist())) | {"bias": 1.0}
        now = {k: weight(k) for k in x}
        p = 1 / (1 + math.exp(-sum(now[k] * v for k, v in x.items())))
        for k, v in x.items():
            g = (p - int(i % 3 > 0)) * v
            before = square.get(k, 0.0)
            square[k] = before + g * g
            pull[k] = pull.get(k, 0.0) + g - (math.sqrt(square[k]) - math.sqrt(before)) / 2.0 * now[k]
    wanted = {k: weight(k) for k in pull if k != "bias" and weight(k)}
    assert dict(zip(model.places.tolist(), model.values.tolist())) == pytest.approx(wanted)
    assert model.bias == pytest.approx(weight("bias"))


def test_features_count_words_and_pairs():
    places, values = quality_model.features("a b a b")
    found = dict(zip(places.tolist(), values.tolist()))
    wanted = {"a": 2, "b": 2, "a b": 2, "b a": 1}
    assert found == {quality_model.bucket(g): pytest.approx(n / math.sqrt(13)) for g, n in wanted.items()}
    same = quality_model.bucket(quality_model.REPEATED)
    assert same in quality_model.features("no no")[0] and same in quality_model.features("yes yes")[0]
    assert len(quality_model.features(" \n")[0]) == 0


def test_parts_can_lie_in_any_task(spark, documents, labels):
    rows = [(i, f"fine text {i % 7} here" if i % 2 else f"### {i % 5} ###") for i in range(60)]
    docs, marks = documents(*rows), labels(*[(i, i % 2, 0) for i, _ in rows])
    first = quality_model.train(docs, marks)
    again = quality_model.train(docs.repartition(7), marks.repartition(3))
    assert np.array_equal(first.places, again.places) and np.allclose(first.values, again.values)
    assert first.score("fine text") > 0.5 > first.score("### ###")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = quality_model.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    found = scored.join(table(spark, folder, "labels"), "doc_id").filter("held_out").select("quality", "predicted").collect()
    missed = sum(r.predicted == 1 for r in found if r.quality == 0)
    lost = sum(r.predicted == 0 for r in found if r.quality == 1)
    assert len(found) > 1_000
    assert missed <= 0.02 * sum(r.quality == 0 for r in found) and lost <= 0.005 * len(found)


def test_held_out_rows_are_never_learnt_from(spark, documents, labels):
    rows = [(i, f"text {i} words") for i in range(60)]
    docs = documents(*rows)
    marks = [(i, i % 2, 0) for i, _ in rows]
    turned = [(i, 1 - q if fold(i) == 1 else q, t) for i, q, t in marks]
    one, other = (quality_model.train(docs, labels(*m)) for m in (marks, turned))
    assert np.array_equal(one.values, other.values) and one.bias == other.bias


def test_without_labels_and_awkward_rows(spark, awkward, nothing, labels):
    none = labels((999, 1, 0)).filter("false")
    found = quality_model.scores(awkward, none).collect()
    assert len(found) == awkward.count() and {r.score for r in found} == {0.5}
    marks = labels((1, 1, 0), (1, 0, 0), (2, 0, 0), (None, 1, 0), (3, None, 0), (5, 0, 0))
    found = quality_model.scores(awkward, marks).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (2, 3, 4)}) == 1
    assert quality_model.scores(nothing, marks).collect() == []
