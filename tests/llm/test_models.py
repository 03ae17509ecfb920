"""Held-out accuracy and edge cases of the trained operators."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from siltbed.llm import features, langid, ordinal, queries, toxicity

SF = "/root/testdata/sf0.01"


def column(table, *names):
    return {r[names[0]]: r for r in pq.read_table(f"{SF}/{table}.parquet").to_pylist()}


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def auc(scores, truth):
    scores, truth = np.array(scores), np.array(truth)
    return np.mean([(a > b) + 0.5 * (a == b) for a in scores[truth == 1] for b in scores[truth == 0]])


def test_features_of_texts():
    texts = pa.array(["stupid word stupid", "", "stupidity"])
    a, none, b = features.feature_sets(texts)
    assert not len(none) and len(np.intersect1d(a, b)) == 3  # stems of 4, 5 and 6 bytes
    table = features.FeatureTable(np.intersect1d(a, b), np.array([1.0, 2.0, 4.0]))
    assert table.sums(texts).tolist() == [7.0, 0.0, 7.0]


def test_language(spark, edge_docs, no_docs):
    rows = queries.op4_langid(spark, SF).collect()
    docs = column("documents", "doc_id")
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and all(r.held_out == out(r.doc_id) for r in rows)
    assert np.mean([r.lang_pred == docs[r.doc_id]["lang"] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and abs(sum(r.proportions.values()) - 1) < 1e-3 for r in rows)
    model = langid.train(edge_docs)
    assert model.languages == ["de", "en"]
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(edge_docs, model).collect()}
    assert {(i, "und") for i in (4, 5, 6, 12, None)} <= found and (10, "en") in found
    empty = langid.train(no_docs)
    assert {r.lang_pred for r in langid.identify(edge_docs, empty).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


def test_mixture_of_two_languages():
    rnd = np.random.default_rng(0)
    likelihood = np.where(rnd.random((300, 1)) < 0.7, [[-5.0, -15.0, -25.0]], [[-15.0, -5.0, -25.0]]).astype(np.float32)
    share, size = langid.best_mixture(np.concatenate([likelihood, likelihood[:1].repeat(50, axis=0)]), np.array([300, 50]))
    assert size.tolist() == [2, 1] and share[0, 2] == 0 and share[1].max() == 1
    assert abs(share[0, 0] - (likelihood[:, 0] == -5).mean()) < 0.02


def test_mixture_of_all_languages():
    rnd = np.random.default_rng(3)
    spoken = rnd.permutation(np.repeat(np.arange(7), 200))
    likelihood = np.full((1400, 9), -20.0, np.float32)
    likelihood[np.arange(1400), spoken] = -5
    share, size = langid.best_mixture(likelihood, np.array([1400]))
    assert size.tolist() == [7] and share[0] == pytest.approx([1 / 7] * 7 + [0, 0], abs=1e-3)


def test_toxicity(spark, edge_docs, no_docs):
    rows = {r.doc_id: r for r in queries.op6_toxicity(spark, SF).collect()}
    labels = column("labels", "doc_id")
    held = [i for i in labels if out(i)]
    assert len(rows) == 1000 and all(r.held_out == out(i) for i, r in rows.items())
    assert auc([rows[i].score for i in held], [labels[i]["toxic"] for i in held]) > 0.85
    clean = [i for i in held if not labels[i]["toxic"]]
    assert np.mean([rows[i].predicted for i in clean]) < 0.02
    rated = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (1, 1)], "doc_id long, toxic int")
    for docs, given in ((edge_docs, rated), (edge_docs, rated.where("false")), (no_docs, rated)):
        found = toxicity.score_documents(docs, toxicity.train(docs, given)).collect()
        assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_label_model_discounts_voters_that_say_the_same():
    rnd = np.random.default_rng(1)
    truth = rnd.random(4000) < 0.2
    good = (rnd.random((4000, 3)) < np.where(truth[:, None], 0.7, 0.05)).astype(float)
    twins = np.repeat(rnd.random((4000, 1)) < np.where(truth[:, None], 0.4, 0.2), 6, axis=1).astype(float)
    rating = np.where(rnd.random(4000) < 0.3, truth, -1)
    votes = np.hstack([good, twins])
    model = toxicity.LabelModel.fit(votes, rating, np.ones(4000))
    assert model.share[:3].min() > 0.7 and model.share[3:].max() < 0.3
    assert np.abs(model.fires[1, :3] - 0.7).max() < 0.1
    assert auc(model.posterior(votes, np.full(4000, -1)), truth) > 0.93


def test_label_model_sees_every_row(spark, monkeypatch):
    """Not only a sample of those without a rating, and given ratings have no say in the targets."""
    monkeypatch.setattr(toxicity, "UNRATED_ROWS", 5)
    fit, seen = toxicity.LabelModel.fit, []
    monkeypatch.setattr(toxicity.LabelModel, "fit", lambda votes, rating, weight: (seen.append((votes, rating, weight)), fit(votes, rating, weight))[1])
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    toxicity.train(docs, labels)
    (votes, rating, weight), = seen
    own = [i for i, r in column("documents", "doc_id").items() if r["text"] is not None and not out(i)]
    rated = {i for i, r in column("labels", "doc_id").items() if r["toxic"] is not None}
    assert weight.sum() == len(own) and weight[rating < 0].sum() == len(set(own) - rated) > 5
    assert len(np.unique(np.column_stack([votes, rating]), axis=0)) == len(votes)


def test_a_rating_is_one_vote():
    model = toxicity.LabelModel(np.array([[0.1], [0.6]]), np.ones(1), 0.1)
    odds = [np.log(p / (1 - p)) for p in model.posterior(np.ones((3, 1)), np.array([-1, 0, 1]))]
    say = np.log(toxicity.RATING_ACCURACY / (1 - toxicity.RATING_ACCURACY))
    assert odds == pytest.approx([odds[0], odds[0] - say, odds[0] + say])


def test_rare_toxic_words_are_entries_at_any_size():
    """Three hundred toxic texts share words by twos only."""
    sets = [np.array([1 + k // 2], np.uint64) for k in range(300)] + [np.array([10_000 + k], np.uint64) for k in range(300)]
    entries = toxicity.mine_entries(sets, np.repeat([1, 0], 300), most=400)
    assert entries.tolist() == list(range(1, 151))


def test_quality(spark, edge_docs, no_docs):
    rows = {r.doc_id: r for r in queries.op8_ordinal(spark, SF).collect()}
    labels = column("labels", "doc_id")
    held = [i for i in labels if out(i)]
    assert len(rows) == 1000 and all(0 <= r.expected_grade <= 2 for r in rows.values())
    assert auc([rows[i].expected_grade for i in held], [labels[i]["quality"] for i in held]) > 0.85
    assert np.mean([rows[i].kept for i in held if labels[i]["quality"]]) > 0.97
    rated = spark.createDataFrame([(1, 1), (2, 0), (3, 2), (3, None), (None, 1)], "doc_id long, grade int")
    for docs, given in ((edge_docs, rated), (edge_docs, rated.where("false")), (no_docs, rated)):
        assert ordinal.grade_documents(docs, ordinal.train(docs, given, 3)).count() == docs.count()


def test_thresholds_are_ordered_and_likely():
    rnd = np.random.default_rng(2)
    names = np.arange(1, 5, dtype=np.uint64)
    sets = [names[rnd.random(4) < 0.5] for _ in range(3000)]
    place = np.array([1.5 * (1 in s) - 1.0 * (2 in s) for s in sets])
    grade = (rnd.logistic(size=3000)[:, None] + place[:, None] > [-1.0, 0.5, 1.5]).sum(axis=1)
    model = ordinal.fit(sets, grade, np.ones(3000), 4, names, rounds=1500)
    assert model.thresholds == pytest.approx([-1.0, 0.5, 1.5], abs=0.25)
    assert model.table.weights == pytest.approx([1.5, -1.0, 0, 0], abs=0.25)


def test_sample_counts_in_tasks(spark):
    rnd = np.random.default_rng(4)
    names = np.sort(rnd.integers(0, 1 << 64, 60, np.uint64))
    sets = [names[rnd.random(60) < 0.4] for _ in range(299)] + [names[:0]]
    target = rnd.random(300)
    data = [(k, bytearray(s.tobytes())) for k, s in enumerate(sets)]
    sample = features.Sample(spark.createDataFrame(data, "place int, features binary").repartition(5), "test-sample")
    place = sample.columns["place"]
    assert sorted(place) == list(range(300)) and "features" not in sample.columns
    some = names[::7]
    assert all(np.array_equal(found, np.intersect1d(sets[k], some)) for k, found in zip(place, sample.sets(some)))
    present = (target > 0.5).astype(np.int64)
    counted = {r.feature % (1 << 64): (r.present, r.share) for r in sample.counts(present[place], place.astype(np.int64)).collect()}
    own = {int(x): [k for k, s in enumerate(sets) if x in s] for x in names}
    assert counted == {x: (present[rows].sum(), sum(rows)) for x, rows in own.items()}


def test_sample_screens_by_gain_then_hash(spark):
    """Of features that tell as much the least hash without sign is taken, and none of too few rows."""
    twins = np.array([5, 1 << 62, (1 << 63) + 1, (1 << 64) - 2], np.uint64)
    rows = [twins if k < 40 else np.array([9, 77][:1 + (k == 50)], np.uint64) for k in range(80)]
    sample = features.Sample(spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(rows)], "place int, features binary").repartition(4), "test-sample")
    target = (sample.columns["place"] < 40).astype(float)
    assert sample.screened(target, 3).tolist() == [5, 9, 1 << 62]
    assert sample.screened(target, 99).tolist() == [5, 9, *twins[1:].tolist()]
    assert sample.screened(np.zeros(80), 99).tolist() == []


@pytest.mark.parametrize("train", [lambda docs, labels: toxicity.train(docs, labels), lambda docs, labels: ordinal.train(docs, labels.selectExpr("doc_id", "quality + 0 grade"), 2)])
def test_sets_of_features_stay_off_the_driver(spark, monkeypatch, train):
    """The largest table that training brings there; the sets of the sample are over 1.5 MB."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    brought, bring = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda frame: (brought.append(found := bring(frame)), found)[1])
    train(docs, labels)
    assert 0 < max(found.nbytes for found in brought) < 400_000
