"""Language and quality: held-out accuracy, gradients and odd rows."""

import zlib

import numpy as np
import pytest

from kerbside.llm import language_id, quality_classifier


def test_language_gradients():
    chance = np.random.default_rng(0)
    network = language_id.ByteNetwork.fresh(["a", "b", "c"], chance)
    for k in network.weights:
        network.weights[k] = network.weights[k].astype(np.float64)
    x, n = language_id.padded([b"abc", b"defgh", b"z"])
    y = np.array([0, 1, 2])

    def loss():
        p, _ = network.positions(x, n)
        inside = (np.arange(x.shape[1]) < n[:, None]).T
        return -(np.log(p[:, np.arange(3), y]) * inside).sum() / inside.sum()

    grad = network.gradients(x, n, y)
    for k, w in network.weights.items():
        at = np.unravel_index(np.argmax(np.abs(grad[k])), w.shape)
        old = w[at]
        w[at] = old + 1e-3
        up = loss()
        w[at] = old - 1e-3
        down = loss()
        w[at] = old
        assert grad[k][at] == pytest.approx((up - down) / 2e-3, rel=1e-2)


def test_language_of_held_out_texts(docs):
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language_id.digest(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_language_of_odd_rows(odd, empty):
    network = language_id.learn([("en", "some english words"), ("de", "einige deutsche wörter")])
    got = {r.doc_id: r for r in language_id.predict(odd, network).collect()}
    assert {got[d].lang_pred for d in (0, 1, 2, 6)} == {"und"} and got[0].score == 0.0
    assert got[4].lang_pred in ("de", "en") and got[11].lang_pred == got[12].lang_pred
    assert language_id.digest(empty).count() == 0
    assert {r.lang_pred for r in language_id.digest(odd.where("lang is null")).collect()} == {"und"}


def test_word_scores_do_not_depend_on_the_table(monkeypatch):
    network = language_id.learn([("en", "some english words"), ("de", "einige deutsche wörter")])
    words = [b"some", b"w" * 60, "wörter".encode(), b"some"]
    first = language_id.WordScores(network)
    at = first.of(words)
    whole = first.sums[at]
    monkeypatch.setattr(language_id, "CACHE_ENTRIES", 1)
    second = language_id.WordScores(network)
    for i, w in enumerate(words):
        at = second.of([w])
        assert np.allclose(second.sums[at], whole[i])


def test_quality_of_held_out_texts(spark, check_dir, docs):
    labels = spark.read.parquet(f"{check_dir}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_classifier.digest(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (7, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in quality_classifier.digest(odd, labels).collect()}
    assert got[0] == got[1] and got[11] == got[12]
    assert quality_classifier.digest(empty, labels.where("false")).count() == 0
    assert quality_classifier.learn([]).scores(np.zeros((2, 36))).tolist() == [0.5, 0.5]
