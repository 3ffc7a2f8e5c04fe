"""Forward passes, pooled features and windows against versions written out step by step."""

import math
import random
from collections import Counter

import numpy as np

from kerbside.llm import decontamination, language_id, quality_classifier


def test_language_probabilities_byte_by_byte():
    network = language_id.ByteNetwork.fresh(["a", "b", "c"], np.random.default_rng(4))
    pieces = [b"x", "größe".encode(), b"languages", b"de"]
    w, hidden = {k: v.astype(float) for k, v in network.weights.items()}, language_id.HIDDEN

    def states(d, raw):
        h, out = [0.0] * hidden, []
        for byte in raw:
            u = [sum(h[i] * w[f"{d}_rec"][i, j] for i in range(hidden)) for j in range(3 * hidden)]
            a = w[f"{d}_in"][byte]
            new = []
            for j in range(hidden):
                z, r = (1 / (1 + math.exp(-(a[k] + u[k]))) for k in (j, hidden + j))
                n = math.tanh(a[2 * hidden + j] + r * u[2 * hidden + j])
                new.append((1 - z) * n + z * h[j])
            h = new
            out.append(h)
        return out

    x, size = language_id.padded(pieces)
    p, _ = network.positions(x, size)
    for i, raw in enumerate(pieces):
        fore, back = states("f", raw), states("b", raw[::-1])[::-1]
        for t in range(len(raw)):
            logit = [sum(v * w["out"][k, c] for k, v in enumerate([*fore[t], *back[t]])) + w["out_b"][c] for c in range(3)]
            total = sum(map(math.exp, logit))
            assert np.allclose(p[t, i], [math.exp(v) / total for v in logit], atol=1e-5)
    sums = network.word_sums(pieces)
    assert np.allclose(sums[:, :-1], [p[:len(raw), i].sum(0) for i, raw in enumerate(pieces)], atol=1e-4)
    assert sums[:, -1].tolist() == [len(raw) for raw in pieces]


def test_quality_scores_text_by_text():
    texts = ["", "one", "the same the same the same", "a longer text, with marks (and more) of all kinds!", "x y " * 400]
    network = quality_classifier.learn([(t + f" {i}", i % 2) for i, t in enumerate(texts * 8)])
    index, rows = quality_classifier.index_vectors(), quality_classifier.Rows()
    at, starts = quality_classifier.word_rows(texts, rows)
    got = network.scores(network.pooled(at, starts, index))
    for text, score in zip(texts, got, strict=True):
        places = [rows[w] for w in quality_classifier.words_of(text)]
        means = np.mean([network.contexts[p] for p in places], axis=0) if places else np.zeros(quality_classifier.SIZE)
        alike = [
            sum(float(index[a] @ index[b]) for a, b in zip(places[lag:], places, strict=False)) / quality_classifier.NONZERO / max(1, len(places) - lag)
            for lag in quality_classifier.LAGS
        ]
        x = np.array([*means, *alike, math.log1p(min(len(places), 1000))])
        w = network.weights
        hidden = np.maximum((x - w["mean"]) / w["spread"] @ w["first"] + w["first_b"], 0)
        logit = float((hidden @ w["second"] + w["second_b"]).ravel()[0]) / network.temperature
        assert abs(score - 1 / (1 + math.exp(-logit))) < 1e-4


def best_window(text, item):
    """The highest similarity of an item with any window of its number of words."""
    def bag(words):
        width = min(5, len(words))
        return Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1))

    words, own = text.lower().split(), item.lower().split()
    if not words or not own:
        return 0.0
    windows = [words[i:i + len(own)] for i in range(max(1, len(words) - len(own) + 1))]

    def alike(window):
        if min(5, len(window)) != min(5, len(own)):
            return 0.0
        a, b = bag(window), bag(own)
        return sum((a & b).values()) / sum((a | b).values())

    return max(map(alike, windows))


def test_leaks_window_by_window(spark):
    chance = random.Random(9)
    word = lambda: "".join(chance.choices("abcdefgh", k=3))
    items = [" ".join(word() for _ in range(n)) for n in (3, 8, 20, 20, 45, 90)] + ["", "same same same same same same same"]
    texts = ["", "same " * 12, items[4], items[5].rsplit(" ", 9)[0]]
    for _ in range(120):
        parts = chance.choice(items).split()
        for _ in range(chance.randrange(4)):
            if parts:
                parts[chance.randrange(len(parts))] = word()
        texts.append(" ".join([*(word() for _ in range(chance.randrange(30))), *parts, *(word() for _ in range(chance.randrange(30)))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.find_leaks(docs, benchmark).collect()}
    want = {(d, i): s for d, t in enumerate(texts) for i, item in enumerate(items) if (s := best_window(t, item)) >= 0.75}
    assert len(want) > 30 and any(s < 0.85 for s in want.values())
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
