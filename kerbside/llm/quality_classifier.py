"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Words and single marks are hashed to a fixed number of rows. A row's index vector is a
sparse random one drawn from its number; its context vector is the sum of the index
vectors of the words around it in the sample learned from. A document is pooled to the
mean context vector of its words, how alike the index vectors of near words are, and its
length. The network's logit is divided by a temperature fitted on rows kept apart.

Defined cases: a null text counts as empty; an empty text pools to zeros and is scored
like any other; labels may be null or repeated (the smallest counts); with labels of one
kind only, or none, every score is that kind's share (one half without any); equal texts
get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.texts import CACHE_ENTRIES, keyed, map_blocks, offsets

#: Bounds of the sample learned from: labelled rows, and characters of each.
ROWS, ROW_CHARS = 4000, 8000
VECTORS, SIZE, NONZERO, REACH = 1 << 15, 32, 4, 2
LAGS = (1, 2, 3)
#: Texts of the sample worked on at once, on the driver.
PART_TEXTS = 200
MARKS = b"#*$%&|<>.,;:!?()[]{}=/\"@_+~^\\"


def index_vectors(seed: int = 11) -> np.ndarray:
    """One sparse vector of ones and minus ones a row."""
    rng = np.random.default_rng(seed)
    out = np.zeros((VECTORS, SIZE), np.float32)
    place = np.argsort(rng.random((VECTORS, SIZE)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, place, rng.choice(np.array([-1, 1], np.float32), (VECTORS, NONZERO)), axis=1)
    return out


class Rows(dict):
    """The row of each word, kept for the words seen last."""

    def __missing__(self, word):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = row = xxhash.xxh3_64_intdigest(word) % VECTORS
        return row


def words_of(text: str) -> list[bytes]:
    raw = text.lower().encode("utf-8", "surrogatepass")
    for i in range(len(MARKS)):
        raw = raw.replace(MARKS[i:i + 1], b" " + MARKS[i:i + 1] + b" ")
    return raw.split()


def word_rows(texts: list[str], rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    words = [words_of(t) for t in texts]
    starts = offsets([len(w) for w in words])
    return np.fromiter(map(rows.__getitem__, (w for ws in words for w in ws)), np.int64, starts[-1]), starts


def context_vectors(parts: list[tuple[np.ndarray, np.ndarray]], index: np.ndarray) -> np.ndarray:
    """Unit sums of the index vectors up to ``REACH`` words away in the same text."""
    out = np.zeros_like(index)
    for at, starts in parts:
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        for step in range(1, REACH + 1):
            same = np.flatnonzero(doc[step:] == doc[:-step])
            a, b = at[same], at[same + step]
            np.add.at(out, a, index[b])
            np.add.at(out, b, index[a])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


@dataclass
class QualityNetwork:
    contexts: np.ndarray
    weights: dict[str, np.ndarray]
    temperature: float = 1.0
    constant: float | None = None

    def pooled(self, at: np.ndarray, starts: np.ndarray, index: np.ndarray) -> np.ndarray:
        """One row of features a text."""
        n = np.diff(starts)
        doc = np.repeat(np.arange(len(n)), n)
        means = np.zeros((len(n), SIZE), np.float64)
        some = n > 0
        if some.any():
            means[some] = np.add.reduceat(self.contexts[at], starts[:-1][some], axis=0) / n[some, None]
        columns = [means]
        for lag in LAGS:
            same = doc[lag:] == doc[:-lag]
            alike = np.einsum("ij,ij->i", index[at[lag:]], index[at[:-lag]]) / NONZERO
            total = np.bincount(doc[lag:][same], alike[same], len(n))
            columns.append((total / np.maximum(n - lag, 1))[:, None])
        return np.concatenate((*columns, np.log1p(np.minimum(n, 1000))[:, None]), axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        hidden = np.maximum((x - w["mean"]) / w["spread"] @ w["first"] + w["first_b"], 0)
        return (hidden @ w["second"] + w["second_b"])[:, 0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def learn(sample: list[tuple[str, int]], seed: int = 5, steps: int = 400, hidden: int = 32) -> QualityNetwork:
    """A calibrated network from (text, label) rows; a quarter of them is kept for the temperature."""
    rng = np.random.default_rng(seed)
    index = index_vectors()
    texts, y = [t or "" for t, _ in sample], np.array([label for _, label in sample], np.float64)
    rows = Rows()
    parts = [word_rows(texts[i:i + PART_TEXTS], rows) for i in range(0, len(texts), PART_TEXTS)]
    network = QualityNetwork(context_vectors(parts, index).astype(np.float32), {})
    if len(set(y.tolist())) < 2 or len(y) < 8:
        network.constant = float(y.mean()) if len(y) else 0.5
        return network
    x = np.concatenate([network.pooled(at, starts, index) for at, starts in parts])
    apart = rng.random(len(y)) < 0.25
    fit_x, fit_y = x[~apart], y[~apart]
    w = network.weights
    w["mean"], w["spread"] = fit_x.mean(0), fit_x.std(0) + 1e-6
    learned = {
        "first": rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), "first_b": np.zeros(hidden),
        "second": rng.normal(0, np.sqrt(1 / hidden), (hidden, 1)), "second_b": np.zeros(1),
    }
    w |= learned
    z = (fit_x - w["mean"]) / w["spread"]
    first, second = ({k: np.zeros_like(v) for k, v in learned.items()} for _ in range(2))
    for step in range(1, steps + 1):
        part = rng.permutation(len(fit_y))[:512]
        pre = z[part] @ w["first"] + w["first_b"]
        act = np.maximum(pre, 0)
        p = 1 / (1 + np.exp(-np.clip(act @ w["second"] + w["second_b"], -60, 60)))
        d = (p - fit_y[part, None]) / len(part)
        d_act = d @ w["second"].T * (pre > 0)
        grad = {"second": act.T @ d, "second_b": d.sum(0), "first": z[part].T @ d_act, "first_b": d_act.sum(0)}
        for k, g in grad.items():
            g = g + (1e-4 * w[k] if not k.endswith("_b") else 0)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * first[k] / (np.sqrt(second[k]) + 1e-8)
    logit = network.logits(x[apart])
    grid = np.geomspace(0.25, 8, 41)
    network.temperature = float(grid[int(np.argmin(
        [np.logaddexp(0, -np.where(y[apart] > 0, 1, -1) * logit / t).mean() for t in grid]
    ))]) if apart.any() else 1.0
    return network


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = ROWS,
) -> list[tuple[str, int]]:
    """At most ``rows`` labelled texts, chosen by the hash of the key; only their keys are sent to the scan of the texts."""
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where("key is not null and label in (0, 1)")
    total = known.count()
    if not total:
        return []
    place = F.pmod(F.xxhash64(F.col("key")), F.lit(1_000_000)) / 1e6
    picked = known.where(place < min(1.0, 0.9 * rows / total)).limit(rows).groupBy("key").agg(F.min("label").alias("label"))
    found = docs.select(F.col(key).alias("key"), F.substring(F.col(text), 1, ROW_CHARS).alias("text")).join(F.broadcast(picked), "key")
    return sorted((r.text or "", int(r.label)) for r in found.select("text", "label").limit(rows).collect())


def classify(docs: DataFrame, network: QualityNetwork, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, score and predicted label."""
    kept: list = []  # one a task, made on first use

    def work(block):
        if not kept:
            kept.append((Rows(), index_vectors()))
        rows, index = kept[0]
        at, starts = word_rows(block[1], rows)
        score = network.scores(network.pooled(at, starts, index))
        return {"score": score, "predicted": (score >= 0.5).astype(np.int32)}

    return map_blocks(keyed(docs, key, text), work, "score double, predicted int", 2 << 20).withColumnRenamed("key", key)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = lambda key: F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    network = learn(labelled_sample(docs, labels.where(~held_out("doc_id"))))
    return classify(docs, network).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
