"""Language identification with a bidirectional gated recurrent network over bytes.

A text is read as its words: runs of letters, in lower case, as UTF-8, cut to pieces of a
bounded length. The network runs over each piece in both directions and gives every byte
a probability for each language; a document's probabilities are the mean over all its
bytes. Words that occur again within a task are scored once, up to a fixed number of them.
It is trained in numpy by backpropagation through time on a bounded sample of labelled rows.

Defined cases: a null text, an empty text and one without a letter get ``und`` and score
0; without any labelled row every text is ``und``; equal texts get equal results; ties
between languages go to the first by name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.texts import BLOCK_BYTES, CACHE_ENTRIES, keyed, map_blocks, offsets

UNKNOWN = "und"
#: Bounds of the sample learned from: rows a language on average, characters of each, and rows in all.
ROWS_A_LANGUAGE, ROW_CHARS, ROWS = 400, 1000, 8000
#: Words trained on, and passes over them.
TRAIN_WORDS, ROUNDS = 60_000, 3
PIECE, HIDDEN = 24, 16
#: All ASCII but letters separates words; bytes beyond ASCII belong to them.
SEPARATE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    words = text.lower().encode("utf-8", "surrogatepass").translate(SEPARATE).split()
    if words and (not text.isascii()) and not any(map(str.isalpha, text)):
        return []
    return words


def padded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes by piece and place, zeros behind the end, and the lengths."""
    size = np.array([len(p) for p in pieces])
    x = np.zeros((len(pieces), int(size.max())), np.uint8)
    x[np.arange(x.shape[1]) < size[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
    return x, size


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class ByteNetwork:
    """Two gated recurrent layers, one for each direction, and a dense layer over both at every byte."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> ByteNetwork:
        w = {}
        for d in "fb":
            w[f"{d}_in"] = rng.normal(0, 0.3, (256, 3 * HIDDEN))
            w[f"{d}_rec"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN))
        w["out"] = rng.normal(0, 1 / np.sqrt(2 * HIDDEN), (2 * HIDDEN, len(languages)))
        w["out_b"] = np.zeros(len(languages))
        return cls(languages, {k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, d: str, x: np.ndarray, keep: bool):
        """States after each byte; with ``keep`` also what the way back needs."""
        given, rec = self.weights[f"{d}_in"], self.weights[f"{d}_rec"]
        h = np.zeros((len(x), HIDDEN), np.float32)
        states, kept = np.empty((x.shape[1], len(x), HIDDEN), np.float32), []
        for t in range(x.shape[1]):
            a, u = given[x[:, t]], h @ rec
            gates = sigmoid(a[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(a[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
            if keep:
                kept.append((h, z, r, n, u[:, 2 * HIDDEN:]))
            h = n + z * (h - n)
            states[t] = h
        return states, kept

    def _back(self, d: str, x: np.ndarray, kept: list, d_states: np.ndarray, grad: dict) -> None:
        rec = self.weights[f"{d}_rec"]
        grad[f"{d}_in"], grad[f"{d}_rec"] = np.zeros_like(self.weights[f"{d}_in"]), np.zeros_like(rec)
        d_h = np.zeros_like(d_states[0])
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, n, u_n = kept[t]
            d_h = d_h + d_states[t]
            d_n = d_h * (1 - z) * (1 - n * n)
            d_z = d_h * (h - n) * z * (1 - z)
            d_r = d_n * u_n * r * (1 - r)
            d_a = np.concatenate((d_z, d_r, d_n), axis=1)
            d_u = np.concatenate((d_z, d_r, d_n * r), axis=1)
            np.add.at(grad[f"{d}_in"], x[:, t], d_a)
            grad[f"{d}_rec"] += h.T @ d_u
            d_h = d_h * z + d_u @ rec.T

    @staticmethod
    def _turned(x: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each place, the place as seen from the other end; behind the end itself."""
        at = np.arange(x.shape[1])
        return np.where(at < size[:, None], size[:, None] - 1 - at, at)

    def positions(self, x: np.ndarray, size: np.ndarray, keep: bool = False):
        """Probabilities of each language at every byte."""
        turned = self._turned(x, size)
        rows = np.arange(len(x))
        fore, kept_f = self._run("f", x, keep)
        back_x = np.take_along_axis(x, turned, axis=1)
        back, kept_b = self._run("b", back_x, keep)
        both = np.concatenate((fore, back[turned.T, rows[None, :]]), axis=2)
        logit = both @ self.weights["out"] + self.weights["out_b"]
        p = np.exp(logit - logit.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        return p, (both, kept_f, kept_b, back_x, turned)

    def gradients(self, x: np.ndarray, size: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, (both, kept_f, kept_b, back_x, turned) = self.positions(x, size, keep=True)
        inside = (np.arange(x.shape[1]) < size[:, None]).T
        d_logit = p.copy()
        d_logit[:, np.arange(len(y)), y] -= 1
        d_logit *= inside[:, :, None] / inside.sum()
        grad = {"out": np.einsum("tbh,tbc->hc", both, d_logit, optimize=True), "out_b": d_logit.sum((0, 1))}
        d_both = (d_logit @ self.weights["out"].T).astype(np.float32)
        self._back("f", x, kept_f, d_both[:, :, :HIDDEN], grad)
        d_back = np.zeros_like(d_both[:, :, HIDDEN:])
        d_back[turned.T, np.arange(len(x))[None, :]] = d_both[:, :, HIDDEN:]
        self._back("b", back_x, kept_b, d_back, grad)
        return grad

    def fit(self, words: list[bytes], y: np.ndarray, rng: np.random.Generator, rounds: int = ROUNDS) -> None:
        """Adam with clipped gradients over batches of words of like length."""
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        size = np.array([len(w) for w in words])
        step = 0
        for _ in range(rounds):
            order = np.argsort(size + rng.random(len(words)) * 3, kind="stable")
            batches = [order[at:at + 256] for at in range(0, len(order), 256)]
            for b in rng.permutation(len(batches)):
                x, n = padded([words[i] for i in batches[b]])
                grad, step = self.gradients(x, n, y[batches[b]]), step + 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grad.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)

    def word_sums(self, words: list[bytes]) -> np.ndarray:
        """Per word, the probabilities of each language summed over its bytes; the last column counts the bytes."""
        owner, pieces = [], []
        for i, w in enumerate(words):
            for at in range(0, len(w), PIECE):
                owner.append(i)
                pieces.append(w[at:at + PIECE])
        out = np.zeros((len(words), len(self.languages) + 1), np.float64)
        size = np.array([len(p) for p in pieces])
        order, owner = np.argsort(size, kind="stable"), np.asarray(owner)
        for at in range(0, len(order), 2048):
            part = order[at:at + 2048]
            x, n = padded([pieces[i] for i in part])
            p, _ = self.positions(x, n)
            p *= (np.arange(x.shape[1]) < n[:, None]).T[:, :, None]
            np.add.at(out, owner[part], np.concatenate((p.sum(0), n[:, None]), axis=1))
        return out


class WordScores:
    """Sums for the words of a task, computed once a word while the table lasts."""

    def __init__(self, network: ByteNetwork):
        self.network, self.number = network, {}
        self.sums = np.zeros((0, len(network.languages) + 1))

    def of(self, words: list[bytes]) -> np.ndarray:
        """Rows of ``sums`` for ``words``."""
        if len(self.number) > CACHE_ENTRIES:
            self.number, self.sums = {}, self.sums[:0]
        new = list(dict.fromkeys(w for w in words if w not in self.number))
        if new:
            self.number.update(zip(new, range(len(self.sums), len(self.sums) + len(new)), strict=True))
            self.sums = np.concatenate((self.sums, self.network.word_sums(new)))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def labelled_sample(labelled: DataFrame, text: str, lang: str, seed: int = 0) -> list[tuple[str, str]]:
    """About ``ROWS_A_LANGUAGE`` beginnings of texts a language, at most ``ROWS`` in all, chosen by hash; copies count once."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, ROWS_A_LANGUAGE / n))]), F.col("lang"))
    place = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1_000_000)) / 1e6
    picked = rows.where(place < share).select("lang", F.substring("text", 1, ROW_CHARS).alias("text")).distinct()
    return sorted((r.lang, r.text) for r in picked.limit(ROWS).collect())


def learn(sample: list[tuple[str, str]], seed: int = 3) -> ByteNetwork:
    """A network from (language, text) rows; of every language about the same number of words."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in sample})
    words, y = [], []
    for i, lang in enumerate(languages):
        own = [w[at:at + PIECE] for k, t in sample if k == lang for w in words_of(t) for at in range(0, len(w), PIECE)]
        for j in rng.permutation(len(own))[:TRAIN_WORDS // len(languages)]:
            words.append(own[j])
            y.append(i)
    network = ByteNetwork.fresh(languages, rng)
    if words:
        network.fit(words, np.asarray(y), rng)
    return network


def predict(docs: DataFrame, network: ByteNetwork, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, the likeliest language, its probability, and those of all languages."""
    known: list[WordScores] = []  # one a task, made on first use

    def work(block):
        own = known[0] if known else known.append(WordScores(network)) or known[0]
        words = [words_of(t) if network.languages else [] for t in block[1]]
        starts = offsets([len(w) for w in words])
        at = own.of([w for ws in words for w in ws])
        out = {"lang_pred": [], "score": [], "probabilities": []}
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if a == b:
                out["lang_pred"].append(UNKNOWN)
                out["score"].append(0.0)
                out["probabilities"].append([])
                continue
            total = own.sums[at[a:b]].sum(0)
            p = total[:-1] / total[-1]
            best = int(np.argmax(p))
            out["lang_pred"].append(network.languages[best])
            out["score"].append(min(1.0, float(p[best])))
            out["probabilities"].append([{"lang": k, "p": float(v)} for k, v in zip(network.languages, p, strict=True)])
        return out

    schema = "lang_pred string, score double, probabilities array<struct<lang: string, p: double>>"
    limit = max(1 << 18, BLOCK_BYTES * 8 // max(8, len(network.languages)))
    return map_blocks(keyed(docs, key, text), work, schema, limit).withColumnRenamed("key", key)


def digest(docs: DataFrame) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    network = learn(labelled_sample(docs.where(~held_out | held_out.isNull()), "text", "lang"))
    return predict(docs, network).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
