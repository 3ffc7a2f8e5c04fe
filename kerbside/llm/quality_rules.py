"""Line-first quality rules: judge each line, drop the failures, then judge what is left of the document.

Defined cases: a null text counts as empty; an empty text has no words and fails; a
line without words is neither judged nor counted; equal lines fail from the second on;
repeated rows are judged alike; other columns are passed through untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.texts import ASCII_SPACE, Numbers, keyed, map_blocks, offsets, runs_hashed, split_words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Ends of sentences in several scripts, and the marks that may close one.
TERMINAL = tuple(".!?:;…。！？；：؟۔।\"'”’»)]")
SEPARATORS = "|»›>·•"
BOILERPLATE = re.compile(
    r"all rights reserved|licensed under|apache license|creative commons|terms of (?:use|service)"
    r"|privacy policy|cookie policy|accept (?:all )?cookies|subscribe to|sign up for|click here"
    r"|enable javascript|follow us on|share this|copyright (?:©|\(c\)|\d{4})|permission is hereby granted"
    r"|lorem ipsum"
)


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the rules; all hold per line but for the last two."""

    short_line: int = 6           # words below which a line must end a sentence
    separators: int = 2           # marks that make a short-celled line navigation
    cell_words: float = 3.0       # words between marks, at most, in navigation
    boilerplate_words: int = 40   # words up to which a stock phrase condemns its line
    symbol_share: float = 0.1     # symbols among the characters of words
    distinct_share: float = 0.3   # distinct words among the words of a line of 20 or more
    lost_share: float = 0.5       # characters of words that a document may lose
    words_left: int = 20          # words that must be left


def line_fault(line: str, words: list[str], limits: RuleLimits) -> str | None:
    """The first rule that a line with words breaks."""
    n = len(words)
    if n <= limits.boilerplate_words and BOILERPLATE.search(line.lower()):
        return "boilerplate"
    marks = sum(map(line.count, SEPARATORS))
    if marks >= limits.separators and n - marks <= limits.cell_words * (marks + 1):
        return "navigation"
    chars = len(line) - line.count(" ")
    if sum(map(line.count, SYMBOLS)) > limits.symbol_share * chars:
        return "symbols"
    if n >= 20 and len(set(words)) < limits.distinct_share * n:
        return "repetition"
    if n < limits.short_line and not line.rstrip().endswith(TERMINAL):
        return "punctuation"
    return None


def clean_lines(text: str, limits: RuleLimits) -> tuple[str, int, int, int, int]:
    """Text without failing lines, its words, characters of words, lines removed, repeated lines."""
    kept, seen = [], set()
    words_left = chars_left = removed = repeated = 0
    for line in text.split("\n"):
        if not line.strip(ASCII_SPACE):
            kept.append(line)
            continue
        words = line.split()
        again = line in seen
        repeated += again
        seen.add(line)
        if again or line_fault(line, words, limits):
            removed += 1
            continue
        kept.append(line)
        words_left += len(words)
        chars_left += len(line) - line.count(" ")
    return "\n".join(kept) if removed else text, words_left, chars_left, removed, repeated


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text, the words in windows of eight that occur in it twice or more, all occurrences counted."""
    starts = offsets([len(w) for w in words])
    ids = np.fromiter(map(Numbers().__getitem__, (w for ws in words for w in ws)), np.uint64, starts[-1])
    doc = np.repeat(np.arange(len(words)), np.diff(starts))
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return np.zeros(len(words), np.int64)
    inside = doc[:n] == doc[WINDOW - 1:]
    at = np.flatnonzero(inside)
    key = runs_hashed(ids, WINDOW)[at] ^ (doc[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    real = doc[a] == doc[b]  # equal hashes are checked word by word
    for i in range(WINDOW):
        real &= ids[a + i] == ids[b + i]
    cover = np.zeros(len(ids) + 1, np.int64)
    hit = np.unique(np.concatenate((a[real], b[real])))
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return covered[starts[1:]] - covered[starts[:-1]]


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Per row: key, counts over the whole text, the verdict, and the text without failing lines."""

    def work(block):
        words = [split_words(t) for t in block[1]]
        repeats = repeated_words(words)
        out = {name: [] for name in COLUMNS}
        for t, w, again in zip(block[1], words, repeats, strict=True):
            n, chars = len(w), len(t) - sum(map(t.count, ASCII_SPACE))
            cleaned, words_left, chars_left, removed, repeated = clean_lines(t, limits)
            failed = n < 20 or 100 * int(again) > 30 * n
            lost = chars_left < (1 - limits.lost_share) * chars or words_left < limits.words_left
            for name, value in zip(COLUMNS, (
                n, chars, sum(map(t.count, SYMBOLS)), repeated, int(again), failed, not (failed or lost),
                removed, cleaned,
            ), strict=True):
                out[name].append(value)
        return out

    judged = map_blocks(keyed(df, key, text), work, SCHEMA)
    return judged.withColumnRenamed("key", key)


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines_removed long, cleaned string"
)
COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]


def digest(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", F.length("cleaned").cast("long").alias("n_chars_left"),
    )
