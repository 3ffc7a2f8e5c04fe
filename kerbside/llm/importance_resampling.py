"""Importance resampling towards a target: hashed features of pre-tokenised words, and a Gumbel draw.

Texts are lower-cased in A-Z only and cut to words by the `tokenizers` library's untrained ``Split``
pre-tokeniser, whose offsets give the words. Words joined by one space make a text in which a feature,
a run of consecutive words, is what lies between the start of one word and the end of another. Features
fall into CRC-32 buckets. One pass stores each row's histogram; the sums over all rows of the corpus and
of the target give every bucket a gain, and a row's weight is the floored mean of its features' gains.
The draw without replacement takes the highest sums of weight and Gumbel noise, which a hash of the key fixes.

Defined cases: a null or wordless text has no features and weight 0; a null key draws its noise as the empty
text; repeated rows count and are drawn as often as they occur; ties go to the smaller key, null keys first;
an empty corpus gives no rows, an empty target gains from the corpus alone. Other columns are not read.
Very long texts are cut between words into pieces of ``PIECE_CHARS``, windows reaching over the cuts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Regex, pre_tokenizers

from kerbside.llm.graphs import stored
from kerbside.llm.texts import CACHE_ENTRIES, keyed, map_blocks
from kerbside.operators.paging import number_rows

#: ASCII characters other than digits and letters part words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Characters handed to the pre-tokeniser at once.
PIECE_CHARS = 1 << 20
#: Scores a bin of the first cut; scores are whole numbers within about +-100,000, so bins are few.
BIN = 100


@dataclass(frozen=True)
class Sampling:
    """Runs of ``shortest`` to ``longest`` words, in ``buckets``; ``percent`` of rows with ``least_words`` words are drawn."""

    shortest: int = 1
    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024


class Buckets(dict):
    """CRC-32 buckets of features, kept for the features seen last."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[feature] = value = zlib.crc32(feature) % self.buckets
        return value


def splitter() -> pre_tokenizers.Split:
    return pre_tokenizers.Split(Regex(f"{SEPARATORS}+"), behavior="removed")


_SEPARATOR = re.compile(SEPARATORS)


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut behind separators, in pieces of about ``size`` characters."""
    at = 0
    while len(text) - at > size and (cut := _SEPARATOR.search(text, at + size)):
        yield text[at:cut.end()]
        at = cut.end()
    yield text[at:]


def lowered(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def windows(words: list[bytes], width: int) -> list[bytes]:
    """All runs of ``width`` words, as slices of the joined words from one offset to another."""
    if width == 1:
        return words
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    return [joined[a:b] for a, b in zip(starts, ends[width - 1:], strict=False)]


def histogram(text: str, split: pre_tokenizers.Split, bucket_of: Buckets, plan: Sampling) -> tuple[int, np.ndarray]:
    """Words of a text, and how many of its features fall into each bucket."""
    counts, n_words, before = np.zeros(plan.buckets, np.int64), 0, []
    for piece in pieces(lowered(text)):
        words = [piece[a:b].encode() for _, (a, b) in split.pre_tokenize_str(piece)]
        n_words += len(words)
        for width in range(plan.shortest, plan.longest + 1):
            # The words before the piece make the windows that reach over the cut.
            features = windows(before[max(0, len(before) - width + 1):] + words, width)
            if features:
                counts += np.bincount(np.fromiter(map(bucket_of.__getitem__, features), np.int64, len(features)), minlength=plan.buckets)
        known = before + words
        before = known[max(0, len(known) - plan.longest + 1):]
    return n_words, counts


def bucketed(df: DataFrame, key: str, text: str, plan: Sampling) -> DataFrame:
    """Per row: key, n_words, n_features, and the buckets of its features with their counts."""

    def work(block):
        split, bucket_of = splitter(), Buckets(plan.buckets)
        out = {"n_words": [], "n_features": [], "buckets": [], "counts": []}
        for t in block[1]:
            n_words, counts = histogram(t, split, bucket_of, plan)
            held = np.flatnonzero(counts)
            out["n_words"].append(n_words)
            out["n_features"].append(int(counts.sum()))
            out["buckets"].append(held)
            out["counts"].append(counts[held])
        return out

    return map_blocks(keyed(df, key, text), work, "n_words long, n_features long, buckets array<int>, counts array<long>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and counts of all rows of a batch in one, and the row of each."""
    buckets, counts = batch.column("buckets"), batch.column("counts")
    lengths = np.diff(buckets.offsets.to_numpy())
    return buckets.flatten().to_numpy(), counts.flatten().to_numpy(), np.repeat(np.arange(len(lengths)), lengths)


def bucket_sums(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all rows; a task sends one row a bucket at most."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            at, counts, _ = _flat(batch)
            np.add.at(total, at, counts)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return rows.select("buckets", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket; both sums have one row a bucket at most."""
    s, t = ({r.bucket: r.n for r in sums.collect()} for sums in (corpus, target))
    all_s, all_t = (float(sum(x.values()) + buckets) for x in (s, t))
    return np.array([
        math.floor(1000 * math.log((float(t.get(b, 0)) + 1) * all_s / ((float(s.get(b, 0)) + 1) * all_t))) for b in range(buckets)
    ], np.int64)


def weighted(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """``bucketed`` rows with ``weight`` in place of the histogram."""
    kept = [f for f in rows.schema.fields if f.name not in ("buckets", "counts")]
    shape = rows.select(*[f.name for f in kept], F.lit(0).cast("long").alias("weight")).schema
    arrow = to_arrow_schema(shape)

    def run(batches):
        for batch in batches:
            at, counts, owner = _flat(batch)
            sums = np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, owner, gains[at] * counts)
            n = np.maximum(batch.column("n_features").to_numpy(), 1)
            columns = [batch.column(f.name).cast(arrow.field(f.name).type) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums // n)], schema=arrow)

    return rows.mapInArrow(run, shape)


def gumbel(key: Column, seed: int) -> Column:
    """Whole thousandths of Gumbel noise out of a hash of the key."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def drawn(scored: DataFrame, plan: Sampling) -> DataFrame:
    """``scored`` rows with their ``rank`` in the draw, null for those that are not drawn.

    Bins of scores, counted over all rows, tell from which score on rows can be drawn; those alone are sorted,
    in ranges of (score, key, place), so no group of equal scores has to fit a task.
    """
    may = F.col("n_words") >= plan.least_words
    bins = sorted(
        ((r.bin, r.n) for r in scored.where(may).groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(F.count("*").alias("n")).collect()),
        reverse=True,
    )
    take = plan.percent * sum(n for _, n in bins) // 100
    reached, least = 0, None
    for bin_, n in bins:
        if reached >= take:
            break
        reached, least = reached + n, bin_ * BIN
    none = F.lit(None).cast("long").alias("rank")
    if least is None:
        return scored.select("*", none)
    ahead = may & (F.col("score") >= least)
    sorted_ = number_rows(scored.where(ahead).withColumn("falling", -F.col("score")), ["falling", "key", "place"])
    ranked = sorted_.select(*scored.columns, F.when(F.col("position") < take, F.col("position") + 1).alias("rank"))
    return ranked.unionByName(scored.where(~ahead).select("*", none))


def resample(
    corpus: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", plan: Sampling = Sampling(),
) -> DataFrame:
    """Per row of ``corpus``: key, n_words, n_features, weight, score, and its rank in the draw (null: not drawn)."""
    rows = stored(bucketed(corpus, key, text, plan).withColumn("place", F.monotonically_increasing_id()), "features")
    aims = bucketed(target.select(F.lit(0).alias("key"), F.col(target_text).alias("text")), "key", "text", plan)
    gains = bucket_gains(bucket_sums(rows, plan.buckets), bucket_sums(aims, plan.buckets), plan.buckets)
    scored = weighted(rows, gains).withColumn("score", F.col("weight") + gumbel(F.col("key"), plan.seed))
    return drawn(stored(scored, "scores"), plan).drop("place").withColumnRenamed("key", key)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
