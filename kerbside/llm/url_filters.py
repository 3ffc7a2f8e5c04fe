"""URL filters: host and path rules first, then naive Bayes over the words of segmented hosts and of paths.

Runs of letters in host names are split to words by unigram Viterbi. Word counts come from a corpus of
texts; each distinct run is joined with the counts of its own substrings only, so no dictionary is sent
to tasks. A multinomial naive Bayes model over these words and the tokens of the path judges every URL that no rule
fits. Tokens are hashed to ``BUCKETS``, which bounds the model; its counts cover all URLs. The class of a URL in
training is told by listed terms (``BLOCK_TERMS``) among its words, so that words seen beside them count too.
Rules are left out of training: they follow sites and folders, which says nothing on words.

Defined cases: a null URL, or one without ``://``, has empty host and path, fits no rule and is judged by the
classes' shares alone; without any term in the corpus nothing but rules blocks; repeated rows are judged alike;
of rules of one length the earlier one wins; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kerbside.llm.graphs import stored

#: Letters of the longest word that a host name may hold; longer runs count as unknown words.
WORD_LETTERS = 24
#: Hashed tokens that the model tells apart.
BUCKETS = 1 << 18
#: Share of all words that a listed term has at least, as texts may lack it.
TERM_SHARE = 1e-5
#: Bytes of the host table up to which it is sent to every task.
BROADCAST_BYTES = 16 << 20
#: Added to every count of the model.
SMOOTHING = 0.1

# Words of hosts and paths that mark gambling, adult, drug, advertising and abuse sites.
BLOCK_TERMS = (
    "adult", "porn", "sex", "xxx", "escort", "casino", "poker", "bet", "bets", "betting", "gambling", "jackpot", "slots",
    "pills", "viagra", "cialis", "pharmacy", "ads", "adserver", "spam", "malware", "phishing", "warez", "crack", "keygen",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lower-case ASCII letters and all characters beyond ASCII.
LETTERS = r"[^\x00-\x60\x7B-\x7F]+"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
)


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruling(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest rule that fits host and path, null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    # From the weakest to the strongest, each before what it overrules.
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(text: Column) -> Column:
    """Runs of letters, and ``0`` for every number, in order."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(rf"([0-9]+|{LETTERS})"), 1), lambda t: F.when(t.rlike("^[0-9]"), F.lit("0")).otherwise(t))


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts: lower-cased runs of up to ``WORD_LETTERS`` letters."""
    words = texts.select(F.explode(F.regexp_extract_all(lowered(F.col(text)), F.lit(f"({LETTERS})"), 1)).alias("word"))
    return words.where(F.length("word") <= WORD_LETTERS).groupBy("word").agg(F.count("*").alias("n"))


def segment(run: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words of a run of letters; an unknown piece costs a power of ten a letter.

    Where several splits are equally likely, the last word that differs is the longest.
    """
    best: list[tuple[float, int]] = [(0.0, 0)]
    unit = math.log(10)
    for end in range(1, len(run) + 1):
        top = (-math.inf, 0)
        for start in range(max(0, end - WORD_LETTERS), end):
            n = counts.get(run[start:end])
            gain = math.log(n / total) if n else math.log(10 / total) - (end - start) * unit
            if best[start][0] + gain > top[0]:
                top = (best[start][0] + gain, start)
        best.append(top)
    words, end = [], len(run)
    while end:
        start = best[end][1]
        words.append(run[start:end])
        end = start
    return words[::-1]


def segmented(runs: DataFrame, counts: DataFrame, terms: Sequence[str] = BLOCK_TERMS) -> DataFrame:
    """(run, words) for a table of distinct runs of letters, by the word counts of a corpus.

    Only substrings of the runs meet the counts, and each run gets those of its own substrings.
    """
    total = max(10, counts.agg(F.sum("n")).first()[0] or 0)
    parts = runs.select("run", F.explode(F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), F.length("run")),
        lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(WORD_LETTERS), F.length("run") - i + 1)), lambda n: F.col("run").substr(i, n)),
    )))).alias("word"))
    least = F.when(F.col("word").isin(*terms), F.lit(max(1, round(total * TERM_SHARE)))).otherwise(F.lit(None)).cast("long")
    known = parts.join(counts, "word", "left").withColumn("n", F.greatest("n", least))
    held = known.groupBy("run").agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("word", "n"))).alias("known"))

    def run_all(batches):
        for batch in batches:
            words = [
                segment(run, {k["word"]: k["n"] for k in known}, total)
                for run, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(words, pa.list_(pa.string()))], names=["run", "words"])

    return held.mapInArrow(run_all, "run string, words array<string>")


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) for a table of distinct hosts, their runs of letters segmented, in order."""
    runs = hosts.select("host", F.posexplode(tokens_of(F.col("host"))).alias("at", "run"))
    words = stored(segmented(runs.where("run != '0'").select("run").distinct(), counts), "runs")
    placed = runs.join(words, "run", "left").select("host", "at", F.coalesce("words", F.array("run")).alias("words"))
    gathered = placed.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("w"))
    return gathered.select("host", F.flatten("w.words").alias("words"))


def small_hosts(table: DataFrame) -> DataFrame:
    """A stored host table, marked for broadcast where its measured bytes allow."""
    width = F.octet_length("host") + 4 * F.size("features") + F.lit(64)
    return F.broadcast(table) if (table.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES else table


def features(words: Column, buckets: int) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def described(urls: DataFrame, counts: DataFrame, key: str, url: str, rules: Sequence[Rule], terms: Sequence[str], buckets: int) -> DataFrame:
    """Per row: key, host, path, the rule's struct, hashed tokens, and whether a listed term is among them."""
    split = urls.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    named = host_words(split.where("host != ''").select("host").distinct(), counts)
    listed = F.array(*map(F.lit, terms)).cast("array<string>")
    table = stored(named.select("host", features(F.col("words"), buckets).alias("features"), F.arrays_overlap("words", listed).alias("listed")), "hosts")
    path_tokens = tokens_of(lowered(F.col("path")))
    joined = split.join(small_hosts(table), "host", "left")
    return joined.select(
        "key", "host", "path", ruling(rules, F.col("host"), F.col("path")).alias("ruled"),
        F.concat(F.coalesce("features", F.array().cast("array<int>")), features(path_tokens, buckets)).alias("features"),
        (F.coalesce("listed", F.lit(False)) | F.arrays_overlap(path_tokens, listed)).alias("listed"),
    )


class Model(NamedTuple):
    """Log odds of blocking, before any token and per bucket."""

    prior: float
    odds: np.ndarray


def learn(rows: DataFrame, buckets: int = BUCKETS) -> Model:
    """Counts of ``described`` rows by class; a task and the driver hold two numbers a bucket at most."""

    def run(batches):
        # The last two places count the rows.
        total = np.zeros(2 * buckets + 2, np.int64)
        for batch in batches:
            held, listed = batch.column("features"), batch.column("listed").to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.diff(held.offsets.to_numpy())
            np.add.at(total, held.flatten().to_numpy() + buckets * np.repeat(listed, lengths), 1)
            np.add.at(total, 2 * buckets + listed, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])

    sums = rows.select("features", "listed").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 * buckets + 2, np.float64)
    total[sums["at"].to_numpy()] = sums["n"].to_numpy()
    fine, bad, (n_fine, n_bad) = total[:buckets], total[buckets:-2], total[-2:]
    seen = np.count_nonzero(fine + bad)
    share = [(x + SMOOTHING) / (x.sum() + SMOOTHING * max(1, seen)) for x in (fine, bad)]
    return Model(math.log((n_bad + SMOOTHING) / (n_fine + SMOOTHING)), np.log(share[1]) - np.log(share[0]))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``described`` rows with ``score``, the probability of the blocked class, in place of their tokens."""
    shape = rows.drop("features", "listed").withColumn("score", F.lit(0.0)).schema

    def run(batches):
        for batch in batches:
            held = batch.column("features")
            lengths = np.diff(held.offsets.to_numpy())
            odds = np.full(batch.num_rows, model.prior)
            np.add.at(odds, np.repeat(np.arange(batch.num_rows), lengths), model.odds[held.flatten().to_numpy()])
            kept = [batch.column(n) for n in shape.names if n != "score"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-np.clip(odds, -700, 700))))], names=shape.names)

    return rows.mapInArrow(run, shape)


def judge(
    urls: DataFrame, texts: DataFrame, key: str = "page_id", url: str = "url", text: str = "text",
    rules: Sequence[Rule] = RULES, terms: Sequence[str] = BLOCK_TERMS, buckets: int = BUCKETS,
) -> DataFrame:
    """Per row of ``urls``: key, host, path, rule, verdict, and the model's probability of blocking."""
    counts = stored(word_counts(texts, text), "words")
    rows = stored(described(urls, counts, key, url, rules, terms, buckets), "urls")
    own = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return scored(rows, learn(rows, buckets)).select(
        F.col("key").alias(key), "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", own).alias("verdict"), "score",
    )


def digest(pages: DataFrame, docs: DataFrame) -> DataFrame:
    return judge(pages, docs).select("page_id", "host", "path", "rule", "verdict")
