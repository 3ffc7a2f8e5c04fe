"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from kerbside.llm import importance_resampling as op
from kerbside.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences


def plain(rows, target, plan):
    """Rows of (key, n_features, weight, score, rank) by the definition."""

    def bag(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i:i + n]) for n in range(plan.shortest, plan.longest + 1) for i in range(len(words) - n + 1)]
        return len(words), Counter(zlib.crc32(r.encode()) % plan.buckets for r in runs)

    bags = [bag(t) for _, t in rows]
    s, t = sum((b for _, b in bags), Counter()), sum((bag(x)[1] for x in target), Counter())
    all_s, all_t = sum(s.values()) + plan.buckets, sum(t.values()) + plan.buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    out = []
    for (key, _), (n, b) in zip(rows, bags, strict=True):
        weight = sum(gain[x] * c for x, c in b.items()) // max(1, sum(b.values()))
        h = int(hashlib.sha256(f"{plan.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, n, sum(b.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    may = sorted((r for r in out if r[1] >= plan.least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    take = plan.percent * len(may) // 100
    ranks = Counter()
    for i, r in enumerate(may):
        ranks[(*r, i + 1 if i < take else None)] += 1
    for r in out:
        if r[1] < plan.least_words:
            ranks[(*r, None)] += 1
    return ranks


def got(df):
    return Counter(tuple(r) for r in df.select(df.columns[0], "n_words", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("plan", [
    op.Sampling(), op.Sampling(longest=3, buckets=97, least_words=2, percent=40, seed=5), op.Sampling(shortest=2, longest=2, least_words=0, percent=100),
])
def test_draw_equals_the_definition(spark, odd, check_dir, plan):
    target = [r.text for r in spark.read.parquet(f"{check_dir}/benchmark.parquet").collect()] + [None, ""]
    aims = spark.createDataFrame([(t, 1) for t in target], "text string, key int")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert got(op.resample(odd, aims, plan=plan)) == plain(rows, target, plan)


def test_query_equals_sql(spark, check_dir):
    name = "op12_importance_resampling"
    assert differences(QUERIES[name](spark, check_dir), connect(check_dir), ORACLES[name]) == []


def test_empty_tables(spark, odd, empty):
    aims = spark.createDataFrame([("some words",)], "text string")
    assert op.resample(empty, aims).count() == 0
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert got(op.resample(odd, aims.limit(0))) == plain(rows, [], op.Sampling())


def test_equal_scores_and_repeated_rows_are_drawn_in_order(spark):
    rows = [(7, "same text here")] * 50 + [(None, "same text here")] * 50
    plan = op.Sampling(least_words=1, percent=55)
    assert got(op.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("x",)], "text string"), plan=plan)) == \
        plain(rows, ["x"], plan)


def test_cuts_lose_no_window(monkeypatch):
    text = "Ab cd, ef " * 50 + "long" * 30 + " é漢 x"
    plan = op.Sampling(longest=4, buckets=1009)
    whole = op.histogram(text, op.splitter(), op.Buckets(1009), plan)
    assert "".join(op.pieces(text, 7)) == text and max(map(len, op.pieces(text, 7))) < 140
    real = op.pieces
    monkeypatch.setattr(op, "pieces", lambda t: real(t, 7))
    cut = op.histogram(text, op.splitter(), op.Buckets(1009), plan)
    assert whole[0] == cut[0] and (whole[1] == cut[1]).all()
