"""URL filters against a plain version, and hosts whose names are run together."""

import functools
import math
import re
from collections import Counter

import pytest
import xxhash

from kerbside.llm import url_filters as op
from kerbside.llm.queries import QUERIES


def tokens(text):
    return ["0" if t[0].isascii() and t[0].isdigit() else t for t in re.findall(r"[0-9]+|[^\x00-\x60\x7B-\x7F]+", text)]


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def word_counts(texts):
    return Counter(w for t in texts for w in re.findall(op.LETTERS, low(t or "")) if len(w) <= op.WORD_LETTERS)


def best_split(run, counts):
    """Words by recursion over the last word, the longest of equally likely ones."""
    total = max(10, sum(counts.values()))
    least = max(1, round(total * op.TERM_SHARE))

    @functools.cache
    def upto(end):
        if end == 0:
            return 0.0, ()
        options = []
        for start in range(max(0, end - op.WORD_LETTERS), end):
            word = run[start:end]
            n = max(counts.get(word, 0), least if word in op.BLOCK_TERMS else 0)
            p = math.log(n / total) if n else math.log(10 / total) - len(word) * math.log(10)
            options.append((upto(start)[0] + p, -start, upto(start)[1] + (word,)))
        top = max(options, key=lambda o: o[:2])
        return top[0], top[2]

    return list(upto(len(run))[1])


def split_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (low(m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    fits = [r for r in op.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def plain(urls, texts):
    counts = word_counts(texts)
    split = functools.cache(lambda run: best_split(run, counts))
    bags, listed = [], []
    for url in urls:
        host, path = split_url(url)
        words = [w for t in tokens(host) for w in ([t] if t == "0" else split(t))] + tokens(low(path))
        bags.append([xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words])
        listed.append(any(w in op.BLOCK_TERMS for w in words))
    signed = lambda x: (x - (1 << 64) if x >> 63 else x) % op.BUCKETS
    bags = [[signed(x) for x in b] for b in bags]
    n = [Counter(x for b, k in zip(bags, listed, strict=True) if k == c for x in b) for c in (False, True)]
    total = [sum(c.values()) + op.SMOOTHING * max(1, len(n[0] | n[1])) for c in n]
    prior = math.log((sum(listed) + op.SMOOTHING) / (len(listed) - sum(listed) + op.SMOOTHING))
    out = []
    for url, bag in zip(urls, bags, strict=True):
        odds = prior + sum(math.log((n[1][x] + op.SMOOTHING) / total[1]) - math.log((n[0][x] + op.SMOOTHING) / total[0]) for x in bag)
        host, path = split_url(url)
        rule = rule_of(host, path)
        out.append((host, path, rule and rule.name, rule.verdict if rule else "block" if odds > 0 else "allow", odds))
    return out


def test_query_equals_the_definition(spark, check_dir):
    pages = spark.read.parquet(f"{check_dir}/pages.parquet").select("page_id", "url").collect()
    texts = [r.text for r in spark.read.parquet(f"{check_dir}/documents.parquet").select("text").collect()]
    want = plain([p.url for p in pages], texts)
    got = {r.page_id: tuple(r)[1:] for r in QUERIES["op13_url_filters"](spark, check_dir).collect()}
    assert len(got) == len(pages)
    assert {p.page_id: w[:4] for p, w in zip(pages, want, strict=True) if abs(w[4]) > 1e-6} == \
        {p.page_id: got[p.page_id] for p, w in zip(pages, want, strict=True) if abs(w[4]) > 1e-6}
    bad = {"casino", "bets", "pills", "adult", "spam", "ads"}
    free = [g for g in got.values() if g[2] is None]
    assert {g[3] for g in free if bad & set(re.split(r"[.-]", g[0]))} == {"block"}
    assert {g[3] for g in free if not bad & set(re.split(r"[.-]", g[0]))} == {"allow"}


ODD_URLS = [
    None, "", "no scheme.example.net/en/", "http://", "://net/", "http://NET", "http://net/", "http://a.b.NET/x?y#z",
    "http://example.net/en", "http://example.net/en/", "http://www.example.net/en/a", "http://badexample.net/en/", "http://xnet/",
    "http://example.com/de/1", "http://example.com/DE/1", "http://x.org/fr/", "http://x.org/frx", "http://u:p@x.org:80/fr/?q=://net/",
    "http://x.org?u=http://y.net/", "http://x.org#/fr/", "a\nb://x.org/fr/\nc", "http://münchen.example.com/straße", "http://漢字.com/é",
    "http://" + "y" * 3000 + ".com/" + "z" * 5000, "http://123.45.6.7/8/9",
]


def test_odd_urls(spark, odd):
    texts = ["free casino games and the news of the day", None, "", "the casino bonus"]
    rows = [(i, u, "k", "h", None) for i, u in enumerate(ODD_URLS)] + [(None, ODD_URLS[7], None, None, None)] * 3
    urls = spark.createDataFrame(rows, "page_id long, url string, key string, host string, features string")
    docs = spark.createDataFrame([(t, 1) for t in texts], "text string, word int")
    got = sorted(map(tuple, op.digest(urls, docs).collect()), key=repr)
    want = plain([r[1] for r in rows], texts)
    assert got == sorted(((r[0], *w[:4]) for r, w in zip(rows, want, strict=True)), key=repr)
    by_id = {g[0]: g for g in got}
    assert by_id[0][1:4] == ("", "", None) and by_id[2][1:4] == ("", "", None)
    assert by_id[9][3:] == ("example.net/en/", "allow") and by_id[8][3:] == ("net/", "block") and by_id[11][3:] == ("net/", "block")
    assert by_id[12][3] is None and by_id[5][3] is None and by_id[15][3:] == ("org/fr/", "allow")


def test_words_run_together_are_found(spark):
    texts = ["free slots and a casino bonus in the city news of today", "play free games today", "city news daily"] * 20
    names = ["freecasinobonus", "casinocity", "bonusgames", "citynewstoday", "dailynews", "playgames", "newscity"]
    rows = [(i, f"https://{n}.com/en/{i}") for i, n in enumerate(names * 30)]
    got = op.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    verdicts = {r.host.split(".")[0]: r.verdict for r in got}
    assert [n for n in names if verdicts[n] == "block"] == ["freecasinobonus", "casinocity"]
    # A word seen beside listed terms alone counts against a host that has no listed term.
    unlisted = op.judge(
        spark.createDataFrame([*rows, (9999, "https://bonusbonus.com")], "page_id long, url string"),
        spark.createDataFrame([(t,) for t in texts], "text string"))
    score = {r.host: r.score for r in unlisted.collect()}
    assert score["bonusbonus.com"] > score["newscity.com"]


def test_segments():
    counts = {"free": 10, "bets": 5, "the": 50, "rapist": 1, "therapist": 3, "a": 5}
    assert op.segment("freebets", counts, 100) == ["free", "bets"]
    assert op.segment("therapist", counts, 100) == ["therapist"]
    assert op.segment("", counts, 100) == [] and op.segment("qqq", counts, 100) == ["qqq"]


def test_rules_of_one_length_go_by_order(spark):
    rules = (op.Rule("allow", "a.b", "/x"), op.Rule("block", "b", "/xyz"), op.Rule("block", "a.b", "/y"))
    urls = spark.createDataFrame([("http://a.b/xyz",), ("http://a.b/y",)], "url string")
    from pyspark.sql import functions as F
    got = [r.v for r in urls.select(op.ruling(rules, op.host_of(F.col("url")), op.path_of(F.col("url"))).verdict.alias("v")).collect()]
    assert got == ["allow", "block"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    texts = spark.createDataFrame([], "text string")
    assert op.digest(none, texts).count() == 0
    one = spark.createDataFrame([(1, "http://abc.com/")], "page_id long, url string")
    assert [tuple(r) for r in op.digest(one, texts).collect()] == [(1, "abc.com", "/", None, "allow")]


@pytest.mark.parametrize("name", ["broadcast", "shuffled"])
def test_large_host_tables_take_the_shuffled_join(spark, monkeypatch, name):
    monkeypatch.setattr(op, "BROADCAST_BYTES", 16 << 20 if name == "broadcast" else -1)
    rows = [(i, f"http://{'hot' if i % 3 else f'h{i}'}.com/en/{i}") for i in range(300)]
    got = op.digest(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([("hot words",)], "text string"))
    assert sorted(r.page_id for r in got.collect()) == list(range(300))
