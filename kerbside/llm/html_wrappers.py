"""Main text of web pages by wrappers inferred for each host.

A page is a stream of tags and texts. The streams of a host are aligned one after another
with the wrapper so far, a regular expression without unions: what repeats side by side
becomes a repeated group, what only one side has becomes an optional group, and texts
become slots. A slot is known by the containers around it, as pages have them: options that exclude
each other stand side by side in a wrapper, so its own order does not nest them. Those inside navigation, headers,
footers, asides, forms, adverts, notices or comments are boilerplate; the main text of a
page is that of its article or main element, or else that of all other slots but the fixed ones,
in page order. A slot is fixed if it has one and the same text wherever it is, is on more than half
of its host's pages, and is in no container with a text of its own that is not fixed.

Streams are shortened and made distinct before a host's are gathered, and aligned in two
steps, so that a host with most of the pages is no larger a group than another.

Defined cases: a null page counts as empty and has the empty text; unclosed and stray tags
are tolerated; an unclosed script, style or comment reaches to the end; a host without
an article and without varying text gives all that is not boilerplate; a null or odd address is
host ""; repeated pages get equal texts.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.graphs import small_or_not, stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|select|title|object)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>?|[^<]+|<",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Elements that can hold a slot's place in the page; others pass without a trace.
CONTAINERS = frozenset(
    "html body head main article section div nav header footer aside form menu dialog ul ol dl table figure blockquote "
    "details button fieldset center td".split()
)
BOILERPLATE = frozenset("head nav header footer aside form menu dialog button".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay"
    r"|newsletter|subscri\w+|nav\w*|menus?|breadcrumbs?|header|masthead|footer|side-?bar\w*|aside|comments?\w*|disqus"
    r"|repl(?:y|ies)|respond|share|sharing|social|related|recommend\w*|widgets?|toolbar|paginat\w+|pager|login|search"
    r"|navigation|contentinfo|complementary|dialog|alert)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Longest group of tokens that is looked for side by side.
GROUP = 12
#: Parts in which the streams of one host are aligned before their wrappers are.
PARTS = 8


def pieces(page: str) -> Iterator[tuple[str, tuple[str, ...], str]]:
    """(token, containers around it, text) for each tag and text in page order."""
    stack: list[tuple[str, str]] = []
    path: tuple[str, ...] = ()
    for m in TOKEN.finditer(page):
        name = m.group(3)
        if name is None:
            text = m.group()
            if text[0] != "<" or text == "<":
                yield "#", path, text
            continue
        name = name.lower()
        if m.group(2):
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
                path = tuple(label for _, label in stack)
            yield "/" + name, path, ""
            continue
        label = name
        if name in CONTAINERS:
            marks = " ".join(v.strip("\"'") for _, v in ATTRIBUTE.findall(m.group(4)))
            if marks:
                label = f"{name}.{re.sub(r'[0-9]+', '0', marks)}"
            if not m.group(4).endswith("/"):
                stack.append((name, label))
                path = tuple(x for _, x in stack)
        yield label, path, ""


def is_boilerplate(path: tuple[str, ...]) -> bool:
    """Whether a container on the way is one of those that hold no main text."""
    inside = False
    for label in path:
        name, _, marks = label.partition(".")
        if name in ("article", "main") and not (marks and MARKED.search(marks)):
            inside = True
        elif name in BOILERPLATE and not (name == "header" and inside):
            return True
        elif marks and name not in ("html", "body") and MARKED.search(marks):
            return True
    return False


def in_article(path: tuple[str, ...]) -> bool:
    return any(label.partition(".")[0] in ("article", "main") for label in path)


def page_text(page: str, fixed: set[tuple[str, ...]]) -> str:
    """The text in articles, or else outside the fixed slots, or else all that is not boilerplate."""
    kept: list[tuple[int, str]] = []
    levels: dict[tuple[str, ...], int | None] = {}
    for token, path, text in pieces(page):
        if token == "#":
            if path not in levels:
                levels[path] = None if is_boilerplate(path) else 2 if in_article(path) else int(path not in fixed)
            if levels[path] is not None:
                kept.append((levels[path], html.unescape(text)))
        elif token.lstrip("/").partition(".")[0] not in INLINE:
            kept.append((2, " "))
    for least in (2, 1, 0):
        if words := "".join(t for level, t in kept if level >= least).split():
            return " ".join(words)
    return ""


# Wrappers: sequences of tokens and of groups ("+", sequence) or ("?", sequence)


def squashed(seq: list) -> list:
    """The sequence with groups that stand side by side, equal, made repeated groups."""
    changed = True
    while changed:
        changed = False
        for size in range(1, GROUP + 1):
            at = 0
            while at + size < len(seq):
                group = seq[at:at + size]
                repeat = ("+", tuple(group))
                stop = at + size
                while seq[stop:stop + size] == group or seq[stop:stop + 1] == [repeat]:
                    stop += 1 if seq[stop:stop + 1] == [repeat] else size
                if stop > at + size and not (size == 1 and isinstance(group[0], tuple) and group[0][0] == "?"):
                    single = size == 1 and isinstance(group[0], tuple)
                    seq = seq[:at] + [group[0] if single else repeat] + seq[stop:]
                    changed = True
                elif isinstance(seq[at], tuple) and seq[at][0] == "+" and list(seq[at][1]) == seq[at + 1:at + 1 + len(seq[at][1])]:
                    seq = seq[:at + 1] + seq[at + 1 + len(seq[at][1]):]
                    changed = True
                else:
                    at += 1
    return seq


def alike(a, b) -> bool:
    if a == b:
        return True
    return isinstance(a, tuple) and isinstance(b, tuple) and a[0] == b[0] and a[1][0] == b[1][0]


def weight(seq) -> int:
    """Tokens in a sequence, those in its groups included."""
    return sum(1 if isinstance(x, str) else weight(x[1]) for x in seq)


def aligned(a: list, b: list) -> list:
    """The least wrapper by this alignment that takes both; unmatched runs become optional."""
    n, m = len(a), len(b)

    def steps(i: int, j: int):
        if i < n and j < m and alike(a[i], b[j]):
            yield i + 1, j + 1, min(weight(a[i:i + 1]), weight(b[j:j + 1]))
        if i < n and isinstance(a[i], tuple) and b[j:j + len(a[i][1])] == list(a[i][1]):
            yield i + 1, j + len(a[i][1]), weight(a[i][1])
        if j < m and isinstance(b[j], tuple) and a[i:i + len(b[j][1])] == list(b[j][1]):
            yield i + len(b[j][1]), j + 1, weight(b[j][1])

    best = [[0] * (m + 1) for _ in range(n + 1)]
    move: list[list] = [[None] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        for j in range(m, -1, -1):
            if i < n:
                best[i][j], move[i][j] = best[i + 1][j], (i + 1, j, "a")
            if j < m and (move[i][j] is None or best[i][j + 1] > best[i][j]):
                best[i][j], move[i][j] = best[i][j + 1], (i, j + 1, "b")
            for i2, j2, gain in steps(i, j):
                if best[i2][j2] + gain > best[i][j]:
                    best[i][j], move[i][j] = best[i2][j2] + gain, (i2, j2, "=")
    out, lone = [], {"a": [], "b": []}

    def close() -> None:
        for run in lone.values():
            if run:
                optional = all(isinstance(x, tuple) and x[0] == "?" for x in run)
                out.extend(run if optional else [("?", tuple(run))])
                run.clear()

    i = j = 0
    while move[i][j] is not None:
        i2, j2, how = move[i][j]
        if how == "=":
            close()
            x, y = (a[i] if i < n else None), (b[j] if j < m else None)
            if i2 - i == 1 and j2 - j == 1 and alike(x, y):
                out.append(x if x == y else (x[0], tuple(aligned(list(x[1]), list(y[1])))))
            else:
                out.append(x if isinstance(x, tuple) and b[j:j + len(x[1])] == list(x[1]) and i2 == i + 1 else y)
        else:
            lone[how] += a[i:i2] if how == "a" else b[j:j2]
        i, j = i2, j2
    close()
    return squashed(out)


def written(seq: list) -> str:
    """A wrapper as text."""
    return " ".join(x if isinstance(x, str) else f"( {written(list(x[1]))} ){x[0]}" for x in seq)


def plain(seq) -> list:
    return [x if isinstance(x, str) else [x[0], plain(x[1])] for x in seq]


def nodes(seq: list) -> list:
    return [x if isinstance(x, str) else (x[0], tuple(nodes(x[1]))) for x in seq]


def align_all(streams: list[str]) -> str:
    """One wrapper, as JSON, from several; the order is that of the text, so it does not depend on arrival."""
    wrapper: list | None = None
    for stream in sorted(set(streams), key=lambda s: (len(s), s)):
        other = nodes(json.loads(stream))
        wrapper = other if wrapper is None else aligned(wrapper, other)
    return json.dumps(plain(wrapper or []), separators=(",", ":"))


# Spark


def host_of(url: str) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1), F.lit("")))


OBSERVED = "host string, stream string, path array<string>, pages long, low long, high long"


def observe(batches):
    """Distinct shortened streams and slots of each batch, per host."""
    for batch in batches:
        streams, slots = {}, {}
        for host, page in zip(batch.column(0), batch.column(1), strict=True):
            host, seq, texts = host.as_py(), [], {}
            for token, path, text in pieces(page.as_py() or ""):
                if token == "#":
                    if not text.strip():
                        continue
                    texts.setdefault(path, []).append(text)
                if token != "#" or not seq or seq[-1] != "#":
                    seq.append(token)
            stream = json.dumps(plain(squashed(seq)), separators=(",", ":"))
            streams[host, stream] = streams.get((host, stream), 0) + 1
            for path, own in texts.items():
                code = xxhash.xxh3_64_intdigest("".join(own)) >> 1
                got = slots.setdefault((host, path), [0, code, code])
                got[0] += 1
                got[1], got[2] = min(got[1], code), max(got[2], code)
        rows = [(h, s, None, n, None, None) for (h, s), n in streams.items()]
        rows += [(h, None, p, *v) for (h, p), v in slots.items()]
        names = [part.split()[0] for part in OBSERVED.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}
        yield pa.RecordBatch.from_arrays([
            pa.array([r[i] for r in rows], kinds[part.split()[1]]) for i, part in enumerate(OBSERVED.split(", "))
        ], names=names)


def fixed_slots(seen: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, fixed): the paths of a host's fixed slots, which are at most twice as many as a page has."""
    found = seen.where("path is not null").groupBy("host", "path").agg(
        F.sum("pages").alias("n"), (F.min("low") == F.max("high")).alias("same")
    )
    found = stored(found.join(hosts, "host").select("host", "path", F.expr("same and 2 * n > pages").alias("fixed")), "slots")
    fixed = found.where("fixed").select("host", "path")
    above = fixed.where("size(path) > 0").select("host", "path", F.explode(F.expr("sequence(0, size(path) - 1)")).alias("depth")).select(
        "host", "path", F.expr("slice(path, 1, depth)").alias("above")
    )
    varying = found.where("not fixed").select("host", F.col("path").alias("above"))
    within = above.join(varying, ["host", "above"], "left_semi").select("host", "path").distinct()
    return fixed.join(within, ["host", "path"], "left_anti").groupBy("host").agg(F.collect_list("path").alias("fixed"))


def infer(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Per host: pages, the wrapper as text, and the plan: its fixed slots."""
    seen = stored(
        pages.select(host_of(url).alias("host"), F.col(page).cast("string").alias("page")).mapInArrow(observe, OBSERVED), "observed"
    )
    streams = seen.where("stream is not null").groupBy("host", "stream").agg(F.sum("pages").alias("pages"))

    def align(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "host": [group["host"].iloc[0]], "stream": [align_all(group["stream"].tolist())], "pages": [int(group["pages"].sum())],
        })

    shape = "host string, stream string, pages long"
    parts = streams.groupBy("host", F.pmod(F.xxhash64("stream"), F.lit(PARTS)).alias("part")).applyInPandas(align, shape)
    wrappers = stored(parts.groupBy("host").applyInPandas(align, shape), "host-wrappers")
    fixed = fixed_slots(seen, wrappers.select("host", "pages"))

    def plan(batches):
        for frame in batches:
            frame["wrapper"] = [written(nodes(json.loads(s))) for s in frame["stream"]]
            frame["plan"] = [json.dumps(sorted(map(list, () if own is None else own))) for own in frame["fixed"]]
            yield frame[["host", "pages", "wrapper", "plan"]]

    return wrappers.join(fixed, "host", "left").mapInPandas(plan, "host string, pages long, wrapper string, plan string")


def extract(pages: DataFrame, wrappers: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row: key, address and main text. ``wrappers`` must be stored, as it is counted first."""
    kind = dict(pages.dtypes)[key]
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("page"), host_of(url).alias("host")
    )
    plans = small_or_not(wrappers.select("host", "plan"))
    both = rows.join(plans, "host", "left").select("key", "url", "page", "plan")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, known = batch.slice(at, 500), {}
                texts = []
                for page, given in zip(part.column(2), part.column(3), strict=True):
                    given = given.as_py() or "[]"
                    if given not in known:
                        known[given] = {tuple(r) for r in json.loads(given)}
                    texts.append(page_text(page.as_py() or "", known[given]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["key", "url", "text"])

    return both.mapInArrow(run, f"key {kind}, url string, text string").withColumnRenamed("key", key)


def digest(pages: DataFrame) -> DataFrame:
    wrappers = stored(infer(pages), "wrappers")
    return extract(pages, wrappers).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
