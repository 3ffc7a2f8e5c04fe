"""WARC archives and main texts."""

import hashlib

from kerbside.llm import html_wrappers, warc
from kerbside.llm.queries import ORACLES, QUERIES
from kerbside.session import fresh_dir
from tests.compare import connect, differences


def test_warc_query_equals_sql(spark, check_dir):
    con = connect(check_dir)
    assert differences(QUERIES["op6_warc"](spark, check_dir), con, ORACLES["op6_warc"]) == []


def test_warc_round_trip(spark):
    rows = [(1, "http://a/ b\n", "x" * 1000), (2, None, "x" * 1000), (2, "u", "x" * 1000), (3, "u", None), (4, "u", ""), (5, "u", "é" * 3), (6, "u", "é" * 3)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    path = fresh_dir(spark, "warc-test")
    warc.write_archives(warc.with_revisits(pages), path)
    records, gaps = warc.read_archives(spark, path)
    assert gaps.count() == 0
    got = {(r.record_id, r.record_type, bytes(r.block), r.refers_to, r.payload_bytes) for r in records.collect()}
    x = b"x" * 1000
    assert ("<urn:page:1>", "revisit", b"", "<urn:page:2>", 1000) in got and ("<urn:page:2>", "response", x, None, 1000) in got
    assert ("<urn:page:5>", "response", "é".encode() * 3, None, 6) in got and records.count() == len(rows)
    assert warc.digest(spark, pages.where("false"), fresh_dir(spark, "warc-test")).count() == 0


def archive(n, packed):
    made = [warc.record_bytes(i, "u", f"payload {i} ".encode() * 50, hashlib.sha1(b"").hexdigest(), None) for i in range(n)]
    return [warc.member(r) if packed else r for r in made]


def ids(items):
    return [int(i.headers["warc-record-id"][10:-1]) for i in items if isinstance(i, warc.Record)]


def test_salvage_goes_on_after_damage():
    for packed in (True, False):
        parts = archive(9, packed)
        damaged = list(parts)
        middle = len(damaged[2]) // 2
        damaged[2] = damaged[2][:middle] + b"\x00\xff" + damaged[2][middle + 2:]
        damaged[5] = damaged[5][:-30]
        damaged[7] = b"no record at all" + damaged[7]
        data = b"".join(damaged)
        items = list(warc.salvage(data))
        assert [i for i in ids(items)] == [0, 1, 3, 4, 6, 7, 8]
        gaps = [i for i in items if isinstance(i, warc.Gap)]
        start = sum(map(len, damaged[:2]))
        assert gaps[0].start == start and gaps[0].stop == start + len(damaged[2])
        edges = sorted({(i.start, i.stop) for i in items})
        assert edges[0][0] == 0 and edges[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
    assert ids(warc.salvage(b"".join(archive(3, True)) + b"".join(archive(2, False)))) == [0, 1, 2, 0, 1]
    assert list(warc.salvage(b"")) == [] and len(list(warc.salvage(b"junk"))) == 1


TEMPLATE = (
    '<html><head><title>t</title></head><body><div id="menu-7">Menu</div><div class="story">{body}</div>'
    '<div class="comments"><p>first!</p></div><form>mail</form><div class="ad">buy</div><footer>f</footer></body></html>'
)


def test_main_text(spark):
    para = lambda *ps: "".join(f"<p>{p}</p>" for p in ps)
    rows = [(i, "http://h.example/x", TEMPLATE.format(body=para(*(f"text {i} {j} with <i>in</i>line &amp; more" for j in range(i + 1))))) for i in range(5)]
    rows += [
        (10, "http://a.example", "<body><nav>n</nav><article><header>Head</header><p>One<br>two<p>th<b>re</b>e &lt;4&gt;</article><aside>no</aside>"),
        (11, None, None), (12, "odd", ""), (13, "x://y", "plain <script>if (a</p>) b"), (14, "http://a.example", "<article>un<!-- closed"),
        (15, "http://a.example", '<article title="a>b">kept<div class="share">no</div></article>'),
    ]
    rows.append(rows[0])
    pages = spark.createDataFrame([(*r, "t", "p") for r in rows], "page_id long, url string, html string, text string, plan string").repartition(3)
    got = {r.page_id: r.text for r in html_wrappers.digest(pages).collect()}
    for i in range(5):
        assert got[i] == " ".join(f"text {i} {j} with inline & more" for j in range(i + 1))
    assert got[10] == "Head One two three <4>" and got[14] == "un" and got[15] == "kept"
    assert got[11] == got[12] == "" and got[13] == "plain"
    assert html_wrappers.digest(pages.where("false")).count() == 0


def test_wrapper_takes_repeats_and_options():
    tokens = lambda s: html_wrappers.squashed(s.split())
    a, b = tokens("ul li # /li li # /li /ul p # /p"), tokens("ul li # /li /ul h1 # /h1 p # /p p # /p")
    assert html_wrappers.written(html_wrappers.aligned(a, b)) == "ul ( li # /li )+ /ul ( h1 # /h1 )? ( p # /p )+"


def test_articles_of_the_table(spark, check_dir):
    import html
    import re

    pages = spark.read.parquet(f"{check_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = html_wrappers.digest(pages).collect()
    assert len(got) == len(source)
    for r in got:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", source[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", inner)).split()) and r.n_chars == len(r.text)


def texts_of(spark, *pages):
    rows = [(i, "http://h.example/x", page) for i, page in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    return [r.text for r in html_wrappers.digest(frame).orderBy("page_id").collect()]


def test_main_text_over_several_containers(spark):
    fixed = '<div class="tagline">always this</div><div class="related">skip</div>'
    story = lambda i: f"<div class=story><p>intro {i}</p><blockquote>{f'long {i} ' * 50}</blockquote><p>more {i}</p></div>"
    got = texts_of(spark, *(fixed + story(i) for i in range(3)), fixed + "<div class=story><p>only</p></div>")
    assert got == [f"intro {i} {f'long {i} ' * 50}more {i}" for i in range(3)] + ["only"]
    parts = lambda i: f"<section class=intro>one {i}<table><td>same</table></section><section class=body>{f'two {i} ' * 20}</section>"
    got = texts_of(spark, *(fixed + parts(i) for i in range(3)), fixed + parts(3) + "<section class=end>once</section>")
    want = [f"one {i} same {f'two {i} ' * 20}".strip() for i in range(4)]
    assert got == [*want[:3], want[3] + " once"]


def test_articles_of_differing_classes(spark):
    one = lambda kind, i: f"<div class=date>day {i}</div><article class={kind}><p>{kind} {i}</p></article>"
    kinds = ("news", "sport", "news", "sport", "weather")
    got = texts_of(spark, *(one(kind, i) for i, kind in enumerate(kinds)))
    assert got == [f"{kind} {i}" for i, kind in enumerate(kinds)]
