"""Operators that compare documents: Jaccard join, repeated strings, decontamination; against brute force."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import decontamination, graphs, jaccard_join, suffix_dedup
from tests.llm import brute


def by_id(df, *names):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *names).collect()}


def near_copies(seed=3, groups=12):
    """Texts around the limit of similarity: copies with some words changed, shared passages and small sets."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdefgh", k=4))
    passage, texts = [word() for _ in range(40)], []
    for g in range(groups):
        base = [word() for _ in range(chance.choice([6, 9, 30, 80, 110, 400]))]
        for _ in range(chance.randint(1, 6)):
            own = [word() if chance.random() < 0.02 else w for w in base]
            cut = chance.randint(0, max(1, len(own) // 7))
            texts.append(" ".join(own[cut:]).replace("a", chance.choice("aA")))
        texts.append(" ".join([*passage, *(word() for _ in range(chance.choice([0, 3, 10, 60])))]))
    return texts


@pytest.fixture(scope="module")
def copies(spark):
    return spark.createDataFrame(list(enumerate(near_copies())), "doc_id long, text string").repartition(5)


def test_components_equal_brute_force(copies, odd, docs):
    for frame in (copies, odd.where("doc_id is not null"), docs):
        texts = dict(frame.select("doc_id", "text").collect())
        want, sizes = brute.components(texts)
        got = by_id(jaccard_join.digest(frame), "n_shingles", "component_id")
        assert got == {d: (sizes[d], want[d]) for d in texts}


def test_each_allocation_finds_all(copies, monkeypatch):
    texts = dict(copies.select("doc_id", "text").collect())
    want, _ = brute.components(texts)
    rows = [(d, t) for d, t in texts.items()]
    for deletions, load in ((True, 2.0), (True, 3.5), (False, 2.0)):
        rule = lambda band, d=deletions, x=load: jaccard_join.Allocation(max(1, int(jaccard_join.band_starts()[band + 1] / x)), d)
        sets = {d: jaccard_join.shingles(jaccard_join.word_list(t), jaccard_join.Hashes()) for d, t in rows}
        monkeypatch.setattr(jaccard_join, "allocation", rule)
        found, short = {}, set()
        for d, s in sets.items():
            band = int(np.searchsorted(jaccard_join.band_starts(), len(s), "right") - 1)
            below = int(jaccard_join.band_starts()[band] - 1)
            for at, partner in [(band, len(s) * 100 // 75), (band - 1, below)][:1 + (band > 0 and below * 100 >= len(s) * 75)]:
                sig, _, needed = jaccard_join.signatures([s], np.array([at]), np.array([partner]))
                if needed[0] == 0:
                    short.add(d)
                for x in sig.tolist():
                    found.setdefault(x, set()).add(d)
        together = {frozenset((a, b)) for group in found.values() for a in group for b in group}
        for a in sets:
            for b in sets:
                if a < b and jaccard_join.linked(sets[a], sets[b]):
                    assert frozenset((a, b)) in together or a in short or b in short


def test_classes_short_of_units_go_the_long_way(copies, monkeypatch):
    texts = dict(copies.select("doc_id", "text").collect())
    want, _ = brute.components(texts)
    pairs = jaccard_join._short_pairs
    called = []
    nothing = copies.sparkSession.createDataFrame([], "sig long, rep binary, size long, at long, place int")
    monkeypatch.setattr(jaccard_join, "candidates", lambda r, s, c: (nothing, c.select("rep", "size")))
    monkeypatch.setattr(jaccard_join, "_short_pairs", lambda s, c: called.append(1) or pairs(s, c))
    assert called == [] and by_id(jaccard_join.digest(copies), "component_id") == {d: (want[d],) for d in texts} and called


@pytest.mark.parametrize("busy", [1, 16])
def test_busy_signatures_lose_no_link(copies, monkeypatch, busy):
    monkeypatch.setattr(jaccard_join, "BUSY", busy)
    texts = dict(copies.select("doc_id", "text").collect())
    want, sizes = brute.components(texts)
    assert by_id(jaccard_join.digest(copies), "n_shingles", "component_id") == {d: (sizes[d], want[d]) for d in texts}


@pytest.mark.parametrize("share", [0.5, 0.7, 0.8])
def test_a_shared_passage_costs_no_pairs(spark, monkeypatch, share):
    """500 documents that hold one passage and do not link, among them ten near copies."""
    chance = random.Random(int(share * 10))
    word = lambda: "".join(chance.choices("abcdefgh", k=6))
    passage = [word() for _ in range(int(150 * share))]
    texts = [" ".join([*passage, *(word() for _ in range(150 - len(passage)))]) for _ in range(500)]
    texts += [t + " " + word() for t in texts[:10]]
    counted, real = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, t: counted.append(pairs.count()) or real(pairs, t))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = by_id(jaccard_join.digest(frame), "component_id")
    assert got == {d: (d if d < 500 else d - 500,) for d in range(510)}
    assert sum(counted) < 2000


def test_null_and_repeated_ids_hide_no_link(spark):
    words = [f"w{i}" for i in range(100)]
    left, bridge, right = " ".join(words), " ".join(words[12:]), " ".join(words[26:])
    rows = [(5, left), (None, bridge), (9, right), (9, "another text of the same id"), (None, "alone and without an id"), (9, right), (None, None)]
    got = sorted(map(tuple, jaccard_join.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([
        (5, 96, 5), (None, 84, 5), (9, 70, 5), (9, 2, 9), (None, 1, None), (9, 70, 5), (None, 0, None)], key=repr)


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60) if i % 20 != 19] + [(100, 7), (5, 5)], "a long, b long")
    got = dict(graphs.components(edges).collect())
    assert got == {i: i // 20 * 20 for i in range(60)} | {100: 0}


def test_few_documents_make_few_files(spark, copies, monkeypatch):
    texts = dict(copies.select("doc_id", "text").collect())
    want, sizes = brute.components(texts)
    made, fresh = {}, graphs.fresh_dir
    monkeypatch.setattr(graphs, "fresh_dir", lambda spark, purpose: made.setdefault(fresh(spark, purpose), purpose) and list(made)[-1])
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = by_id(jaccard_join.digest(copies), "n_shingles", "component_id")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {d: (sizes[d], want[d]) for d in texts}
    files = [(purpose, len(list(Path(path).glob("part-*")))) for path, purpose in made.items()]
    assert max(n for _, n in files) <= spark.sparkContext.defaultParallelism
    assert {n for purpose, n in files if purpose in ("classes", "involved", "edges", "parents", "components")} == {1}


def test_shingles_of_many_texts_at_once():
    chance = random.Random(2)
    parts = [b"a", b"B", b"b", b" ", b"\t", b"\x0b", b"\x0c", b"\r", b"\n", b"\x1c", b"\xc2\x85", b"\0", b"q" * 7, b"Q" * 8, b"x" * 64, b"x" * 65, b"y" * 200]
    hashes, codes_of, shingle_of = jaccard_join.Hashes(), {}, {}
    for _ in range(400):
        texts = [b"".join(chance.choices(parts, k=chance.randint(0, 60))) for _ in range(chance.randint(1, 8))]
        words = [t.lower().split() for t in texts]
        codes, bounds = jaccard_join.word_codes([t.lower() for t in texts], hashes)
        assert np.diff(bounds).tolist() == list(map(len, words)) and len(codes) == sum(map(len, words))
        for word, code in zip(sum(words, []), codes.tolist(), strict=True):
            assert codes_of.setdefault(word, code) == code
        for held, found in zip(words, jaccard_join.shingle_sets(texts, hashes), strict=True):
            want = {tuple(held[i:i + 5]) for i in range(max(1, len(held) - 4))} if held else set()
            assert len(found) == len(want) and (found[1:] > found[:-1]).all()
            if len(want) == 1:
                assert shingle_of.setdefault(*want, int(found[0])) == int(found[0])
    assert len(set(codes_of.values())) == len(codes_of) and len(set(shingle_of.values())) == len(shingle_of)


def test_sending_signatures_is_cheap():
    hashes = jaccard_join.Hashes()
    assert len(jaccard_join.shingles(jaccard_join.word_list("some words of a common length " + "x" * 100), hashes)) == 3
    assert list(hashes) == [b"x" * 100]  # other words are not looked up one by one
    texts = pa.RecordBatch.from_pydict({"key": list(range(2000)), "text": [" ".join(f"w{i * j}" for j in range(200)) for i in range(2000)]})
    sent = list(jaccard_join.sender(pa.int64())([texts]))
    assert sum(b.nbytes for b in sent) < 40 * sum(b.num_rows for b in sent)


def test_files_by_rows(spark):
    assert [graphs.narrow_files(n) for n in (0, 1, 20_000, 20_001)] == [1, 1, 1, 2]
    assert [graphs.wide_files(spark, n) for n in (0, 32_000, 32_001)] == [8, 8, 9]
    edges = spark.createDataFrame([(i, i + 1) for i in range(60) if i % 20 != 19] + [(100, 7), (5, 5)], "a long, b long")
    assert dict(graphs.components(edges, 1).collect()) == {i: i // 20 * 20 for i in range(60)} | {100: 0}


def test_tables_over_blocks_only_for_many_items():
    chance = np.random.default_rng(4)
    prints = chance.integers(0, 1 << 63, 900, dtype=np.uint64)
    few, many = decontamination.BlockIndex(prints[:500]), decontamination.BlockIndex(prints)
    assert not few.tables and len(many.tables) == decontamination.BLOCKS
    asked = prints[:40] ^ (np.uint64(1) << chance.integers(0, 64, 40, dtype=np.uint64))
    for index, n in ((few, 500), (many, 900)):
        near = np.bitwise_count(asked[:, None] ^ prints[None, :n]) <= decontamination.RADIUS
        assert set(zip(*map(np.ndarray.tolist, index.near(asked)), strict=True)) <= set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))
        assert {(i, i) for i in range(40)} <= set(zip(*map(np.ndarray.tolist, index.near(asked)), strict=True))


@pytest.mark.parametrize("split", [512, 2])
@pytest.mark.parametrize("keep_first", [False, True])
def test_repeats_equal_brute_force(spark, odd, monkeypatch, split, keep_first):
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    chance = random.Random(split)
    piece = lambda n: "".join(chance.choices("abcdé ", k=n))
    shared = [piece(450), piece(700), "z" * 900, "ab" * 450]
    texts = [piece(chance.randint(0, 300)) + chance.choice(shared) + piece(chance.randint(0, 300)) + chance.choice([*shared, ""]) for _ in range(30)]
    rows = list(enumerate(texts)) + [(90, None), (91, ""), (92, texts[0]), (93, "z" * 399)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute.removed_ranges(dict(rows), suffix_dedup.LENGTH, keep_first)
    got = suffix_dedup.remove_repeats(frame, keep_first=keep_first).collect()
    for r in got:
        raw = (dict(rows)[r.doc_id] or "").encode()
        assert [tuple(s) for s in r.spans] == want[r.doc_id]
        assert r.n_bytes == len(raw) and r.n_removed == sum(b - a for a, b in want[r.doc_id])
        kept, done = b"", 0
        for a, b in want[r.doc_id]:
            kept, done = kept + raw[done:a], b
        assert bytes(r.kept) == kept + raw[done:]
    assert len(got) == len(rows)
    assert suffix_dedup.digest(odd).count() == odd.count()


@pytest.mark.parametrize("split", [512, 1])
def test_repeats_of_rows_without_id(spark, monkeypatch, split):
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    chance = random.Random(6)
    piece = lambda n: "".join(chance.choices("abcdef ", k=n))
    shared = piece(600)
    texts = [shared + piece(900), piece(500) + shared + piece(400), piece(1600), piece(300) + shared, piece(1500)]
    want = brute.removed_ranges(dict(enumerate(texts)), suffix_dedup.LENGTH, False)
    for same in (None, 7):
        frame = spark.createDataFrame([(same, t) for t in texts], "doc_id long, text string").repartition(3)
        got = suffix_dedup.remove_repeats(frame, keep_first=False).collect()
        assert all(r.doc_id == same for r in got)
        assert sorted([tuple(s) for s in r.spans] for r in got) == sorted(want.values())


def test_factors_equal_their_definition():
    chance = np.random.default_rng(2)
    for _ in range(50):
        position = chance.permutation(30)
        common = chance.integers(0, 9, 30)
        common[0] = 0
        got = suffix_dedup.nearest_smaller(position, common)
        for i in range(30):
            before = [j for j in range(i) if position[j] < position[i]]
            assert got[i] == (common[before[-1] + 1:i + 1].min() if before else 0)


def test_leaks(spark, odd):
    chance = random.Random(4)
    word = lambda: "".join(chance.choices("abcdefgh", k=5))
    items = [(i, " ".join(word() for _ in range(chance.choice([3, 8, 20, 40])))) for i in range(40)] + [(98, None), (99, "")]
    filler = lambda n: [word() for _ in range(n)]
    docs, want = [], set()
    for d in range(80):
        item, text = items[d % 40]
        own = text.split()
        if d >= 40 and len(own) >= 20:
            own[len(own) // 2] = "changed"
        elif d >= 40:
            own = []
        docs.append((d, " ".join([*filler(30), *[w.upper() for w in own], *filler(d)])))
        a, b = decontamination.shingle_counts(text.split()), decontamination.shingle_counts([w.lower() for w in own])
        if own and decontamination.similarity(a, b) >= 0.75:
            want.add((d, item))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and len(want) > 45
    assert decontamination.find_leaks(odd, benchmark).count() == 0
    assert decontamination.find_leaks(odd, benchmark.where("false")).count() == 0


def test_leaks_in_documents_shorter_than_the_item(spark):
    chance = random.Random(5)
    words = ["".join(chance.choices("abcdefgh", k=5)) for _ in range(100)]
    docs = [(n, " ".join(words[:n])) for n in (4, 60, 75, 77, 90, 99, 100)] + [(101, " ".join(["other", *words[9:]]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, "a b c d e f")], "item_id long, text string")
    found = {r.doc_id: (r.item_id, r.start_word, r.n_words, round(r.similarity, 3)) for r in decontamination.find_leaks(frame, benchmark).collect()}
    want = {n: (1, 0, n, round((n - 4) / 96, 3)) for n in (77, 90, 99, 100)} | {101: (1, 0, 92, round(87 / 97, 3))}
    assert found == want


def test_block_index_finds_all_within_radius():
    chance = np.random.default_rng(1)
    base = chance.integers(0, 2**63, 20).astype(np.uint64)
    flip = np.array([sum(1 << int(b) for b in chance.choice(64, chance.integers(0, 30), replace=False)) for _ in range(2000)], np.uint64)
    queries = base[chance.integers(0, 20, 2000)] ^ flip
    want = {(q, i) for q in range(2000) for i in range(20) if np.bitwise_count(queries[q] ^ base[i]) <= decontamination.RADIUS}
    index = decontamination.BlockIndex(base)
    assert set(zip(*(x.tolist() for x in index.near(queries)), strict=True)) == want
    many = decontamination.BlockIndex(np.concatenate((base, chance.integers(0, 2**63, 1500).astype(np.uint64))))
    found = {(q, i) for q, i in zip(*(x.tolist() for x in many.near(queries[:60])), strict=True) if i < 20}
    assert found == {(q, i) for q, i in want if q < 60}
