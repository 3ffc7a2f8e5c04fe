"""The filter audit against a plain version, over batches in every order and with replays."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from kerbside.llm import filter_audit as op
from kerbside.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences


def plain(docs, labels):
    """Rows by the definition, out of (doc_id, text, lang) and (doc_id, quality, toxic)."""
    good, toxic = ({d for d, *marks in labels if marks[i] == 1 and d is not None} for i in (0, 1))
    failing = []
    for d, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {x for x, failed in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            any(e is not None and d is not None and e < d and (t or "") == text for e, t, _ in docs)), strict=True) if failed}
        failing.append((lang or "", fails, d in good, d in toxic))
    out, shapley = {}, Counter()
    for part in {f[0] for f in failing}:
        own = [f[1:] for f in failing if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                before = set(order[:step - 1])
                here = [f for f in own if x in f[0] and not before & f[0]]
                shapley[part, x] += len(here)
                out[part, order, step] = (
                    sum(not (before | {x}) & f[0] for f in own), len(here), sum(x in f[0] and bool(before & f[0]) for f in own),
                    sum(f[0] == {x} for f in own), sum(f[1] for f in here), sum(f[2] for f in here))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def told(df):
    rows = df.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()
    found = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def made(n, seed):
    chance = random.Random(seed)
    texts = [None, "", "a", "A B C", "x # y", "word " * 250, " ".join(f"w{i}" for i in range(220)), " ".join(f"w{i}" for i in range(220)) + " $"]
    docs = [(i, chance.choice(texts), chance.choice(["en", "de", None])) for i in range(n)]
    docs += [(3, docs[3][1], "fr"), docs[5], (None, "a", "en"), (None, None, None)]
    labels = [(chance.choice([*range(n), None]), chance.choice([0, 1, None]), chance.choice([0, 1, None])) for _ in range(n)]
    return docs, labels


DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def test_query_equals_sql(spark, check_dir):
    name = "op11_filter_audit"
    assert differences(QUERIES[name](spark, check_dir), connect(check_dir), ORACLES[name]) == []


@pytest.mark.parametrize("order", ["rising", "falling", "mixed"])
def test_batches_in_any_order_with_replays(spark, tmp_path, order):
    docs, labels = made(60, 4)
    dealt = {"rising": docs, "falling": docs[::-1], "mixed": random.Random(1).sample(docs, len(docs))}[order]
    audit = op.Audit(str(tmp_path), op.label_table(spark.createDataFrame(labels, LABELS)))
    for batch in range(6):
        part = dealt[batch * 11:batch * 11 + 11] if batch < 5 else dealt[55:]
        for _ in range(2 if batch in (2, 5) else 1):
            audit.add(spark.createDataFrame(part, DOCS), batch)
        if batch in (1, 5):
            assert told(op.interactions(audit.masks(spark))) == plain(dealt[:batch * 11 + 11] if batch < 5 else dealt, labels)
    assert len(audit.counters.manifest(spark).parts) == 3


def test_a_batch_that_fails_between_its_tables_is_repaired(spark, tmp_path, monkeypatch):
    docs, labels = made(40, 7)
    audit = op.Audit(str(tmp_path), op.label_table(spark.createDataFrame(labels, LABELS)))
    audit.add(spark.createDataFrame(docs[20:], DOCS), 0)
    real = op.Levels.add

    def broken(self, rows, batch_id):
        if self.path.endswith("state"):
            raise RuntimeError("lost")
        return real(self, rows, batch_id)

    with monkeypatch.context() as m:
        m.setattr(op.Levels, "add", broken)
        with pytest.raises(RuntimeError):
            audit.add(spark.createDataFrame(docs[:20], DOCS), 1)
    audit.add(spark.createDataFrame(docs[:20], DOCS), 1)
    assert told(op.interactions(audit.masks(spark))) == plain(docs, labels)


def test_a_text_held_by_many_rows_reaches_the_state_as_one_row_a_task(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("id", "'' AS part", "0 AS mask", "X'00' AS digest", "true AS good", "false AS toxic").repartition(4)
    thin = op.thinned(rows).collect()
    assert sum(r.n for r in thin) == 5000 and sum(r.digest is not None for r in thin) <= 4
    assert {r.mask for r in thin if r.digest is None} == {op.COPY}
    # A task that holds few texts at once hands them on early, and nothing is lost.
    monkeypatch.setattr(op, "HELD_TEXTS", 2)
    many = rows.withColumn("digest", rows.id.cast("string").cast("binary"))
    assert sum(r.n for r in op.thinned(many).collect()) == 5000


def test_odd_rows_and_empty_tables(spark, odd, empty, tmp_path):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (None, 1, 1)], LABELS)
    audit = op.Audit(str(tmp_path / "odd"), op.label_table(labels))
    audit.add(odd, 0)
    docs = [tuple(r) for r in odd.select("doc_id", "text", "lang").collect()]
    assert told(op.interactions(audit.masks(spark))) == plain(docs, [tuple(r) for r in labels.collect()])
    none = op.Audit(str(tmp_path / "none"), op.label_table(labels))
    assert op.interactions(none.masks(spark)).count() == 0
    none.add(empty, 0)
    assert op.interactions(none.masks(spark)).count() == 0
    empty.select("doc_id", "text", "lang").write.parquet(str(tmp_path / "empty.parquet"))
    assert op.digest(spark, str(tmp_path / "empty.parquet"), labels.limit(0)).count() == 0


def test_masks():
    words = [f"w{i}" for i in range(200)]
    assert op.mask_of(" ".join(words)) == 0 and op.mask_of(" ".join(words[1:])) == 1
    assert op.mask_of(" ".join(words[:100] * 2)) == 0 and op.mask_of(" ".join(words[:99] * 2 + words[:2])) == 2
    assert op.mask_of("") == 1 and op.mask_of("A" * 3 + "ä" * 97) == 1 and op.mask_of("A" * 4 + "ä" * 96) == 5
    assert [op.mask_of(c) for c in "#$%&*|"] == [9] * 6 and op.mask_of("@!^<>") == 1
