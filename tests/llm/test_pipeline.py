"""The stages one after another, and each with odd rows."""

import __spark_entry__ as entry
import corpus_pipeline
from kerbside.llm import decontamination, secret_scan
from kerbside.session import fresh_dir
from tests.llm import brute


def test_registered():
    made = entry.queries()
    assert "pipeline" in made and {int(n[2:].split("_")[0]) for n in made if n.startswith("op")} == set(range(1, 14))


def test_each_stage_takes_effect(spark, sf_dir, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_dir(spark, "stage")
        made = stage(spark, docs, check_dir)
        assert made.columns[:len(docs.columns)] == docs.columns
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    rules, near, clean, safe, last = (seen[n] for n, _ in corpus_pipeline.STAGES)
    want, _ = brute.components(rules)
    assert near.keys() == {d for d in rules if want[d] == d}
    items = [r.text for r in spark.read.parquet(f"{check_dir}/benchmark.parquet").collect()]
    held = {d for d, t in near.items() if any(i in t for i in items)}
    assert held and not held & clean.keys() and len(clean) > len(near) - 2 * len(held) - 5
    assert safe.keys() == clean.keys() == last.keys()
    for d, t in safe.items():
        assert not any(kind in ("hex", "access") for *_, kind in secret_scan.base_spans(t))
        assert t == clean[d] or "[SECRET]" in t
    assert docs.where("decodes and n_tokens > 0").count() == docs.count()


def test_odd_rows(spark, check_dir, odd, empty):
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, odd, check_dir)
        assert made.columns[:len(odd.columns)] == odd.columns and made.count() <= odd.count()
        assert stage(spark, empty, check_dir).count() == 0
    kept = corpus_pipeline.near_duplicate_stage(spark, odd, check_dir)
    assert sorted(r.doc_id for r in kept.where("doc_id in (3, 11, 12)").collect()) == [3, 11]
    assert decontamination.find_leaks(odd, spark.read.parquet(f"{check_dir}/benchmark.parquet")).count() == 0


def test_documents_are_told_by_id_and_text(spark, check_dir):
    item = spark.read.parquet(f"{check_dir}/benchmark.parquet").first().text
    words = [f"word{i}" for i in range(60)]
    texts = {
        "one": " ".join(words), "near": " ".join([*words, "end"]), "other": "a text of its own that shares nothing " * 2,
        "leak": f"some words before it {item} and some behind", "clean": "nothing to see here but a few plain words",
    }
    rows = [
        (7, "one"), (7, "other"), (None, "near"), (None, "other"), (8, "near"), (7, "one"), (None, "leak"), (3, "leak"), (3, "clean"),
        (None, "clean2"), (None, "clean2"),
    ]
    texts["clean2"] = "yet another row without any id at all but with words"
    docs = spark.createDataFrame([(d, texts[t], t) for d, t in rows], "doc_id long, text string, key string")
    near = corpus_pipeline.near_duplicate_stage(spark, docs, check_dir)
    # Of each group the smallest id, and one row of the group that has none.
    assert sorted((repr(r.doc_id), r.key) for r in near.collect()) == [
        ("3", "clean"), ("3", "leak"), ("7", "one"), ("7", "other"), ("None", "clean2")]
    clean = corpus_pipeline.decontamination_stage(spark, docs, check_dir)
    assert sorted((repr(r.doc_id), r.key) for r in clean.collect()) == sorted((repr(d), t) for d, t in rows if t != "leak")
