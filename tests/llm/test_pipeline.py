import importlib

import corpus_pipeline as P
import sentencepiece

import __spark_entry__ as entry
from tabwright.llm import sentencepiece_codec
from tests.llm import test_decontamination, test_hyperminhash, test_line_dedup
from tests.llm.fixtures import awkward, frame, sample, words


def documents(spark):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    leaks = [(60_000 + i, f"Some words first. {b.text} And some after it, different in each {i}.", "en") for i, b in enumerate(bench[:6])]
    near = [(61_000 + k, " ".join(f"only{k}" if i == 7 * k else f"own{i}" for i in range(90)), "en") for k in range(6)]
    docs = frame(spark, sample(spark) + awkward() + leaks + near + test_line_dedup.planted())
    return docs.withColumn("score", docs.n_chars).withColumn("lang_pred", docs.lang)


def test_each_stage_against_plain_python(spark, tmp_path):
    docs = documents(spark)
    columns, sf = docs.columns, "/root/testdata/sf0.001"
    rows = lambda df: [(r.doc_id, r.text, r.lang) for r in df.collect()]
    stages = dict(P.STAGES)
    assert list(stages) == ["language", "lines", "near_duplicates", "decontaminate", "tokenize"]

    def written(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    one = written(stages["language"](spark, docs, sf), "one")
    before, after = rows(docs), rows(one)
    assert one.columns == columns and {d for d, t, _ in before if any(c.isalpha() for c in t or "")} == {d for d, _, _ in after}

    two = written(stages["lines"](spark, one, sf), "two")
    want = {d: t for d, (_, _, t) in test_line_dedup.brute(after).items() if words(t)}
    assert two.columns == columns and {d: t for d, t, _ in rows(two)} == want
    assert all(r.n_chars == len(r.text) for r in two.collect())

    three = written(stages["near_duplicates"](spark, two, sf), "three")
    kept = {d for d, v in test_hyperminhash.brute(rows(two), 5).items() if v[2]}
    assert three.columns == columns and {d for d, _, _ in rows(three)} == kept and 61_001 not in kept and 61_000 in kept

    four = written(stages["decontaminate"](spark, three, sf), "four")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    dirty = {d for d, _ in test_decontamination.brute(rows(three), items)}
    assert four.columns == columns and {d for d, _, _ in rows(four)} == kept - dirty and 60_000 in dirty

    five = stages["tokenize"](spark, four, sf)
    there = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    assert five.columns == [*columns, "token_ids"]
    assert all(list(r.token_ids) == there.encode(r.text) for r in five.collect())


def test_empty_table_and_repeated_ids(spark):
    docs = documents(spark).limit(20)
    twice = docs.union(docs.limit(3))
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
    for name in ("lines", "near_duplicates"):
        assert dict(P.STAGES)[name](spark, twice, "").count() <= docs.count()


def test_columns_of_any_name_and_without_n_chars(spark):
    docs = documents(spark).limit(15).drop("n_chars")
    clash = docs.withColumns({"_of": docs.doc_id, "_KEPT": docs.text, "token_ids": docs.doc_id, "least_": docs.lang})
    for name, stage in P.STAGES:
        plain, odd = stage(spark, docs, "/root/testdata/sf0.001"), stage(spark, clash, "/root/testdata/sf0.001")
        assert sorted(map(repr, odd.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
        assert name == "tokenize" or odd.columns == clash.columns


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
    assert importlib.import_module("tabwright.llm")
