"""Empty, constant and contradictory input."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import coltypes, evaluate, ordered, prep, profile, quality, split, table
from tabwright.operators.prep import PrepConfig, Preparation
from tabwright.sources.csv import CsvError, read_csv, read_scoring_csv
from tabwright.sources.shared import fresh_path


def test_empty_table_has_zero_percent(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert {(r["missing_count"], r["missing_percent"]) for r in profile.missing_values(df).collect()} == {(0, 0.0)}
    assert profile.outliers(df).first()["outlier_count"] == 0
    assert not coltypes.validate_target(df, "b").first()["ok"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "a double")
    assert profile.missing_values(df).first()["missing_count"] == 2
    assert profile.numeric_stats(df).first()["n"] == 1


def test_no_numeric_columns_give_empty_tables(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    p = profile.profile(df)
    assert p["outliers"].count() == 0 and p["correlations"].count() == 0 and len(p["warnings"]) == 1


def test_missing_names_are_reported(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError):
        table.features_of(df, "zzz")
    with pytest.raises(KeyError, match="c, d"):
        table.features_of(df, "a", ["b", "c", "d"])


def test_nested_columns_are_refused(spark):
    with pytest.raises(TypeError):
        table.tabular(spark.createDataFrame([([1],)], "a array<int>"))


def test_preview_of_nothing(spark):
    assert table.preview(spark.range(5), ["id"], -1).count() == 0


def test_all_null_target_is_not_imbalanced(spark):
    df = spark.createDataFrame([(None,), (None,)], "t string")
    row = quality.imbalance(df, "t").first()
    assert not row["is_imbalanced"] and row["missing_target_count"] == 2 and row["reason"]


def test_column_without_values_leaves_no_feature(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "n int, empty double, c string")
    p = Preparation.fit(df, PrepConfig(target="t"), ["n", "empty"], ["c"])
    assert [r["name"] for r in p.feature_names(spark).orderBy("position").collect()] == ["n", "c_a"]


def test_bad_options_are_refused():
    with pytest.raises(ValueError):
        PrepConfig(target="t", scaler="robust")


def write(spark, data: bytes) -> str:
    import os

    folder = fresh_path(spark, "csv")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "wb") as f:
        f.write(data)
    return folder


def test_csv_types_nulls_and_lengths(spark):
    t = read_csv(spark, write(spark, b'\xef\xbb\xbfa,b,c,d,e\n1,2.5,x,True,NA\n3\n4,5,"y, ""q""\nz",False,\n5,6,7,True,9,10\n'))
    assert dict(t.rows.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "boolean", "e": "string"}
    rows = [tuple(r) for r in t.rows.orderBy("a").collect()]
    assert rows == [(1, 2.5, "x", True, None), (3, None, None, None, None), (4, 5.0, 'y, "q"\nz', False, None)]
    assert any("1 rows have more cells" in w for w in t.warnings)


def test_csv_latin1(spark):
    t = read_csv(spark, write(spark, "a,b\n1,caf\xe9\n".encode("latin-1")))
    assert t.rows.first()["b"] == "café" and any("latin-1" in w for w in t.warnings)


def test_csv_replacement_character_is_not_a_broken_byte(spark):
    t = read_csv(spark, write(spark, "a\nx�y é\n".encode()))
    assert t.rows.first()["a"] == "x�y é" and not t.warnings


@pytest.mark.parametrize("data", [b"", b"a,b\n"])
def test_csv_without_rows(spark, data):
    with pytest.raises(CsvError):
        read_csv(spark, write(spark, data))


def test_repeated_header_names(spark):
    assert read_csv(spark, write(spark, b"a,a,\n1,2,3\n")).rows.columns == ["a", "a.1", "Unnamed: 2"]


def test_declared_type_beats_inference(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(100)], "a int, b int")
    assert coltypes.resolve_profile_types(df, {"b": "numeric"}, None) == {"b": "numeric", "a": "numeric"}
    assert coltypes.resolve_types(df, {"b": "categorical"}) == {"b": "categorical", "a": "numeric"}


def test_type_mismatch_on_sample_is_reproducible(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, "x").otherwise("1").alias("c"))
    a = quality.type_mismatch(df, {"c": "numeric"}, ids=["id"], sample_size=100).collect()
    assert a == quality.type_mismatch(df.repartition(5), {"c": "numeric"}, ids=["id"], sample_size=100).collect()


def test_infinite_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(99)] + [(float("inf"),)], "a double")
    assert profile.outliers(df, "zscore").first()["outlier_count"] == 0
    many = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("inf"),)] * 30, "a double")
    assert ordered.exact_quantiles(many, {"a": [0.0, 0.1, 0.75, 1.0]})["a"] == pytest.approx([0.0, 3.9, float("inf"), float("inf")])


def test_comparison_without_any_success(spark):
    rows = evaluate.rank_models(evaluate.compare_models({"a": "broke", "b": "broke too"}), "accuracy").collect()
    assert [(r["model"], r["error"], r["accuracy"]) for r in rows] == [("a", "broke", None), ("b", "broke too", None)]


def test_unused_array_column_is_no_obstacle(spark):
    df = spark.createDataFrame([(i, float(i), [i], "xy"[i % 2]) for i in range(40)], "id int, n double, arr array<int>, t string")
    ready = prep.preprocess(df, PrepConfig(target="t", feature_columns=["n"]), ["id"])
    assert ready.train.count() + ready.test.count() == 40


def test_repeated_keys_are_told_apart(spark):
    df = spark.range(1000).selectExpr("id % 10 as key", "id % 7 as v", "id % 2 as t")
    train, test, _ = split.train_test_split(df, ["key"], "t", 0.25)
    assert (train.count(), test.count()) == (750, 250) and train.columns == df.columns
    folds = split.stratified_folds(df, ["key"], "t", 5).groupBy("fold").count().collect()
    assert [r["count"] for r in folds] == [200] * 5


def test_fingerprint_sees_white_space_and_cell_borders(spark):
    prints = [tuple(table.fingerprint(spark.createDataFrame([row], "a string, b string")).first())
              for row in [(" a ", "b"), ("a", "b"), ("a", None), ("a", "-"), ("a,1:b", ""), ("a", "1:b,")]]
    assert len(set(prints)) == len(prints)


def test_files_of_one_folder_share_their_header(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("1,2",)], "`id,v` string").coalesce(1).write.options(header=True, sep="\x01", quote="").csv(path)
    spark.createDataFrame([("3,4",)], "`v,id` string").coalesce(1).write.mode("append").options(header=True, sep="\x01", quote="").csv(path)
    with pytest.raises(CsvError, match="header line"):
        read_csv(spark, path)


def test_scoring_refuses_other_encodings_and_stray_quotes_split(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("1,é",)], "`id,v` string").write.options(header=True, sep="\x01", quote="", encoding="ISO-8859-1").csv(path)
    with pytest.raises(CsvError, match="UTF-8"):
        read_scoring_csv(spark, path, {"id": "bigint"})
    from tabwright.sources.csv import text_facts

    path = fresh_path(spark, "csv")
    spark.createDataFrame([('1,a 5" pipe',), ("2,b",)], "`id,v` string").coalesce(1).write.options(header=True, sep="\x01", quote="").csv(path)
    assert text_facts(spark, path) == (False, True)
    assert read_csv(spark, path).rows.count() == 2


def test_overview_lists_all_issues(spark):
    from tabwright.operators import report
    from tabwright.operators.prep import PrepConfig

    issues = spark.createDataFrame([("gaps", f"c{i:02}", "share", i / 100) for i in range(40)], "issue string, subject string, detail string, value double")
    got = report.overview_sections(spark.createDataFrame([(1, 2)], "a int, b int"), issues, PrepConfig(target="b"), None).where("name = 'issues'").collect()
    assert sorted(r.item for r in got) == [f"c{i:02}" for i in range(40)]
