"""Reading under a contract, normalising, writing results."""

import pytest
from pyspark.sql import functions as F

from outcome_lens.contract import CENSUS, AnalysisError, Field, Outcome, SourceContract
from outcome_lens.operators.compare import compare_frames, compare_multisets, comparison_summary
from outcome_lens.sources import (
    normalise,
    parsing,
    published_runs,
    read_contract,
    read_quarantined,
    read_raw,
    read_results,
    write_results,
)

SMALL = SourceContract(
    fields=(Field("k", "int"), Field("x", "float"), Field("label", "string")), outcome=Outcome("label", "yes")
)


def test_contract_scan_trims_nulls_and_strips_the_label(spark, census_file):
    df = read_contract(spark, census_file, CENSUS)
    rows = df.orderBy("age").collect()
    assert df.columns == CENSUS.names
    assert [r["age"] for r in rows] == [23, 35, 47, 64]
    assert [r["income"] for r in rows] == ["<=50K", "<=50K", ">50K", ">50K"]
    assert [c for c in df.columns if rows[0][c] is None] == ["workclass", "occupation", "native-country"]
    assert (rows[3]["education"], rows[3]["capital-loss"], rows[2]["native-country"]) == ("Prof-school", 1721, "Italy")


def test_both_readers_give_identical_tables(spark, census_file):
    typed = read_contract(spark, census_file, CENSUS)
    strings = normalise(read_raw(spark, census_file, CENSUS), CENSUS)
    assert compare_multisets(typed, strings).count() == 0
    row = comparison_summary(typed, strings, ["fnlwgt"]).first()
    assert row["identical"] and row["type_mismatch"] == row["null_mismatch"] == row["value_mismatch"] == 0


def test_raw_read_without_normalising_differs(spark, census_file):
    typed, raw = read_contract(spark, census_file, CENSUS), read_raw(spark, census_file, CENSUS)
    diff = {r["column"]: r for r in compare_frames(typed, raw.withColumn("fnlwgt", F.trim("fnlwgt").cast("long")), ["fnlwgt"]).collect()}
    assert diff["age"]["type_mismatch"]
    assert diff["workclass"]["value_mismatch"] > 0
    assert diff["occupation"]["null_mismatch"] == 1


def test_missing_file_is_a_domain_error(spark, tmp_path):
    with pytest.raises(AnalysisError, match="no data file"):
        read_contract(spark, str(tmp_path / "absent.csv"), CENSUS)


def test_malformed_file_is_a_domain_error(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("1, 2.5, yes\nnot a number, 1.0, no\n")
    with pytest.raises(AnalysisError, match="cannot parse"), parsing(str(path)):
        read_contract(spark, str(path), SMALL).collect()


def test_comment_mark_inside_a_line_is_data(spark, tmp_path):
    path = tmp_path / "mark.csv"
    path.write_text("|whole line\n1, 2.5, a|b.\n")
    assert [tuple(r) for r in read_contract(spark, str(path), SMALL).collect()] == [(1, 2.5, "a|b")]


def test_quarantine_keeps_every_row_on_one_side(spark):
    raw = spark.createDataFrame(
        [(" 1", "2.5 ", "yes."), ("x", "1", "no."), ("2", "?", ""), (None, None, None), ("3", "y", "?")],
        SMALL.raw_schema(),
    )
    typed, rejected = normalise(raw, SMALL, on_error="quarantine")
    assert sorted(tuple(r) for r in typed.collect()) == [(1, 2.5, "yes"), (2, None, None)]
    assert {r["k"]: r["failed_columns"] for r in rejected.collect()} == {"x": ["k"], "3": ["x"]}


def test_strict_normalise_fails_on_a_bad_cell(spark):
    raw = spark.createDataFrame([("x", "1", "no.")], SMALL.raw_schema())
    with pytest.raises(AnalysisError), parsing("memory"):
        normalise(raw, SMALL).collect()


def test_unknown_options_are_refused(spark):
    with pytest.raises(AnalysisError):
        normalise(spark.createDataFrame([("1", "1", "no")], SMALL.raw_schema()), SMALL, on_error="ignore")
    with pytest.raises(AnalysisError):
        write_results({}, "/nowhere", "r", file_format="xml")


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_results_are_kept_per_run(spark, tmp_path, file_format):
    path = str(tmp_path / "results")
    one, two = spark.range(3), spark.range(5)
    write_results({"t": one}, path, "a", file_format)
    write_results({"t": two}, path, "b", file_format)
    write_results({"t": one}, path, "b", file_format)
    assert read_results(spark, path, "t", "a", file_format).count() == 3
    assert read_results(spark, path, "t", file_format=file_format).count() == 6
    with pytest.raises(AnalysisError):
        read_results(spark, path, "absent")


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text("|comment\n1, 2.5, yes.\n2, 3.5\n\n3, x, no.\n4, 1.0, no., more\n, ,\n5, ?, ?\n")
    typed, rejected = read_quarantined(spark, str(path), SMALL)
    # a line of blanks has cells, if empty ones; an empty line is no row
    assert {tuple(r) for r in typed.collect()} == {(1, 2.5, "yes"), (5, None, None), (None, None, None)}
    found = {(r.reason, r.line, tuple(r.failed_columns)) for r in rejected.collect()}
    assert ("cells", None, (SMALL.names[1],)) in found
    assert {line for reason, line, _ in found if reason == "line"} == {"2, 3.5", "4, 1.0, no., more"}
    assert all(r.file.endswith("broken.csv") and r.block == 0 for r in rejected.collect())


def test_a_killed_write_leaves_the_run_before(spark, tmp_path):
    path = str(tmp_path / "results")
    write_results({"t": spark.range(3), "u": spark.range(2)}, path, "a")
    broken = spark.range(5).select(F.raise_error(F.lit("killed")).cast("long").alias("id"))
    with pytest.raises(AnalysisError, match="cannot write result u"):
        write_results({"t": spark.range(9), "u": broken}, path, "a")
    assert read_results(spark, path, "t", "a").count() == 3 and read_results(spark, path, "u", "a").count() == 2
    assert sorted((r.run_id, r.name) for r in published_runs(spark, path).collect()) == [("a", "t"), ("a", "u")]
    write_results({"t": spark.range(4)}, path, "a")
    assert read_results(spark, path, "t", "a").count() == 4 and read_results(spark, path, "u").columns == ["id", "run_id"]
    with pytest.raises(AnalysisError, match="of run b"):
        read_results(spark, path, "t", "b")
