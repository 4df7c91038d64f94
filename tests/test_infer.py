"""Types of files by one aggregation: against Spark's own inference, and codes that stay text."""

import random

import pytest

from maskfold import infer_schemas, read_inferred


def _write(path, rows, sep):
    with open(path, "w") as f:
        f.write("\n".join(sep.join(r) for r in rows) + "\n")


COLUMNS = {
    "i": ["1", "-5", "", "+7", "2147483647"], "l": ["1", "2147483648", "-9223372036854775808"], "big": ["1", "92233720368547758080", "-3"],
    "d": ["1", "2.5", "1e5", "-.5", "3."], "mixed": ["1", "x", ""], "dt": ["2024-01-31", "", "1999-12-01"], "ts": ["2024-01-31", "2024-01-31 10:00:00", "2024-01-31T10:00:00.123Z"],
    "b": ["true", "FALSE", ""], "none": ["", "", ""], "bd": ["true", "1", ""], "bad_date": ["2024-02-31", "2024-01-01", ""], "text": ["a b", "é", "12-5"], "dd": ["2024-01-01", "5", ""],
    "bigd": ["92233720368547758080", "1.5", ""],
}


def test_types_as_spark_infers_them(spark, tmp_out):
    names, rng = list(COLUMNS), random.Random(2)
    rows = [names] + [[rng.choice(COLUMNS[c]) or "" for c in names] for _ in range(200)] + [[COLUMNS[c][k] for c in names] for k in range(3)]
    _write(f"{tmp_out}/a.csv", rows, ",")
    _write(f"{tmp_out}/a.txt", rows, "|")
    want = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_out}/a.csv").schema
    got = infer_schemas(spark, {"one": (f"{tmp_out}/a.csv", ","), "two": (f"{tmp_out}/a.txt", "|")}, "number")
    for schema in got.values():
        assert {f.name: f.dataType for f in schema} == {f.name: f.dataType for f in want}


def test_codes_stay_text(spark, tmp_out):
    _write(f"{tmp_out}/a.txt", [["ZIP", "N", "Z2", "NEG"], ["02134", "1", "0", "-012"], ["10001", "2", "5", "3"]], "|")
    _write(f"{tmp_out}/b.csv", [["POSTCODE", "LON"], ["00501", "1.5"]], ",")
    data, addresses = read_inferred(spark, f"{tmp_out}/a.txt", f"{tmp_out}/b.csv")
    assert dict(data.dtypes) == {"ZIP": "string", "N": "int", "Z2": "int", "NEG": "int"}
    assert sorted(r.ZIP for r in data.collect()) == ["02134", "10001"] and addresses.first().POSTCODE == "00501"
    data, addresses = read_inferred(spark, f"{tmp_out}/a.txt", codes="number")
    assert dict(data.dtypes)["ZIP"] == "int" and addresses is None
    with pytest.raises(ValueError, match="codes"):
        infer_schemas(spark, {}, "both")


def test_one_job_for_all_files(spark, tmp_out):
    """Apart from reading headers, one job looks at all tables of a run, split over their files."""
    for k in range(4):
        _write(f"{tmp_out}/a{k}.csv", [["x"], *[[str(k)]] * 5, ["2.5" if k == 3 else "7"]], ",")
    _write(f"{tmp_out}/b.csv", [["y"], ["z"]], ",")
    tracker, group = spark.sparkContext.statusTracker(), "inference"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = infer_schemas(spark, {"a": (f"{tmp_out}/a*.csv", ","), "b": (f"{tmp_out}/b.csv", ",")})
        plain = len(tracker.getJobIdsForGroup(group))
        spark.read.option("header", True).csv(f"{tmp_out}/a*.csv"), spark.read.option("header", True).csv(f"{tmp_out}/b.csv")
        headers = len(tracker.getJobIdsForGroup(group)) - plain
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got["a"].simpleString() == "struct<x:double>" and got["b"].simpleString() == "struct<y:string>"
    assert plain - headers <= 5  # the stages of one adaptive query


def test_header_without_rows(spark, tmp_out):
    _write(f"{tmp_out}/a.csv", [["x", "y"]], ",")
    assert infer_schemas(spark, {"a": (f"{tmp_out}/a.csv", ",")})["a"].simpleString() == "struct<x:string,y:string>"
