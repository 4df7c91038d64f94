"""Rule loading, trimming, execution order and validation (with the reference's messages)."""

import pytest
from pyspark.sql import functions as F

from maskfold import Rule, RuleViolationError, ScrubOptions, check_rules, load_rules, scrub
from maskfold.plans.rules import (
    MSG_COLUMNS,
    MSG_DUPLICATE,
    MSG_TYPES,
    execution_order,
    parse_int,
    parse_mapping,
    parse_piece,
    violations_frame,
)

RULE_CSV = """Column,Type,Value
LOAN_NUM,numeric,1000
BAL_AMT,amount,1.1
 STATUS_CD ,multiple,"{'A':'Alpha','N':None}"
CITY, fix ,ANYTOWN
"""


def test_load_rules_from_csv_trims_and_keeps_quoted_dict(spark, tmp_out):
    path = f"{tmp_out}/rules.csv"
    with open(path, "w") as f:
        f.write(RULE_CSV)
    rules = load_rules(path, spark)
    assert rules[2] == Rule("STATUS_CD", "multiple", "{'A':'Alpha','N':None}")
    assert rules[3] == Rule("CITY", "fix", "ANYTOWN")
    assert parse_mapping(rules[2].value) == {"A": "Alpha", "N": None}


def test_load_rules_from_dataframe(spark):
    df = spark.createDataFrame([("A ", " fix", " x ")], "Column string, Type string, Value string")
    assert load_rules(df) == [Rule("A", "fix", "x")]


def test_execution_order_groups_types_first_seen():
    rules = [Rule("A", "numeric", "1"), Rule("B", "fix", "x"), Rule("C", "numeric", "2")]
    assert [r.column for r in execution_order(rules)] == ["A", "C", "B"]


def test_parsers():
    assert parse_int("5") == 5 and parse_int("5.0") == 5
    assert parse_piece("FULL_NAME#1") == ("FULL_NAME", "#", 1)
    assert parse_mapping('{"a": null}') == {"a": None}
    with pytest.raises(ValueError):
        parse_piece("AB")


def test_validation_reports_every_problem():
    cols = ["A", "B", "FULL"]
    rules = [
        Rule("A", "fix", "x"),
        Rule("A", "fix", "y"),
        Rule("Z", "fix", "x"),
        Rule("BTCH_CR_TS", "fix", "x"),
        Rule("B", "Fix", "x"),
        Rule("FULL", "single", "NOPE#1"),
        Rule("B", "amount", "abc"),
    ]
    found = {(v.check, v.column) for v in check_rules(cols, rules, ScrubOptions())}
    assert ("duplicate", "A") in found
    assert ("column", "Z") in found and ("column", "BTCH_CR_TS") in found
    assert ("type", "B") in found
    assert ("column", "NOPE") in found
    assert ("value", "B") in found


def test_scrub_raises_before_any_job_and_reports(spark):
    df = spark.range(3).withColumn("A", F.lit("a")).withColumn("BTCH_CR_TS", F.current_timestamp())
    with pytest.raises(RuleViolationError) as e:
        scrub(df, [Rule("A", "fix", "x"), Rule("A", "numeric", "1"), Rule("BTCH_CR_TS", "fix", "x"),
                   Rule("id", "Fix", "y")])
    msgs = {v.message for v in e.value.violations}
    assert {MSG_DUPLICATE, MSG_COLUMNS, MSG_TYPES} <= msgs
    report = violations_frame(spark, e.value.violations)
    assert report.columns == ["check", "column", "type", "message"]
    assert report.count() == len(e.value.violations)


def test_padded_names_pass(spark):
    df = spark.createDataFrame([("x",)], "A string")
    out = scrub(df, [Rule(" A ", " fix ", " y ")])
    assert out.collect()[0].A == "y"


def test_rule_order_read_after_write(spark):
    df = spark.createDataFrame([(5, 0)], "ASST_ID long, X long")
    # numeric on the id runs first (first-seen type), cross then copies the shifted id
    out = scrub(df, [Rule("ASST_ID", "numeric", "10"), Rule("X", "cross", "100")])
    assert out.collect()[0].asDict() == {"ASST_ID": 15, "X": 115}
    out = scrub(df, [Rule("X", "cross", "100"), Rule("ASST_ID", "numeric", "10")])
    assert out.collect()[0].asDict() == {"ASST_ID": 15, "X": 105}


def test_numeric_on_id_runs_before_keyed_address(spark):
    data = spark.createDataFrame([(1, "x"), (11, "x")], "ASST_ID long, PRPTY_ADDR_LN1 string")
    addr = spark.createDataFrame(
        [(1, "1", "Main", "Boston", "MA", "02134"), (11, "2", "Elm", "Austin", "TX", "73301")],
        "ASST_ID long, NUMBER string, STREET string, CITY string, REGION string, POSTCODE string",
    )
    # numeric is seen first: ids are shifted by 10 before the join, so 1 -> 11 meets Austin
    out = scrub(data, [Rule("ASST_ID", "numeric", "10"), Rule("PRPTY_ADDR_LN1", "address", "")], addr)
    assert [(r.ASST_ID, r.CITY) for r in out.collect()] == [(11, "Austin")]
    # address seen first: the join uses the original ids, then they are shifted
    out = scrub(data, [Rule("PRPTY_ADDR_LN1", "address", ""), Rule("ASST_ID", "numeric", "10")], addr)
    assert sorted((r.ASST_ID, r.CITY) for r in out.collect()) == [(11, "Boston"), (21, "Austin")]


def test_validate_returns_report_frame(spark):
    from maskfold import validate

    df = spark.createDataFrame([("x",)], "A string")
    assert validate(df, [Rule("A", "fix", "y")]).count() == 0
    bad = validate(df, [Rule("B", "fix", "y"), Rule("A", "Fix", "y")]).collect()
    assert {r.check for r in bad} == {"column", "type"}


def test_rule_file_columns_by_header_name(spark, tmp_out):
    path = f"{tmp_out}/rules_reordered.csv"
    with open(path, "w") as f:
        f.write('Value, Type ,Column\n"{\'A\': 1}",multiple,STATUS_CD\n7,numeric,LOAN_NUM\n')
    assert load_rules(path, spark) == [
        Rule("STATUS_CD", "multiple", "{'A': 1}"),
        Rule("LOAN_NUM", "numeric", "7"),
    ]
    bad = f"{tmp_out}/rules_bad.csv"
    with open(bad, "w") as f:
        f.write("Col,Type,Value\nA,fix,x\n")
    with pytest.raises(ValueError, match="lacks column"):
        load_rules(bad, spark)


def test_names_with_dots_and_blanks(spark):
    from maskfold import AddressColumns

    data = spark.createDataFrame(
        [(1, 10, "BA12", 2.0, "5-LOW", "x", "y", "9-8", "A")],
        "`ASST.ID` long, `DIM ID` long, `LOAN.NUM` string, `BAL AMT` double, `FULL.NAME` string, "
        "`FIRST NAME` string, `ADDR.LN1` string, `ACCT.NUM` string, `ST.CD` string",
    )
    addr = spark.createDataFrame(
        [(1, "1", "Main", "Boston", "MA", "02134")],
        "`ASST.ID` long, NUMBER string, STREET string, CITY string, REGION string, POSTCODE string",
    )
    cols = AddressColumns(target_line1="ADDR.LN1", target_state="ST.CD")
    o = ScrubOptions(id_col="ASST.ID", order_col="DIM ID", columns=cols)
    rules = [
        Rule("LOAN.NUM", "numeric", "1"),
        Rule("BAL AMT", "amount", "2"),
        Rule("FIRST NAME", "single", "FULL.NAME-1"),
        Rule("ACCT.NUM", "regex", "#"),
        Rule("ST.CD", "multiple", "{'A': 'B'}"),
        Rule("ADDR.LN1", "address", ""),
    ]
    r = scrub(data, rules, addr, o).collect()[0].asDict()
    assert r["LOAN.NUM"] == 13 and r["BAL AMT"] == 4.0 and r["FIRST NAME"] == "LOW"
    assert r["ACCT.NUM"] == "-411#8" and r["ADDR.LN1"] == "1 Main" and r["ST.CD"] == "MA"
    assert r["STAT_CD_DESC"] == "Massachusetts"
    sampled = scrub(data, [Rule("ADDR.LN1", "address", "")], addr.drop("ASST.ID"), o.with_(address="sample"))
    assert sampled.collect()[0]["ADDR.LN1"] == "1 Main"
