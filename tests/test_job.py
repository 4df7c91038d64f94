"""The end-to-end job: text in, three formats out, violations reported before writing."""

import os

import pytest

from maskfold.__main__ import main
from maskfold.plans.job import run_job
from maskfold.plans.rules import RuleViolationError

DATA = """ASST_ID|ASST_DIM_ID|LOAN_NUM|BAL_AMT|CITY|STAT|ZIP|PRPTY_ADDR_LN1|PRPTY_ADDR_LN2|STAT_CD_DESC|BTCH_CR_TS
1|10|BA8321|100.0|x|x|x|x|x|x|2015-01-01 00:00:00
2|20|BA1|0.5|x|x|x|x|x|x|2015-01-01 00:00:00
3|30|BA2|1.5|x|x|x|x|x|x|2015-01-01 00:00:00
"""
ADDR = """ASST_ID,NUMBER,STREET,UNIT,CITY,REGION,POSTCODE,LON,LAT
1,10,Main,,Boston,MA,02134,1.0,2.0
2,12,None,,Austin,TX,73301,1.0,2.0
"""
RULES = """Column,Type,Value
LOAN_NUM,numeric,10
BAL_AMT,amount,2
PRPTY_ADDR_LN1,address,x
"""


def _files(tmp_out):
    paths = {}
    for name, text in (("data.txt", DATA), ("addr.csv", ADDR), ("rules.csv", RULES)):
        paths[name] = os.path.join(tmp_out, name)
        with open(paths[name], "w") as f:
            f.write(text)
    return paths


def test_run_job_end_to_end(spark, tmp_out):
    p = _files(tmp_out)
    msg, report = run_job(spark, p["data.txt"], p["rules.csv"], f"{tmp_out}/out", p["addr.csv"])
    assert msg == "Scrubbing process successfully completed" and report.count() == 0
    rows = spark.read.parquet(f"{tmp_out}/out/parquet").collect()
    assert len(rows) == 1  # id 2 has street 'None', id 3 has no address (inner join)
    r = rows[0]
    assert (r.ASST_ID, r.LOAN_NUM, r.CITY, r.STAT_CD_DESC) == (1, 8331, "Boston", "Massachusetts")
    assert "BTCH_CR_TS" not in rows[0].asDict()
    assert os.path.isdir(f"{tmp_out}/out/csv") and os.path.isdir(f"{tmp_out}/out/pipe")


def test_run_job_rejects_before_writing(spark, tmp_out):
    p = _files(tmp_out)
    with open(p["rules.csv"], "a") as f:
        f.write("NOPE,fix,x\n")
    with pytest.raises(RuleViolationError):
        run_job(spark, p["data.txt"], p["rules.csv"], f"{tmp_out}/out2", p["addr.csv"])
    assert not os.path.exists(f"{tmp_out}/out2")


def test_cli(spark, tmp_out):
    p = _files(tmp_out)
    assert main([p["data.txt"], p["addr.csv"], p["rules.csv"], f"{tmp_out}/cli"]) == 0
    assert main([f"{tmp_out}/data.json", p["addr.csv"], p["rules.csv"], f"{tmp_out}/cli2"]) == 2


def test_missing_files_give_reference_messages(spark, tmp_out):
    from maskfold.plans.rules import MSG_DATA_FILE, MSG_RULE_FILE

    p = _files(tmp_out)
    with pytest.raises(FileNotFoundError, match="Replace file mentioned is not available"):
        run_job(spark, p["data.txt"], f"{tmp_out}/nope.csv", f"{tmp_out}/o1", p["addr.csv"])
    with pytest.raises(FileNotFoundError, match="Data file mentioned is not available"):
        run_job(spark, f"{tmp_out}/nope.txt", p["rules.csv"], f"{tmp_out}/o2", p["addr.csv"])
    assert MSG_DATA_FILE != MSG_RULE_FILE
