"""

Every query reads whole driver tables and scrubs data Spark derives from them: the reference's
wide asset table is rebuilt from ``orders``/``supplier``, its address file from ``customer``.
Each oracle builds the same inputs in SQL and applies the rule by hand, so the two sides share
no code. Column names match on both sides.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # the package sits next to this file

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F

from maskfold import (  # noqa: E402
    Rule,
    ScrubOptions,
    preset,
    read_addresses,
    read_inferred,
    read_table,
    run_job,
    scrub,
    write_outputs,
)
from maskfold.functions.states import STATE_NAMES  # noqa: E402
from maskfold.operators import (  # noqa: E402
    address_report,
    dense_index,
    map_values_join,
    prepare_addresses,
    sample_exact,
)
from maskfold.sources import shared_dir  # noqa: E402
from maskfold.sources.sinks import write_one  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Region code per nation key (index = n_nationkey): real codes, 'NA', wrong case, unknown codes
# and the literal text None, so the state lookup and the address filter both see every case.
NATION_CODES = [
    "CA", "NY", "TX", "NA", "ca", "ZZ", "FL", "WA", "None", "GU", "PR", "VI", "DC",
    "AS", "MP", "OR", "IL", "MA", "AK", "HI", "WY", "VT", "KS", "NV", "UT",
]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _s(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _code(nation: Column) -> Column:
    codes = F.expr("array(" + ", ".join(f"'{c}'" for c in NATION_CODES) + ")")
    return F.element_at(codes, nation + F.lit(1))


# ---------------------------------------------------------------- derived inputs (Spark side)


def address_pool(spark: SparkSession, sf: str) -> DataFrame:
    """An address file in the reference's layout, one row per customer (key ASST_ID)."""
    c = _t(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("ASST_ID"),
        F.concat(F.lit("No "), _s(F.col("c_nationkey") * 10 + 1)).alias("NUMBER"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("None"))
        .otherwise(F.concat(F.lit("Street "), F.col("c_name")))
        .alias("STREET"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise(_s("c_nationkey"))
        .alias("UNIT"),
        F.when(F.col("c_nationkey") == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("CITY_"), _s("c_nationkey")))
        .alias("CITY"),
        _code(F.col("c_nationkey")).alias("REGION"),
        F.lpad(_s("c_custkey"), 5, "0").alias("POSTCODE"),
        F.col("c_acctbal").alias("LON"),
        F.col("c_nationkey").cast("double").alias("LAT"),
        F.col("c_mktsegment").alias("DISTRICT"),
        F.col("c_name").alias("ID"),
        F.md5(F.col("c_name")).alias("HASH"),
    )


def address_map(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed address map: the pool plus a second address for every nation-0 customer, so those
    ids appear twice (an inner join multiplies their rows)."""
    pool = address_pool(spark, sf)
    again = pool.filter(F.col("LAT") == 0).withColumn("CITY", F.lit("CITY_0_B"))
    return pool.unionByName(again)


def _address_targets() -> list[Column]:
    return [
        F.lit("OLD CITY").alias("CITY"),
        F.lit("XX").alias("STAT"),
        F.lit("Z0000").alias("ZIP"),
        F.lit("1 OLD ROAD").alias("PRPTY_ADDR_LN1"),
        F.lit(None).cast("string").alias("PRPTY_ADDR_LN2"),
        F.lit("Old").alias("STAT_CD_DESC"),
    ]


def asset_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the reference's wide asset table (ids, address columns, audit columns)."""
    o = _t(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("ASST_ID"),
        F.col("o_orderkey").alias("ASST_DIM_ID"),
        F.concat(F.lit("BA"), _s("o_orderkey")).alias("LOAN_NUM"),
        F.col("o_totalprice").alias("BAL_AMT"),
        F.col("o_orderkey").alias("XREF_ID"),
        F.col("o_orderstatus").alias("STATUS_CD"),
        F.lit("USA").alias("CNTRY_CD"),
        F.concat(_s("o_orderkey"), F.lit("-"), _s("o_custkey")).alias("ACCT_NUM"),
        F.col("o_orderpriority").alias("FULL_NAME"),
        F.col("o_orderpriority").alias("FIRST_NAME"),
        F.col("o_orderdate").alias("OPEN_DT"),
        *_address_targets(),
        F.col("o_orderkey").alias("BTCH_CR_RUN_ID"),
        F.col("o_orderdate").alias("BTCH_CR_TS"),
        F.col("o_custkey").alias("BTCH_LST_UPD_RUN_ID"),
        F.col("o_orderdate").alias("BTCH_LST_UPD_TS"),
    )


def asset_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    s = _t(spark, sf, "supplier")
    return s.select(
        F.col("s_suppkey").alias("ASST_DIM_ID"),
        "s_name",
        "s_nationkey",
        "s_acctbal",
        *_address_targets(),
    )


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    acct = (
        F.when(F.col("l_linenumber") == 7, F.lit("none"))
        .when(
            F.col("l_linenumber") == 6,
            F.concat(F.lit("AB"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber"), F.lit("X")),
        )
        .otherwise(F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")))
    )
    return li.withColumn("ACCT_NUM", acct)


# thousands of keys
LARGE_MAPPING = "{" + ", ".join(f"{k}: 'C{k}'" for k in range(0, 6000, 2)) + "}"

FULL_RULES = [
    Rule("LOAN_NUM", "numeric", "1000"),
    Rule("BAL_AMT", "amount", "1.1"),
    Rule("XREF_ID", "cross", "500"),
    Rule("STATUS_CD", "multiple", "{'F': 'Filled', 'O': None}"),
    Rule("CNTRY_CD", "fix", "US"),
    Rule("ACCT_NUM", "regex", "#"),
    Rule("FIRST_NAME", "single", "FULL_NAME-1"),
    Rule("PRPTY_ADDR_LN1", "address", "x"),
]


def scrub_full(spark: SparkSession, sf: str) -> DataFrame:
    return scrub(asset_orders(spark, sf), FULL_RULES, address_map(spark, sf))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: all eight rule types on one wide table plus keyed address replacement."""
    return scrub_full(spark, SMOKE_DIR)


# ---------------------------------------------------------------- queries


def _io_dir(spark: SparkSession) -> str:
    """A fresh folder under the session's shared checkpoint folder. A local session that names none
    gets a temporary folder; a cluster must name one, as its executors share no other."""
    try:
        base = shared_dir(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        base = tempfile.mkdtemp(prefix="maskfold-shared-")
    return f"{base}/maskfold-io/{uuid.uuid4().hex}"


def _one(table: str, rules: list[Rule], options: ScrubOptions | None = None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return scrub(_t(spark, sf, table), rules, options=options)

    return run


def _sequence(spark: SparkSession, sf: str) -> DataFrame:
    return scrub(_t(spark, sf, "orders"), [Rule("o_orderkey", "numeric", "1000")], options=preset("v2"))


def _regex(mode: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return scrub(
            accounts(spark, sf), [Rule("ACCT_NUM", "regex", "#")], options=ScrubOptions(regex=mode)
        )

    return run


def _multiple_join(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary as a table: nation key -> nation name for nations outside region 4 (those
    keys pass through), nation 3 mapped to null, applied to every customer."""
    nation = (
        _t(spark, sf, "nation")
        .filter(F.col("n_regionkey") != 4)
        .select(
            F.col("n_nationkey").alias("key"),
            F.when(F.col("n_nationkey") == 3, F.lit(None)).otherwise(F.col("n_name")).alias("value"),
        )
    )
    return map_values_join(_t(spark, sf, "customer"), "c_nationkey", nation)


def _drop_audit(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders").withColumns(
        {
            "BTCH_CR_RUN_ID": F.col("o_orderkey"),
            "BTCH_CR_TS": F.col("o_orderdate"),
            "BTCH_LST_UPD_RUN_ID": F.col("o_custkey"),
            "BTCH_LST_UPD_TS": F.col("o_orderdate"),
        }
    )
    return scrub(o, [Rule("o_orderpriority", "fix", "MASKED")])


def _address_filter(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_addresses(address_pool(spark, sf), preset("v2"))


def _address_keyed(how: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return scrub(
            asset_orders(spark, sf),
            [Rule("PRPTY_ADDR_LN1", "address", "x")],
            address_map(spark, sf),
            ScrubOptions(address_how=how),
        )

    return run


def _address_report(spark: SparkSession, sf: str) -> DataFrame:
    o = ScrubOptions()
    prepared = prepare_addresses(address_map(spark, sf), o, key=o.id_col)
    return address_report(asset_orders(spark, sf), prepared, o)


def _address_sampled(spark: SparkSession, sf: str) -> DataFrame:
    return scrub(
        asset_suppliers(spark, sf),
        [Rule("PRPTY_ADDR_LN1", "address", "x")],
        address_pool(spark, sf),
        preset("v2"),
    )


def _state_name(spark: SparkSession, sf: str) -> DataFrame:
    from maskfold.functions import state_name

    n = _t(spark, sf, "nation").withColumn("STAT", _code(F.col("n_nationkey")))
    return n.withColumn("STAT_CD_DESC", state_name("STAT"))


def _rule_order(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        Rule(" o_orderkey ", "numeric", " 1000 "),
        Rule("o_orderstatus", "fix", "X"),
        Rule("o_custkey", "cross", "500"),
        Rule("o_totalprice", "numeric", "0"),
    ]
    return scrub(_t(spark, sf, "orders"), rules, options=ScrubOptions(id_col="o_orderkey"))


def _dense_index(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return dense_index(li, ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"], "row_index")


def _numeric_large(spark: SparkSession, sf: str) -> DataFrame:
    """Doubles of 16 to 19 digits, printed with an exponent."""
    o = _t(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") * F.lit(1e13)).alias("o_totalprice"))
    return scrub(o, [Rule("o_totalprice", "numeric", "7")])


def _dense_index_wide(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]
    return dense_index(_t(spark, sf, "lineitem"), keys, "row_index")


def _regex_long(spark: SparkSession, sf: str) -> DataFrame:
    """Account numbers of more than 40 digits, whose subtraction borrows through all of them."""
    number = F.concat((F.col("l_orderkey") + 1).cast("string"), F.repeat(F.lit("0"), F.lit(40)), F.col("l_linenumber").cast("string"))
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(number, F.lit("-"), F.col("l_linenumber").cast("string")).alias("ACCT_NUM")
    )
    return scrub(li, [Rule("ACCT_NUM", "regex", "#")])


def _keyed_text_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The keyed address join where the data's ids are text, one in ten of them no number."""
    text = F.col("ASST_ID").cast("string")
    data = asset_orders(spark, sf).withColumn(
        "ASST_ID", F.when(F.col("ASST_DIM_ID") % 10 == 0, F.concat(F.lit("A"), text)).otherwise(text)
    )
    return scrub(data, [Rule("PRPTY_ADDR_LN1", "address", "x")], address_map(spark, sf))


def _multiple_join_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary as a table whose keys are text, some of them no number."""
    key = F.col("n_nationkey").cast("string")
    nation = _t(spark, sf, "nation").select(
        F.when(F.col("n_regionkey") == 4, F.concat(F.lit("X"), key)).otherwise(key).alias("key"),
        F.col("n_name").alias("value"),
    )
    return map_values_join(_t(spark, sf, "customer"), "c_nationkey", nation)


def _sample_exact(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    n = _t(spark, sf, "orders").count()
    return sample_exact(li, n, ["l_orderkey", "l_linenumber", "l_quantity"], seed=7)


def _orders_scrubbed(spark: SparkSession, sf: str) -> DataFrame:
    return scrub(_t(spark, sf, "orders"), [Rule("o_totalprice", "amount", "2")])


def _read_text(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = _orders_scrubbed(spark, sf)
        path = f"{_io_dir(spark)}/orders.{name}"
        write_one(df, "pipe" if name == "txt" else "csv", path)
        return read_table(spark, path, schema=df.schema)

    return run


def _read_glob(spark: SparkSession, sf: str) -> DataFrame:
    pool = address_pool(spark, sf)
    base = _io_dir(spark)
    household = F.col("DISTRICT") == "HOUSEHOLD"
    write_one(pool.filter(household), "csv", f"{base}/addresses_a.csv")
    write_one(pool.filter(~household), "csv", f"{base}/addresses_b.csv")
    return prepare_addresses(read_addresses(spark, f"{base}/addresses_*.csv", schema=pool.schema))


def _read_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and addresses written as text and read back with inferred types, joined."""
    base, o = _io_dir(spark), _t(spark, sf, "orders")
    data = o.select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", F.lpad(_s("o_custkey"), 8, "0").alias("CUST_CD"),
        (F.col("o_orderstatus") == "O").alias("IS_OPEN"), (F.col("o_orderkey") * 10**12).alias("BIG_ID"),
        F.to_date("o_orderdate").alias("OPEN_DT"), F.lit(None).cast("string").alias("EMPTY"),
    )
    write_one(data, "pipe", f"{base}/orders.txt")
    write_one(address_pool(spark, sf).select("ASST_ID", "CITY", "POSTCODE", "LON"), "csv", f"{base}/addresses.csv")
    rows, addresses = read_inferred(spark, f"{base}/orders.txt", f"{base}/addresses.csv")
    out = rows.join(addresses, rows["CUST_CD"].try_cast("int") == addresses["ASST_ID"], "left")
    # the day of a date and the wall time of a timestamp: other inferred types would fail here
    return out.withColumns({"OPEN_DT": F.unix_date("OPEN_DT"), "o_orderdate": F.timestamp_micros(F.unix_micros("o_orderdate")).cast("timestamp_ntz")})


def _write_parquet(spark: SparkSession, sf: str) -> DataFrame:
    base = _io_dir(spark)
    write_outputs(_t(spark, sf, "orders"), base, ["parquet"])
    paths = write_outputs(_orders_scrubbed(spark, sf), base, ["parquet"])
    return spark.read.parquet(paths["parquet"])


def _write_outputs(spark: SparkSession, sf: str) -> DataFrame:
    df = scrub(asset_orders(spark, sf), FULL_RULES, address_map(spark, sf))
    paths = write_outputs(df, _io_dir(spark))
    schema = spark.read.parquet(paths["parquet"]).schema
    return read_table(spark, paths["pipe"], schema=schema, sep="|")


def _job(fmt: str):
    """A whole run from files: rule CSV, address CSV and pipe text in, one output format read back."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        base = _io_dir(spark)
        data, address = asset_orders(spark, sf), address_map(spark, sf)
        rules = spark.createDataFrame([(r.column, r.type, r.value) for r in FULL_RULES], "Column string, Type string, Value string")
        write_one(data, "pipe", f"{base}/assets.txt")
        write_one(address, "csv", f"{base}/addresses.csv")
        write_one(rules, "csv", f"{base}/rules.csv", single_file=True)
        run_job(
            spark, f"{base}/assets.txt", f"{base}/rules.csv", f"{base}/out", f"{base}/addresses.csv",
            schema=data.schema, address_schema=address.schema, single_file=fmt == "csv",
        )
        written = spark.read.parquet(f"{base}/out/parquet")
        return written if fmt == "parquet" else spark.read.schema(written.schema).option("header", True).csv(f"{base}/out/csv")

    return run


def _shipped(query: Callable[[SparkSession, str], DataFrame]):
    """The query after the package has been added to the session's files, as ``--py-files`` does,
    so that Python workers can import it whatever folder they start in."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        if spark.sparkContext.applicationId not in _SHIPPED:
            here = Path(__file__).resolve().parent
            target = Path(tempfile.mkdtemp(prefix="maskfold-files-")) / "maskfold.zip"
            with zipfile.ZipFile(target, "w") as z:
                for f in sorted(here.glob("maskfold/**/*.py")):
                    z.write(f, f.relative_to(here).as_posix())
            spark.sparkContext.addPyFile(str(target))
            _SHIPPED.add(spark.sparkContext.applicationId)
        return query(spark, sf)

    return run


_SHIPPED: set[str] = set()


def _training_data_queries() -> tuple[dict, dict]:
    """Queries and SQL of the optional subpackage ``maskfold.llm`` and of ``corpus_pipeline``; empty
    where these are not present."""
    found, sql = {}, {}
    spec = importlib.util.find_spec("maskfold.llm")
    if spec is not None and spec.origin:  # a folder without modules is no subpackage
        from maskfold.llm.queries import QUERIES, SQL

        found, sql = {name: _shipped(query) for name, query in QUERIES.items()}, dict(SQL)
        if importlib.util.find_spec("corpus_pipeline") is not None:
            import corpus_pipeline

            found["pipeline"] = _shipped(corpus_pipeline.run)
            if corpus_pipeline.ORACLE_SQL:
                sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _library_queries() | _training_data_queries()[0]


def _library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scrub_numeric": _one("customer", [Rule("c_name", "numeric", "1000")]),
        "scrub_numeric_zero": _one("customer", [Rule("c_custkey", "numeric", "1000")]),
        "scrub_numeric_double": _one("customer", [Rule("c_acctbal", "numeric", "7")]),
        "scrub_sequence": _sequence,
        "scrub_amount": _one("orders", [Rule("o_totalprice", "amount", "1.1")]),
        "scrub_cross": _one(
            "orders", [Rule("o_custkey", "cross", "500")], ScrubOptions(id_col="o_orderkey")
        ),
        "scrub_multiple": _one(
            "orders", [Rule("o_orderstatus", "multiple", "{'F': 'Filled', 'O': None}")]
        ),
        "scrub_multiple_numeric": _one(
            "customer",
            [Rule("c_nationkey", "multiple", "{0: 'zero', 1: 1.5, 2.0: 'two', '3': 'three'}")],
        ),
        "scrub_multiple_join": _multiple_join,
        "scrub_multiple_large": _one("orders", [Rule("o_custkey", "multiple", LARGE_MAPPING)]),
        "scrub_choice": _one(
            "customer", [Rule("c_mktsegment", "multiple", "SEG A, SEG_B,SEG_C")], ScrubOptions(multiple="choice", seed=42)
        ),
        "scrub_fix": _one("customer", [Rule("c_mktsegment", "fix", "ANYSEG")]),
        "scrub_fix_commas": _one(
            "customer",
            [Rule("c_mktsegment", "fix", "a, b,c")],
            ScrubOptions(fix="comma_to_space"),
        ),
        "scrub_regex": _regex("reverse"),
        "scrub_regex_index": _regex("index"),
        "scrub_single": _one(
            "orders",
            [
                Rule("o_orderstatus", "single", "o_orderpriority-0"),
                Rule("o_orderpriority", "single", "o_orderpriority-1"),
            ],
        ),
        "drop_audit": _drop_audit,
        "address_filter": _address_filter,
        "address_keyed": _address_keyed("inner"),
        "address_keyed_left": _address_keyed("left"),
        "address_report": _address_report,
        "address_sampled": _address_sampled,
        "state_name": _state_name,
        "rule_order": _rule_order,
        "dense_index": _dense_index,
        "dense_index_wide": _dense_index_wide,
        "scrub_numeric_large": _numeric_large,
        "scrub_regex_long": _regex_long,
        "address_keyed_text_ids": _keyed_text_ids,
        "scrub_multiple_join_mixed": _multiple_join_mixed,
        "scrub_cross_double": _one(
            "orders", [Rule("o_custkey", "cross", "500")], ScrubOptions(id_col="o_totalprice")
        ),
        "sample_exact": _sample_exact,
        "read_pipe": _read_text("txt"),
        "read_csv": _read_text("csv"),
        "read_glob": _read_glob,
        "write_parquet": _write_parquet,
        "write_outputs": _write_outputs,
        "read_inferred": _read_inferred,
        "job_files": _job("parquet"),
        "job_csv_one_file": _job("csv"),
        "scrub_full": scrub_full,
    }


# ---------------------------------------------------------------- oracle SQL (DuckDB)

_CODES_SQL = "[" + ", ".join(f"'{c}'" for c in NATION_CODES) + "]"
_STATE_CASE = (
    "CASE {x} "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_NAMES.items())
    + " ELSE NULL END"
)

_POOL_SQL = f"""
SELECT c_custkey AS ASST_ID,
       'No ' || CAST(c_nationkey * 10 + 1 AS VARCHAR) AS NUMBER,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'None' ELSE 'Street ' || c_name END AS STREET,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS UNIT,
       CASE WHEN c_nationkey = 3 THEN NULL ELSE 'CITY_' || CAST(c_nationkey AS VARCHAR) END AS CITY,
       ({_CODES_SQL})[c_nationkey + 1] AS REGION,
       lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS POSTCODE,
       c_acctbal AS LON, CAST(c_nationkey AS DOUBLE) AS LAT, c_mktsegment AS DISTRICT,
       c_name AS ID, md5(c_name) AS HASH
FROM customer
"""

_MAP_SQL = f"""
SELECT * FROM ({_POOL_SQL}) p
UNION ALL
SELECT ASST_ID, NUMBER, STREET, UNIT, 'CITY_0_B' AS CITY, REGION, POSTCODE, LON, LAT, DISTRICT, ID, HASH
FROM ({_POOL_SQL}) p WHERE LAT = 0
"""

_KEYED_PREP = f"""
SELECT ASST_ID, CITY AS NEW_CITY, REGION, POSTCODE, NUMBER || ' ' || STREET AS ADDR_LN_1,
       ' ' AS ADDR_LN_2
FROM ({_MAP_SQL}) m
WHERE STREET <> 'None' AND CITY <> 'None' AND REGION <> 'None'
"""

_SAMPLE_PREP = f"""
SELECT DISTINCT CITY AS NEW_CITY, REGION, POSTCODE, NUMBER || ' ' || STREET AS ADDR_LN_1,
       'UNIT ' || UNIT AS ADDR_LN_2
FROM ({_POOL_SQL}) p
WHERE STREET <> 'None' AND UNIT <> 'None' AND CITY <> 'None' AND REGION <> 'None'
"""

_ASSET_SQL = """
SELECT o_custkey AS ASST_ID, o_orderkey AS ASST_DIM_ID, 'BA' || CAST(o_orderkey AS VARCHAR) AS LOAN_NUM,
       o_totalprice AS BAL_AMT, o_orderkey AS XREF_ID, o_orderstatus AS STATUS_CD, 'USA' AS CNTRY_CD,
       CAST(o_orderkey AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR) AS ACCT_NUM,
       o_orderpriority AS FULL_NAME, o_orderpriority AS FIRST_NAME, o_orderdate AS OPEN_DT,
       'OLD CITY' AS CITY, 'XX' AS STAT, 'Z0000' AS ZIP, '1 OLD ROAD' AS PRPTY_ADDR_LN1,
       CAST(NULL AS VARCHAR) AS PRPTY_ADDR_LN2, 'Old' AS STAT_CD_DESC
FROM orders
"""

_ACCOUNTS_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_linenumber = 7 THEN 'none'
            WHEN l_linenumber = 6 THEN 'AB' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || 'X'
            ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS ACCT_NUM
FROM lineitem
"""


def _digits_sql(x: str, start: int) -> str:
    """numeric rule on a text column: digits -> double -> bigint + start; empty/null -> null."""
    return (
        f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE "
        f"CAST(CAST(NULLIF(regexp_replace({x}, '[^0-9]', '', 'g'), '') AS DOUBLE) AS BIGINT) + {start} END"
    )


def _regex_sql(src: str, cols: str, head: str) -> str:
    return f"""
WITH t AS (SELECT *, regexp_extract(ACCT_NUM, '(\\d+)-(\\d+)', 1) AS pre,
                     regexp_extract(ACCT_NUM, '(\\d+)-(\\d+)', 2) AS post FROM ({src}) s),
     u AS (SELECT *, CAST(CAST(NULLIF(pre, '') AS DECIMAL(38,0)) - 123 AS VARCHAR) AS d FROM t)
SELECT {cols}, ({head}) || '#' || post AS ACCT_NUM FROM u
"""


_REVERSE_HEAD = "CASE WHEN pre = '' THEN '' ELSE substring(d, 1, 1) || reverse(substring(d, 2)) END"
_INDEX_HEAD = (
    "substring(pre, 1, 1) || CASE WHEN length(pre) > 1 THEN "
    "array_to_string(list_transform(range(0, length(pre) - 1), lambda i: CAST(i AS VARCHAR)), '') "
    "ELSE '' END"
)
_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _full_sql(text_round_trip: bool = False) -> str:
    """The flagship's oracle. Spark's text writers trim surrounding blanks (as the reference's
    writes do), so after a round trip through CSV the one-blank address line 2 reads back null."""
    st = _STATE_CASE.format(x="p.REGION")
    line2 = "CAST(NULL AS VARCHAR)" if text_round_trip else "p.ADDR_LN_2"
    return f"""
WITH a AS ({_ASSET_SQL}), p AS ({_KEYED_PREP})
SELECT a.ASST_ID, a.ASST_DIM_ID,
       {_digits_sql('a.LOAN_NUM', 1000)} AS LOAN_NUM,
       CAST(a.BAL_AMT * CAST(1.1 AS DOUBLE) AS FLOAT) AS BAL_AMT,
       a.ASST_ID + 500 AS XREF_ID,
       CASE a.STATUS_CD WHEN 'F' THEN 'Filled' WHEN 'O' THEN NULL ELSE a.STATUS_CD END AS STATUS_CD,
       'US' AS CNTRY_CD,
       (CASE WHEN regexp_extract(a.ACCT_NUM, '(\\d+)-(\\d+)', 1) = '' THEN '' ELSE
          substring(CAST(CAST(regexp_extract(a.ACCT_NUM, '(\\d+)-(\\d+)', 1) AS DECIMAL(38,0)) - 123 AS VARCHAR), 1, 1) ||
          reverse(substring(CAST(CAST(regexp_extract(a.ACCT_NUM, '(\\d+)-(\\d+)', 1) AS DECIMAL(38,0)) - 123 AS VARCHAR), 2))
        END) || '#' || regexp_extract(a.ACCT_NUM, '(\\d+)-(\\d+)', 2) AS ACCT_NUM,
       a.FULL_NAME, string_split(a.FULL_NAME, '-')[2] AS FIRST_NAME, a.OPEN_DT,
       p.NEW_CITY AS CITY, p.REGION AS STAT, p.POSTCODE AS ZIP, p.ADDR_LN_1 AS PRPTY_ADDR_LN1,
       {line2} AS PRPTY_ADDR_LN2, {st} AS STAT_CD_DESC
FROM a JOIN p ON a.ASST_ID = p.ASST_ID
"""


def _keyed_sql(join: str, ids: str = "a.ASST_ID") -> str:
    st = _STATE_CASE.format(x="p.REGION")
    return f"""
WITH a AS ({_ASSET_SQL}), p AS ({_KEYED_PREP})
SELECT {ids} AS ASST_ID, a.ASST_DIM_ID, a.LOAN_NUM, a.BAL_AMT, a.XREF_ID, a.STATUS_CD, a.CNTRY_CD,
       a.ACCT_NUM, a.FULL_NAME, a.FIRST_NAME, a.OPEN_DT,
       p.NEW_CITY AS CITY, p.REGION AS STAT, p.POSTCODE AS ZIP, p.ADDR_LN_1 AS PRPTY_ADDR_LN1,
       p.ADDR_LN_2 AS PRPTY_ADDR_LN2, {st} AS STAT_CD_DESC
FROM a {join} JOIN p ON TRY_CAST({ids} AS BIGINT) = p.ASST_ID
"""


def _sampled_sql() -> str:
    cols = ["NEW_CITY", "REGION", "POSTCODE", "ADDR_LN_1", "ADDR_LN_2"]
    key = "md5(concat_ws('|', '42', " + ", ".join(f"coalesce({c}, '')" for c in cols) + "))"
    by = ", ".join(f"{c} ASC NULLS FIRST" for c in cols)
    st = _STATE_CASE.format(x="p.REGION")
    return f"""
WITH prep AS ({_SAMPLE_PREP}),
     ranked AS (SELECT *, row_number() OVER (ORDER BY {key}, {by}) AS rk FROM prep),
     chosen AS (SELECT * FROM ranked WHERE rk <= (SELECT count(*) FROM supplier)),
     p AS (SELECT *, row_number() OVER (ORDER BY {by}) AS join_index FROM chosen),
     d AS (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS join_index FROM supplier)
SELECT d.s_suppkey AS ASST_DIM_ID, d.s_name, d.s_nationkey, d.s_acctbal,
       p.NEW_CITY AS CITY, p.REGION AS STAT, p.POSTCODE AS ZIP, p.ADDR_LN_1 AS PRPTY_ADDR_LN1,
       p.ADDR_LN_2 AS PRPTY_ADDR_LN2, {st} AS STAT_CD_DESC
FROM d JOIN p ON d.join_index = p.join_index
"""


def oracle_sql() -> dict[str, str]:
    return _library_sql() | _training_data_queries()[1]


def _library_sql() -> dict[str, str]:
    cust = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
    acct_cols = "l_orderkey, l_linenumber, l_quantity"
    return {
        "scrub_numeric": f"SELECT c_custkey, {_digits_sql('c_name', 1000)} AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "scrub_numeric_zero": "SELECT CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey + 1000 END AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "scrub_numeric_double": "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal = 0 THEN NULL ELSE CAST(CAST(NULLIF(regexp_replace(CAST(c_acctbal AS VARCHAR), '[^0-9]', '', 'g'), '') AS DOUBLE) AS BIGINT) + 7 END AS c_acctbal, c_mktsegment FROM customer",
        "scrub_sequence": "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 + 1000 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "scrub_amount": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice * CAST(1.1 AS DOUBLE) AS FLOAT) AS o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "scrub_cross": "SELECT o_orderkey, o_orderkey + 500 AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "scrub_multiple": "SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "scrub_multiple_numeric": "SELECT c_custkey, c_name, CASE c_nationkey WHEN 0 THEN 'zero' WHEN 1 THEN '1.5' WHEN 2 THEN 'two' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "scrub_multiple_join": "SELECT c_custkey, c_name, CASE WHEN n.n_nationkey IS NULL THEN CAST(c.c_nationkey AS VARCHAR) WHEN n.n_nationkey = 3 THEN NULL ELSE n.n_name END AS c_nationkey, c_acctbal, c_mktsegment FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON c.c_nationkey = n.n_nationkey",
        "scrub_multiple_large": "SELECT o_orderkey, CASE WHEN o_custkey < 6000 AND o_custkey % 2 = 0 THEN 'C' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "scrub_choice": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'SEG_C123' AS c_mktsegment FROM customer",
        "scrub_fix": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'ANYSEG' AS c_mktsegment FROM customer",
        "scrub_fix_commas": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'a b c' AS c_mktsegment FROM customer",
        "scrub_regex": _regex_sql(_ACCOUNTS_SQL, acct_cols, _REVERSE_HEAD),
        "scrub_regex_index": _regex_sql(_ACCOUNTS_SQL, acct_cols, _INDEX_HEAD),
        "scrub_single": "SELECT o_orderkey, o_custkey, string_split(o_orderpriority, '-')[1] AS o_orderstatus, o_totalprice, o_orderdate, string_split(o_orderpriority, '-')[2] AS o_orderpriority FROM orders",
        "drop_audit": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'MASKED' AS o_orderpriority FROM orders",
        "address_filter": _SAMPLE_PREP,
        "address_keyed": _keyed_sql(""),
        "address_keyed_left": _keyed_sql("LEFT"),
        "address_report": f"""
WITH a AS ({_ASSET_SQL}), c AS (SELECT ASST_ID, count(*) AS copies FROM ({_KEYED_PREP}) p GROUP BY ASST_ID)
SELECT count(*) AS data_rows, count(*) FILTER (WHERE c.copies IS NULL) AS unmatched_rows,
       CAST(sum(CASE WHEN c.copies > 1 THEN c.copies - 1 ELSE 0 END) AS BIGINT) AS extra_rows,
       CAST(sum(coalesce(c.copies, 0)) AS BIGINT) AS output_rows
FROM a LEFT JOIN c ON a.ASST_ID = c.ASST_ID
""",
        "address_sampled": _sampled_sql(),
        "state_name": f"SELECT n_nationkey, n_name, n_regionkey, ({_CODES_SQL})[n_nationkey + 1] AS STAT, {_STATE_CASE.format(x=f'({_CODES_SQL})[n_nationkey + 1]')} AS STAT_CD_DESC FROM nation",
        "rule_order": "SELECT CASE WHEN o_orderkey = 0 THEN NULL ELSE o_orderkey + 1000 END AS o_orderkey, CASE WHEN o_orderkey = 0 THEN NULL ELSE o_orderkey + 1500 END AS o_custkey, 'X' AS o_orderstatus, CASE WHEN o_totalprice = 0 THEN NULL ELSE CAST(CAST(regexp_replace(CAST(o_totalprice AS VARCHAR), '[^0-9]', '', 'g') AS DOUBLE) AS BIGINT) END AS o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "dense_index": "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, row_number() OVER (ORDER BY l_shipdate NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_quantity NULLS FIRST) AS row_index FROM lineitem",
        "dense_index_wide": "SELECT *, row_number() OVER (ORDER BY l_shipdate NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_quantity NULLS FIRST) AS row_index FROM lineitem",
        "scrub_numeric_large": "SELECT o_orderkey, TRY_CAST(CAST(NULLIF(regexp_replace(CAST(o_totalprice * CAST(1e13 AS DOUBLE) AS VARCHAR), '[^0-9]', '', 'g'), '') AS DOUBLE) AS BIGINT) + 7 AS o_totalprice FROM orders",
        "scrub_regex_long": """
SELECT l_orderkey, l_linenumber, substring(d, 1, 1) || reverse(substring(d, 2)) || '#' || CAST(l_linenumber AS VARCHAR) AS ACCT_NUM
FROM (SELECT *, CASE WHEN l_orderkey = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END || repeat('9', 38) || CAST(877 + l_linenumber AS VARCHAR) AS d FROM lineitem) t
""",
        "address_keyed_text_ids": _keyed_sql("", "CASE WHEN a.ASST_DIM_ID % 10 = 0 THEN 'A' || CAST(a.ASST_ID AS VARCHAR) ELSE CAST(a.ASST_ID AS VARCHAR) END"),
        "scrub_multiple_join_mixed": "SELECT c_custkey, c_name, coalesce(n.n_name, CAST(c.c_nationkey AS VARCHAR)) AS c_nationkey, c_acctbal, c_mktsegment FROM customer c LEFT JOIN nation n ON c.c_nationkey = TRY_CAST(CASE WHEN n.n_regionkey = 4 THEN 'X' ELSE '' END || CAST(n.n_nationkey AS VARCHAR) AS BIGINT)",
        "scrub_cross_double": "SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "sample_exact": "SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '7', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_quantity AS VARCHAR))), l_orderkey, l_linenumber, l_quantity) AS rk FROM lineitem) s WHERE rk <= (SELECT count(*) FROM orders)",
        "read_pipe": f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice * CAST(2 AS DOUBLE) AS FLOAT) AS o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "read_csv": f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice * CAST(2 AS DOUBLE) AS FLOAT) AS o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "read_glob": _SAMPLE_PREP.replace("DISTINCT ", "").replace("'UNIT ' || UNIT", "' '").replace(" AND UNIT <> 'None'", ""),
        "write_parquet": f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice * CAST(2 AS DOUBLE) AS FLOAT) AS o_totalprice, o_orderdate, o_orderpriority FROM orders",
        "write_outputs": _full_sql(text_round_trip=True),
        "read_inferred": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
            lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS CUST_CD, o_orderstatus = 'O' AS IS_OPEN, o_orderkey * 1000000000000 AS BIG_ID,
            CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS OPEN_DT, CAST(NULL AS VARCHAR) AS EMPTY, CAST(c_custkey AS INTEGER) AS ASST_ID,
            CASE WHEN c_nationkey <> 3 THEN 'CITY_' || CAST(c_nationkey AS VARCHAR) END AS CITY, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS POSTCODE, c_acctbal AS LON
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
        "job_files": _full_sql(),
        "job_csv_one_file": _full_sql(text_round_trip=True),
        "scrub_full": _full_sql(),
    }
