"""Address replacement: by key (join on the asset id) or by a seeded sample of an address pool."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskfold.functions.names import col, quoted
from maskfold.functions.pytext import is_string
from maskfold.functions.states import state_name
from maskfold.operators.index import (
    dense_index,
    dense_index_counted,
    materialised,
    row_hash,
    sample_exact,
    steady,
)
from maskfold.plans.options import ScrubOptions

# Names of the prepared address columns (as the reference names them after its rename).
ADDRESS_FIELDS = ("NEW_CITY", "REGION", "POSTCODE", "ADDR_LN_1", "ADDR_LN_2")
_A = "__mf_address"
_J = "__mf_join_index"
_H, _H2 = "__mf_hash", "__mf_hash2"
_K = "__mf_key"


def prepare_addresses(
    addresses: DataFrame, options: ScrubOptions | None = None, key: str | None = None
) -> DataFrame:
    """Usable addresses: street, city, region (and unit when used) not the text ``None`` (which
    also drops nulls); line 1 = ``NUMBER STREET``; line 2 = one blank or ``UNIT <unit>``.

    Returns exactly ``[key] + ADDRESS_FIELDS``; raw columns such as LON/LAT/HASH never reach the
    output. Optionally whole-row DISTINCT.
    """
    o = options or ScrubOptions()
    c = o.columns
    required = [c.street, c.city, c.region] + ([c.unit] if o.include_unit else [])
    usable = reduce(lambda a, b: a & b, [col(x).cast("string") != F.lit("None") for x in required])
    line2 = (
        F.concat(F.lit("UNIT"), F.lit(" "), col(c.unit).cast("string"))
        if o.include_unit
        else F.lit(" ")
    )
    out = addresses.filter(usable).select(
        *([col(key)] if key else []),
        col(c.city).alias("NEW_CITY"),
        col(c.region).alias("REGION"),
        col(c.postcode).alias("POSTCODE"),
        F.concat(col(c.number).cast("string"), F.lit(" "), col(c.street).cast("string")).alias(
            "ADDR_LN_1"
        ),
        line2.alias("ADDR_LN_2"),
    )
    return out.distinct() if o.distinct_addresses else out


def _overwrite(joined: DataFrame, o: ScrubOptions) -> DataFrame:
    t = o.columns
    a = F.col(_A)
    out = joined.withColumns(
        {
            t.target_city: a["NEW_CITY"],
            t.target_state: a["REGION"],
            t.target_zip: a["POSTCODE"],
            t.target_line1: a["ADDR_LN_1"],
            t.target_line2: a["ADDR_LN_2"],
        }
    ).drop(_A)
    return out.withColumn(t.target_state_name, state_name(col(t.target_state)))


def key_condition(df: DataFrame, side: DataFrame, left: str, right: str) -> Column:
    """Equality of two key columns whose types may differ: text meets another type as a value of
    that type, and text that is no such value matches nothing (never an error)."""
    types = [{f.name: f.dataType for f in x.schema.fields}[n] for x, n in ((df, left), (side, right))]
    a, b = df[quoted(left)], side[quoted(right)]
    if is_string(types[0]) and not is_string(types[1]):
        a = a.try_cast(types[1])
    elif is_string(types[1]) and not is_string(types[0]):
        b = b.try_cast(types[0])
    return a == b


def replace_keyed(df: DataFrame, prepared: DataFrame, options: ScrubOptions | None = None) -> DataFrame:
    """Join the prepared addresses on the id column and overwrite the address columns.

    ``inner`` (default) drops rows without an address and multiplies rows whose id appears more
    than once in the address table; ``left`` keeps them with null address columns. The id column
    moves to the front, as the reference's ``join(..., 'ASST_ID')`` does. Ids may differ in type
    (each file's types are inferred by themselves). The planner broadcasts the address side where its
    size is known to be below the session's threshold; otherwise it is a shuffle join.
    """
    o = options or ScrubOptions()
    key = o.id_col
    payload = prepared.select(col(key).alias(_K), F.struct(*ADDRESS_FIELDS).alias(_A))
    joined = df.join(payload, key_condition(df, payload, key, _K), o.address_how)
    rest = [col(c) for c in df.columns if c != key]
    return _overwrite(joined.select(col(key), *rest, F.col(_A)), o)


def replace_sampled(df: DataFrame, prepared: DataFrame, options: ScrubOptions | None = None) -> DataFrame:
    """Give the i-th data row by the order column the i-th address, by city, of a seeded exact
    sample (without replacement) of as many pool rows as there are data rows.

    A narrow table of the data (order column and two row hashes, 128 bits that name a row) is stored and numbered;
    the numbers are paired with those of the sampled addresses; and the pairs join the data on the hashes. The wide rows
    travel once, for that join, and are neither sorted by the order column nor written. Equal rows have one name: of
    these one stays, and takes all the addresses of that name. A pool with fewer usable addresses than data rows fails the
    job, as the reference's sampler does.
    """
    o = options or ScrubOptions()
    fields = list(ADDRESS_FIELDS)
    df = steady(df)
    names = {_H: row_hash(df), _H2: row_hash(df, 1)}
    keys = materialised(df.select(col(o.order_col), *[c.alias(k) for k, c in names.items()]))
    ranks, n = dense_index_counted(keys, [o.order_col, _H, _H2], _J)
    try:
        chosen = sample_exact(prepared.select(*fields), n, fields, o.seed) if n else prepared.select(*fields).limit(0)
    except ValueError as e:
        raise ValueError(f"address pool has fewer rows than the data: {e}") from e
    addresses = dense_index(chosen, fields, _J).select(_J, F.struct(*fields).alias(_A))
    pairs = ranks.select(_H, _H2, _J).join(addresses, _J).drop(_J)
    named = df.withColumns(names)
    if not keys.groupBy(_H, _H2).count().where("count > 1").isEmpty():
        named = named.dropDuplicates([_H, _H2])
    joined = named.join(pairs, [_H, _H2])
    return _overwrite(joined.select(*[col(c) for c in df.columns], _A), o)


def address_report(df: DataFrame, prepared: DataFrame, options: ScrubOptions | None = None) -> DataFrame:
    """What the keyed join does to the row count, as one row: ``data_rows``; ``unmatched_rows``
    (no usable address: dropped by the inner join, null addresses in the left form);
    ``extra_rows`` (added because an id has more than one address); ``output_rows`` of the inner
    join. The address side is pre-aggregated to one row per id before it meets the data."""
    o = options or ScrubOptions()
    key = o.id_col
    copies = prepared.groupBy(col(key).alias(_K)).agg(F.count(F.lit(1)).alias("__mf_copies"))
    c = F.col("__mf_copies")
    joined = df.join(copies, key_condition(df, copies, key, _K), "left")
    return joined.agg(
        F.count(F.lit(1)).alias("data_rows"),
        F.count_if(c.isNull()).alias("unmatched_rows"),
        F.sum(F.when(c > 1, c - 1).otherwise(F.lit(0))).cast("bigint").alias("extra_rows"),
        F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias("output_rows"),
    )
