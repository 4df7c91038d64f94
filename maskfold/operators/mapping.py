"""Dictionary replacement from a mapping table, for maps too large to be a literal in the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskfold.functions.names import col
from maskfold.operators.address import key_condition

_K, _V, _HIT = "__mf_map_key", "__mf_map_value", "__mf_map_hit"


def map_values_join(
    df: DataFrame, column: str, mapping: DataFrame, key: str = "key", value: str = "value"
) -> DataFrame:
    """The ``multiple`` rule with the dictionary as a DataFrame ``(key, value)``: mapped values are
    replaced (a null value gives null), unmapped values pass through as text; the column becomes a
    string and keeps its position. A table has no order, so a key listed twice keeps its greatest value
    (a dictionary has one value per key, the last). Keys of another type are compared in the type that
    is not text; text that is no such value matches nothing. The planner broadcasts the mapping where
    its size is known to be below the session's threshold, otherwise it is a shuffle join (AQE splits
    hot keys)."""
    m = mapping.groupBy(col(key).alias(_K)).agg(F.max(col(value).cast("string")).alias(_V))
    side = m.withColumn(_HIT, F.lit(True))
    joined = df.join(side, key_condition(df, side, column, _K), "left")
    replaced = F.when(F.col(_HIT), F.col(_V)).otherwise(col(column).cast("string"))
    return joined.withColumn(column, replaced).drop(_K, _V, _HIT)
