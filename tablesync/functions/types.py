"""Spark types for the type texts of a MySQL inventory."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of type texts, first match wins, and the Spark type of each.
# Whatever matches none (varchar, text, enum, set, json, time) is text.
TYPE_PATTERNS = (
    (r"^(tinyint\(1\)|bool(ean)?)$", "boolean"),
    (r"^bigint.* unsigned", "decimal(20,0)"),
    (r"^int.* unsigned", "bigint"),
    (r"^bigint", "bigint"),
    (r"^(tinyint|smallint|mediumint|int|year)", "int"),
    (r"^float", "float"),
    (r"^double", "double"),
    (r"^date$", "date"),
    (r"^(datetime|timestamp)", "timestamp_ntz"),
    (r"^(tiny|medium|long)?blob|^(var)?binary", "binary"),
)
DECIMAL_PATTERN = r"^(?:decimal|numeric|dec|fixed)(?:\((\d+)(?:, ?(\d+))?\))?( unsigned)?( zerofill)?$"
# Digits and scale of a bare decimal, and the most digits that Spark's decimals have.
DECIMAL_DEFAULT = 10, 0
MOST_DIGITS = 38


def spark_type(column_type: Column) -> Column:
    """The Spark type, as DDL text, of a column of type texts.

    A decimal of more digits than Spark has is text, so that no digit is lost.
    """
    text = F.lower(F.trim(column_type))
    digits = F.nullif(F.regexp_extract(text, DECIMAL_PATTERN, 1), F.lit("")).cast("int")
    scale = F.nullif(F.regexp_extract(text, DECIMAL_PATTERN, 2), F.lit("")).cast("int")
    digits, scale = F.coalesce(digits, F.lit(DECIMAL_DEFAULT[0])), F.coalesce(scale, F.lit(DECIMAL_DEFAULT[1]))
    decimal = F.concat(F.lit("decimal("), digits, F.lit(","), scale, F.lit(")"))
    found = F.when(
        text.rlike(DECIMAL_PATTERN), F.when(digits <= MOST_DIGITS, decimal).otherwise("string")
    )
    for pattern, name in TYPE_PATTERNS:
        found = found.when(text.rlike(pattern), name)
    return found.otherwise("string")
