"""SQL-surface helpers: session SQL functions with Java semantics.

``java_split`` is registered as a temporary SQL function (a SQL UDF: its
body is a built-in expression, inlined by the analyzer, so it runs JVM-side
like the DataFrame form in :mod:`sensorflow.functions.text`).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

JAVA_SPLIT_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION java_split(s STRING, sep STRING) RETURNS ARRAY<STRING>
RETURN CASE WHEN s = '' THEN array('')
            ELSE slice(split(s, sep, -1), 1, array_max(transform(split(s, sep, -1), (x, i) -> CASE WHEN x <> '' THEN i + 1 ELSE 0 END))) END
"""

# The multiplier of Java's String.hashCode, the 32-bit mask, the surrogate bases.
JAVA_HASH_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION java_hash(s STRING, factor INT) RETURNS INT
RETURN (SELECT CAST(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS INT) FROM (SELECT
  (aggregate(filter(split(s, ''), x -> x <> ''), 0L, (acc, ch) ->
     CASE WHEN ascii(ch) < 65536 THEN acc * 31 + ascii(ch)
          ELSE ((acc * 31 + 55296 + shiftright(ascii(ch) - 65536, 10)) & 4294967295) * 31 + 56320 + (ascii(ch) & 1023) END & 4294967295)
   * (CAST(factor AS BIGINT) & 4294967295)) & 4294967295 AS u))
"""


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(JAVA_SPLIT_SQL)
    spark.sql(JAVA_HASH_SQL)
