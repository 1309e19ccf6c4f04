"""Query registry: every operator of the inventory as a (spark, sf_dir) → DataFrame
callable, plus its independent DuckDB SQL oracle.

Outputs are normalised to portable types on both sides (dates as ISO text,
integers as BIGINT, floating values rounded to 6 digits) so that the cross-engine
value hash compares values, not engine-specific types or last-digit noise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormlens.session import ship_package

# Means of 0.1 mm readings over 2^k days land exactly on a 6-digit rounding midpoint
# (e.g. 22.6384375). Both sides first go to a decimal of 10 digits, which takes away
# what differs by the order of summation, and then round that decimal half up.

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double").cast("decimal(38,10)"), 6).cast("double")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_KIND = {
    "s": "{c}",
    "d": "CAST({c} AS VARCHAR)",
    "i": "CAST({c} AS BIGINT)",
    "f": "CAST(round(CAST(CAST({c} AS DOUBLE) AS DECIMAL(38, 10)), 6) AS DOUBLE)",
    "a": "array_to_string({c}, ',')",
}


def portable_sql(inner: str, spec: str) -> str:
    """Wrap an oracle statement with the same normalisation. ``spec`` lists the
    output columns as ``name:kind`` with kind s (text), d (date), i (integer),
    f (float), a (integer list)."""
    parts = []
    for item in spec.split():
        name, kind = item.split(":")
        parts.append(_KIND[kind].format(c=f'"{name}"') + f' AS "{name}"')
    return f"SELECT {', '.join(parts)} FROM (\n{inner}\n) AS q"


def register(name: str, sql: str | None = None, spec: str | None = None):
    """Decorator: register a query under ``name`` with an optional oracle."""
    def deco(fn):
        def run(spark, sf_dir):
            ship_package(spark)  # pandas-UDF operators need the package on the workers
            return portable(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = portable_sql(sql, spec) if spec else sql
        return fn
    return deco
