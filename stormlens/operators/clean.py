"""Filters, projections and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlens.functions.calendar import parse_obs_date

# Gauge sentinel codes. 9999 marks a broken gauge (missing value);
# 8888 marks trace rain (recorded as 0 mm).
NULL_CODES = (9999.0,)
ZERO_CODES = (8888.0,)


# --- predicates -----------------------------------------------------------

def filter_prefix(df: DataFrame, col: str, prefix) -> DataFrame:
    """keep ids starting with a prefix (or any of several prefixes).

    ``startswith`` on a plain column pushes to Parquet as ``StringStartsWith``."""
    prefixes = [prefix] if isinstance(prefix, str) else list(prefix)
    cond = reduce(lambda a, b: a | b, [F.col(col).startswith(p) for p in prefixes])
    return df.filter(cond)


def keep_stations(df: DataFrame, col: str, ids) -> DataFrame:
    """keep listed ids. A literal list becomes an ``In`` filter (pushed down);
    a DataFrame of ids becomes a left-semi join (broadcast by the planner when small)."""
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        return df.join(ids.select(F.col(key).alias(col)).distinct(), on=col, how="left_semi")
    return df.filter(F.col(col).isin(list(ids)))


def drop_stations(df: DataFrame, col: str, ids) -> DataFrame:
    """drop listed ids; rows with a NULL id are kept (as ``~isin`` on NaN keeps them)."""
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        return df.join(ids.select(F.col(key).alias(col)).distinct(), on=col, how="left_anti")
    return df.filter(~F.coalesce(F.col(col).isin(list(ids)), F.lit(False)))


def search_names(df: DataFrame, keywords, id_col: str = "station_id",
                 name_col: str = "name") -> DataFrame:
    """case-insensitive plain-text keyword search on station names.

    Returns one row per (keyword, id, name) found, and a row with NULL id / name
    for a keyword that matches nothing. One pass over the data: the distinct
    (id, name) catalog is aggregated once, each catalog row carries the literal
    keyword list (explode), and a ``contains`` predicate keeps the matches."""
    kw = F.array(*[F.lit(k) for k in keywords])
    hits = (df.select(id_col, name_col).distinct()
            .select(id_col, name_col, F.explode(kw).alias("keyword"))
            .filter(F.lower(F.col(name_col)).contains(F.lower(F.col("keyword")))))
    kw_df = df.sparkSession.createDataFrame([(k,) for k in keywords], "keyword string")
    return kw_df.join(hits, on="keyword", how="left") \
        .select("keyword", id_col, name_col, F.col(id_col).isNotNull().cast("int").alias("found"))


def map_names(df: DataFrame, names, col: str = "name", out: str = "short_name", keep_unmatched: bool = False) -> DataFrame:
    """Look names up. Unmatched names give NULL, or themselves with ``keep_unmatched``.
    ``names`` is a dictionary (becomes a literal map, no join) or a frame (name, mapped name)
    of any size, joined without a hint."""
    if isinstance(names, DataFrame):
        key, value = names.columns
        dim = names.select(F.col(key).alias("_from"), F.col(value).alias("_mapped"))
        df = df.join(dim, F.col(col) == F.col("_from"), "left").drop("_from")
        found = F.col("_mapped")
    else:
        pairs = [F.lit(x) for pair in names.items() for x in pair]
        found = F.try_element_at(F.create_map(*pairs), F.col(col)) if pairs else F.lit(None).cast("string")
    found = F.coalesce(found, F.col(col)) if keep_unmatched else found
    return df.withColumn(out, found).drop("_mapped")


def valid_only(df: DataFrame, col: str) -> DataFrame:
    """F5."""
    return df.filter(F.col(col).isNotNull())


def cut_range(df: DataFrame, start, end, date_col: str = "obs_date") -> DataFrame:
    """inclusive date range."""
    return df.filter(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def around_date(df: DataFrame, date, n: int, date_col: str = "obs_date") -> DataFrame:
    """centred window of ±n days around ``date``."""
    d = F.lit(date).cast("date")
    return df.filter(F.col(date_col).between(F.date_sub(d, n), F.date_add(d, n)))


def on_date(df: DataFrame, date, date_col: str = "obs_date") -> DataFrame:
    """F8."""
    return df.filter(F.col(date_col) == F.lit(date).cast("date"))


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """F9."""
    return df.dropna(how="any", subset=subset)


def any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def incomplete_rows(df: DataFrame, cols) -> DataFrame:
    """rows having a NULL in any of ``cols``."""
    return df.filter(any_null(cols))


def present(df: DataFrame, mapping: dict) -> DataFrame:
    """select, rename and order columns for presentation (``{old: new}``)."""
    return df.select([F.col(f"`{k}`").alias(v) for k, v in mapping.items()])


def feature_columns(df: DataFrame, exclude) -> list[str]:
    """all columns except the excluded ones (target, reference-only value, keys)."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


# --- cleaning -------------------------------------------------------------

def clean_sentinels(df: DataFrame, col: str = "rain_mm", null_codes=NULL_CODES,
                    zero_codes=ZERO_CODES, out: str | None = None) -> DataFrame:
    """9999 → NULL (broken gauge), 8888 → 0 (trace)."""
    c = F.col(col)
    expr = (F.when(c.isin(*null_codes), F.lit(None).cast("double"))
            .when(c.isin(*zero_codes), F.lit(0.0))
            .otherwise(c))
    return df.withColumn(out or col, expr)


def to_station_days(readings: DataFrame, station_col: str = "station_id",
                    ts_col: str = "data_timestamp", value_col: str = "rain_mm") -> DataFrame:
    """Readings → ``(station, obs_date, rain_mm)`` with sentinels recoded.

    Rows without a station are dropped (a NULL key would otherwise form its own
    group, trap T23)."""
    cleaned = clean_sentinels(readings, value_col)
    return cleaned.select(F.col(station_col).alias("station"),
                          parse_obs_date(ts_col).alias("obs_date"),
                          F.col(value_col).alias("rain_mm")) \
                  .filter(F.col("station").isNotNull() & F.col("obs_date").isNotNull())


def duplicate_keys(df: DataFrame, keys=("station", "obs_date")) -> DataFrame:
    """Keys occurring more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def daily_mean(df: DataFrame, keys=("station", "obs_date"), value_col: str = "rain_mm") -> DataFrame:
    """Resolve duplicate (station, day) rows by their mean (NULLs skipped).

    A hash aggregate with a map-side partial: a hot key (one station-day holding a
    large share of the readings) is pre-combined in every task before the shuffle."""
    return df.groupBy(*keys).agg(F.avg(value_col).alias(value_col))


def clip_lower(df: DataFrame, col: str, lower: float = 0.0) -> DataFrame:
    """Clip values below ``lower`` (NULL stays NULL)."""
    c = F.col(col)
    return df.withColumn(col, F.when(c.isNotNull(), F.greatest(c, F.lit(lower))))


def negative_count(df: DataFrame, col: str) -> DataFrame:
    """I5 check: number of negative values."""
    return df.agg(F.count_if(F.col(col) < 0).alias("n_negative"))


def fill_level(df: DataFrame, col: str = "level", default: str = "Aman") -> DataFrame:
    """I8."""
    return df.fillna({col: default})


def station_catalog(df: DataFrame, id_col: str = "station_id", name_col: str = "name") -> DataFrame:
    """Distinct (id, name) pairs."""
    return df.select(id_col, name_col).distinct()
