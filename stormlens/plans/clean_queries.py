"""Registered queries: sources, filters, joins, cleaning (S4, F*, I1-I3, I5, J1-J3, U1-U2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stormlens.functions.calendar import parse_obs_date
from stormlens.operators import clean as C
from stormlens.operators import features as FE
from stormlens.operators import label as L
from stormlens.operators import profile as P
from stormlens.plans import fixture as fx
from stormlens.plans.registry import register
from stormlens.session import ensure_checkpoint_dir
from stormlens.sources.readings import RAW_COLUMNS, read_readings, write_table

READ_SPEC = "rid:i station_id:s name:s data_timestamp:s rain_mm:f trace:s"
TS_DATE = "CAST(substr(data_timestamp, 1, 10) AS DATE)"


# --- flagship -------------------------------------------------------------------

def flagship(spark, sf_dir):
    """Dense calendar → lags/rolling → per-station P95 label → complete rows →
    class balance of extreme days per station."""
    g = fx.grid(spark, sf_dir)
    feats = FE.add_rolling(FE.add_lags(g, (1, 2, 3)), (7, 30))
    lab = L.label_extreme(feats)
    complete = C.drop_incomplete(lab, ["rain_mm", "lag1", "lag2", "lag3", "roll7", "roll30"])
    return P.class_balance(complete, "label", by="station")


FLAGSHIP_SQL = fx.sql("""
feats AS (
  SELECT *, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2,
         lag(rain_mm, 3) OVER w AS lag3,
         avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7,
         avg(rain_mm) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS roll30
  FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date)),
thr AS (SELECT station, quantile_cont(rain_mm, 0.95) AS threshold FROM grid
        WHERE rain_mm IS NOT NULL GROUP BY station),
lab AS (SELECT f.*, CAST(coalesce(f.rain_mm > t.threshold, false) AS INT) AS label
        FROM feats f LEFT JOIN thr t USING (station))""", body="""
SELECT station, count(*) AS n_rows, sum(label) AS n_pos,
       sum(label) * 100.0 / count(*) AS pct_pos,
       CASE WHEN sum(label) > 0 THEN (100.0 - sum(label) * 100.0 / count(*))
            / (sum(label) * 100.0 / count(*)) END AS imbalance_ratio
FROM lab WHERE rain_mm IS NOT NULL AND lag1 IS NOT NULL AND lag2 IS NOT NULL
  AND lag3 IS NOT NULL AND roll7 IS NOT NULL AND roll30 IS NOT NULL
GROUP BY station""")
CB_SPEC = "station:s n_rows:i n_pos:i pct_pos:f imbalance_ratio:f"

register("a21_class_balance", FLAGSHIP_SQL, CB_SPEC)(flagship)


# --- sources --------------------------------------------------------------------

@register("s1_read_readings", fx.sql(body="""
SELECT station_id, name, data_timestamp, rain_mm, CASE WHEN substr(data_timestamp, 1, 4) = '1997' THEN NULL ELSE trace END AS trace
FROM readings"""), "station_id:s name:s data_timestamp:s rain_mm:f trace:s")
def s1_read_readings(spark, sf_dir):
    """The readings as yearly CSV exports under one glob - years differ in the order of
    their columns and 1997 has no trace column - read back by name."""
    r = fx.readings(spark, sf_dir).withColumn("year", F.substring("data_timestamp", 1, 4).cast("int"))
    raw = {v: k for k, v in RAW_COLUMNS.items()}
    orders = [["station_id", "name", "data_timestamp", "rain_mm", "trace"], ["rain_mm", "trace", "station_id", "data_timestamp", "name"]]
    top = f"{ensure_checkpoint_dir(spark)}/exports-{uuid.uuid4().hex}"
    for name, rows, columns in (("even", r.filter("year % 2 = 0"), orders[0]), ("odd", r.filter("year % 2 = 1 and year <> 1997"), orders[1]),
                                ("1997", r.filter("year = 1997"), orders[1][:1] + orders[1][2:])):
        write_table(rows.select(*[F.col(c).alias(raw[c]) for c in columns]), f"{top}/{name}", fmt="csv")
    return read_readings(spark, f"{top}/*/part-*")


@register("s4_parse_obs_date", fx.sql(body=f"""
SELECT rid, {TS_DATE} AS obs_date, CAST(year({TS_DATE}) AS BIGINT) AS year FROM readings"""),
          "rid:i obs_date:d year:i")
def s4_parse_obs_date(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    d = parse_obs_date("data_timestamp")
    return r.select("rid", d.alias("obs_date"), F.year(d).alias("year"))


# --- filters --------------------------------------------------------------------

@register("f1_prefix_filter", fx.sql(body="SELECT * FROM readings WHERE station_id LIKE '1371%'"),
          READ_SPEC)
def f1_prefix_filter(spark, sf_dir):
    return C.filter_prefix(fx.readings(spark, sf_dir), "station_id", fx.PREFIX)


@register("f2_keep_stations", fx.sql(body=f"SELECT * FROM cleaned WHERE station IN {fx.in_list(fx.TARGETS)}"),
          "station:s obs_date:d rain_mm:f")
def f2_keep_stations(spark, sf_dir):
    return C.keep_stations(fx.cleaned(spark, sf_dir), "station", fx.TARGETS)


@register("f2_keep_stations_semi", fx.sql(body="""
SELECT * FROM readings r WHERE r.station_id IN
  (SELECT station FROM cleaned GROUP BY station HAVING count(rain_mm) > 0)"""), READ_SPEC)
def f2_keep_stations_semi(spark, sf_dir):
    """F2, id list given as a DataFrame → left-semi join."""
    ids = fx.cleaned(spark, sf_dir).groupBy("station").agg(F.count("rain_mm").alias("n")) \
        .filter("n > 0").select("station")
    return C.keep_stations(fx.readings(spark, sf_dir), "station_id", ids)


@register("f3_drop_stations", fx.sql(body=f"""
SELECT * FROM cleaned WHERE NOT coalesce(station IN {fx.in_list(fx.TARGETS)}, false)"""),
          "station:s obs_date:d rain_mm:f")
def f3_drop_stations(spark, sf_dir):
    return C.drop_stations(fx.cleaned(spark, sf_dir), "station", fx.TARGETS)


SEARCH_WORDS = ("urg", "Spec", "LOW", "storm")


@register("f4_name_search", fx.sql(f"""
kw AS (SELECT * FROM (VALUES {", ".join(f"('{k}')" for k in SEARCH_WORDS)}) AS t(keyword)),
cat AS (SELECT DISTINCT station_id, name FROM readings)""", body="""
SELECT kw.keyword, cat.station_id, cat.name, CAST(cat.station_id IS NOT NULL AS INT) AS found
FROM kw LEFT JOIN cat ON contains(lower(cat.name), lower(kw.keyword))"""),
          "keyword:s station_id:s name:s found:i")
def f4_name_search(spark, sf_dir):
    return C.search_names(fx.readings(spark, sf_dir), SEARCH_WORDS)


@register("f5_valid_only", fx.sql(body="SELECT * FROM cleaned WHERE rain_mm IS NOT NULL"),
          "station:s obs_date:d rain_mm:f")
def f5_valid_only(spark, sf_dir):
    return C.valid_only(fx.cleaned(spark, sf_dir), "rain_mm")


@register("f6_cut_range", fx.sql(body="""
SELECT * FROM grid WHERE obs_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""),
          "station:s obs_date:d rain_mm:f")
def f6_cut_range(spark, sf_dir):
    return C.cut_range(fx.grid(spark, sf_dir), "1996-01-01", "2000-12-31")


@register("f7_around_date", fx.sql(body="""
SELECT * FROM grid WHERE obs_date BETWEEN DATE '1999-06-15' - INTERVAL 7 DAY
                                       AND DATE '1999-06-15' + INTERVAL 7 DAY"""),
          "station:s obs_date:d rain_mm:f")
def f7_around_date(spark, sf_dir):
    return C.around_date(fx.grid(spark, sf_dir), "1999-06-15", 7)


@register("f8_on_date", fx.sql(body="SELECT * FROM grid WHERE obs_date = DATE '1999-06-15'"),
          "station:s obs_date:d rain_mm:f")
def f8_on_date(spark, sf_dir):
    return C.on_date(fx.grid(spark, sf_dir), "1999-06-15")


LAGROLL_SQL = """
lr AS (
  SELECT *, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2,
         avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7
  FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date))"""
LR_SPEC = "station:s obs_date:d rain_mm:f lag1:f lag2:f roll7:f"


def _lagroll(spark, sf_dir):
    return FE.add_rolling(FE.add_lags(fx.grid(spark, sf_dir), (1, 2)), (7,))


@register("f9_drop_incomplete", fx.sql(LAGROLL_SQL, body="""
SELECT * FROM lr WHERE rain_mm IS NOT NULL AND lag1 IS NOT NULL AND lag2 IS NOT NULL
  AND roll7 IS NOT NULL"""), LR_SPEC)
def f9_drop_incomplete(spark, sf_dir):
    return C.drop_incomplete(_lagroll(spark, sf_dir), ["rain_mm", "lag1", "lag2", "roll7"])


@register("f10_incomplete_rows", fx.sql(LAGROLL_SQL, body="""
SELECT station, count(*) AS n_incomplete FROM lr
WHERE rain_mm IS NULL OR lag1 IS NULL OR lag2 IS NULL OR roll7 IS NULL GROUP BY station"""),
          "station:s n_incomplete:i")
def f10_incomplete_rows(spark, sf_dir):
    rows = C.incomplete_rows(_lagroll(spark, sf_dir), ["rain_mm", "lag1", "lag2", "roll7"])
    return rows.groupBy("station").agg(F.count(F.lit(1)).alias("n_incomplete"))


@register("f11_present", fx.sql(body="""
SELECT obs_date AS "day", station AS "gauge", rain_mm AS "depth_mm"
FROM grid"""), "day:d gauge:s depth_mm:f")
def f11_present(spark, sf_dir):
    return C.present(fx.grid(spark, sf_dir), {"obs_date": "day", "station": "gauge", "rain_mm": "depth_mm"})


# --- cleaning -------------------------------------------------------------------

@register("i1_clean_sentinels", fx.sql(body="""
SELECT rid, station_id, CASE WHEN rain_mm = 9999e0 THEN NULL WHEN rain_mm = 8888e0 THEN 0e0
                             ELSE rain_mm END AS rain_mm FROM readings"""),
          "rid:i station_id:s rain_mm:f")
def i1_clean_sentinels(spark, sf_dir):
    return C.clean_sentinels(fx.readings(spark, sf_dir)).select("rid", "station_id", "rain_mm")


@register("i2_duplicate_keys", fx.sql(body="""
SELECT station, obs_date, count(*) AS n_rows FROM cleaned GROUP BY station, obs_date
HAVING count(*) > 1"""), "station:s obs_date:d n_rows:i")
def i2_duplicate_keys(spark, sf_dir):
    return C.duplicate_keys(fx.cleaned(spark, sf_dir))


@register("i3_daily_mean", fx.sql(body="SELECT * FROM daily"), "station:s obs_date:d rain_mm:f")
def i3_daily_mean(spark, sf_dir):
    return C.daily_mean(fx.cleaned(spark, sf_dir))


@register("i5_clip_lower", fx.sql(body="""
SELECT rid, CASE WHEN rain_mm IS NOT NULL THEN greatest(rain_mm - 50e0, 0e0) END AS shifted
FROM readings"""), "rid:i shifted:f")
def i5_clip_lower(spark, sf_dir):
    """I5 on values shifted by −50 mm so that negatives exist."""
    r = fx.readings(spark, sf_dir).select("rid", (F.col("rain_mm") - 50.0).alias("shifted"))
    return C.clip_lower(r, "shifted", 0.0)


@register("j3_densify", fx.sql(body="SELECT * FROM grid"), "station:s obs_date:d rain_mm:f")
def j3_densify(spark, sf_dir):
    return fx.grid(spark, sf_dir)


@register("u2_station_catalog", fx.sql(body="SELECT DISTINCT station_id, name FROM readings"),
          "station_id:s name:s")
def u2_station_catalog(spark, sf_dir):
    return C.station_catalog(fx.readings(spark, sf_dir))


@register("u1_union_by_name", fx.sql(body="""
SELECT station_id, rain_mm, NULL AS trace FROM readings WHERE station_id LIKE '1371%'
UNION ALL SELECT station_id, NULL AS rain_mm, trace FROM readings WHERE station_id LIKE '1301%'"""),
          "station_id:s rain_mm:f trace:s")
def u1_union_by_name(spark, sf_dir):
    """Union by name with a missing column on each side (NULL-filled)."""
    r = fx.readings(spark, sf_dir)
    a = r.filter(F.col("station_id").startswith("1371")).select("station_id", "rain_mm")
    b = r.filter(F.col("station_id").startswith("1301")).select("trace", "station_id")
    return a.unionByName(b, allowMissingColumns=True)


# --- dictionary joins -------------------------------------------------------------

# A station dimension: long name → short name; two names are deliberately unmapped.
NAME_MAP = {"URGENT": "North_Ridge", "HIGH": "Mill_Creek", "MEDIUM": "Old_Harbour"}


@register("j1_map_names", fx.sql(f"""
dim AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in NAME_MAP.items())})
        AS t(name, short_name))""", body="""
SELECT r.rid, r.name, d.short_name FROM readings r LEFT JOIN dim d USING (name)"""),
          "rid:i name:s short_name:s")
def j1_map_names(spark, sf_dir):
    """Dictionary lookup, unmatched → NULL."""
    return C.map_names(fx.readings(spark, sf_dir), NAME_MAP, "name", "short_name").select("rid", "name", "short_name")


@register("j2_map_names_default", fx.sql(f"""
dim AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in NAME_MAP.items())})
        AS t(name, short_name))""", body="""
SELECT r.rid, coalesce(d.short_name, r.name) AS station_name FROM readings r LEFT JOIN dim d USING (name)"""),
          "rid:i station_name:s")
def j2_map_names_default(spark, sf_dir):
    """Lookup with pass-through default (``dict.get(x, x)``)."""
    r = C.map_names(fx.readings(spark, sf_dir), NAME_MAP, "name", "station_name", keep_unmatched=True)
    return r.select("rid", "station_name")


# --- labels and rule comparison ----------------------------------------------------

@register("x8_label_extreme", fx.sql("""
thr AS (SELECT station, quantile_cont(rain_mm, 0.95) AS threshold FROM grid WHERE rain_mm IS NOT NULL
        GROUP BY station)""", body="""
SELECT g.station, g.obs_date, g.rain_mm, t.threshold, CAST(coalesce(g.rain_mm > t.threshold, false) AS INT) AS label
FROM grid g LEFT JOIN thr t USING (station)"""),
          "station:s obs_date:d rain_mm:f threshold:f label:i")
def x8_label_extreme(spark, sf_dir):
    """Strict ``value > P95`` label per station; a missing day is 0."""
    return L.label_extreme(fx.grid(spark, sf_dir))


@register("x8_label_fit_until", fx.sql("""
thr AS (SELECT station, quantile_cont(rain_mm, 0.95) AS threshold FROM grid
        WHERE rain_mm IS NOT NULL AND obs_date < DATE '2000-01-01' GROUP BY station)""", body="""
SELECT g.station, sum(CAST(coalesce(g.rain_mm > t.threshold, false) AS INT)) AS n_pos, max(t.threshold) AS threshold
FROM grid g LEFT JOIN thr t USING (station) GROUP BY g.station"""), "station:s n_pos:i threshold:f")
def x8_label_fit_until(spark, sf_dir):
    """X8 with the threshold fitted on the training period only (leak guard, T3)."""
    lab = L.label_extreme(fx.grid(spark, sf_dir), fit_until="2000-01-01")
    return lab.groupBy("station").agg(F.sum("label").alias("n_pos"), F.max("threshold").alias("threshold"))


@register("x9_compare_thresholds", fx.sql("""
q AS (SELECT station, quantile_cont(rain_mm, 0.95) AS thr_q FROM grid WHERE rain_mm IS NOT NULL GROUP BY station),
qw AS (SELECT station, quantile_cont(rain_mm, 0.95) AS thr_q_wet FROM grid WHERE rain_mm > 0 GROUP BY station),
c AS (SELECT g.station, count(g.rain_mm) AS n_valid, count_if(g.rain_mm > q.thr_q) AS n_p,
             count_if(g.rain_mm > 150) AS n_mm150, count_if(g.rain_mm > 50) AS n_mm50, any_value(q.thr_q) AS thr_q
      FROM grid g JOIN q USING (station) GROUP BY g.station)""", body="""
SELECT c.station, qw.thr_q_wet, r.rule, r.threshold, r.n_extreme, r.n_extreme * 100.0 / c.n_valid AS pct_extreme
FROM c JOIN qw USING (station),
LATERAL (SELECT 'p' AS rule, c.thr_q AS threshold, c.n_p AS n_extreme
         UNION ALL SELECT 'mm150', 150.0, c.n_mm150 UNION ALL SELECT 'mm50', 50.0, c.n_mm50) r"""),
          "station:s thr_q_wet:f rule:s threshold:f n_extreme:i pct_extreme:f")
def x9_compare_thresholds(spark, sf_dir):
    """Extreme-day counts under P95, 150 mm and 50 mm per station."""
    return L.compare_thresholds(fx.grid(spark, sf_dir))


# --- typed CSV hand-off ---------------------------------------------------------------

@register("s3_csv_roundtrip", fx.sql(body="SELECT station, obs_date, rain_mm FROM grid"),
          "station:s obs_date:d rain_mm:f")
def s3_csv_roundtrip(spark, sf_dir):
    """S3 + S2: write the dense panel as CSV with a header (partitioned by year) into
    the shared folder, read it back with an explicit schema and date parsing."""
    import os
    import uuid

    from pyspark.sql import types as T

    from stormlens.session import ensure_checkpoint_dir
    from stormlens.sources.readings import read_csv_typed, write_table
    path = os.path.join(ensure_checkpoint_dir(spark), f"csv-{uuid.uuid4().hex}")
    g = fx.grid(spark, sf_dir).withColumn("year", F.year("obs_date"))
    write_table(g, path, fmt="csv", partition_by=("year",))
    schema = T.StructType([T.StructField("station", T.StringType()), T.StructField("obs_date", T.StringType()),
                           T.StructField("rain_mm", T.DoubleType())])
    return read_csv_typed(spark, path, schema, date_cols=("obs_date",)).select("station", "obs_date", "rain_mm")


@register("o3_sorted_output", fx.sql(body="""
SELECT row_number() OVER (ORDER BY rain_mm DESC NULLS LAST, station, obs_date) - 1 AS place, station, obs_date, rain_mm FROM grid"""),
          "place:i station:s obs_date:d rain_mm:f")
def o3_sorted_output(spark, sf_dir):
    """O3: the dense panel written with the largest values first, and the place at which each row then lies in the files."""
    import os
    import uuid

    from stormlens.session import ensure_checkpoint_dir
    from stormlens.sources.readings import read_in_order, write_sorted
    path = os.path.join(ensure_checkpoint_dir(spark), f"sorted-{uuid.uuid4().hex}")
    write_sorted(fx.grid(spark, sf_dir).select("station", "obs_date", "rain_mm"), path, [F.desc_nulls_last("rain_mm"), "station", "obs_date"])
    return read_in_order(spark, path).select("place", "station", "obs_date", "rain_mm")


@register("f12_feature_columns", fx.sql("""
feats AS (SELECT station, obs_date, rain_mm, CAST(lag(rain_mm, 1) OVER w AS DOUBLE) AS lag1, CAST(lag(rain_mm, 2) OVER w AS DOUBLE) AS lag2,
                 avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7
          FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date))""", body="""
SELECT feature, count(*) AS n, avg(v) AS mean
FROM (UNPIVOT (SELECT * EXCLUDE (station, obs_date, rain_mm) FROM feats) ON COLUMNS(*) INTO NAME feature VALUE v) GROUP BY feature"""),
          "feature:s n:i mean:f")
def f12_feature_columns(spark, sf_dir):
    """the feature columns of a frame - all but the keys and the value of the day - each with its number of values and mean."""
    from stormlens.operators import features as FE
    frame = FE.add_rolling(FE.add_lags(fx.grid(spark, sf_dir), (1, 2)), (7,))
    names = C.feature_columns(frame, ["station", "obs_date", "rain_mm"])
    long = frame.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v")) for c in names])))
    return long.filter("v is not null").groupBy("feature").agg(F.count("*").alias("n"), F.avg("v").alias("mean"))


@register("s5_timestamp_to_day", fx.sql(body="""
SELECT o_orderkey AS rid, CAST(o_orderdate AS DATE) AS obs_date FROM orders"""), "rid:i obs_date:d")
def s5_timestamp_to_day(spark, sf_dir):
    """Day of a timestamp column (zone-less timestamps: no shift)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("rid"), parse_obs_date("o_orderdate").alias("obs_date"))
