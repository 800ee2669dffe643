"""DuckDB oracle SQL for the registered queries.

Each statement recomputes a query from the driver tables with plain SQL;
the trip view follows the fixture projection of ``events``. Float outputs
are rounded to 6 decimals and integer outputs cast to BIGINT on both sides.
"""

from __future__ import annotations

# Numeric and categorical feature lists of the two tasks.
REG_NUM = ["passenger_count", "lpep_pickup_datetime_week", "lpep_pickup_datetime_day",
           "lpep_pickup_datetime_hour", "lpep_pickup_datetime_minute",
           "lpep_pickup_datetime_dayofweek"]
REG_CAT = ["PU_DO", "store_and_fwd_flag"]
CLS_NUM = ["passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
           "improvement_surcharge", "tolls_amount", "lpep_pickup_datetime_week",
           "lpep_pickup_datetime_day", "lpep_pickup_datetime_hour",
           "lpep_pickup_datetime_minute", "lpep_pickup_datetime_dayofweek"]
CLS_CAT = ["PU_DO", "store_and_fwd_flag", "RatecodeID", "trip_type"]

TRIPS = """trips AS (
  SELECT event_id AS trip_id,
    ts AS lpep_pickup_datetime,
    ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS lpep_dropoff_datetime,
    CAST(user_id AS VARCHAR) AS PULocationID,
    CAST(event_id % 7 AS VARCHAR) AS DOLocationID,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(1 + user_id % 3 AS DOUBLE) END AS RatecodeID,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(1 + event_id % 2 AS DOUBLE) END AS trip_type,
    CASE WHEN event_type IN ('view','click','purchase') THEN 1.0::DOUBLE WHEN event_type = 'error' THEN 2.0::DOUBLE ELSE NULL END AS payment_type,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(1 + event_id % 5 AS DOUBLE) END AS passenger_count,
    value * 0.2::DOUBLE AS trip_distance,
    2.5::DOUBLE + value * 0.5::DOUBLE AS fare_amount,
    CASE WHEN hour(ts) >= 16 AND hour(ts) < 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS extra,
    0.5::DOUBLE AS mta_tax,
    0.3::DOUBLE AS improvement_surcharge,
    CASE WHEN event_id % 9 = 0 THEN 6.55::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN value > 30 AND event_id % 5 <> 0 THEN value * 0.15::DOUBLE ELSE 0.0::DOUBLE END AS tip_amount,
    strftime(ts, '%Y-%m') AS year_month
  FROM events
),
tp AS (SELECT *, PULocationID || '_' || DOLocationID AS PU_DO FROM trips),
pc AS (SELECT year_month, PU_DO, count(*) AS cnt FROM tp WHERE PU_DO IS NOT NULL GROUP BY 1, 2),
reduced AS (
  SELECT tp.* FROM tp
  WHERE EXISTS (SELECT 1 FROM pc WHERE pc.year_month = tp.year_month AND pc.PU_DO = tp.PU_DO AND pc.cnt > 10)
),
cal AS (
  SELECT *,
    (epoch_us(lpep_dropoff_datetime) - epoch_us(lpep_pickup_datetime)) / 60000000.0::DOUBLE AS duration_raw,
    CAST(weekofyear(lpep_pickup_datetime) AS DOUBLE) AS lpep_pickup_datetime_week,
    CAST(day(lpep_pickup_datetime) AS DOUBLE) AS lpep_pickup_datetime_day,
    CAST(hour(lpep_pickup_datetime) AS DOUBLE) AS lpep_pickup_datetime_hour,
    CAST(minute(lpep_pickup_datetime) AS DOUBLE) AS lpep_pickup_datetime_minute,
    CAST(isodow(lpep_pickup_datetime) - 1 AS DOUBLE) AS lpep_pickup_datetime_dayofweek,
    ((trip_id * 7919 + 123) % 1000) < 300 AS is_test
  FROM reduced
),
reg AS (
  SELECT trip_id, is_test, """ + ", ".join(REG_NUM) + ", " + ", ".join(REG_CAT) + """,
    duration_raw AS duration
  FROM cal WHERE duration_raw BETWEEN 1 AND 60
),
cls AS (
  SELECT trip_id, is_test, """ + ", ".join(CLS_NUM) + ", " + ", ".join(CLS_CAT) + """,
    CAST(coalesce(tip_amount > 0, false) AS INTEGER) AS tipped
  FROM cal WHERE payment_type = 1
)"""


def with_trips(body: str) -> str:
    return "WITH " + TRIPS + "\n" + body


def _r(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, 6) AS {alias or expr}"


def mode_sql(src: str, c: str, where: str = "TRUE") -> str:
    """Most frequent non-NULL value, smallest on ties (scalar subquery)."""
    return (f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {src} "
            f"WHERE {c} IS NOT NULL AND {where} GROUP BY {c}) ORDER BY n DESC, v ASC LIMIT 1)")


def _fill_cte(src: str, num: list[str], cat: list[str], name: str = "filled",
              per_side: bool = False) -> str:
    """Mean/mode imputation; train statistics, or each side's own."""
    if per_side:
        stats = ", ".join([f"avg({c}) AS m_{c}" for c in num] +
                          [f"{mode_sql(src, c, f'is_test = o.is_test')} AS m_{c}" for c in cat])
        cols = ", ".join([f"coalesce({src}.{c}, s.m_{c}) AS {c}" for c in num + cat])
        return (f"st AS (SELECT o.is_test, {', '.join(f'avg(o.{c}) AS m_{c}' for c in num)}, "
                + ", ".join(f"{mode_sql(src, c, 'is_test = o.is_test')} AS m_{c}" for c in cat)
                + f" FROM {src} o GROUP BY o.is_test),\n"
                f"{name} AS (SELECT {src}.trip_id, {src}.is_test, {cols} FROM {src} "
                f"JOIN st s ON s.is_test = {src}.is_test)")
    stats = ", ".join([f"avg({c}) AS m_{c}" for c in num] +
                      [f"{mode_sql(src, c, 'NOT is_test')} AS m_{c}" for c in cat])
    cols = ", ".join([f"coalesce({src}.{c}, s.m_{c}) AS {c}" for c in num + cat])
    return (f"st AS (SELECT {stats} FROM {src} WHERE NOT is_test),\n"
            f"{name} AS (SELECT {src}.* EXCLUDE ({', '.join(num + cat)}), {cols} "
            f"FROM {src}, st s)")


SQL: dict[str, str] = {}

SQL["trip_scan"] = with_trips("""
SELECT trip_id, epoch_us(lpep_pickup_datetime) AS pickup_us, epoch_us(lpep_dropoff_datetime) AS dropoff_us,
  PULocationID, DOLocationID, store_and_fwd_flag, RatecodeID, trip_type, payment_type, passenger_count,
  trip_distance, fare_amount, extra, mta_tax, improvement_surcharge, tolls_amount, tip_amount, year_month
FROM trips""")

SQL["month_summary"] = with_trips("""
SELECT year_month, count(*) AS trips, count(DISTINCT PU_DO) AS distinct_pairs,
  min(epoch_us(lpep_pickup_datetime)) AS first_pickup_us, max(epoch_us(lpep_pickup_datetime)) AS last_pickup_us
FROM tp GROUP BY year_month""")

SQL["pair_counts"] = with_trips("SELECT year_month, PU_DO, cnt AS count FROM pc")

SQL["frequent_pair_trips"] = with_trips(
    "SELECT trip_id, year_month, PULocationID, DOLocationID FROM reduced")

SQL["reduction_report"] = with_trips("""
SELECT year_month, count(*) AS distinct_pairs, CAST(sum(cnt) AS BIGINT) AS total_rows,
  CAST(sum(CASE WHEN cnt > 10 THEN 1 ELSE 0 END) AS BIGINT) AS kept_pairs,
  CAST(coalesce(sum(CASE WHEN cnt > 10 THEN cnt END), 0) AS BIGINT) AS kept_rows
FROM pc GROUP BY year_month""")

SQL["top_pairs"] = with_trips("""
SELECT year_month, PU_DO, count, rank FROM (
  SELECT year_month, PU_DO, cnt AS count,
    row_number() OVER (PARTITION BY year_month ORDER BY cnt DESC, PU_DO ASC) AS rank
  FROM pc) WHERE rank <= 5""")

SQL["reduced_sink_roundtrip"] = with_trips(
    "SELECT trip_id, year_month, PULocationID, DOLocationID, fare_amount FROM reduced")

SQL["sampled_trips"] = with_trips(
    "SELECT trip_id, year_month FROM reduced WHERE ((trip_id * 15485863 + 124) % 1009) < 504")

SQL["sample_then_split"] = with_trips("""
SELECT ((trip_id * 7919 + 123) % 1000) < 300 AS is_test, count(*) AS rows, CAST(sum(trip_id) AS BIGINT) AS key_sum
FROM reduced WHERE ((trip_id * 15485863 + 124) % 1009) < 303 GROUP BY 1""")

SQL["validation_share"] = with_trips("""
SELECT is_test, count(*) AS rows,
  CAST(sum(CASE WHEN ((trip_id * 32452843 + 125) % 1013) < 101 THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows
FROM cls GROUP BY is_test""")

SQL["duration_target"] = with_trips(
    "SELECT trip_id, round(duration_raw, 6) AS duration FROM cal WHERE duration_raw BETWEEN 1 AND 60")

SQL["tipped_target"] = with_trips(
    "SELECT trip_id, tipped, false AS has_tip FROM cls")

SQL["regression_columns"] = with_trips(
    "SELECT trip_id, " + ", ".join(_r(c) for c in REG_NUM) + ", " + ", ".join(REG_CAT)
    + ", round(duration, 6) AS duration FROM reg")

SQL["classification_columns"] = with_trips(
    "SELECT trip_id, " + ", ".join(_r(c) for c in CLS_NUM) + ", " + ", ".join(CLS_CAT)
    + ", tipped FROM cls")

SQL["split_assignment"] = with_trips("SELECT trip_id, is_test FROM reg")


def _fill_stats_sql(src, num, cat):
    return with_trips(
        f"SELECT is_test, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in num) + ", "
        + ", ".join(f"{mode_sql(src, c, 'is_test = o.is_test')} AS {c}" for c in cat)
        + f" FROM {src} o GROUP BY is_test")


SQL["regression_fill_statistics"] = _fill_stats_sql("reg", REG_NUM, REG_CAT)
SQL["classification_fill_statistics"] = _fill_stats_sql("cls", CLS_NUM, CLS_CAT)

SQL["imputed_regression_features"] = with_trips(
    "," + _fill_cte("reg", REG_NUM, REG_CAT) + "\nSELECT trip_id, is_test, "
    + ", ".join(_r(c) for c in REG_NUM) + ", " + ", ".join(REG_CAT) + " FROM filled")

SQL["imputed_within_sides"] = with_trips(
    "," + _fill_cte("cls", CLS_NUM, CLS_CAT, per_side=True) + "\nSELECT trip_id, is_test, "
    + ", ".join(_r(c) for c in CLS_NUM) + ", " + ", ".join(CLS_CAT) + " FROM filled")

SQL["scaled_classification_features"] = with_trips(
    "," + _fill_cte("cls", CLS_NUM, CLS_CAT) + ",\nsc AS (SELECT "
    + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in CLS_NUM)
    + " FROM filled WHERE NOT is_test)\nSELECT trip_id, is_test, "
    + ", ".join(f"round(({c} - a_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS {c}"
                for c in CLS_NUM) + " FROM filled, sc")


def _slot_sql():
    parts = []
    joins = []
    for i, c in enumerate(REG_CAT):
        parts.append(f"""CAST(k{i}.slot AS BIGINT) AS {c}_slot,
  CAST(CASE WHEN k{i}.slot >= 1 THEN k{i}.slot - 1 END AS BIGINT) AS {c}_slot_drop_first,
  CAST((SELECT count(*) FROM v{i}) AS BIGINT) AS {c}_width""")
        joins.append(f"LEFT JOIN v{i} k{i} ON k{i}.val = filled.{c}")
    vals = ",\n".join(
        f"v{i} AS (SELECT val, row_number() OVER (ORDER BY val) - 1 AS slot FROM "
        f"(SELECT DISTINCT {c} AS val FROM filled WHERE NOT is_test AND {c} IS NOT NULL))"
        for i, c in enumerate(REG_CAT))
    return with_trips("," + _fill_cte("reg", REG_NUM, REG_CAT) + ",\n" + vals +
                      "\nSELECT trip_id, is_test, " + ",\n  ".join(parts) +
                      " FROM filled " + " ".join(joins))


SQL["onehot_slots"] = _slot_sql()


def _codes_sql():
    vals = ",\n".join(
        f"v{i} AS (SELECT val, row_number() OVER (ORDER BY val) - 1 AS code FROM "
        f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS val FROM filled WHERE NOT is_test AND {c} IS NOT NULL))"
        for i, c in enumerate(CLS_CAT))
    cols = ", ".join(
        f"CAST(coalesce(k{i}.code, (SELECT count(*) FROM v{i})) AS BIGINT) AS {c}_code"
        for i, c in enumerate(CLS_CAT))
    joins = " ".join(f"LEFT JOIN v{i} k{i} ON k{i}.val = CAST(filled.{c} AS VARCHAR)"
                     for i, c in enumerate(CLS_CAT))
    return with_trips("," + _fill_cte("cls", CLS_NUM, CLS_CAT) + ",\n" + vals +
                      f"\nSELECT trip_id, {cols} FROM filled {joins}")


SQL["category_codes"] = _codes_sql()

SQL["regression_baseline"] = with_trips("""
, m AS (SELECT avg(duration) AS mu FROM reg WHERE NOT is_test)
SELECT round(sqrt(avg(CASE WHEN NOT is_test THEN (duration - mu) * (duration - mu) END)), 6) AS rmse_train,
  round(sqrt(avg(CASE WHEN is_test THEN (duration - mu) * (duration - mu) END)), 6) AS rmse_test,
  round(avg(CASE WHEN NOT is_test THEN abs(duration - mu) END), 6) AS mae_train,
  round(avg(CASE WHEN is_test THEN abs(duration - mu) END), 6) AS mae_test
FROM reg, m""")


def _cls_report_sql(scored_cte: str, pred_expr: str, score_expr: str,
                    prelude=None) -> str:
    """Confusion metrics + AUC (ties half) per side, pivoted to one row.
    ``prelude`` opens the WITH list (default: the trip views)."""
    return (prelude or with_trips)(f""",
{scored_cte},
pr AS (SELECT is_test, tipped AS y, {pred_expr} AS yhat, {score_expr} AS s FROM scored),
conf AS (
  SELECT is_test,
    avg(CASE WHEN y = yhat THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy,
    coalesce(sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 END)::DOUBLE / nullif(sum(CASE WHEN yhat = 1 THEN 1 ELSE 0 END), 0), 0::DOUBLE) AS precision,
    coalesce(sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 END)::DOUBLE / nullif(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END), 0), 0::DOUBLE) AS recall,
    coalesce(2.0::DOUBLE * sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 ELSE 0 END) / nullif(2 * sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN y = 0 AND yhat = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN y = 1 AND yhat = 0 THEN 1 ELSE 0 END), 0), 0::DOUBLE) AS f1_score
  FROM pr GROUP BY is_test),
g AS (SELECT is_test, s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg FROM pr GROUP BY is_test, s),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY is_test ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS negb FROM g),
auc AS (SELECT is_test, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (negb + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) END AS roc_auc FROM c GROUP BY is_test),
side AS (SELECT conf.*, auc.roc_auc FROM conf LEFT JOIN auc USING (is_test))
SELECT """ + ", ".join(
        f"round(max(CASE WHEN {'' if t else 'NOT '}is_test THEN {m} END), 6) AS {m}_{'test' if t else 'train'}"
        for m in ["accuracy", "precision", "recall", "f1_score", "roc_auc"] for t in (False, True))
        + " FROM side")


SQL["classification_baseline"] = _cls_report_sql(
    "md AS (SELECT " + mode_sql("cls", "tipped", "NOT is_test") + " AS mo),\n"
    "scored AS (SELECT cls.*, md.mo AS pred, CASE WHEN md.mo = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p1 FROM cls, md)",
    "pred", "p1")

SQL["threshold_report"] = _cls_report_sql(
    "rate AS (SELECT PU_DO, avg(tipped) AS pair_rate FROM cls WHERE NOT is_test GROUP BY PU_DO),\n"
    "prior AS (SELECT avg(tipped) AS pr FROM cls WHERE NOT is_test),\n"
    "scored AS (SELECT cls.*, coalesce(rate.pair_rate, prior.pr) AS p1 FROM cls LEFT JOIN rate USING (PU_DO), prior)",
    "CASE WHEN 1.0::DOUBLE - p1 >= 0.5::DOUBLE THEN 0 ELSE 1 END", "p1")

SQL["fare_score_auc"] = with_trips("""
, g AS (SELECT is_test, fare_amount AS s, sum(CASE WHEN tipped = 1 THEN 1 ELSE 0 END) AS pos,
          sum(CASE WHEN tipped = 0 THEN 1 ELSE 0 END) AS neg FROM cls GROUP BY is_test, fare_amount),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY is_test ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS negb FROM g)
SELECT is_test, round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (negb + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) END, 6) AS roc_auc
FROM c GROUP BY is_test""")


def _one_feature_sql(x: str, slope: str, where: str = "TRUE") -> str:
    """Closed-form one-feature fit on regression train rows; ``slope`` may
    use n, sxy, sxx (centered sums over train rows)."""
    return with_trips(f""",
d AS (SELECT * FROM reg WHERE {x} IS NOT NULL AND {where}),
s AS (SELECT count(*) AS n, regr_sxy(duration, {x}) AS sxy, regr_sxx(duration, {x}) AS sxx,
        avg(duration) AS my, avg({x}) AS mx FROM d WHERE NOT is_test),
b AS (SELECT {slope} AS b1, my, mx FROM s),
p AS (SELECT d.is_test, d.duration AS y, (b.my - b.b1 * b.mx) + b.b1 * d.{x} AS yhat FROM d, b)
SELECT round((SELECT my - b1 * mx FROM b), 6) AS intercept, round((SELECT b1 FROM b), 6) AS coefficient,
  round(sqrt(avg(CASE WHEN NOT is_test THEN (y - yhat) * (y - yhat) END)), 6) AS rmse_train,
  round(sqrt(avg(CASE WHEN is_test THEN (y - yhat) * (y - yhat) END)), 6) AS rmse_test,
  round(avg(CASE WHEN NOT is_test THEN abs(y - yhat) END), 6) AS mae_train,
  round(avg(CASE WHEN is_test THEN abs(y - yhat) END), 6) AS mae_test
FROM p""")


def _soft(z: str, g: str) -> str:
    return f"sign({z}) * greatest(abs({z}) - ({g}), 0)"


SQL["ols_one_feature"] = _one_feature_sql("lpep_pickup_datetime_hour", "sxy / sxx")
SQL["ridge_one_feature"] = _one_feature_sql("passenger_count", "sxy / (sxx + 1.0)")
SQL["lasso_one_feature"] = _one_feature_sql("passenger_count", f"{_soft('sxy / n', '0.05')} / (sxx / n)")
SQL["elastic_net_one_feature"] = _one_feature_sql(
    "passenger_count", f"{_soft('sxy / n', '0.05 * 0.5')} / (sxx / n + 0.05 * 0.5)")

SQL["lineitem_price_ols"] = """
WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b1, regr_intercept(l_extendedprice, l_quantity) AS b0,
                  count(*) AS n FROM lineitem)
SELECT round(b0, 6) AS intercept, round(b1, 6) AS coefficient,
  round((SELECT sqrt(avg((l_extendedprice - b0 - b1 * l_quantity) * (l_extendedprice - b0 - b1 * l_quantity))) FROM lineitem), 6) AS rmse,
  CAST(n AS BIGINT) AS n
FROM s"""


_FOLDS = """,
tr AS (SELECT trip_id, tipped FROM cls WHERE NOT is_test),
fo AS (SELECT trip_id, tipped,
  CAST((row_number() OVER (PARTITION BY tipped ORDER BY (trip_id * 104729 + 123) % 2147483647, trip_id) - 1) % 10 AS INTEGER) AS fold
  FROM tr)"""

SQL["stratified_folds"] = with_trips(_FOLDS + "\nSELECT trip_id, tipped, fold FROM fo")
SQL["fold_class_shares"] = with_trips(
    _FOLDS + "\nSELECT fold, tipped, count(*) AS rows FROM fo GROUP BY fold, tipped")
SQL["learning_curve_subsets"] = with_trips(_FOLDS + """,
fs AS (SELECT range AS f FROM range(10)),
ex AS (SELECT fs.f, fo.trip_id,
  row_number() OVER (PARTITION BY fs.f ORDER BY (fo.trip_id * 1299709 + 130) % 2147483629, fo.trip_id) - 1 AS r
  FROM fo, fs WHERE fo.fold <> fs.f),
n0 AS (SELECT count(*) AS n FROM fo WHERE fold <> 0),
sz AS (SELECT DISTINCT greatest(1, CAST(floor((CAST(i AS DOUBLE) / 10.0) * n + 1e-9) AS BIGINT)) AS size
       FROM range(1, 11) t(i), n0)
SELECT CAST(ex.f AS BIGINT) AS fold, CAST(sz.size AS BIGINT) AS train_size, count(*) AS rows,
  CAST(sum(ex.trip_id) AS BIGINT) AS key_sum
FROM ex, sz WHERE ex.r < sz.size GROUP BY ex.f, sz.size""")


_XY_TERMS = " UNION ALL ".join(
    [f"SELECT abs(sum({c} * duration)) AS v FROM t" for c in REG_NUM] +
    [f"SELECT abs(sum(duration)) AS v FROM t GROUP BY {c}" for c in REG_CAT])



def _alphas_sql(l1_ratio: float) -> str:
    return with_trips(
        "," + _fill_cte("reg", REG_NUM, REG_CAT) + f""",
t AS (SELECT * FROM filled WHERE NOT is_test),
xy AS ({_XY_TERMS}),
am AS (SELECT max(v) / (SELECT count(*) FROM t) / {l1_ratio} AS amax FROM xy)
SELECT CAST(k AS BIGINT) AS alpha_idx,
  round(pow(10, log10(amax) + k * (-3.0 / 29)), 6) AS alpha,
  round(-(log10(amax) + k * (-3.0 / 29)), 6) AS neg_log10_alpha
FROM am, range(30) r(k)""")


SQL["lasso_path_alphas"] = _alphas_sql(1.0)
SQL["elastic_net_path_alphas"] = _alphas_sql(0.5)
SQL["path_optimality"] = """SELECT path, CAST(k AS BIGINT) AS alpha_idx, true AS optimal
FROM (VALUES ('ridge', 10), ('lasso', 30), ('elastic_net', 30)) p(path, n), range(30) r(k) WHERE k < n"""



def _u(name: str, k: int) -> str:
    """The uniform number of candidate i (a column)."""
    return f"((CAST('0x' || substr(md5('123:' || i || ':{name}:{k}'), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def _lognormal(name: str, mu: float, sigma: float) -> str:
    return f"exp({mu}::DOUBLE + {sigma}::DOUBLE * sqrt(-2 * ln({_u(name, 1)})) * cos(2 * pi() * {_u(name, 2)}))"


SQL["search_candidates"] = with_trips(f"""
SELECT m.year_month, CAST(i AS BIGINT) AS candidate, round({_lognormal('alpha', -1, 0.5)}, 6) AS alpha,
  round(0.5::DOUBLE + 1.5::DOUBLE * {_u('eta', 1)}, 6) AS eta, CAST(1 + floor(4 * {_u('max_depth', 1)}) AS INTEGER) AS max_depth,
  floor(3 + 2 * {_u('leaf_depth', 1)} + 0.5::DOUBLE)::DOUBLE AS leaf_depth
FROM (SELECT DISTINCT year_month FROM trips) m, range(20) r(i)""")

SQL["ridge_one_feature_search"] = with_trips(f""",
t AS (SELECT passenger_count AS x, duration AS y, is_test FROM reg WHERE passenger_count IS NOT NULL),
s AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, sum(x * x) - count(*) * avg(x) * avg(x) AS sxx,
        sum(x * y) - count(*) * avg(x) * avg(y) AS sxy FROM t WHERE NOT is_test),
v AS (SELECT i, {_lognormal('alpha', 0, 1)} AS alpha FROM range(5) r(i)),
c AS (SELECT CAST(i AS BIGINT) AS candidate, alpha, my - sxy / (sxx + alpha) * mx AS b0, sxy / (sxx + alpha) AS b1 FROM s, v),
e AS (SELECT candidate, alpha, b0, b1,
        sqrt(avg(CASE WHEN NOT is_test THEN (y - b0 - b1 * x) * (y - b0 - b1 * x) END)) AS rmse_train,
        sqrt(avg(CASE WHEN is_test THEN (y - b0 - b1 * x) * (y - b0 - b1 * x) END)) AS rmse_test
      FROM c, t GROUP BY candidate, alpha, b0, b1)
SELECT candidate, round(alpha, 6) AS alpha, round(b0, 6) AS intercept, round(b1, 6) AS coefficient,
  round(rmse_train, 6) AS rmse_train, round(rmse_test, 6) AS rmse_test,
  row_number() OVER (ORDER BY rmse_test, candidate) AS rank, row_number() OVER (ORDER BY rmse_test, candidate) = 1 AS wins FROM e""")

_MONTHS = """,
f AS (SELECT *, event_month FROM (SELECT tp.*, 1 + trip_id % 4 AS event_month FROM tp)),
d AS (SELECT *, (epoch_us(lpep_dropoff_datetime) - epoch_us(lpep_pickup_datetime)) / 60000000.0::DOUBLE AS y FROM f)"""
SQL["monthly_files_summary"] = with_trips(_MONTHS + """
SELECT '2022-0' || event_month AS year_month, count(*) AS trips, count(DISTINCT PU_DO) AS distinct_pairs,
  CAST(sum(CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tipped FROM f GROUP BY event_month""")
SQL["next_month_scoring"] = with_trips(_MONTHS + """,
g AS (SELECT PU_DO, count(*) AS n, sum(y) AS s FROM d WHERE event_month < 4 AND y BETWEEN 1 AND 60 GROUP BY PU_DO),
b AS (SELECT sum(s / (n + 1.0::DOUBLE)) / sum(n / (n + 1.0::DOUBLE)) AS b FROM g)
SELECT d.trip_id, round(b.b + coalesce((g.s - g.n * b.b) / (g.n + 1.0::DOUBLE), 0), 6) AS predicted_duration
FROM d LEFT JOIN g USING (PU_DO), b WHERE d.event_month = 4""")

SQL["logistic_one_flag"] = with_trips(""",
o AS (SELECT store_and_fwd_flag = 'Y' AS flag, ln(avg(tipped) / (1 - avg(tipped))) AS odds
      FROM cls WHERE NOT is_test AND store_and_fwd_flag IS NOT NULL GROUP BY 1)
SELECT round(max(CASE WHEN NOT flag THEN odds END), 4) AS intercept,
  round(max(CASE WHEN flag THEN odds END) - max(CASE WHEN NOT flag THEN odds END), 4) AS coefficient FROM o""")

SQL["boosted_one_round"] = with_trips("""
SELECT fare_amount > 17.5 AS above, round(-1.5 * sum(0.5 - tipped) / (sum(0.25) + 1.0)::DOUBLE, 6) AS leaf
FROM cls WHERE NOT is_test AND fare_amount IS NOT NULL GROUP BY 1""")

SQL["boosted_patience"] = with_trips("""
SELECT CAST(count(*) AS BIGINT) AS valid_rows, true AS kept_best, true AS stopped_in_time, true AS not_worse
FROM cls WHERE NOT is_test AND ((trip_id % 1013) * 32452843 + 125) % 1013 < 101""")

SQL["kmeans_assign_label_centers"] = """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS center, i, avg(CAST(x AS DOUBLE)) AS cx FROM e GROUP BY label, i),
d AS (SELECT e.vec_id, e.label, c.center, sum((CAST(e.x AS DOUBLE) - c.cx) * (CAST(e.x AS DOUBLE) - c.cx)) AS dist
      FROM e JOIN c ON e.i = c.i GROUP BY e.vec_id, e.label, c.center)
SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(arg_min(center, dist) AS BIGINT) AS center
FROM d GROUP BY vec_id, label"""

SQL["embedding_covariance"] = """
WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT CAST(a.i AS BIGINT) AS i, CAST(b.i AS BIGINT) AS j,
  round(covar_samp(CAST(a.x AS DOUBLE), CAST(b.x AS DOUBLE)), 6) AS cov
FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.i, b.i"""


_DOCS = """WITH ld AS (
  SELECT d.doc_id, d.n_chars, l.quality AS tipped, ((d.doc_id * 7919 + 123) % 1000) < 300 AS is_test
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


def _docs_report(scored: str, pred_expr: str, score_expr: str) -> str:
    """The classification report over labeled documents ("tipped" = quality)."""
    return _cls_report_sql(scored, pred_expr, score_expr, prelude=lambda body: _DOCS + body)


SQL["document_quality_baseline"] = _docs_report(
    "md AS (SELECT " + mode_sql("ld", "tipped", "NOT is_test") + " AS mo),\n"
    "scored AS (SELECT ld.*, md.mo AS pred, CASE WHEN md.mo = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p1 FROM ld, md)",
    "pred", "p1")

SQL["document_length_auc"] = _DOCS + """,
g AS (SELECT is_test, CAST(n_chars AS DOUBLE) AS s, sum(CASE WHEN tipped = 1 THEN 1 ELSE 0 END) AS pos,
        sum(CASE WHEN tipped = 0 THEN 1 ELSE 0 END) AS neg FROM ld GROUP BY is_test, n_chars),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY is_test ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS negb FROM g)
SELECT is_test, round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (negb + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) END, 6) AS roc_auc
FROM c GROUP BY is_test"""


SQL["decision_stump"] = with_trips(""",
t AS (SELECT CAST(floor(fare_amount / 10) AS DOUBLE) AS x, tipped AS y FROM cls WHERE NOT is_test),
v AS (SELECT DISTINCT x FROM t),
th AS (SELECT (x + lead(x) OVER (ORDER BY x)) / 2.0::DOUBLE AS thr FROM v),
tot AS (SELECT count(*) AS n, sum(y) AS p FROM t),
s AS (
  SELECT th.thr,
    sum(CASE WHEN t.x <= th.thr THEN 1 ELSE 0 END) AS nl,
    sum(CASE WHEN t.x <= th.thr THEN t.y ELSE 0 END) AS pl
  FROM th, t WHERE th.thr IS NOT NULL GROUP BY th.thr),
g AS (
  SELECT s.thr, s.nl, s.pl, tot.n - s.nl AS nr, tot.p - s.pl AS pr, tot.n, tot.p,
    (1 - power(tot.p::DOUBLE / tot.n, 2) - power((tot.n - tot.p)::DOUBLE / tot.n, 2))
    - (s.nl::DOUBLE / tot.n) * (1 - power(s.pl::DOUBLE / s.nl, 2) - power((s.nl - s.pl)::DOUBLE / s.nl, 2))
    - ((tot.n - s.nl)::DOUBLE / tot.n) * (1 - power((tot.p - s.pl)::DOUBLE / (tot.n - s.nl), 2)
        - power(((tot.n - s.nl) - (tot.p - s.pl))::DOUBLE / (tot.n - s.nl), 2)) AS gain
  FROM s, tot WHERE s.nl > 0 AND s.nl < tot.n),
best AS (SELECT * FROM g ORDER BY gain DESC, thr ASC LIMIT 1)
SELECT * FROM (
  SELECT round(thr, 6) AS threshold, round(gain, 6) AS gain,
    CAST(CASE WHEN pl > nl - pl THEN 1 ELSE 0 END AS BIGINT) AS left_class,
    CAST(CASE WHEN pr > nr - pr THEN 1 ELSE 0 END AS BIGINT) AS right_class
  FROM best WHERE gain > 0) WHERE left_class <> right_class""")

SQL["saved_ols_scoring"] = with_trips(""",
b AS (SELECT regr_slope(duration, lpep_pickup_datetime_hour) AS b1,
             regr_intercept(duration, lpep_pickup_datetime_hour) AS b0 FROM reg WHERE NOT is_test)
SELECT trip_id, round(b0 + b1 * CAST(hour(lpep_pickup_datetime) AS DOUBLE), 6) AS predicted_duration
FROM trips, b""")

SQL["feature_row_guard"] = with_trips("""
SELECT is_test, count(*) AS rows_before, count(*) AS rows_after, 'regression' AS task FROM reg GROUP BY is_test
UNION ALL
SELECT is_test, count(*) AS rows_before, count(*) AS rows_after, 'classification' AS task FROM cls GROUP BY is_test""")
