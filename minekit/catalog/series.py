"""Time series: windows, splits, forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import clean, linear, metrics, reshape, split, timeseries
from .registry import query, table

R = clean.round_numbers

DAILY = "daily AS (SELECT event_type, CAST(ts AS DATE) AS day, round(sum(value), 4) AS total FROM events GROUP BY 1, 2)"
ORDERS = "series AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2)"


def daily(spark, folder) -> DataFrame:
    """Daily value per event type."""
    return table(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.round(F.sum("value"), 4).alias("total")
    )


def sales(spark, folder) -> DataFrame:
    """Daily sales per priority."""
    return table(spark, folder, "orders").groupBy(
        F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


def _lags(n: int, source: str, key: str) -> str:
    cols = ", ".join(f"lag(total, {i}) OVER w AS total_lag_{i}" for i in range(1, n + 1))
    return f"lagged AS (SELECT {key}, day, total AS label, {cols} FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY day) QUALIFY lag(total, {n}) OVER w IS NOT NULL)"


@query("""SELECT DISTINCT event_type, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS day, value AS total FROM events
 WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""")
def prepare_series(spark, folder):
    day = F.when(F.col("event_id") % 11 == 0, "unknown").otherwise(F.date_format("ts", "dd/MM/yyyy"))
    total = F.when(F.col("event_id") % 13 == 0, "-").otherwise(F.col("value").cast("string"))
    raw = table(spark, folder, "events").select("event_type", day.alias('"day"'), total.alias(" total "))
    return timeseries.prepare(raw, "day", "total", ["event_type"], formats=["dd/MM/yyyy"])


@query(f"WITH {DAILY}, {_lags(7, 'daily', 'event_type')} SELECT * FROM lagged")
def lag_table(spark, folder):
    return timeseries.lag_table(daily(spark, folder), "day", "total", 7, ["event_type"])


@query(f"""WITH {DAILY}, p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS pos, count(*) OVER (PARTITION BY event_type) AS n FROM daily)
 SELECT event_type, day, total, pos <= n - greatest(1, round_even(n * 0.25, 0)) AS is_train FROM p""")
def time_split(spark, folder):
    return split.time_split(daily(spark, folder), "day", ["event_type"])


@query(f"""WITH {DAILY}, p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS back FROM daily)
 SELECT event_type, day, total, back > 5 AS is_train FROM p""")
def time_split_fixed(spark, folder):
    return split.series_split(daily(spark, folder), "day", "total", ["event_type"], test_size=5)


@query(f"""WITH {ORDERS}, p AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY day) - 1 AS pos, count(*) OVER (PARTITION BY series) AS n FROM series),
 f AS (SELECT p.*, fold, n - (5 - fold) * (n // 6) AS start, n // 6 AS size FROM p, (SELECT unnest(range(5))::INTEGER AS fold))
 SELECT series, day, total, fold, CASE WHEN pos >= start AND pos < start + size THEN 'test' ELSE 'train' END AS role FROM f WHERE pos < start - 2 OR (pos >= start AND pos < start + size)""")
def expanding_folds(spark, folder):
    return split.expanding_folds(sales(spark, folder), "day", ["series"], 5, gap=2)


@query(f"""WITH {DAILY}, s AS (SELECT event_type, count(*) AS n FROM daily GROUP BY 1) SELECT event_type, CAST(greatest(1, least(5, (n - 7) // 4)) AS BIGINT) AS test_size FROM s""")
def backtest_sizes(spark, folder):
    sizes = daily(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"))
    least = sizes.agg(F.min("n").alias("n")).first()["n"]
    split.backtest_size(least, 7, 3, 5)  # too short a series is an error
    size = F.greatest(F.lit(1), F.least(F.lit(5), F.floor((F.col("n") - 7) / 4)))
    return sizes.select("event_type", size.alias("test_size"))


@query(f"""WITH {DAILY}, m AS (SELECT event_type, max(day) AS d FROM daily GROUP BY 1) SELECT event_type, CAST(i AS INTEGER) AS step, CAST(d + CAST(i AS INTEGER) AS TIMESTAMP)::DATE AS day FROM m, range(1, 15) t(i)""")
def future_calendar(spark, folder):
    return timeseries.future_calendar(daily(spark, folder), "day", 14, ["event_type"])


@query(f"""WITH {ORDERS}, {_lags(1, 'series', 'series')}, c AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY day DESC) AS back FROM lagged),
 m AS (SELECT series, regr_slope(label, total_lag_1) AS b, regr_intercept(label, total_lag_1) AS a FROM c WHERE back > 60 GROUP BY 1)
 SELECT series, day, label, round(a + b * total_lag_1, 2) AS prediction FROM c JOIN m USING (series) WHERE back <= 60""")
def lag_regression_one(spark, folder):
    """One lag per series, fitted before the last sixty days and applied to them."""
    return R(timeseries.lag_holdout(sales(spark, folder), "day", "total", 1, ["series"], 60), 2).drop("alpha")


@query()
def lag_regression(spark, folder):
    made = timeseries.lag_holdout(sales(spark, folder), "day", "total", 7, ["series"], 60)
    return R(metrics.regression(made, ["series"]))


@query(f"""WITH {ORDERS}, {_lags(1, 'series', 'series')}, p AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY day) - 1 AS pos, count(*) OVER (PARTITION BY series) AS n FROM lagged),
 f AS (SELECT p.*, fold, n - (5 - fold) * (n // 6) AS start, n // 6 AS size FROM p, (SELECT unnest(range(5)) AS fold)),
 m AS (SELECT series, fold, regr_slope(label, total_lag_1) AS b, regr_intercept(label, total_lag_1) AS a FROM f WHERE pos < start GROUP BY 1, 2),
 e AS (SELECT series, fold, label AS y, a + b * total_lag_1 AS p FROM f JOIN m USING (series, fold) WHERE pos >= start AND pos < start + size),
 k AS (SELECT series, fold, avg(abs(y - p)) AS mae, avg((y - p) ** 2) AS mse, 1 - avg((y - p) ** 2) / var_pop(y) AS r2, avg(abs((y - p) / y)) * 100 AS mape FROM e GROUP BY 1, 2)
 SELECT series, round(avg(mae), 1) AS MAE, round(avg(sqrt(mse)), 1) AS RMSE, round(avg(r2), 4) AS R2, round(avg(mape), 3) AS MAPE_pct,
 round(stddev_samp(mae), 1) AS MAE_std, round(stddev_samp(sqrt(mse)), 1) AS RMSE_std, round(stddev_samp(r2), 4) AS R2_std, round(stddev_samp(mape), 3) AS MAPE_pct_std FROM k GROUP BY 1""")
def lag_backtest(spark, folder):
    out = timeseries.lag_backtest(sales(spark, folder), "day", "total", 1, ["series"], 5).drop("MSE", "MSE_std")
    digits = {"MAE": 1, "RMSE": 1, "R2": 4, "MAPE_pct": 3}
    return out.withColumns({c: F.round(c, digits[c.removesuffix("_std")]) for c in out.columns if c != "series"})


COEF = (0.5, 0.3, 0.1)


@query(f"""WITH RECURSIVE {DAILY}, l AS (SELECT event_type, arg_max(total, day, 3) AS v, max(day) AS d FROM daily GROUP BY 1),
 r AS (SELECT event_type, d, 0 AS step, v[1] AS a, v[2] AS b, v[3] AS c FROM l
 UNION ALL SELECT event_type, d, step + 1, 10 + {COEF[0]}::DOUBLE * a + {COEF[1]}::DOUBLE * b + {COEF[2]}::DOUBLE * c, a, b FROM r WHERE step < 10)
 SELECT event_type, step, CAST(d + step AS DATE) AS day, round(a, 4) AS forecast FROM r WHERE step > 0""")
def recursive_forecast(spark, folder):
    """Given coefficients, so that SQL can follow the recursion."""
    rows = daily(spark, folder)
    models = rows.select("event_type").distinct().select(
        "event_type", F.array(*map(F.lit, COEF)).alias("coefficients"), F.lit(10.0).alias("intercept")
    )
    return R(timeseries.recursive_forecast(rows, models, "day", "total", 3, 10, ["event_type"]))


@query()
def lag_forecast(spark, folder):
    return R(timeseries.lag_forecast(sales(spark, folder), "day", "total", 7, 30, ["series"]))


@query(f"""WITH RECURSIVE {DAILY}, y AS (SELECT event_type, list(total ORDER BY day) AS y, max(day) AS d FROM daily GROUP BY 1),
 i AS (SELECT *, list_avg(y[1:7]) AS l, (list_avg(y[8:14]) - list_avg(y[1:7])) / 7 AS b FROM y),
 r AS (SELECT event_type, y, d, 8 AS t, l, b, list_transform(y[1:7], lambda v: v - l) AS s FROM i
 UNION ALL SELECT event_type, y, d, t + 1, l2, 0.1::DOUBLE * (l2 - l) + 0.9::DOUBLE * b, list_append(s[2:7], 0.2::DOUBLE * (y[t] - l2) + 0.8::DOUBLE * s[1])
 FROM (SELECT *, 0.5::DOUBLE * (y[t] - s[1]) + 0.5::DOUBLE * (l + b) AS l2 FROM r WHERE t <= len(y)))
 SELECT event_type, CAST(h AS INTEGER) AS step, CAST(d + CAST(h AS INTEGER) AS DATE) AS day, round(l + h * b + s[(h - 1) % 7 + 1], 4) AS forecast FROM r, range(1, 15) q(h) WHERE t = len(y) + 1""")
def holt_winters_fixed(spark, folder):
    out = timeseries.holt_winters(daily(spark, folder), "day", "total", ["event_type"], 7, 14, [(0.5, 0.1, 0.2)])
    return R(out.select("event_type", "step", "day", "forecast"))


@query()
def holt_winters(spark, folder):
    return R(timeseries.holt_winters(sales(spark, folder), "day", "total", ["series"], 7, 30))


@query()
def arima(spark, folder):
    return R(timeseries.arima(sales(spark, folder), "day", "total", ["series"], (1, 1, 1), 30))


@query()
def forecast_comparison(spark, folder):
    made = timeseries.holdout_predictions(sales(spark, folder), "day", "total", ["series"], 30)
    return R(timeseries.compare(made, ["series"]))


@query()
def forecast_backtest(spark, folder):
    """Every forecaster over expanding folds, ranked by the mean RMSE of the folds."""
    return R(timeseries.ranking(daily(spark, folder), "day", "total", ["event_type"], 2, 3, lags=3, period=3, orders=((1, 1, 0),)))


@query()
def holdout_table(spark, folder):
    """Held-out days with the forecast of each model."""
    return R(timeseries.holdout_predictions(daily(spark, folder), "day", "total", ["event_type"], 7, 3))


@query(f"""WITH {ORDERS}, m AS (SELECT series, max(day) AS d, avg(total) AS mean FROM series GROUP BY 1)
 SELECT series, day, total AS actual, NULL::DOUBLE AS forecast FROM series UNION ALL SELECT series, CAST(d + CAST(i AS INTEGER) AS DATE), NULL, round(mean, 2) FROM m, range(1, 31) t(i)""")
def history_and_forecast(spark, folder):
    """A flat forecast after the history, as one chart table."""
    rows = sales(spark, folder)
    mean = rows.groupBy("series").agg(F.round(F.avg("total"), 2).alias("value"))
    ahead = timeseries.future_calendar(rows, "day", 30, ["series"]).join(mean, "series")
    return reshape.history_and_forecast(rows.withColumnRenamed("total", "value"), ahead, ["series", "day"])


@query(f"""WITH {ORDERS}, g AS (SELECT series, (day - lag(day) OVER (PARTITION BY series ORDER BY day)) * 86400.0::DOUBLE AS gap FROM series),
 m AS (SELECT series, gap, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY series ORDER BY n DESC, gap) = 1)
 SELECT series, count(*) AS n_rows, CAST(0 AS BIGINT) AS null_values, max(day) - min(day) + 1 - count(DISTINCT day) AS missing_dates,
 round(count(DISTINCT day) * 100.0::DOUBLE / (max(day) - min(day) + 1), 3) AS completeness_pct, any_value(gap) AS gap_seconds, 'Diaria' AS frequency,
 round(avg(total), 3) AS mean, round(stddev_samp(total), 3) AS std, min(total) AS min, round(quantile_cont(total, 0.25), 3) AS q25, round(quantile_cont(total, 0.5), 3) AS median,
 round(quantile_cont(total, 0.75), 3) AS q75, round(quantile_cont(total, 0.75) - quantile_cont(total, 0.25), 3) AS iqr, max(total) AS max FROM series JOIN m USING (series) GROUP BY 1""")
def calendar_quality(spark, folder):
    return R(timeseries.calendar_quality(sales(spark, folder), "day", "total", ["series"]), 3)


@query("""SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem GROUP BY 1""")
def linear_fit(spark, folder):
    models = linear.fit(table(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity"], ["l_returnflag"])
    return models.select("l_returnflag", F.round(F.col("coefficients")[0], 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


# ---------------------------------------------------------------- trees on lags


def _tree_sql(lags: int, depth: int, bins: int, min_leaf: int, source: str, key: str) -> str:
    """One regression tree per series, grown level by level from bin totals; the last rows are predicted."""
    names = [f"total_lag_{i}" for i in range(1, lags + 1)]
    at = ", ".join(f"coalesce(least({bins - 1}, greatest(0, CAST(floor(({n} - lo_{n}) / nullif(hi_{n} - lo_{n}, 0) * {bins}) AS INTEGER))), 0)" for n in names)
    bounds = ", ".join(f"min({n}) FILTER (is_train) OVER g AS lo_{n}, max({n}) FILTER (is_train) OVER g AS hi_{n}" for n in names)
    parts = [_lags(lags, source, key), f"""p AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY day) AS pos, count(*) OVER (PARTITION BY {key}) AS n FROM lagged),
 cut AS (SELECT *, pos <= n - greatest(1, round_even(n * 0.25, 0)) AS is_train FROM p),
 bounded AS (SELECT *, {bounds} FROM cut WINDOW g AS (PARTITION BY {key})),
 rows_0 AS (SELECT {key}, day, label, is_train, [{at}] AS bins, 1 AS node FROM bounded)"""]
    for d in range(depth):
        parts.append(f"""cells_{d} AS (SELECT {key}, node, label, unnest(bins) AS bin, generate_subscripts(bins, 1) AS feature FROM rows_{d} WHERE is_train AND node >= {2 ** d}),
 hist_{d} AS (SELECT {key}, node, feature, bin, count(*) AS n, sum(label) AS s FROM cells_{d} GROUP BY ALL),
 cum_{d} AS (SELECT {key}, node, feature, bin, sum(n) OVER l AS nl, sum(s) OVER l AS sl, sum(n) OVER w AS n, sum(s) OVER w AS s FROM hist_{d}
   WINDOW w AS (PARTITION BY {key}, node, feature), l AS (PARTITION BY {key}, node, feature ORDER BY bin)),
 gain_{d} AS (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS raw FROM cum_{d} WHERE nl >= {min_leaf} AND n - nl >= {min_leaf}),
 best_{d} AS (SELECT {key}, node, feature, bin FROM gain_{d} WHERE raw > (s * s / n + sl * sl / nl) * 1e-12 AND round(raw, 6) > 0
   QUALIFY row_number() OVER (PARTITION BY {key}, node ORDER BY round(raw, 6) DESC, feature, bin) = 1),
 rows_{d + 1} AS (SELECT r.{key}, day, label, is_train, bins, CASE WHEN b.bin IS NULL THEN r.node ELSE 2 * r.node + CAST(bins[feature] > b.bin AS INTEGER) END AS node
   FROM rows_{d} r LEFT JOIN best_{d} b ON r.{key} = b.{key} AND r.node = b.node)""")
    parts.append(f"leaves AS (SELECT {key}, node, avg(label) AS prediction FROM rows_{depth} WHERE is_train GROUP BY ALL)")
    return f"""WITH {{}}, {", ".join(parts)}
 SELECT r.{key}, day, label, round(prediction, 6) AS prediction FROM rows_{depth} r LEFT JOIN leaves l ON r.{key} = l.{key} AND r.node = l.node WHERE NOT is_train"""


@query(_tree_sql(1, 1, 16, 1, "daily", "event_type").format(DAILY))
def lag_stump(spark, folder):
    found = timeseries.lag_tree_holdout(daily(spark, folder), "day", "total", 1, ["event_type"], depth=1, bins=16)
    return found.withColumn("prediction", F.round("prediction", 6))


@query(_tree_sql(5, 3, 32, 5, "series", "series").format(ORDERS))
def lag_trees(spark, folder):
    found = timeseries.lag_tree_holdout(sales(spark, folder), "day", "total", 5, ["series"], depth=3, min_leaf=5)
    return found.withColumn("prediction", F.round("prediction", 6))


@query()
def lag_forest_backtest(spark, folder):
    return timeseries.lag_tree_backtest(daily(spark, folder), "day", "total", 3, ["event_type"], 3, kind="forest", depth=3, rounds=10)


@query()
def lag_boosted_forecast(spark, folder):
    return timeseries.lag_tree_forecast(daily(spark, folder), "day", "total", 3, 14, ["event_type"], kind="boosted", depth=2, rounds=5)
