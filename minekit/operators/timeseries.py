"""Preparation, lag models, exponential smoothing, ARIMA and back-tests for many series at once."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.bounds import GROUP_ROWS, attach, complete_rows, has_large_group, join_facts, limit_of, pinned, require
from ..plans.ordering import lagged, row_numbers
from . import clean, linear, metrics, profile, reshape, split, trees

# Smoothing weights that are tried when none are given: level, trend, season.
GRID = tuple(itertools.product((0.2, 0.5, 0.8), (0.01, 0.1, 0.3), (0.05, 0.2, 0.5)))


def prepare(
    df: DataFrame, time: str, value: str, by: Sequence[str] = (), drop_duplicates: bool = True,
    formats: Sequence[str] = (),
) -> DataFrame:
    """Clean headers, parsed dates, numeric values, no nulls, no repeated rows."""
    df = clean.strip_header_quotes(df)
    require(df, time, value, *by)
    rows = clean.to_number(clean.to_datetime(df.select(*by, time, value), [time], formats), [value])
    rows = clean.drop_nulls(rows)
    return rows.distinct() if drop_duplicates else rows


def lag_table(
    df: DataFrame, time: str, value: str, lags: int = 12, by: Sequence[str] = (), features: Sequence[str] = (),
    large: bool | None = None,
) -> DataFrame:
    """(by, time, label, value_lag_1..lags, features) for rows where all of them are known."""
    require(df, time, value, *by, *features)
    if not isinstance(lags, int) or lags <= 0:
        raise ValueError("lags must be a positive integer")
    extra = [c for c in features if c != value]
    kept = df.select(*by, time, *extra, F.col(value).try_cast("double").alias("label"))
    out = lagged(kept, by, [time], {f"{value}_lag_{i}": ("label", i) for i in range(1, lags + 1)}, large)
    names = [f"{value}_lag_{i}" for i in range(1, lags + 1)]
    return complete_rows(out.select(*by, time, "label", *names, *extra), ["label", *names, *extra])


def lag_names(value: str, lags: int) -> list[str]:
    return [f"{value}_lag_{i}" for i in range(1, lags + 1)]


def lag_holdout(
    df: DataFrame, time: str, value: str, lags: int = 7, by: Sequence[str] = (), test_size: int | None = None,
    alphas: Sequence[float] = (0.0,), features: Sequence[str] = (), large: bool | None = None,
) -> DataFrame:
    """(alpha, by, time, label, prediction) for the last rows of each series.

    Every series has its own linear model (ridge where alpha > 0); the lag table is written once,
    because splitting, fitting and predicting all read it.
    """
    table = pinned(lag_table(df, time, value, lags, by, features, large))
    parts = split.time_split(table, time, by, test_size)
    xs = [*lag_names(value, lags), *[c for c in features if c != value]]
    made = []
    for alpha in alphas:
        models = linear.fit(parts.filter("is_train"), "label", xs, by, alpha)
        tested = linear.predict(parts.filter("not is_train"), models, xs, by)
        made.append(tested.select(F.lit(float(alpha)).alias("alpha"), *by, time, "label", "prediction"))
    return reshape.stack(made)


def lag_backtest(
    df: DataFrame, time: str, value: str, lags: int = 7, by: Sequence[str] = (), k: int = 5,
    test_size: int | None = None, gap: int = 0, alpha: float = 0.0,
) -> DataFrame:
    """Mean and deviation over expanding-window folds of each metric; all folds are fitted together."""
    folded = split.expanding_folds(pinned(lag_table(df, time, value, lags, by)), time, by, k, test_size, gap)
    xs, keys = lag_names(value, lags), [*by, "fold"]
    models = linear.fit(folded.filter("role = 'train'"), "label", xs, keys, alpha)
    tested = linear.predict(folded.filter("role = 'test'"), models, xs, keys)
    return profile.metric_summary(metrics.regression(tested, keys).drop("fold"), by, ["MAE", "MSE", "RMSE", "R2", "MAPE_pct"])


def last_values(df: DataFrame, time: str, value: str, n: int, by: Sequence[str] = (), out: str = "history") -> DataFrame:
    """The last n values of each series, oldest first, with the last time."""
    latest = Window.partitionBy(*by).orderBy(F.desc(time))
    kept = df.filter(F.col(value).isNotNull()).select(*by, time, F.col(value).cast("double").alias("_v"))
    kept = kept.withColumn("_r", F.row_number().over(latest)).filter(F.col("_r") <= n)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col("_v").alias("v"))))
    return kept.groupBy(*by).agg(ordered.alias("_h")).select(
        *by, F.col("_h.v").alias(out), F.element_at("_h", -1)["t"].alias("last_time")
    )


def _or_nulls(values: Column, horizon: int) -> Column:
    """Forecasts, or as many nulls where there are none."""
    return F.coalesce(values, F.array_repeat(F.lit(None).cast("double"), horizon))


def _steps(rows: DataFrame, by: Sequence[str], values: Column, time: str, step: str) -> DataFrame:
    exploded = rows.select(*by, "last_time", F.posexplode(values).alias("_i", "forecast"))
    later = F.expr(f"last_time + (_i + 1) * interval {step}").cast(rows.schema["last_time"].dataType)
    return exploded.select(*by, (F.col("_i") + 1).alias("step"), later.alias(time), "forecast")


def future_calendar(df: DataFrame, time: str, horizon: int, by: Sequence[str] = (), step: str = "1 day") -> DataFrame:
    """The next `horizon` times after the last one of each series."""
    last = df.groupBy(*by).agg(F.max(time).alias("last_time"))
    return _steps(last, by, F.array_repeat(F.lit(0.0), horizon), time, step).drop("forecast")


def recursive_forecast(
    df: DataFrame, models: DataFrame, time: str, value: str, lags: int, horizon: int, by: Sequence[str] = (),
    step: str = "1 day",
) -> DataFrame:
    """(by, step, time, forecast): each value predicted feeds the lags of the next.

    A series with fewer values than lags, or without a model, gets null forecasts.
    """
    if not isinstance(horizon, int) or horizon <= 0:
        raise ValueError("horizon must be a positive integer")
    ready = join_facts(last_values(df, time, value, lags, by), models, by, "left")

    def extend(known: Column, _: Column) -> Column:
        nxt = linear.linear_value([F.element_at(known, -i) for i in range(1, lags + 1)])
        return F.concat(known, F.array(nxt))

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("history"), extend)
    values = F.when(F.size("history") >= lags, F.slice(grown, F.lit(lags + 1), F.lit(horizon)))
    return _steps(ready, by, _or_nulls(values, horizon), time, step)


def lag_forecast(
    df: DataFrame, time: str, value: str, lags: int = 7, horizon: int = 30, by: Sequence[str] = (), alpha: float = 0.0,
    step: str = "1 day",
) -> DataFrame:
    """Refit on the whole series, then forecast recursively."""
    models = linear.fit(lag_table(df, time, value, lags, by), "label", lag_names(value, lags), by, alpha)
    return recursive_forecast(df, models, time, value, lags, horizon, by, step)


def lag_tree_holdout(
    df: DataFrame, time: str, value: str, lags: int = 7, by: Sequence[str] = (), test_size: int | None = None,
    features: Sequence[str] = (), kind: str = "tree", depth: int = 3, bins: int = 32, large: bool | None = None, **options,
) -> DataFrame:
    """(by, time, label, prediction) for the last rows of each series, by trees on its lags (see `trees.fit`).

    All series grow their trees together; a forest draws rows by their time.
    """
    table = pinned(lag_table(df, time, value, lags, by, features, large))
    parts = split.time_split(table, time, by, test_size)
    xs = [*lag_names(value, lags), *[c for c in features if c != value]]
    models = trees.fit(parts.filter("is_train"), "label", xs, by, kind, depth, bins, key=[time], **options)
    tested = trees.predict(parts.filter("not is_train"), models, xs, by, depth, bins)
    return tested.select(*by, time, "label", "prediction")


def lag_tree_backtest(
    df: DataFrame, time: str, value: str, lags: int = 7, by: Sequence[str] = (), k: int = 5, test_size: int | None = None,
    gap: int = 0, kind: str = "tree", depth: int = 3, bins: int = 32, **options,
) -> DataFrame:
    """Mean and deviation over expanding-window folds of each metric; the trees of all series and folds grow together."""
    folded = pinned(split.expanding_folds(pinned(lag_table(df, time, value, lags, by)), time, by, k, test_size, gap))
    xs, keys = lag_names(value, lags), [*by, "fold"]
    models = trees.fit(folded.filter("role = 'train'"), "label", xs, keys, kind, depth, bins, key=[time], **options)
    tested = trees.predict(folded.filter("role = 'test'"), models, xs, keys, depth, bins)
    return profile.metric_summary(metrics.regression(tested, keys).drop("fold"), by, ["MAE", "MSE", "RMSE", "R2", "MAPE_pct"])


def lag_tree_forecast(
    df: DataFrame, time: str, value: str, lags: int = 7, horizon: int = 30, by: Sequence[str] = (), step: str = "1 day",
    kind: str = "tree", depth: int = 3, bins: int = 32, **options,
) -> DataFrame:
    """(by, step, time, forecast): trees fitted to the whole series, each prediction feeding the lags of the next."""
    table = lag_table(df, time, value, lags, by)
    models = trees.fit(table, "label", lag_names(value, lags), by, kind, depth, bins, key=[time], **options)
    ready = join_facts(last_values(df, time, value, lags, by), models, by, "left")

    def extend(known: Column, _: Column) -> Column:
        nxt = trees.tree_value([F.element_at(known, -i) for i in range(1, lags + 1)], bins, depth)
        return F.concat(known, F.array(nxt))

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("history"), extend)
    values = F.when(F.size("history") >= lags, F.slice(grown, F.lit(lags + 1), F.lit(horizon)))
    return _steps(ready, by, _or_nulls(values, horizon), time, step)


# ---------------------------------------------------------------- additive Holt-Winters
# A state is (level, trend, one slot per phase of the season).  Each update is linear in the
# state and the new value, so a long series is cut into runs whose effects are composed.


def _smooth(y: np.ndarray, weights: np.ndarray, state: np.ndarray, phase: int) -> tuple[np.ndarray, np.ndarray]:
    """Run all weight triples over y; returns their end states and squared one-step errors."""
    level_w, trend_w, season_w = weights.T
    period = state.shape[1] - 2
    state, errors = state.copy(), np.zeros(len(weights))
    for i, value in enumerate(y):
        at = 2 + (phase + i) % period
        level, trend, season = state[:, 0].copy(), state[:, 1].copy(), state[:, at].copy()
        errors += (value - level - trend - season) ** 2
        state[:, 0] = level_w * (value - season) + (1 - level_w) * (level + trend)
        state[:, 1] = trend_w * (state[:, 0] - level) + (1 - trend_w) * trend
        state[:, at] = season_w * (value - state[:, 0]) + (1 - season_w) * season
    return state, errors


def _first_state(y: np.ndarray, period: int, count: int) -> np.ndarray:
    """Level, trend and season from the first two seasons."""
    level = y[:period].mean()
    trend = (y[period : 2 * period].mean() - level) / period
    return np.tile(np.concatenate([[level, trend], y[:period] - level]), (count, 1))


def _run_effect(y, weights, period, phase):
    """What a run adds from a zero state, and the matrix it applies to the state before it."""
    count, size = len(weights), period + 2
    added, _ = _smooth(y, weights, np.zeros((count, size)), phase)
    effects = np.zeros((count, size, size))
    whole, rest = divmod(len(y), period)
    for g in range(count):
        same = np.repeat(weights[g : g + 1], size, axis=0)
        one = _smooth(np.zeros(period), same, np.eye(size), phase)[0].T
        tail = _smooth(np.zeros(rest), same, np.eye(size), phase)[0].T
        effects[g] = tail @ np.linalg.matrix_power(one, whole)
    return added, effects


def _ahead(state: np.ndarray, period: int, phase: int, horizon: int) -> list[float]:
    return [float(state[0] + (h + 1) * state[1] + state[2 + (phase + h) % period]) for h in range(horizon)]


def holt_winters(
    df: DataFrame, time: str, value: str, by: Sequence[str] = (), period: int = 7, horizon: int = 30,
    grid: Sequence[tuple[float, float, float]] = GRID, step: str = "1 day", large: bool | None = None,
) -> DataFrame:
    """(by, step, time, forecast, alpha, beta, gamma, sse) with the weights of least squared error.

    Series shorter than two seasons give no first state: their forecasts and weights are null.
    """
    weights = np.array(grid, dtype=float)
    by = list(by)
    rows = df.select(*by, time, F.col(value).try_cast("double").alias("_y")).filter(F.col("_y").isNotNull() & F.col(time).isNotNull())
    last = rows.groupBy(*by).agg(F.max(time).alias("last_time"), F.count("*").alias("_n"))
    keyed = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in by]
    schema = ", ".join([*keyed, "forecasts array<double>", "alpha double", "beta double", "gamma double", "sse double"])

    def best(keys, state, errors, phase):
        g = int(np.argmin(errors))
        row = [*keys, _ahead(state[g], period, phase, horizon), *weights[g], float(errors[g])]
        return pd.DataFrame([row], columns=[*by, "forecasts", "alpha", "beta", "gamma", "sse"])

    if not (has_large_group(rows, by) if large is None else large):

        def whole(keys, series: pd.DataFrame) -> pd.DataFrame:
            y = series.sort_values(time)["_y"].to_numpy()
            if len(y) < 2 * period:
                return pd.DataFrame(columns=[*by, "forecasts", "alpha", "beta", "gamma", "sse"])
            state, errors = _smooth(y[period:], weights, _first_state(y, period, len(weights)), 0)
            return best(keys, state, errors, len(y) % period)

        found = rows.groupBy(*by).applyInPandas(whole, schema)
    else:
        found = _long_holt_winters(rows, time, by, period, weights, schema, keyed, best)
    ready = join_facts(last, found, by, "left")
    out = ready.select(*by, "last_time", "alpha", "beta", "gamma", "sse", F.posexplode(_or_nulls(F.col("forecasts"), horizon)).alias("_i", "forecast"))
    later = F.expr(f"last_time + (_i + 1) * interval {step}").cast(rows.schema[time].dataType).alias(time)
    return out.select(*by, (F.col("_i") + 1).alias("step"), later, "forecast", "alpha", "beta", "gamma", "sse")


def _long_holt_winters(rows, time, by, period, weights, schema, keyed, best) -> DataFrame:
    """The same result from runs of bounded length: effects, then start states, then errors."""
    length = max(limit_of(rows.sparkSession, GROUP_ROWS), 2 * period)
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") >= 2 * period)
    runs = attach(row_numbers(rows, by, [time], "_pos"), sizes, by)
    runs = pinned(runs.withColumn("_run", F.floor((F.col("_pos") - 1) / length)))
    count, size = len(weights), period + 2
    keys = [*by, "_run"]
    keyed_runs = ", ".join([*keyed, "_run long"])

    def values(part: pd.DataFrame) -> np.ndarray:
        return part.sort_values("_pos")["_y"].to_numpy()

    def opening(y):
        # Only the first run holds whole first seasons; a run is never shorter than that.
        return _smooth(y[period:], weights, _first_state(y, period, count), 0)

    def effect(key, part: pd.DataFrame) -> pd.DataFrame:
        y, run = values(part), int(key[-1])
        if run == 0:
            added, change = opening(y)[0], np.zeros((count, size, size))
        else:
            added, change = _run_effect(y, weights, period, run * length % period)
        row = [*key, added.ravel().tolist(), change.ravel().tolist()]
        return pd.DataFrame([row], columns=[*keys, "added", "change"])

    effects = runs.groupBy(*keys).applyInPandas(effect, f"{keyed_runs}, added array<double>, change array<double>")

    def compose(key, parts: pd.DataFrame) -> pd.DataFrame:
        state, out = np.zeros((count, size)), []
        for part in parts.sort_values("run").itertuples(index=False):
            out.append([*key, part.run, state.ravel().tolist()])
            change = np.array(part.change, dtype=float).reshape(count, size, size)
            state = np.array(part.added, dtype=float).reshape(count, size) + np.einsum("gij,gj->gi", change, state)
        return pd.DataFrame(out, columns=[*keys, "start"])

    starts = effects.withColumnRenamed("_run", "run").groupBy(*by).applyInPandas(compose, f"{keyed_runs}, start array<double>")

    def errors_of(key, part: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, "state", "errors", "upto"]
        if part.empty or start.empty:
            return pd.DataFrame(columns=names)
        y, run = values(part), int(key[-1])
        state = np.array(start["start"].iloc[0], dtype=float).reshape(count, size)
        state, errors = opening(y) if run == 0 else _smooth(y, weights, state, run * length % period)
        return pd.DataFrame([[*key, state.ravel().tolist(), errors.tolist(), int(part["_pos"].max())]], columns=names)

    scored = runs.groupBy(*keys).cogroup(starts.groupBy(*keys)).applyInPandas(
        errors_of, f"{keyed_runs}, state array<double>, errors array<double>, upto long"
    )
    totals = scored.groupBy(*by).agg(
        F.array(*[F.sum(F.col("errors")[g]) for g in range(count)]).alias("errors"),
        F.max_by("state", "upto").alias("state"), F.max("upto").alias("upto"),
    )

    def finish(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                state = np.array(row["state"], dtype=float).reshape(count, size)
                yield best([row[k] for k in by], state, np.array(row["errors"], dtype=float), int(row["upto"]) % period)

    return totals.mapInPandas(finish, schema)


# ---------------------------------------------------------------- ARIMA


def arima(
    df: DataFrame, time: str, value: str, by: Sequence[str] = (), order: tuple[int, int, int] = (1, 1, 1),
    horizon: int = 30, step: str = "1 day", large: bool | None = None,
) -> DataFrame:
    """(by, step, time, forecast) by the two-stage regression of Hannan and Rissanen.

    A long autoregression gives the shocks; the series is then regressed on its own lags and on
    lagged shocks.  Both stages are grouped aggregates, and d may be 0 or 1.  Series too short for
    that get null forecasts.
    """
    p, d, q = order
    if d not in (0, 1) or p < 0 or q < 0 or p + q == 0:
        raise ValueError("order needs d of 0 or 1 and p + q > 0")
    by = list(by)
    rows = complete_rows(df.select(*by, time, F.col(value).try_cast("double").alias("_y")), ["_y", time])
    large = has_large_group(rows, by) if large is None else large
    if d == 1:
        rows = lagged(rows, by, [time], {"_y1": ("_y", 1)}, large)
        rows = rows.withColumn("_z", F.col("_y") - F.col("_y1")).drop("_y1")
    else:
        rows = rows.withColumn("_z", F.col("_y"))
    reach = p + q + 2
    rows = pinned(lagged(rows, by, [time], {f"_z{i}": ("_z", i) for i in range(1, reach + 1)}, large))
    if q:
        long_lags = [f"_z{i}" for i in range(1, reach + 1)]
        rows = linear.predict(rows, linear.fit(rows, "_z", long_lags, by), long_lags, by, "_fit")
        rows = rows.withColumn("_e", F.col("_z") - F.col("_fit"))
        rows = pinned(lagged(rows, by, [time], {f"_e{j}": ("_e", j) for j in range(1, q + 1)}, large))
    xs = [f"_z{i}" for i in range(1, p + 1)] + [f"_e{j}" for j in range(1, q + 1)]
    models = linear.fit(rows, "_z", xs, by)

    ready = rows.groupBy(*by).agg(F.max_by("_y", time).alias("_last"), F.max(time).alias("last_time"))
    ready = join_facts(ready, last_values(rows, time, "_z", max(p, 1), by, "_zs").drop("last_time"), by, "left")
    ready = join_facts(ready, models, by, "left")
    if q:
        ready = join_facts(ready, last_values(rows, time, "_e", q, by, "_es").drop("last_time"), by, "left")
    else:
        ready = ready.withColumn("_es", F.array().cast("array<double>"))
    enough = (F.size("_zs") >= p) & (F.size("_es") >= q)

    def extend(known: Column, _: Column) -> Column:
        terms = [F.element_at(known["z"], -i) for i in range(1, p + 1)]
        terms += [F.element_at(known["e"], -j) for j in range(1, q + 1)]
        return F.struct(
            F.concat(known["z"], F.array(linear.linear_value(terms))).alias("z"),
            F.concat(known["e"], F.array(F.lit(0.0))).alias("e"),
        )

    start = F.struct(F.col("_zs").alias("z"), F.col("_es").alias("e"))
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, extend)["z"]
    changes = F.slice(grown, F.size("_zs") + 1, F.lit(horizon))
    if d == 1:
        sums = F.aggregate(
            changes, F.array(F.col("_last")), lambda done, z: F.concat(done, F.array(F.element_at(done, -1) + z))
        )
        changes = F.slice(sums, F.lit(2), F.lit(horizon))
    return _steps(ready, by, _or_nulls(F.when(enough, changes), horizon), time, step)


# ---------------------------------------------------------------- comparison and summaries


def holdout_predictions(
    df: DataFrame, time: str, value: str, by: Sequence[str] = (), test_size: int = 7, lags: int = 7, period: int = 7,
    orders: Sequence[tuple[int, int, int]] = ((1, 1, 1), (2, 1, 2)), step: str = "1 day",
) -> DataFrame:
    """(model, by, time, label, prediction) of every model on the last rows of each series.

    Predictions meet the held-out rows by their place in the series, so times may repeat and keys may be null. Places
    go by time, then value.
    """
    rows = pinned(complete_rows(df.select(*by, time, F.col(value).try_cast("double").alias(value)), [time, value]))
    large = has_large_group(rows, by)
    cut = split.time_split(rows, time, by, test_size)
    train = cut.filter("is_train").drop("is_train")
    test = row_numbers(cut.filter("not is_train"), by, [time, value], "step", large)
    test = row_numbers(test, by, [F.desc(time), F.desc(value)], "_back", large).select(
        *by, time, F.col("step").cast("int").alias("step"), "_back", F.col(value).cast("double").alias("label")
    )
    by_lags = lag_holdout(rows, time, value, lags, by, test_size, (0.0, 1.0), large=large)
    name = F.when(F.col("alpha") == 0, "Linear").otherwise("Ridge")
    by_lags = row_numbers(by_lags.withColumn("model", name), ["model", *by], [F.desc(time), F.desc("label")], "_back", large)
    by_lags = by_lags.select("model", *by, "_back", "prediction")
    # Every model answers for every held-out row, with a null where the series is too short for it.
    named = test.select(F.explode(F.array(F.lit("Linear"), F.lit("Ridge"))).alias("model"), *by, time, "_back", "label")
    tables = [join_facts(named, by_lags, ["model", *by, "_back"], "left").select("model", *by, time, "label", "prediction")]
    direct = {f"HoltWinters_{period}": holt_winters(train, time, value, by, period, test_size, step=step, large=large)}
    direct |= {f"ARIMA_{''.join(map(str, o))}": arima(train, time, value, by, o, test_size, step, large) for o in orders}
    keys = [*by, "step"]
    for name, ahead in direct.items():
        joined = join_facts(test, ahead.select(*keys, F.col("forecast").alias("prediction")), keys, "left")
        tables.append(joined.select(F.lit(name).alias("model"), *by, time, "label", "prediction"))
    return reshape.stack(tables)


def backtest_predictions(
    df: DataFrame, time: str, value: str, by: Sequence[str] = (), k: int = 3, test_size: int = 7, **models
) -> DataFrame:
    """(model, by, fold, time, label, prediction) of every model on the last k blocks of each series.

    Each fold is a series of its own that ends with its test block, so all folds are fitted together.
    """
    rows = complete_rows(df.select(*by, time, F.col(value).try_cast("double").alias(value)), [time, value])
    folded = split.expanding_folds(rows, time, by, k, test_size).drop("role")
    return holdout_predictions(folded, time, value, [*by, "fold"], test_size, **models)


def ranking(
    df: DataFrame, time: str, value: str, by: Sequence[str] = (), k: int = 3, test_size: int = 7, **models
) -> DataFrame:
    """Hold-out metrics per model and series, means and deviations over k folds as `CV_*`, the `rank` by mean
    RMSE of the folds (hold-out RMSE where a series has no folds) and the `best_model`."""
    held = metrics.regression(holdout_predictions(df, time, value, by, test_size, **models), ["model", *by])
    keys = ["model", *by]
    each = metrics.regression(backtest_predictions(df, time, value, by, k, test_size, **models), [*keys, "fold"]).drop("fold")
    names = [c for c in each.columns if c not in keys]
    cv = profile.metric_summary(each, keys, names)
    table = join_facts(held, cv.withColumnsRenamed({c: f"CV_{c}" for c in cv.columns if c not in keys}), keys, "left")
    table = table.withColumn("_score", F.coalesce("CV_RMSE", "RMSE"))
    order = Window.partitionBy(*by).orderBy(F.asc_nulls_last("_score"), "model")  # one row per model
    ranked = table.withColumn("rank", F.row_number().over(order)).drop("_score")
    best = ranked.groupBy(*by).agg(F.min_by("model", "rank").alias("best_model"))
    return attach(ranked, best, by)


def compare(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metrics per model and series, with the model of least RMSE in `best_model`."""
    table = metrics.regression(predictions, ["model", *by])
    best = table.groupBy(*by).agg(F.min_by("model", F.struct("RMSE", "model")).alias("best_model"))
    return attach(table, best, by)


def calendar_quality(df: DataFrame, time: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, nulls, missing dates, completeness, common gap and value summary of each series."""
    counts = df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(value).isNull()).alias("null_values"),
        F.count_distinct(F.to_date(time)).alias("_days"),
        (F.datediff(F.max(F.to_date(time)), F.min(F.to_date(time))) + 1).alias("_span"),
    )
    shaped = counts.select(
        *by, "n_rows", "null_values", (F.col("_span") - F.col("_days")).alias("missing_dates"),
        (F.try_divide(F.col("_days"), F.col("_span")) * 100).alias("completeness_pct"),
    )
    summary = profile.series_summary(df, value, by).drop("count")
    return join_facts(join_facts(shaped, profile.frequency(df, time, by), by, "left"), summary, by, "left")
