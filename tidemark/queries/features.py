"""Queries on features, labels, splits, folds, scaling and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features, metrics, moments, quantiles, scaling
from tidemark.operators.align import attach_macro
from tidemark.operators.features import add_features
from tidemark.operators.split import add_label, expanding_folds, temporal_split
from tidemark.queries.fixtures import (
    DAILY_SQL,
    HOURLY_SQL,
    daily_bars,
    hourly_bars,
    table,
)
from tidemark.queries.registry import num, nums, query, tidy, when
from tidemark.queries.tables import JOINED_SQL, MACRO_NAMES, _macro, small_blocks
from tidemark.sources.bars import FIELDS

T = "Close"
BUNDLE = {
    "lags": 20,
    "returns": [1],
    "rolling_windows": [3],
    "high_column": "High",
    "low_column": "Low",
    "volume_column": "Volume",
    "price_for_nominal": "Close",
}
KEYS_OUT = f"series_id, {when()}, ordinal"


def _over(partition: str = "series_id") -> str:
    return f"(PARTITION BY {partition} ORDER BY ts, ordinal"


def _lag(n: int, partition: str = "series_id", column: str = '"Close"') -> str:
    return f"lag({column}, {n}) OVER {_over(partition)})"


def _rolling(function: str, size: int, least: int | None = None, partition: str = "series_id") -> str:
    frame = f"{_over(partition)} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    return (
        f'CASE WHEN count("Close") OVER {frame} >= {least or size} '
        f'THEN {function}("Close") OVER {frame} END'
    )


def _bundle_items(partition: str = "series_id") -> dict[str, str]:
    """SQL of each feature of the bundle; the fixtures have no missing and no zero price."""
    items = {f"Close_lag_{n}": _lag(n, partition) for n in range(1, 21)}
    items["Close_ret_1"] = f'"Close" / {_lag(1, partition)} - 1'
    items["Close_sma_3"] = _rolling("avg", 3, None, partition)
    items["Close_std_3"] = _rolling("stddev_samp", 3, None, partition)
    items["amplitude"] = '"High" - "Low"'
    items["nominal_value"] = '"Close" * "Volume"'
    return items


def _out(items: dict[str, str]) -> str:
    return ", ".join(num(sql, name) for name, sql in items.items())


def _feature(items: dict[str, str], source: str = DAILY_SQL) -> str:
    keys = KEYS_OUT.replace("strftime(ts", "strftime(bars.ts")
    return f"WITH {source} SELECT {keys}, {_out(items)} FROM bars"


def _only(df, names):
    return tidy(df.select("series_id", "ts", "ordinal", *names))


@query("feature_lag", _feature({f"Close_lag_{n}": _lag(n) for n in (1, 5, 10)}))
def feature_lag(spark, folder):
    df = add_features(daily_bars(spark, folder), T, lags=[1, 5, 10], returns=[], rolling_windows=[])
    return _only(df, ["Close_lag_1", "Close_lag_5", "Close_lag_10"])


@query(
    "feature_return",
    _feature({"Close_ret_1": f'"Close"/{_lag(1)} - 1', "Close_ret_5": f'"Close"/{_lag(5)} - 1'}),
)
def feature_return(spark, folder):
    df = add_features(daily_bars(spark, folder), T, lags=(), returns=[1, 5], rolling_windows=[])
    return _only(df, ["Close_ret_1", "Close_ret_5"])


GAPPY = "CASE WHEN ordinal % 5 <> 0 THEN \"Close\" END"


@query(
    "feature_return_over_gaps",
    f"""WITH {DAILY_SQL}, g AS (SELECT series_id, ts, ordinal, {GAPPY} AS "Close" FROM bars),
        f AS (SELECT *, last_value("Close" IGNORE NULLS) OVER {_over()}
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM g)
        SELECT {KEYS_OUT.replace('strftime(ts', 'strftime(f.ts')},
          {num(f"c / {_lag(2, column='c')} - 1", 'Close_ret_2')} FROM f""",
)
def feature_return_over_gaps(spark, folder):
    """Every fifth price or so is missing: a return first carries the last price on."""
    bars = daily_bars(spark, folder)
    gappy = bars.withColumn(T, F.when(F.col("ordinal") % 5 != 0, F.col(T)))
    df = add_features(gappy, T, lags=(), returns=[2], rolling_windows=[])
    return _only(df, ["Close_ret_2"])


@query("feature_logret", _feature({"Close_logret_1": f'ln("Close"/{_lag(1)})'}))
def feature_logret(spark, folder):
    df = add_features(
        daily_bars(spark, folder), T, lags=(), returns=[], rolling_windows=[], log_returns=[1]
    )
    return _only(df, ["Close_logret_1"])


@query(
    "feature_sma",
    _feature({"Close_sma_5": _rolling("avg", 5), "Close_sma_20": _rolling("avg", 20)}),
)
def feature_sma(spark, folder):
    df = add_features(daily_bars(spark, folder), T, lags=(), returns=[], rolling_windows=[5, 20])
    return _only(df, ["Close_sma_5", "Close_sma_20"])


LONG_WINDOWS = (101, 251)


@query(
    "feature_rolling_long",
    f"WITH {DAILY_SQL} SELECT {KEYS_OUT.replace('strftime(ts', 'strftime(bars.ts')}, "
    + ", ".join(
        num(_rolling(kind, n), f"Close_{short}_{n}")
        for n in LONG_WINDOWS
        for short, kind in (("sma", "avg"), ("std", "stddev_samp"))
    )
    + " FROM bars",
)
def feature_rolling_long(spark, folder):
    """Windows of many rows, merged from blocks."""
    df = add_features(daily_bars(spark, folder), T, lags=(), returns=[], rolling_windows=LONG_WINDOWS)
    names = [f"Close_{kind}_{n}" for n in LONG_WINDOWS for kind in ("sma", "std")]
    return _only(df, names)


@query("feature_sma_min_periods", _feature({"Close_sma_7": _rolling("avg", 7, 2)}))
def feature_sma_min_periods(spark, folder):
    df = add_features(
        daily_bars(spark, folder), T, lags=(), returns=[], rolling_windows=[7], min_periods=2
    )
    return _only(df, ["Close_sma_7"])


@query(
    "feature_std",
    _feature({"Close_std_5": _rolling("stddev_samp", 5), "Close_std_20": _rolling("stddev_samp", 20)}),
)
def feature_std(spark, folder):
    df = add_features(daily_bars(spark, folder), T, lags=(), returns=[], rolling_windows=[5, 20])
    return _only(df, ["Close_std_5", "Close_std_20"])


@query("feature_amplitude", _feature({"amplitude": '"High" - "Low"'}))
def feature_amplitude(spark, folder):
    bars = daily_bars(spark, folder)
    return _only(bars.select("*", features.amplitude_column()), ["amplitude"])


@query("feature_nominal", _feature({"nominal_value": '"Close" * "Volume"'}))
def feature_nominal(spark, folder):
    bars = daily_bars(spark, folder)
    return _only(bars.select("*", features.nominal_column()), ["nominal_value"])


@query("feature_bundle", _feature(_bundle_items()))
def feature_bundle(spark, folder):
    df = add_features(daily_bars(spark, folder), T, **BUNDLE)
    return _only(df, list(_bundle_items()))


@query("feature_bundle_hourly", _feature(_bundle_items(), HOURLY_SQL))
def feature_bundle_hourly(spark, folder):
    df = add_features(hourly_bars(spark, folder), T, **BUNDLE)
    return _only(df, list(_bundle_items()))


@query("feature_bundle_in_blocks", _feature(_bundle_items(), HOURLY_SQL))
def feature_bundle_in_blocks(spark, folder):
    """The same features by the way taken for long series, with small blocks."""
    with small_blocks(spark):
        df = add_features(hourly_bars(spark, folder), T, **BUNDLE)
    return _only(df, list(_bundle_items()))


LABEL_SQL = f"""{DAILY_SQL}, labelled AS (
  SELECT *, lead("Close", 20) OVER {_over()}) AS "Close_target_h20" FROM bars),
kept AS (SELECT *, row_number() OVER {_over()}) - 1 AS p,
                count(*) OVER (PARTITION BY series_id) AS n
         FROM labelled WHERE "Close_target_h20" IS NOT NULL)"""


@query(
    "label_h20",
    f"WITH {LABEL_SQL} SELECT {KEYS_OUT}, {nums('Close', 'Close_target_h20')} FROM kept",
)
def label_h20(spark, folder):
    return _only(add_label(daily_bars(spark, folder), T, 20), ["Close", "Close_target_h20"])


SPLIT_SQL = f"""{LABEL_SQL}, sized AS (
  SELECT *, floor(n * 0.7::DOUBLE)::BIGINT AS a,
         floor(n * 0.7::DOUBLE)::BIGINT + floor(n * 0.15::DOUBLE)::BIGINT AS b FROM kept),
parts AS (SELECT *, CASE WHEN p < greatest(a - 1, 0) THEN 'train'
                         WHEN p >= a + 1 AND p < b THEN 'val'
                         WHEN p >= b + 1 THEN 'test' END AS split FROM sized)"""


@query(
    "temporal_split",
    f"""WITH {SPLIT_SQL} SELECT {KEYS_OUT}, split, {nums('Close_target_h20')}
        FROM parts WHERE split IS NOT NULL""",
)
def temporal_split_query(spark, folder):
    df = temporal_split(daily_bars(spark, folder), T, gap=1, horizon=20)
    return _only(df, ["split", "Close_target_h20"])


@query(
    "split_views",
    f"""WITH {SPLIT_SQL} SELECT series_id, split, count(*)::BIGINT AS "rows",
        {when('min(ts)', 'first_ts')}, {when('max(ts)', 'last_ts')}
        FROM parts WHERE split IS NOT NULL GROUP BY 1, 2""",
)
def split_views(spark, folder):
    df = temporal_split(daily_bars(spark, folder), T, gap=1, horizon=20)
    return tidy(
        df.groupBy("series_id", "split").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


FOLD_SQL = f"""{DAILY_SQL}, placed AS (
  SELECT *, row_number() OVER {_over()}) - 1 AS p, count(*) OVER (PARTITION BY series_id) AS n
  FROM bars),
folds AS (SELECT placed.*, k.fold, n - (3 - k.fold) * (n // 4) AS s, n // 4 AS t
          FROM placed, (VALUES (0), (1), (2)) AS k(fold)),
roles AS (SELECT *, CASE WHEN p < s - 1 THEN 'train' WHEN p >= s AND p < s + t THEN 'test' END
          AS "role" FROM folds)"""


@query(
    "ts_folds",
    f"""WITH {FOLD_SQL} SELECT {KEYS_OUT}, fold::BIGINT AS fold, "role" FROM roles
        WHERE "role" IS NOT NULL""",
)
def ts_folds(spark, folder):
    return _only(expanding_folds(daily_bars(spark, folder), 3, 1), ["fold", "role"])


LOCAL_ITEMS = {
    "Close_lag_1": _lag(1, "series_id, split"),
    "Close_lag_5": _lag(5, "series_id, split"),
    "Close_sma_3": _rolling("avg", 3, None, "series_id, split"),
}


@query(
    "split_local_features",
    f"""WITH {SPLIT_SQL}, inside AS (SELECT * FROM parts WHERE split IS NOT NULL)
        SELECT {KEYS_OUT.replace('strftime(ts', 'strftime(inside.ts')}, split, {_out(LOCAL_ITEMS)}
        FROM inside""",
)
def split_local_features(spark, folder):
    """Features whose frames end at the border of the split."""
    df = temporal_split(daily_bars(spark, folder), T, gap=1, horizon=20)
    local = add_features(
        df, T, lags=[1, 5], returns=[], rolling_windows=[3], keys=("series_id", "split")
    )
    return _only(local, ["split", *LOCAL_ITEMS])


SCALED = ("Close", "Volume", "macro_a", "macro_n")


def _scaled_sql(centre: str, scale: str) -> str:
    stats = ", ".join(
        f'{centre.format(c=c)} AS "{c}_m", {scale.format(c=c)} AS "{c}_s"' for c in SCALED
    )
    out = ", ".join(
        num(f'("{c}" - "{c}_m") / CASE WHEN "{c}_s" = 0 THEN 1 ELSE "{c}_s" END', c) for c in SCALED
    )
    return f"""WITH {JOINED_SQL}, means AS (SELECT """ + ", ".join(
        f'coalesce(avg("{c}"), 0) AS "{c}_a"' for c in SCALED
    ) + f""" FROM joined), filled AS (SELECT """ + ", ".join(
        f'coalesce("{c}", "{c}_a") AS "{c}"' for c in SCALED
    ) + f""" FROM joined, means), stats AS (SELECT {stats} FROM filled)
        SELECT series_id, {when()}, {out} FROM joined, stats"""


def _scaled(spark, folder, kind):
    joined = attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    statistics = scaling.fit_scaler(joined, SCALED, kind)
    return tidy(scaling.apply_scaler(joined, statistics).select("series_id", "ts", *SCALED))


@query("scale_standard", _scaled_sql('avg("{c}")', 'stddev_pop("{c}")'))
def scale_standard(spark, folder):
    return _scaled(spark, folder, "standard")


@query("scale_minmax", _scaled_sql('min("{c}")', 'max("{c}") - min("{c}")'))
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@query(
    "scale_robust",
    _scaled_sql(
        'quantile_cont("{c}"::DOUBLE, 0.5)',
        'quantile_cont("{c}"::DOUBLE, 0.75) - quantile_cont("{c}"::DOUBLE, 0.25)',
    ),
)
def scale_robust(spark, folder):
    return _scaled(spark, folder, "robust")


@query(
    "imputation_means",
    f"WITH {JOINED_SQL} SELECT "
    + ", ".join(num(f'coalesce(avg("{c}"), 0)', c) for c in (*FIELDS, *MACRO_NAMES))
    + " FROM joined",
)
def imputation_means(spark, folder):
    joined = attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    means = scaling.column_means(joined, (*FIELDS, *MACRO_NAMES))
    return tidy(spark.range(1).select(*[F.lit(v).alias(c) for c, v in means.items()]))


MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
FRACTIONS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)


@query(
    "exact_quantiles",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {q}::DOUBLE AS fraction,
            {num(f'quantile_cont({c}::DOUBLE, {q})', 'value')} FROM lineitem"""
        for c in MEASURES
        for q in FRACTIONS
    )
    + ")",
)
def exact_quantiles(spark, folder):
    """Quantiles of columns with many and with few distinct values."""
    found = quantiles.exact_quantiles(table(spark, folder, "lineitem"), MEASURES, FRACTIONS)
    rows = [(c, q, found[c][i]) for c in MEASURES for i, q in enumerate(FRACTIONS)]
    return tidy(spark.createDataFrame(rows, "column string, fraction double, value double"))


WIDE = {f"x{i}": f"l_extendedprice / {i}.37e0 + l_quantity * {i}.0e0 / 7 - l_discount * {10 * i}.0e0 / 3" for i in range(1, 36)}


@query(
    "scale_robust_wide",
    f"WITH x AS (SELECT {', '.join(f'({e})::DOUBLE AS {c}' for c, e in WIDE.items())} FROM lineitem) SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {num(f'quantile_cont({c}, 0.5)', 'centre')},
            {num(f'quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)', 'scale')} FROM x"""
        for c in WIDE
    )
    + ")",
)
def scale_robust_wide(spark, folder):
    """Median and quartiles of 35 columns at once."""
    wide = table(spark, folder, "lineitem").selectExpr(*[f"cast({e} as double) as {c}" for c, e in WIDE.items()])
    fitted = scaling.fit_scaler(wide, list(WIDE), "robust")
    return tidy(spark.createDataFrame([(c, *fitted[c]) for c in WIDE], "column string, centre double, scale double"))


CORR = (*FIELDS, "macro_a", "macro_n", "amplitude", "nominal_value")
CORR_SQL = f"""{JOINED_SQL}, wide AS (
  SELECT *, "High" - "Low" AS amplitude, "Close" * "Volume" AS nominal_value FROM joined),
pairs(i, j, a, b, corr) AS (""" + " UNION ALL ".join(
    f"SELECT {i}, {j}, '{a}', '{b}', nullif(corr(\"{a}\", \"{b}\"), 'NaN'::DOUBLE) FROM wide"
    for i, a in enumerate(CORR)
    for j, b in enumerate(CORR)
    if i < j
) + ")"


def _correlation_input(spark, folder):
    joined = attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    return joined.select("*", features.amplitude_column(), features.nominal_column())


@query("corr_matrix", f"WITH {CORR_SQL} SELECT a, b, {nums('corr')} FROM pairs")
def corr_matrix(spark, folder):
    pairs = moments.pairwise_correlation(_correlation_input(spark, folder), CORR)
    return tidy(pairs.select("a", "b", "corr"))


@query("corr_drop", f"WITH {CORR_SQL} SELECT DISTINCT b AS dropped FROM pairs WHERE abs(corr) > 0.3")
def corr_drop(spark, folder):
    df = _correlation_input(spark, folder)
    dropped = moments.correlated_columns(df, CORR, 0.3)
    return spark.createDataFrame([(c,) for c in dropped], "dropped string")


NAIVE_SQL = f"""{SPLIT_SQL}, guesses AS (
  SELECT split, "Close_target_h20" AS y, "Close" AS last_value,
         "High" AS highest, ("High" + "Low") / 2 AS middle
  FROM parts WHERE split IN ('val', 'test')),
guess AS (UNPIVOT guesses ON last_value, highest, middle INTO NAME candidate VALUE f),
metrics AS (
  SELECT candidate, split, count(*)::BIGINT AS n, sqrt(avg((y-f)*(y-f))) AS rmse,
         avg(abs(y-f)) AS mae, 100*avg(abs((y-f)/(y+1e-8))) AS mape, avg((y-f)*(y-f)) AS mse,
         1 - sum((y-f)*(y-f)) / nullif(var_pop(y)*count(*), 0) AS r2
  FROM guess GROUP BY 1, 2)"""
METRICS_OUT = ", ".join(
    [num("rmse", digits=3), num("mae", digits=3), num("mape", digits=3), num("mse", digits=0), num("r2")]
)


def _guesses(spark, folder):
    """Three naive forecasts of the label: the last close, the high, the middle of the bar."""
    df = temporal_split(daily_bars(spark, folder), T, gap=1, horizon=20)
    return (
        df.filter(F.col("split") != "train")
        .select(
            "split",
            F.col("Close_target_h20").alias("y"),
            F.col("Close").alias("last_value"),
            F.col("High").alias("highest"),
            ((F.col("High") + F.col("Low")) / 2).alias("middle"),
        )
        .unpivot(["split", "y"], ["last_value", "highest", "middle"], "candidate", "f")
    )


def _rounded_metrics(df):
    return df.withColumns(
        {
            **{c: F.round(c, 3) for c in ("rmse", "mae", "mape")},
            "mse": F.round("mse", 0),
        }
    )


@query("metrics_eval", f"WITH {NAIVE_SQL} SELECT candidate, split, n, {METRICS_OUT} FROM metrics")
def metrics_eval(spark, folder):
    scored = metrics.evaluate(_guesses(spark, folder), "y", "f", ["candidate", "split"])
    return tidy(_rounded_metrics(scored))


@query(
    "scorer",
    f"""WITH {NAIVE_SQL} SELECT candidate, split,
          {num('-avg(abs(y-f) / greatest(abs(y), 2.220446049250313e-16))', 'score')}
        FROM guess GROUP BY 1, 2""",
)
def scorer(spark, folder):
    score = metrics.score_column("neg_mean_absolute_percentage_error", "y", "f")
    return tidy(
        _guesses(spark, folder).groupBy("candidate", "split").agg(score.alias("score"))
    )


POSITIONS = {"last_value": 0, "highest": 1, "middle": 2}


@query(
    "leaderboard",
    f"""WITH {NAIVE_SQL} SELECT candidate, n, {METRICS_OUT},
          row_number() OVER (ORDER BY metrics.rmse,
            CASE candidate WHEN 'last_value' THEN 0 WHEN 'highest' THEN 1 ELSE 2 END) AS place
        FROM metrics WHERE split = 'val'""",
)
def leaderboard(spark, folder):
    val = _guesses(spark, folder).filter(F.col("split") == "val")
    order = F.create_map(*[F.lit(x) for pair in POSITIONS.items() for x in pair])
    results = metrics.evaluate(val, "y", "f", ["candidate"]).withColumn(
        "position", order[F.col("candidate")]
    )
    return tidy(_rounded_metrics(metrics.leaderboard(results, "rmse").drop("position")))


@query(
    "fold_summary",
    f"""WITH {FOLD_SQL}, scores AS (
          SELECT series_id AS params, fold, -avg(abs("High" - "Close") / "Close") AS score
          FROM roles WHERE "role" = 'test' GROUP BY 1, 2),
        means AS (SELECT params, avg(score) AS m, stddev_pop(score) AS s FROM scores GROUP BY 1)
        SELECT params, {num('m', 'mean_test_score')}, {num('s', 'std_test_score')},
          rank() OVER (ORDER BY m DESC)::BIGINT AS rank_test_score FROM means""",
)
def fold_summary(spark, folder):
    """Fold scores of one guess per series, summarised as parameter sets are."""
    folds = expanding_folds(daily_bars(spark, folder), 3, 1).filter(F.col("role") == "test")
    score = metrics.score_column("neg_mean_absolute_percentage_error", "Close", "High")
    scores = folds.groupBy(F.col("series_id").alias("params"), "fold").agg(score.alias("score"))
    return tidy(metrics.summarize_folds(scores))
