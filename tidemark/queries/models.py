"""Queries on model fits, selection, tuning, competition, registry and forecasts."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.functions.names import label_name
from tidemark.ml.competition import (
    Candidate,
    choose_features,
    complete_rows,
    feature_stages,
    run_competition,
)
from tidemark.ml.estimators import create_estimator
from tidemark.ml.selection import SelectionConfig
from tidemark.ml.stages import FeatureAssembler, FeatureSubset, FillMissing
from tidemark.ml.trees import TREE_CELLS
from tidemark.ml.tuning import TuningConfig, search
from tidemark.operators.split import temporal_split
from tidemark.plans import forecast as forecasting
from tidemark.queries.features import (
    NAIVE_SQL,
    SPLIT_SQL,
    _bundle_items,
    _guesses,
    _over,
)
from tidemark.plans.ingest import fetch_market_data
from tidemark.queries.fixtures import DAILY_SQL, MACRO_SQL, MACROS, daily_bars, macro_long, table
from tidemark.queries.registry import num, nums, query, tidy, when
from tidemark.queries.tables import small_blocks
from tidemark.session import freeze, setting
from tidemark.sources.models import latest_versions
from tidemark.sources.runs import metrics_report

T, HORIZON = "Close", 20
LABEL = label_name(T, HORIZON)
LEAN = {
    "lags": [1],
    "returns": [],
    "rolling_windows": [],
    "high_column": None,
    "low_column": None,
    "volume_column": None,
}
SHIPPED = {
    "lags": 20,
    "returns": [1],
    "rolling_windows": [3],
    "price_for_nominal": "Close",
    "scaler": "standard",
    "attach_base": True,
}


def _splits(spark, folder):
    return temporal_split(daily_bars(spark, folder), T, gap=1, horizon=HORIZON)


def _train(spark, folder):
    return _splits(spark, folder).filter(F.col("split") == "train")


def _shipped_splits(spark, folder):
    """The splits of bars with filled macro columns; a macro that meets no bar is dropped."""
    dataset = fetch_market_data(
        daily_bars(spark, folder), ticker=None, start="1990-01-01", end="2010-01-01",
        macro=macro_long(spark, folder), macro_series=list(MACROS.values()),
    )
    return temporal_split(dataset, T, gap=1, horizon=HORIZON)


def _linear_fit(spark, folder, name, columns, label, params=None):
    """Intercept and coefficients of a linear model on raw columns of the daily bars."""
    bars = daily_bars(spark, folder)
    rows = VectorAssembler(inputCols=list(columns), outputCol="features").transform(bars)
    model = create_estimator(name, params, label).fit(rows.select("features", label))
    cells = [("intercept", float(model.intercept))]
    cells += [(c, float(v)) for c, v in zip(columns, model.coefficients)]
    return tidy(spark.createDataFrame(cells, "term string, weight double"))


def _one_weight_sql(weight: str) -> str:
    """Rows (term, weight) for one feature, from its variance, covariance and the means."""
    return f"""WITH {DAILY_SQL}, m AS (SELECT count(*) AS n, avg("High") AS mx, avg("Close") AS my,
        var_pop("High") AS vx, covar_pop("High", "Close") AS cxy FROM bars),
      f AS (SELECT *, {weight} AS w FROM m)
      SELECT 'High' AS term, {num('w', 'weight')} FROM f
      UNION ALL SELECT 'intercept', {num('my - w * mx', 'weight')} FROM f"""


@query(
    "ols_fit",
    f"""WITH {DAILY_SQL}
      SELECT 'High' AS term, {num('regr_slope("Close", "High")', 'weight')} FROM bars
      UNION ALL SELECT 'intercept', {num('regr_intercept("Close", "High")', 'weight')} FROM bars""",
)
def ols_fit(spark, folder):
    return _linear_fit(spark, folder, "linear_regression", ["High"], "Close")


@query(
    "ols_two_features",
    f"""WITH {DAILY_SQL}, m AS (SELECT avg("High") AS ma, avg("Low") AS mb, avg("Close") AS my,
        var_pop("High") AS aa, var_pop("Low") AS bb, covar_pop("High", "Low") AS ab,
        covar_pop("High", "Close") AS ay, covar_pop("Low", "Close") AS by_ FROM bars),
      f AS (SELECT *, (ay*bb - by_*ab) / (aa*bb - ab*ab) AS wa,
                      (by_*aa - ay*ab) / (aa*bb - ab*ab) AS wb FROM m)
      SELECT 'High' AS term, {num('wa', 'weight')} FROM f
      UNION ALL SELECT 'Low', {num('wb', 'weight')} FROM f
      UNION ALL SELECT 'intercept', {num('my - wa*ma - wb*mb', 'weight', 2)} FROM f""",
)
def ols_two_features(spark, folder):
    fit = _linear_fit(spark, folder, "linear_regression", ["High", "Low"], "Close")
    digits = F.when(F.col("term") == "intercept", F.round("weight", 2))
    return fit.withColumn("weight", digits.otherwise(F.col("weight")))


@query("ridge_fit", _one_weight_sql("cxy / (vx + 5e13 / n)"))
def ridge_fit(spark, folder):
    return _linear_fit(spark, folder, "ridge", ["High"], "Close", {"alpha": 5e13})


@query(
    "lasso_fit", _one_weight_sql("CASE WHEN cxy > 0 THEN 1 ELSE -1 END * greatest(abs(cxy) - 1e9, 0) / vx")
)
def lasso_fit(spark, folder):
    fit = _linear_fit(
        spark, folder, "lasso", ["High"], "Close", {"alpha": 1e9, "tol": 1e-12, "max_iter": 10000}
    )
    return fit


NEIGHBOUR_COLUMNS = ("Open", "High", "Low", "Close")


@query(
    "knn_predict",
    f"""WITH {SPLIT_SQL}, known AS (SELECT * FROM parts WHERE split = 'train'),
      asked AS (SELECT * FROM parts WHERE split IN ('val', 'test')),
      near AS (SELECT a.series_id, a.ts, a.ordinal,
          arg_min(k."{LABEL}", """
    + " + ".join(f'(a."{c}" - k."{c}") * (a."{c}" - k."{c}")' for c in NEIGHBOUR_COLUMNS)
    + f""", 5) AS labels FROM asked a, known k GROUP BY 1, 2, 3)
      SELECT series_id, {when()}, ordinal, {num('list_avg(labels)', 'prediction', 2)} FROM near""",
)
def knn_predict(spark, folder):
    rows = VectorAssembler(inputCols=list(NEIGHBOUR_COLUMNS), outputCol="features").transform(
        _splits(spark, folder)
    )
    rows = freeze(rows.select("series_id", "ts", "ordinal", "split", LABEL, "features"))
    model = create_estimator("knn", {"n_neighbors": 5}, LABEL).fit(
        rows.filter(F.col("split") == "train")
    )
    predicted = model.transform(rows.filter(F.col("split") != "train"))
    return tidy(predicted.select("series_id", "ts", "ordinal", "prediction"), 2)


ASSEMBLED = _bundle_items("series_id, split")


@query(
    "assembled_features",
    f"""WITH {SPLIT_SQL}, inside AS (SELECT * FROM parts WHERE split IS NOT NULL),
      built AS (SELECT series_id, ts, ordinal, split, """
    + ", ".join(f'{sql} AS "{name}"' for name, sql in ASSEMBLED.items())
    + " FROM inside), stats AS (SELECT "
    + ", ".join(
        f'avg("{c}") AS "{c}_m", stddev_pop(coalesce("{c}", "{c}_a")) AS "{c}_s"' for c in ASSEMBLED
    )
    + " FROM (SELECT * FROM built, (SELECT "
    + ", ".join(f'avg("{c}") AS "{c}_a"' for c in ASSEMBLED)
    + " FROM built WHERE split = 'train') WHERE split = 'train'))"
    + f" SELECT series_id, {when()}, split, "
    + ", ".join(num(f'("{c}" - "{c}_m") / "{c}_s"', c) for c in ASSEMBLED)
    + " FROM built, stats",
)
def assembled_features(spark, folder):
    """The assembler, fitted on the train rows with standard scaling, applied to every slice."""
    rows = freeze(_splits(spark, folder))
    assembler = FeatureAssembler(target_column=T, **{**SHIPPED, "attach_base": False})
    model = assembler.fit(rows.filter(F.col("split") == "train"))
    return tidy(model.transform(rows).select("series_id", "ts", "split", *ASSEMBLED))


@query(
    "selected_subset",
    f"""WITH {SPLIT_SQL}, inside AS (SELECT * FROM parts WHERE split IS NOT NULL),
      x AS (SELECT series_id, ts, lag("Close", 1) OVER {_over('series_id, split')}) AS l FROM inside)
      SELECT series_id, {when()}, 0.0::DOUBLE AS unknown, {num('coalesce(l, 0)', 'Close_lag_1')}
      FROM x""",
)
def selected_subset(spark, folder):
    """Missing values become 0, an unknown feature is 0, the order is the listed one."""
    rows = freeze(_splits(spark, folder))
    stages = [
        FeatureAssembler(target_column=T, **{**LEAN, "lags": 3}),
        FillMissing(),
        FeatureSubset(features=["unknown", "Close_lag_1"], fail_on_missing=False),
    ]
    model = Pipeline(stages=stages).fit(rows)
    return tidy(model.transform(rows).select("series_id", "ts", "unknown", "Close_lag_1"))


def _tree_predictions(spark, folder, name, params):
    splits = freeze(_splits(spark, folder))
    assembler = FeatureAssembler(target_column=T, **{**LEAN, "lags": 5, "rolling_windows": [3]})
    stages = [*feature_stages(assembler, None), create_estimator(name, params, LABEL)]
    model = Pipeline(stages=stages).fit(splits.filter(F.col("split") == "train"))
    predicted = model.transform(splits.filter(F.col("split") != "train"))
    return tidy(predicted.select("series_id", "ts", "split", "prediction"), 2)


WEEKDAYS_SQL = f"""{DAILY_SQL}, b AS (SELECT isodow(ts) - 1 AS x, "Close" AS y FROM bars)"""


def _stump_sql(name: str, rows: str) -> str:
    """The two means of ``rows`` (x, y) at the split of x that leaves the least squared error."""
    side = "count(*) FILTER ({0}) * var_pop(y) FILTER ({0})"
    return f"""{name}_cut AS (
        SELECT t FROM (
          SELECT c.t, r.x, r.y FROM {rows} r, (SELECT DISTINCT x AS t FROM {rows}) c
          WHERE c.t < (SELECT max(x) FROM {rows})) GROUP BY t
        ORDER BY {side.format('x <= t')} + {side.format('x > t')} LIMIT 1),
      {name} AS (SELECT t, avg(y) FILTER (x <= t) AS low, avg(y) FILTER (x > t) AS high
        FROM {rows}, {name}_cut GROUP BY t)"""


ONE_SPLIT_SQL = f"""WITH {WEEKDAYS_SQL}, {_stump_sql('s', 'b')}
  SELECT DISTINCT x::BIGINT AS weekday,
    {num('CASE WHEN x <= t THEN low ELSE high END', 'prediction', 2)} FROM b, s"""


def _weekday_predictions(spark, folder, name, params):
    """What a model of the close by the day of the week predicts for each day."""
    bars = daily_bars(spark, folder).select(F.weekday("ts").cast("double").alias("weekday"), "Close")
    rows = VectorAssembler(inputCols=["weekday"], outputCol="features").transform(bars)
    model = create_estimator(name, params, "Close").fit(rows)
    days = model.transform(rows.select("weekday", "features").dropDuplicates(["weekday"]))
    return tidy(days.select(F.col("weekday").cast("long").alias("weekday"), "prediction"), 2)


@query("dt_one_split", ONE_SPLIT_SQL)
def dt_one_split(spark, folder):
    return _weekday_predictions(spark, folder, "decision_tree", {"max_depth": 1})


@query("rf_without_bootstrap", ONE_SPLIT_SQL)
def rf_without_bootstrap(spark, folder):
    """Trees on all rows and all features are equal, and so is their mean."""
    params = {"n_estimators": 3, "max_depth": 1, "bootstrap": False}
    return _weekday_predictions(spark, folder, "random_forest", params)


@query(
    "gbt_two_stumps",
    f"""WITH {WEEKDAYS_SQL}, {_stump_sql('s', 'b')},
      r AS (SELECT x, 2 * (y - CASE WHEN x <= t THEN low ELSE high END) AS y FROM b, s),
      {_stump_sql('u', 'r')}
      SELECT DISTINCT x::BIGINT AS weekday,
        {num('CASE WHEN x <= s.t THEN s.low ELSE s.high END + 0.25 * CASE WHEN x <= u.t THEN u.low ELSE u.high END', 'prediction', 2)}
      FROM b, s, u""",
)
def gbt_two_stumps(spark, folder):
    """The second stump is fitted to the gradient, twice the error, and counts a quarter."""
    params = {"n_estimators": 2, "max_depth": 1, "learning_rate": 0.25}
    return _weekday_predictions(spark, folder, "gradient_boosting", params)


def _levels_sql(depth: int) -> str:
    """Grows a tree on x0 and x1 of ``g0`` (node 1, x0, x1, y) level by level into ``g<depth>``."""
    parts = []
    for k in range(depth):
        parts.append(f"""h{k} AS (SELECT node, f, x, count(*) AS n, sum(y) AS s FROM (
            SELECT node, 0 AS f, x0 AS x, y FROM g{k} UNION ALL SELECT node, 1, x1, y FROM g{k}) GROUP BY ALL),
          c{k} AS (SELECT node, f, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
              sum(n) OVER (PARTITION BY node, f) AS n, sum(s) OVER (PARTITION BY node, f) AS s
            FROM h{k} WINDOW w AS (PARTITION BY node, f ORDER BY x)),
          b{k} AS (SELECT DISTINCT ON (node) node, f, x AS t FROM c{k} WHERE nl < n
            ORDER BY node, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, f, x),
          g{k + 1} AS (SELECT 2 * g{k}.node + CASE WHEN CASE f WHEN 0 THEN x0 ELSE x1 END > t THEN 1 ELSE 0 END
              AS node, x0, x1, y FROM g{k} JOIN b{k} USING (node))""")
    return ", ".join(parts)


THREE_LEVELS_SQL = f"""WITH {DAILY_SQL}, g0 AS (
      SELECT 1 AS node, isodow(ts) - 1 AS x0, month(ts) AS x1,
        "Close" - (SELECT avg("Close") FROM bars) AS y FROM bars),
    {_levels_sql(3)},
    leaf AS (SELECT node, avg(y) + (SELECT avg("Close") FROM bars) AS value FROM g3 GROUP BY 1)
  SELECT DISTINCT x0::BIGINT AS weekday, x1::BIGINT AS month, {num('value', 'prediction', 2)}
  FROM g3 JOIN leaf USING (node)"""


def _calendar_predictions(spark, folder, name, params):
    """What a model of the close by weekday and month predicts for each that occurs."""
    bars = daily_bars(spark, folder).select(
        F.weekday("ts").cast("double").alias("weekday"), F.month("ts").cast("double").alias("month"), "Close"
    )
    rows = VectorAssembler(inputCols=["weekday", "month"], outputCol="features").transform(bars)
    model = create_estimator(name, params, "Close").fit(rows)
    days = model.transform(rows.dropDuplicates(["weekday", "month"]))
    names = [F.col(c).cast("long").alias(c) for c in ("weekday", "month")]
    return tidy(days.select(*names, "prediction"), 2)


@query("dt_three_levels", THREE_LEVELS_SQL)
def dt_three_levels(spark, folder):
    """Three levels on two features, grown in tasks on the broadcast table."""
    return _calendar_predictions(spark, folder, "decision_tree", {"max_depth": 3})


@query("dt_three_levels_over_rows", THREE_LEVELS_SQL)
def dt_three_levels_over_rows(spark, folder):
    """The same tree by one pass over the rows for each level, as for large tables."""
    with setting(spark, TREE_CELLS, "0"):
        return _calendar_predictions(spark, folder, "decision_tree", {"max_depth": 3})


@query("rf_of_400_equal_trees", THREE_LEVELS_SQL)
def rf_of_400_equal_trees(spark, folder):
    params = {"n_estimators": 400, "max_depth": 3, "bootstrap": False}
    return _calendar_predictions(spark, folder, "random_forest", params)


#: Boosted stumps on weekdays: what is known of a weekday is its count and sum, kept as lists.
STUMPS_SQL = f"""WITH RECURSIVE {WEEKDAYS_SQL},
  h AS (SELECT x, count(*)::DOUBLE AS n, sum(y) AS s FROM b GROUP BY x),
  l AS (SELECT list(x ORDER BY x) AS x, list(n ORDER BY x) AS n, list(s ORDER BY x) AS s FROM h),
  steps AS (
    SELECT 0 AS k, list_transform(n, lambda v: 0.0::DOUBLE) AS f, x, n, s FROM l
    UNION ALL
    SELECT k + 1, list_transform(range(1, len(n) + 1), lambda i: f[i] + CASE WHEN k = 0 THEN 1.0 ELSE 0.05 END
        * CASE WHEN i <= j THEN list_sum(t[1:j]) / list_sum(n[1:j])
          ELSE list_sum(t[j + 1:]) / list_sum(n[j + 1:]) END), x, n, s
    FROM (SELECT *, list_position(gains, list_max(gains)) AS j FROM (
      SELECT *, list_transform(range(1, len(n)), lambda i:
          list_sum(t[1:i]) * list_sum(t[1:i]) / list_sum(n[1:i])
          + list_sum(t[i + 1:]) * list_sum(t[i + 1:]) / list_sum(n[i + 1:])) AS gains
      FROM (SELECT *, list_transform(range(1, len(n) + 1),
          lambda i: CASE WHEN k = 0 THEN s[i] ELSE 2 * (s[i] - n[i] * f[i]) END) AS t FROM steps WHERE k < 100))))
  SELECT unnest(x)::BIGINT AS weekday, round(unnest(f), 2) AS prediction
  FROM steps WHERE k = 100"""


@query("gbt_hundred_stumps", STUMPS_SQL)
def gbt_hundred_stumps(spark, folder):
    params = {"n_estimators": 100, "max_depth": 1, "learning_rate": 0.05}
    return _weekday_predictions(spark, folder, "gradient_boosting", params)


@query("dt_fit")
def dt_fit(spark, folder):
    return _tree_predictions(spark, folder, "decision_tree", {"max_depth": 5, "random_state": 7})


@query("rf_fit")
def rf_fit(spark, folder):
    return _tree_predictions(
        spark, folder, "random_forest", {"n_estimators": 400, "max_depth": 6, "random_state": 42}
    )


@query("gbt_fit")
def gbt_fit(spark, folder):
    params = {"n_estimators": 100, "learning_rate": 0.05, "max_depth": 2, "random_state": 42}
    return _tree_predictions(spark, folder, "gradient_boosting", params)


SELECTION = SelectionConfig(
    estimator="lasso",
    params={"alpha": 1e-4, "max_iter": 10000},
    n_splits=2,
    min_features_to_select=5,
    scoring="neg_mean_absolute_percentage_error",
    gap=1,
    min_samples_required=5,
    correlation_threshold=0.9,
)


@query("rfecv")
def rfecv(spark, folder):
    """Rank and support of every feature, with the shipped settings."""
    train = _shipped_splits(spark, folder).filter(F.col("split") == "train")
    matrix, original = complete_rows(train, FeatureAssembler(target_column=T, **SHIPPED))
    result = choose_features(matrix, original, LABEL, SELECTION, "lasso")
    rows = list(zip(result.columns, result.ranking, result.support))
    return spark.createDataFrame(rows, "feature string, ranking long, support boolean")


def _searched(spark, folder, config):
    assembler = FeatureAssembler(target_column=T, **{**LEAN, "lags": 5, "scaler": "standard"})
    stages = feature_stages(assembler, None)
    train = freeze(_train(spark, folder))
    return tidy(search(stages, "ridge", {}, train, LABEL, config).summary)


@query("grid_search")
def grid_search(spark, folder):
    grid = {"estimator__alpha": [0.1, 10.0, 1000.0], "feature_assembler__lags": [2, 5]}
    scoring = "neg_mean_absolute_percentage_error"
    return _searched(
        spark, folder, TuningConfig(param_grid=grid, gap=1, scoring=scoring, refit=False)
    )


ALPHAS = (1, 10**14, 10**15)


ONE_FEATURE_SEARCH_SQL = (
    f"""WITH {SPLIT_SQL}, tr AS (
        SELECT *, row_number() OVER {_over()}) - 1 AS q, count(*) OVER (PARTITION BY series_id) AS m
        FROM parts WHERE split = 'train'),
      member AS (SELECT tr.*, k.fold, CASE WHEN q < m - (3 - k.fold) * (m // 4) - 1 THEN 'train'
          WHEN q >= m - (3 - k.fold) * (m // 4) AND q < m - (2 - k.fold) * (m // 4) THEN 'test' END
          AS "role" FROM tr, (VALUES (0), (1), (2)) AS k(fold)),
      lean AS (SELECT fold, "role", "{LABEL}" AS y,
          coalesce(lag("Close", 1) OVER {_over('series_id, fold, "role"')}), 0) AS x
        FROM member WHERE "role" IS NOT NULL),
      fits AS (SELECT fold, alpha, covar_pop(x, y) / (var_pop(x) + alpha / count(*)) AS w,
          avg(x) AS mx, avg(y) AS my
        FROM lean, (VALUES {', '.join(f'({a})' for a in ALPHAS)}) AS a(alpha)
        WHERE "role" = 'train' GROUP BY 1, 2),
      scores AS (SELECT fold, alpha,
          -avg(abs(y - my - w * (x - mx)) / greatest(abs(y), 2.220446049250313e-16)) AS score
        FROM lean JOIN fits USING (fold) WHERE "role" = 'test' GROUP BY 1, 2),
      means AS (SELECT alpha, avg(score) AS m, stddev_pop(score) AS s FROM scores GROUP BY 1)
      SELECT '{{"estimator__alpha": ' || alpha || '}}' AS params, {num('m', 'mean_test_score')},
        {num('s', 'std_test_score')}, rank() OVER (ORDER BY m DESC)::BIGINT AS rank_test_score
      FROM means"""
)


@query("grid_search_one_feature", ONE_FEATURE_SEARCH_SQL)
def grid_search_one_feature(spark, folder):
    """Three penalties on expanding folds, features built inside each fold's train and test."""
    return _one_feature_search(spark, folder)


@query("random_search_whole_grid", ONE_FEATURE_SEARCH_SQL)
def random_search_whole_grid(spark, folder):
    """As many draws as the grid has sets: without repetition that is the grid."""
    return _one_feature_search(spark, folder, strategy="random", n_iter=len(ALPHAS), random_state=1)


def _one_feature_search(spark, folder, **more):
    config = TuningConfig(
        param_grid={"estimator__alpha": list(ALPHAS)},
        gap=1,
        scoring="neg_mean_absolute_percentage_error",
        refit=False,
        **more,
    )
    stages = feature_stages(FeatureAssembler(target_column=T, **LEAN), None)
    train = freeze(_train(spark, folder))
    return tidy(search(stages, "ridge", {}, train, LABEL, config).summary)


@query("random_search")
def random_search(spark, folder):
    grid = {"estimator__alpha": [0.1, 1.0, 10.0, 100.0, 1000.0, 1e4]}
    config = TuningConfig(
        "random", grid, n_iter=3, gap=1, scoring="r2", random_state=42, refit=False
    )
    return _searched(spark, folder, config)


# One feature, the previous close inside the slice. The first row of a slice has none and
# gets 0; train rows without it are left out first, so the second row of the split is one too.
LEAN_SQL = f"""{SPLIT_SQL}, inside AS (SELECT * FROM parts WHERE split IS NOT NULL),
ranked AS (SELECT *, row_number() OVER {_over('series_id, split')}) AS r FROM inside),
kept_rows AS (SELECT * FROM ranked WHERE split <> 'train' OR r > 1),
lean AS (SELECT *, coalesce(lag("Close", 1) OVER {_over('series_id, split')}), 0) AS x,
           "{LABEL}" AS y FROM kept_rows),
ols AS (SELECT regr_slope(y, x) AS w, regr_intercept(y, x) AS b FROM lean WHERE split = 'train'),
ridge AS (SELECT covar_pop(x, y) / (var_pop(x) + 1e15 / count(*)) AS w, avg(x) AS mx, avg(y) AS my
          FROM lean WHERE split = 'train'),
guess AS (
  SELECT 'linear_regression' AS candidate, split, y, ols.b + ols.w * x AS f FROM lean, ols
  UNION ALL SELECT 'ridge', split, y, my + w * (x - mx) FROM lean, ridge),
metrics AS (
  SELECT candidate, split, count(*)::BIGINT AS n, sqrt(avg((y-f)*(y-f))) AS rmse,
         avg(abs(y-f)) AS mae, 100*avg(abs((y-f)/(y+1e-8))) AS mape,
         1 - sum((y-f)*(y-f)) / nullif(var_pop(y)*count(*), 0) AS r2
  FROM guess WHERE split IN ('val', 'test') GROUP BY 1, 2)"""


def _lean_competition(spark, folder, candidates):
    return run_competition(
        _splits(spark, folder), LABEL, FeatureAssembler(target_column=T, **LEAN), candidates,
        primary_metric="mae",
    )


@query(
    "competition",
    f"""WITH {LEAN_SQL} SELECT candidate, n, {num('rmse', digits=2)}, {num('mae', digits=2)},
          {num('mape', digits=3)}, {nums('r2')},
          row_number() OVER (ORDER BY metrics.mae, candidate) AS place
        FROM metrics WHERE split = 'val'""",
)
def competition(spark, folder):
    """Two linear candidates on one feature, ranked by their error on the val rows."""
    candidates = [
        Candidate("linear_regression", "linear_regression"),
        Candidate("ridge", "ridge", {"alpha": 1e15}),
    ]
    board = _lean_competition(spark, folder, candidates).leaderboard
    rounded = board.withColumns(
        {"rmse": F.round("rmse", 2), "mae": F.round("mae", 2), "mape": F.round("mape", 3)}
    )
    return tidy(rounded.select("candidate", "n", "rmse", "mae", "mape", "r2", "place"))


SHIPPED_CANDIDATES = (
    {"name": "linear_regression", "estimator": "linear_regression"},
    {
        "name": "gradient_boosting",
        "estimator": "gradient_boosting",
        "params": {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 6, "random_state": 42},
        "tuning": {
            "strategy": "grid",
            "param_grid": {
                "estimator__n_estimators": [100, 200, 300],
                "estimator__learning_rate": [0.05, 0.1],
                "estimator__max_depth": [2, 3],
            },
            "n_splits": 3,
            "gap": 1,
            "scoring": "neg_mean_absolute_percentage_error",
        },
    },
    {
        "name": "knn",
        "estimator": "knn",
        "params": {"n_neighbors": 5},
        "extra_steps": [{"type": "standard_scaler", "name": "knn_standard_scaler"}],
    },
)


@query("competition_shipped")
def competition_shipped(spark, folder):
    """Correlation drop, elimination, and the shipped candidates with their parameters and grid."""
    outcome = run_competition(
        _shipped_splits(spark, folder),
        LABEL,
        FeatureAssembler(target_column=T, **SHIPPED),
        [Candidate.from_mapping(c) for c in SHIPPED_CANDIDATES],
        SELECTION,
        "mape",
    )
    return tidy(outcome.leaderboard.drop("position"))


FORECAST_END = "2001-06-15"


def _forecast_sql(rows: str, need: int, value: str, more: str = "") -> str:
    """A row per series from the newest of ``rows``, which have the bar's number from the end.

    ``more`` is what a complete row needs beside enough bars.
    """
    return f"""newest AS (
        SELECT series_id, max(ts) AS latest, min(ts) AS oldest, count(*) AS n
        FROM {rows} WHERE back <= {need} GROUP BY 1),
      known AS (SELECT DISTINCT series_id FROM bars WHERE ts < TIMESTAMP '{FORECAST_END}')
      SELECT known.series_id, strftime(oldest, '%Y-%m-%dT%H:%M:%S') AS lookback_start,
        '{FORECAST_END}T00:00:00' AS lookback_end, 20::BIGINT AS horizon,
        strftime(CASE isodow(latest) WHEN 6 THEN latest - INTERVAL 1 DAY
          WHEN 7 THEN latest - INTERVAL 2 DAY ELSE latest END + INTERVAL 28 DAY, '%Y-%m-%d')
          AS prediction_date,
        {num(f"CASE WHEN n >= {need} THEN {value} END", 'prediction_value', 2)},
        coalesce(n >= {need} {more}, false) AS complete, true AS date_was_read
      FROM known LEFT JOIN newest USING (series_id)
        LEFT JOIN (SELECT * FROM {rows} WHERE back = 1) AS last USING (series_id), ols"""


RECENT_SQL = f"""recent AS (
  SELECT series_id, ts, "Close" AS c,
    row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS back,
    lag("Close", 1) OVER (PARTITION BY series_id ORDER BY ts) AS x,
    lag("Close", 20) OVER (PARTITION BY series_id ORDER BY ts) AS x20
  FROM bars WHERE ts < TIMESTAMP '{FORECAST_END}')"""


@query(
    "forecast_latest",
    f"WITH {LEAN_SQL}, {RECENT_SQL}, {_forecast_sql('recent', 2, 'b + w * last.x')}",
)
def forecast_latest(spark, folder):
    """The winner of a competition forecasts from the newest bars of every series."""
    candidates = [Candidate("linear_regression", "linear_regression")]
    best = _lean_competition(spark, folder, candidates).best.model
    result = forecasting.forecast(
        daily_bars(spark, folder),
        best,
        horizon=HORIZON,
        prediction_date=FORECAST_END,
        configured_start="1995-01-01",
    )
    return tidy(result, 2)


@query(
    "forecast_twenty_lags",
    f"""WITH {SPLIT_SQL}, ranked AS (
        SELECT *, row_number() OVER {_over('series_id, split')}) AS r FROM parts WHERE split = 'train'),
      lean AS (SELECT coalesce(lag("Close", 20) OVER {_over('series_id')}), 0) AS x, "{LABEL}" AS y
        FROM ranked WHERE r > 20),
      ols AS (SELECT regr_slope(y, x) AS w, regr_intercept(y, x) AS b FROM lean),
      {RECENT_SQL}, {_forecast_sql('recent', 21, 'b + w * last.x20')}""",
)
def forecast_twenty_lags(spark, folder):
    """A forecast from the price twenty bars ago: series need 21 bars, gaps or not."""
    assembler = FeatureAssembler(target_column=T, **{**LEAN, "lags": [20]})
    outcome = run_competition(
        _splits(spark, folder), LABEL, assembler,
        [Candidate("linear_regression", "linear_regression")], primary_metric="mae",
    )
    result = forecasting.forecast(
        daily_bars(spark, folder), outcome.best.model, horizon=HORIZON, prediction_date=FORECAST_END
    )
    return tidy(result, 2)


def _filled(column: str, over: str) -> str:
    """SQL for the last value so far, else the next one."""
    return f"""coalesce(last_value({column} IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value({column} IGNORE NULLS) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


LOOKED_FROM = "2001-05-10"
_IN_SERIES = "PARTITION BY series_id ORDER BY ts, ordinal"


@query(
    "forecast_with_macro",
    f"""WITH {SPLIT_SQL}, {MACRO_SQL},
      joined AS (SELECT bars.*, macro_a FROM bars LEFT JOIN macro_wide USING (ts)),
      carried AS (SELECT series_id, ts, ordinal, {_filled("macro_a", _IN_SERIES)} AS m FROM joined),
      inside AS (SELECT parts.*, m FROM parts JOIN carried USING (series_id, ts, ordinal) WHERE split = 'train'),
      ranked AS (SELECT *, row_number() OVER ({_IN_SERIES}) AS r FROM inside),
      lean AS (SELECT m, "{LABEL}" AS y, coalesce(lag("Close", 1) OVER ({_IN_SERIES}), 0) AS x
        FROM ranked WHERE r > 1),
      mo AS (SELECT avg(x) AS mx, avg(m) AS mm, avg(y) AS my, var_pop(x) AS aa, var_pop(m) AS bb,
        covar_pop(x, m) AS ab, covar_pop(x, y) AS ay, covar_pop(m, y) AS by_ FROM lean),
      ols AS (SELECT *, (ay*bb - by_*ab) / (aa*bb - ab*ab) AS wa, (by_*aa - ay*ab) / (aa*bb - ab*ab) AS wb FROM mo),
      near AS (SELECT series_id, count(*) FILTER (ts >= TIMESTAMP '{LOOKED_FROM}') AS late FROM joined
        WHERE ts < TIMESTAMP '{FORECAST_END}' GROUP BY 1),
      looked AS (SELECT joined.* FROM joined JOIN near USING (series_id) WHERE ts < TIMESTAMP '{FORECAST_END}'
        AND (late < 2 OR ts >= TIMESTAMP '{LOOKED_FROM}')),
      recent AS (SELECT series_id, ts, "Close" AS c, {_filled("macro_a", _IN_SERIES)} AS m,
        lag("Close", 1) OVER ({_IN_SERIES}) AS x,
        row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS back FROM looked),
      {_forecast_sql('recent', 2, 'my + wa * (last.x - mx) + wb * (last.m - mm)', 'AND last.m IS NOT NULL')}""",
)
def forecast_with_macro(spark, folder):
    """A model of the last close and a macro series; the series is attached to the newest bars."""
    names = {"macro_a": "macro_a"}
    bars, macro = daily_bars(spark, folder), macro_long(spark, folder)
    dataset = fetch_market_data(
        bars, ticker=None, start="1995-01-01", end="2002-01-01", macro=macro, macro_series=names
    )
    assembler = FeatureAssembler(
        target_column=T, **{**LEAN, "attach_base": True, "base_columns": ["macro_a"]}
    )
    outcome = run_competition(
        temporal_split(dataset, T, gap=1, horizon=HORIZON), LABEL, assembler,
        [Candidate("linear_regression", "linear_regression")], primary_metric="mae",
    )
    result = forecasting.forecast(
        bars, outcome.best.model, horizon=HORIZON, prediction_date=FORECAST_END, macro=macro, macro_series=names
    )
    return tidy(result, 2)


@query(
    "lookback_window",
    f"""WITH {DAILY_SQL} SELECT series_id, {when()}, {nums('Close')} FROM bars
        WHERE ts >= TIMESTAMP '2000-03-24' AND ts < TIMESTAMP '2000-06-16'""",
)
def lookback_window(spark, folder):
    """Sixty business days before a date; the bounds are literals in the filter and in the scan."""
    end = F.lit("2000-06-16").cast("timestamp")
    start = forecasting.lookback_start(end, 60, "1995-01-01")
    first = spark.range(1).select(start.cast("string")).first()[0]
    bars = daily_bars(spark, folder, first, "2000-06-16")
    return tidy(bars.select("series_id", "ts", "Close"))


@query(
    "latest_model",
    """SELECT o_orderpriority AS name, arg_max(v, v::INTEGER) AS version,
         arg_max('models/' || o_orderpriority || '/' || v, v::INTEGER) AS uri,
         arg_max('run-' || v, v::INTEGER) AS run_id
       FROM (SELECT o_orderpriority, o_orderkey::VARCHAR AS v FROM orders) GROUP BY 1""",
)
def latest_model(spark, folder):
    """The numerically largest of versions kept as text, per name."""
    version = F.col("o_orderkey").cast("string")
    models = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("name"),
        version.alias("version"),
        F.concat_ws("/", F.lit("models"), "o_orderpriority", version).alias("uri"),
        F.concat(F.lit("run-"), version).alias("run_id"),
    )
    return latest_versions(models)


@query(
    "runs_report",
    f"""WITH {NAIVE_SQL} SELECT candidate AS run_id, split AS name, {num('avg(abs(y-f))', 'mae', 3)},
          {num('sqrt(avg((y-f)*(y-f)))', 'rmse', 3)} FROM guess GROUP BY 1, 2""",
)
def runs_report(spark, folder):
    """Metrics logged as rows of text, pivoted to one row per run."""
    error = F.col("y") - F.col("f")
    logged = (
        _guesses(spark, folder)
        .groupBy(F.col("candidate").alias("run_id"), F.col("split").alias("name"))
        .agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))
        .unpivot(["run_id", "name"], ["mae", "rmse"], "key", "number")
        .withColumn("kind", F.lit("metric"))
        .withColumn("value", F.col("number").cast("string"))
    )
    return tidy(metrics_report(logged, ["mae", "rmse"]), 3)


@query(
    "split_in_blocks",
    f"""WITH {SPLIT_SQL} SELECT series_id, {when()}, ordinal, split, {nums(LABEL)}
        FROM parts WHERE split IS NOT NULL""",
)
def split_in_blocks(spark, folder):
    """Labels and splits by the way taken for long series, with small blocks."""
    with small_blocks(spark):
        splits = _splits(spark, folder)
    return tidy(splits.select("series_id", "ts", "ordinal", "split", LABEL))
