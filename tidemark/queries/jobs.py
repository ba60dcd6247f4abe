"""Queries that write and read back: datasets, selections, searches, models, run logs, whole jobs."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.ml.competition import Candidate, choose_features, feature_stages, run_competition
from tidemark.ml.estimators import create_estimator
from tidemark.ml.selection import (
    SelectionConfig,
    load_selected_features,
    save_selection,
    select_features,
)
from tidemark.ml.stages import FeatureAssembler
from tidemark.ml.tuning import TuningConfig, save_tuning, search
from tidemark.operators.clean import numbers_to_double
from tidemark.plans.train import run_training
from tidemark.queries.features import SPLIT_SQL, T, _over
from tidemark.queries.fixtures import DAILY_SQL, daily_bars
from tidemark.queries.models import (
    ALPHAS,
    HORIZON,
    LABEL,
    LEAN,
    LEAN_SQL,
    ONE_FEATURE_SEARCH_SQL,
    _splits,
    _train,
    knn_predict,
)
from tidemark.queries.registry import ORACLES, num, nums, query, tidy, when
from tidemark.queries.tables import BARS_OUT
from tidemark.session import freeze, setting, shared_folder
from tidemark.sources.files import load_dataset, save_dataset
from tidemark.sources.models import load_latest, register_model
from tidemark.sources.runs import metrics_report, read_runs


def _new_folder(spark) -> str:
    return f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}"


@query("dataset_as_parquet", f"WITH {DAILY_SQL} SELECT {BARS_OUT} FROM bars")
def dataset_as_parquet(spark, folder):
    """Written in folders by series, and read back."""
    path = f"{_new_folder(spark)}/bars.parquet"
    save_dataset(daily_bars(spark, folder), path)
    return tidy(load_dataset(spark, {"save": {"path": path}}))


@query("dataset_as_csv", f"WITH {DAILY_SQL} SELECT {BARS_OUT} FROM bars")
def dataset_as_csv(spark, folder):
    """Written as text with a time column of another name, and read back with types from the header."""
    path = f"{_new_folder(spark)}/bars.csv"
    save_dataset(daily_bars(spark, folder).withColumnRenamed("ts", "Date"), path, "csv")
    return tidy(load_dataset(spark, {"path": path, "time_column": "Date"}))


PRICES = ("Open", "High", "Low", "Close", "Volume")


@query(
    "selection_file",
    f"""WITH {SPLIT_SQL}, train AS (SELECT * FROM parts WHERE split = 'train'),
      dropped AS ("""
    + " UNION ".join(
        f"""SELECT '{b}' AS b FROM train HAVING abs(nullif(corr("{a}", "{b}"), 'NaN'::DOUBLE)) > 0.3"""
        for i, a in enumerate(PRICES)
        for b in PRICES[i + 1 :]
    )
    + f""") SELECT name AS feature FROM (VALUES {', '.join(f"('{c}')" for c in PRICES)}) AS n(name)
      WHERE name NOT IN (SELECT b FROM dropped)""",
)
def selection_file(spark, folder):
    """Too few rows to eliminate on: what correlation leaves is kept, written and read back."""
    train = _train(spark, folder)
    matrix = train.select("series_id", "ts", "ordinal", *PRICES, LABEL)
    config = SelectionConfig("lasso", min_samples_required=10**9, correlation_threshold=0.3)
    result = choose_features(matrix, train, LABEL, config, "lasso")
    path = _new_folder(spark)
    save_selection(spark, result, config, path)
    names = load_selected_features(spark, path)
    return spark.createDataFrame([(n,) for n in names], "feature string")


def _elimination_sql() -> str:
    """Least squares on High and Low, then on the one of larger weight, in two folds and on all rows."""
    return f"""WITH {SPLIT_SQL}, tr AS (
        SELECT "High" AS a, "Low" AS b, "{LABEL}" AS y, row_number() OVER {_over()}) - 1 AS q,
          count(*) OVER (PARTITION BY series_id) AS m FROM parts WHERE split = 'train'),
      member AS (
        SELECT tr.*, k.fold, CASE WHEN k.fold = 2 OR q < m - (2 - k.fold) * (m // 3) - 1 THEN 'train'
            WHEN q >= m - (2 - k.fold) * (m // 3) AND q < m - (1 - k.fold) * (m // 3) THEN 'test' END AS "role"
        FROM tr, (VALUES (0), (1), (2)) AS k(fold)),
      mo AS (SELECT fold, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb,
          covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_
        FROM member WHERE "role" = 'train' GROUP BY 1),
      two AS (SELECT *, (ay*bb - by_*ab) / (aa*bb - ab*ab) AS wa, (by_*aa - ay*ab) / (aa*bb - ab*ab) AS wb FROM mo),
      fit AS (SELECT fold, 2 AS size, ma, mb, my, wa, wb FROM two
        UNION ALL SELECT fold, 1, ma, mb, my, CASE WHEN wa*wa > wb*wb THEN ay / aa ELSE 0 END,
          CASE WHEN wa*wa > wb*wb THEN 0 ELSE by_ / bb END FROM two),
      scores AS (SELECT fold, size, -avg(abs(y - my - wa * (a - ma) - wb * (b - mb))
          / greatest(abs(y), 2.220446049250313e-16)) AS s
        FROM member JOIN fit USING (fold) WHERE "role" = 'test' AND fold < 2 GROUP BY 1, 2),
      best AS (SELECT size FROM (SELECT size, avg(s) AS s FROM scores GROUP BY 1) ORDER BY s DESC, size LIMIT 1),
      gone AS (SELECT CASE WHEN wa*wa > wb*wb THEN 'Low' ELSE 'High' END AS name FROM two, best
        WHERE fold = 2 AND size = 1),
      means AS (SELECT size, avg(s) AS s FROM scores GROUP BY 1)
      SELECT n.name AS feature, CASE WHEN gone.name IS NULL THEN 1 ELSE 2 END::BIGINT AS ranking,
        gone.name IS NULL AS support, {num('(SELECT s FROM means WHERE size = 1)', 'score_1')},
        {num('(SELECT s FROM means WHERE size = 2)', 'score_2')}
      FROM (VALUES ('High'), ('Low')) AS n(name) LEFT JOIN gone ON gone.name = n.name"""


@query("rfecv_two_features", _elimination_sql())
def rfecv_two_features(spark, folder):
    """Elimination over two folds, with the mean score of each size."""
    matrix = _train(spark, folder).select("series_id", "ts", "ordinal", "High", "Low", LABEL)
    config = SelectionConfig(
        "linear_regression", n_splits=2, gap=1, scoring="neg_mean_absolute_percentage_error"
    )
    result = select_features(matrix, LABEL, config)
    rows = [
        (c, r, s, *result.validation_scores)
        for c, r, s in zip(result.columns, result.ranking, result.support)
    ]
    return tidy(
        spark.createDataFrame(rows, "feature string, ranking long, support boolean, score_1 double, score_2 double")
    )


@query(
    "tuning_file",
    ONE_FEATURE_SEARCH_SQL[: ONE_FEATURE_SEARCH_SQL.rindex("SELECT '{")]
    + f"""SELECT '{{"estimator__alpha": ' || alpha || '}}' AS params, fold::BIGINT AS fold, {nums('score')},
        {num('m', 'mean_test_score')}, alpha = (SELECT arg_max(alpha, m) FROM means) AS is_best
      FROM scores JOIN means USING (alpha)""",
)
def tuning_file(spark, folder):
    """A search written with its summary, one row per set and fold, and read back."""
    config = TuningConfig(
        param_grid={"estimator__alpha": list(ALPHAS)}, gap=1,
        scoring="neg_mean_absolute_percentage_error", refit=False,
    )
    stages = feature_stages(FeatureAssembler(target_column=T, **LEAN), None)
    result = search(stages, "ridge", {}, freeze(_train(spark, folder)), LABEL, config)
    path = _new_folder(spark)
    save_tuning(result, config, path)
    return tidy(spark.read.json(path).select("params", "fold", "score", "mean_test_score", "is_best"))


@query(
    "registered_model",
    f"""WITH {DAILY_SQL}, m AS (SELECT regr_slope("Close", "Low") AS w, regr_intercept("Close", "Low") AS b FROM bars)
      SELECT series_id, {when()}, '2' AS version, 'second' AS run_id, {num('b + w * "Low"', 'prediction', 2)}
      FROM bars, m""",
)
def registered_model(spark, folder):
    """Two versions are registered; the newest one is loaded and scores the bars."""
    bars, base = daily_bars(spark, folder), _new_folder(spark)
    for column, run in (("High", "first"), ("Low", "second")):
        stages = [
            VectorAssembler(inputCols=[column], outputCol="features"),
            create_estimator("linear_regression", {}, "Close"),
        ]
        model = Pipeline(stages=stages).fit(bars)
        register_model(spark, base, model, "prices", run_id=run, example=bars)
    newest = load_latest(spark, base, "prices")
    scored = newest.model.transform(bars).select(
        "series_id", "ts", F.lit(newest.version).alias("version"), F.lit(newest.run_id).alias("run_id"), "prediction"
    )
    return tidy(scored, 2)


@query(
    "training_job",
    f"""WITH {LEAN_SQL} SELECT candidate AS name, {num('mae', 'val_mae', 2)}, {num('rmse', 'val_rmse', 2)},
        '1' AS version,
        candidate = (SELECT arg_min(candidate, metrics.mae) FROM metrics WHERE split = 'val') AS is_best
      FROM metrics WHERE split = 'val'""",
)
def training_job(spark, folder):
    """Splits, candidates from a configuration, run log and registry, as the log tells it."""
    base, runs = _new_folder(spark), _new_folder(spark)
    config = {
        "target_column": T, "horizon": HORIZON, "split": {"train_size": 0.7, "val_size": 0.15, "gap": 1},
        "assembler": LEAN, "feature_selection": {"enabled": False}, "primary_metric": "mae",
        "candidates": [
            {"name": "linear_regression"},
            {"name": "ridge", "estimator": "ridge", "params": {"alpha": 1e15}},
        ],
        "model_registry": {"model_name": "prices"},
    }
    run_training(daily_bars(spark, folder), config, models_path=base, runs_path=runs)
    newest = load_latest(spark, base, "prices")
    log = read_runs(spark, runs)
    best = log.filter("key = 'best_candidate' and kind = 'param'").first()["value"]
    report = metrics_report(log, ["val_mae", "val_rmse"]).filter("name <> 'training'")
    named = report.select(
        "name", F.round("val_mae", 2).alias("val_mae"), F.round("val_rmse", 2).alias("val_rmse"),
        F.lit(newest.version).alias("version"), (F.col("name") == best).alias("is_best"),
    )
    return tidy(named)


@query(
    "extra_step",
    f"""WITH {LEAN_SQL}, z AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) AS c,
          count(*) AS many FROM lean WHERE split = 'train'),
      g AS (SELECT split, y, my + c / sx / (1 + 1000.0 / many) * (x - mx) / sx AS f FROM lean, z WHERE split <> 'train')
      SELECT split, {num('avg(abs(y - f))', 'mae', 2)}, {num('sqrt(avg((y - f) * (y - f)))', 'rmse', 2)}
      FROM g GROUP BY 1""",
)
def extra_step(spark, folder):
    """A candidate with a scaler of its own between the features and the estimator."""
    candidate = Candidate.from_mapping(
        {
            "name": "scaled ridge", "estimator": "ridge", "params": {"alpha": 1000.0},
            "extra_steps": [{"type": "standard_scaler", "name": "scaler"}],
        }
    )
    assembler = FeatureAssembler(target_column=T, **LEAN)
    best = run_competition(_splits(spark, folder), LABEL, assembler, [candidate], primary_metric="mae").best
    rows = [(s, m["mae"], m["rmse"]) for s, m in (("val", best.metrics_val), ("test", best.metrics_test))]
    return tidy(spark.createDataFrame(rows, "split string, mae double, rmse double"), 2)


@query(
    "base_columns_attached",
    f"""WITH {DAILY_SQL} SELECT series_id, {when()}, {nums('Open', 'Volume')},
        {num(f'lag("Close", 1) OVER {_over()})', 'Close_lag_1')} FROM bars""",
)
def base_columns_attached(spark, folder):
    """Listed bar columns beside the features; a feature without any value is dropped."""
    assembler = FeatureAssembler(
        target_column=T,
        **{**LEAN, "rolling_windows": [10**6], "attach_base": True, "base_columns": ["Open", "Volume"]},
    )
    bars = numbers_to_double(daily_bars(spark, folder))
    built = assembler.fit(bars).transform(bars)
    return tidy(built.drop("ordinal"))


@query("knn_predict_small_blocks", ORACLES["knn_predict"])
def knn_predict_small_blocks(spark, folder):
    """The same neighbours from blocks of a hundred rows, of which a query visits several."""
    with setting(spark, "spark.tidemark.neighbourRows", "100"):
        return freeze(knn_predict(spark, folder))
