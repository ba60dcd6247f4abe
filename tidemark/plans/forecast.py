"""The forecast job: newest model, recent bars, one forecast per series."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.values import business_day_offset, date_or_now, iso_text, largest_integer
from tidemark.ml.stages import FeatureAssemblerModel, FeatureSubset
from tidemark.operators.clean import HELPERS, keep_one_per_key, numbers_to_double
from tidemark.operators.features import feature_names
from tidemark.operators.ordered import KEYS
from tidemark.plans.ingest import aligned_dataset
from tidemark.session import freeze
from tidemark.sources.macro import fetch_macro
from tidemark.sources.models import load_latest
from tidemark.sources.runs import read_runs

FALLBACK_HISTORY = 60
#: Business days searched first: a few per needed bar, and room for holidays.
DAYS_PER_BAR, SPARE_DAYS = 3, 20


def required_history(model: PipelineModel | None, values: Mapping[str, str] | None = None) -> int:
    """Bars a series needs up to its newest one.

    What the parameters and tags of a run say about lags; else what the model's assembler asks for;
    else 60.
    """
    if values:
        spark = SparkSession.builder.getOrCreate()
        pairs = [(str(k), str(v)) for k, v in values.items()]
        said = _largest_lag(spark.createDataFrame(pairs, "key string, value string"))
        if said is not None:
            return said
    for stage in model.stages if model is not None else []:
        if isinstance(stage, FeatureAssemblerModel):
            return stage.required_history()
    return FALLBACK_HISTORY


def _largest_lag(pairs: DataFrame) -> int | None:
    """The largest integer in any value whose key names lags; one query."""
    about = pairs.filter(F.lower("key").contains("lag"))
    return about.agg(F.max(largest_integer(F.col("value")).try_cast("long"))).first()[0]


def logged_history(runs: DataFrame, run_id: str) -> int | None:
    """The same from the log of a run."""
    return _largest_lag(runs.filter((F.col("run_id") == run_id) & F.col("kind").isin("param", "tag")))


def lookback_start(end: Column, days: int, configured: str | None = None) -> Column:
    """``days`` business days before ``end``, but not before the configured start."""
    start = business_day_offset(end, -days)
    return F.greatest(start, F.lit(configured).cast("timestamp")) if configured else start


def newest_bars(
    bars: DataFrame, rows: int, start: Column, end: Column, whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The bars before ``end`` that a forecast may need, and a row for every series with a bar.

    A series with ``rows`` complete bars from ``start`` on is read from there, which reaches the
    scan. Any other one gives its newest ``rows`` complete bars, however old: such are picked in every
    partition before the shuffle. With ``whole`` it gives its whole history, so that values which
    lie further back can be filled forward. No series depends on another one.
    """
    before = bars.filter(F.col("ts") < end)
    window = before.filter(F.col("ts") >= start)
    columns = [c for c in bars.columns if c not in HELPERS]
    full = reduce(lambda a, b: a & b, [_has_value(bars, c) for c in columns], F.lit(True))
    counts = window.filter(full).groupBy(*KEYS).agg(F.countDistinct("ts").alias("n"))
    known = before.select(*KEYS).distinct().join(counts, list(KEYS), "left")
    known = freeze(known.select(*KEYS, F.coalesce("n", F.lit(0)).alias("n")))
    short = known.filter(F.col("n") < rows).select(*KEYS)
    late = window.join(short, list(KEYS), "left_anti")
    early = before.join(short, list(KEYS), "left_semi")
    if not whole:
        newest = Window.partitionBy(*KEYS).orderBy(F.col("ts").desc(), F.col("ordinal").desc())
        once = keep_one_per_key(early.filter(full), "last")
        early = once.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= rows).drop("_r")
    return late.unionByName(early), known


def _has_value(bars: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    number = bars.schema[column].dataType.typeName() in ("double", "float")
    return value.isNotNull() & ~F.isnan(value) if number else value.isNotNull()


def needed_columns(model: PipelineModel) -> tuple[list[str], list[str]]:
    """The features that the model uses, and those of them that must come with the bars."""
    assembler = next((s for s in model.stages if isinstance(s, FeatureAssemblerModel)), None)
    if assembler is None:
        return [], []
    subset = next((s for s in model.stages if isinstance(s, FeatureSubset)), None)
    used = assembler.feature_columns()
    if subset is not None:
        used = [c for c in used if c in subset.setting("features")]
    settings = assembler.getOrDefault(assembler.settings)
    bundle = ("lags", "returns", "rolling_windows", "high_column", "low_column", "volume_column")
    built = feature_names(settings["target_column"], **{k: settings[k] for k in bundle})
    return used, [c for c in used if c not in built]


def forecast(
    bars: DataFrame,
    model: PipelineModel,
    *,
    horizon: int,
    history: int | None = None,
    prediction_date: str | None = None,
    configured_start: str | None = None,
    macro: DataFrame | None = None,
    macro_series: Mapping[str, str] | None = None,
    macro_fill_method: str | None = "ffill",
    macro_on: str = "timestamp",
) -> DataFrame:
    """One row per series with a bar before the date: the forecast from its newest bars.

    ``history`` bars are used, the model's need if not given. Where the newest bars leave a feature
    without a value ``complete`` is false and the forecast NULL. Macro series are attached and
    filled over the days looked at. An unreadable prediction date means now; ``date_was_read`` says so.
    """
    spark = bars.sparkSession
    rows = max(history or 0, required_history(model))
    # The bounds are one row of constants; as literals they reach the scan.
    text = F.lit(prediction_date).cast("string")
    end = date_or_now(text)
    bounds = spark.range(1).select(
        lookback_start(end, DAYS_PER_BAR * rows + SPARE_DAYS, configured_start).alias("start"),
        end.alias("end"),
        F.try_to_timestamp(text).isNotNull().alias("read"),
    ).select(
        F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "read"
    ).first()
    first, last = (F.timestamp_micros(F.lit(v)) for v in (bounds["start"], bounds["end"]))
    if configured_start:
        bars = bars.filter(F.col("ts") >= F.lit(configured_start).cast("timestamp"))

    with_macro = macro is not None and bool(macro_series)
    found, known = newest_bars(bars, rows, first, last, whole=with_macro)
    wide = None
    if with_macro:
        span = found.agg(F.min("ts").cast("string"), F.max("ts").cast("string")).first()
        wide = fetch_macro(macro, macro_series, *(span if span[0] else (None, None)))
    data = keep_one_per_key(numbers_to_double(aligned_dataset(found, wide, macro_fill_method, macro_on)), "last")
    newest = Window.partitionBy(*KEYS).orderBy(F.col("ts").desc())
    recent = freeze(data.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= rows).drop("_r"))

    used, given = needed_columns(model)
    absent = [c for c in given if c not in recent.columns]
    if absent:
        raise ValueError(f"The model needs columns that the bars and macro series lack: {absent}")
    latest = recent.groupBy(*KEYS).agg(F.max("ts").alias("ts"), F.min("ts").alias("oldest"))
    at_latest = ["ts", *KEYS]
    features = model.stages[0].transform(recent) if used else recent
    whole = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in used], F.lit(True))
    complete = features.join(latest, at_latest, "left_semi").select(*KEYS, whole.alias("complete"))
    predicted = model.transform(recent).join(latest, at_latest).select(*KEYS, "ts", "oldest", "prediction")
    result = known.select(*KEYS).join(predicted.join(complete, list(KEYS)), list(KEYS), "left")
    return result.select(
        *KEYS,
        iso_text(F.col("oldest")).alias("lookback_start"),
        iso_text(last).alias("lookback_end"),
        F.lit(horizon).alias("horizon"),
        F.to_date(business_day_offset(F.col("ts"), horizon)).alias("prediction_date"),
        F.when(F.col("complete"), F.col("prediction")).alias("prediction_value"),
        F.coalesce("complete", F.lit(False)).alias("complete"),
        F.lit(prediction_date is None or bounds["read"]).alias("date_was_read"),
    )


def forecast_from_registry(
    bars: DataFrame,
    config: Mapping,
    *,
    models_path: str,
    runs_path: str | None = None,
    prediction_date: str | None = None,
    ticker: str | None = None,
    configured_start: str | None = None,
    macro: DataFrame | None = None,
) -> DataFrame:
    """The same with the newest registered model, and its name, version and place.

    ``config["macro"]`` has ``series``, ``fill_method`` and ``on`` for the macro table.
    """
    spark = bars.sparkSession
    loaded = load_latest(spark, models_path, config["model_registry"]["model_name"])
    logged = logged_history(read_runs(spark, runs_path), loaded.run_id) if runs_path and loaded.run_id else None
    if ticker is not None:
        bars = bars.filter(F.col("series_id") == ticker.strip())
    wanted = config.get("macro") or {}
    result = freeze(
        forecast(
            bars,
            loaded.model,
            horizon=int(config.get("horizon", 1)),
            history=logged,
            prediction_date=prediction_date,
            configured_start=configured_start,
            macro=macro,
            macro_series=wanted.get("series"),
            macro_fill_method=wanted.get("fill_method", "ffill"),
            macro_on=wanted.get("on", "timestamp"),
        )
    )
    if result.isEmpty():
        raise ValueError("There are no bars to forecast from.")
    return result.select(
        "*",
        F.lit(datetime.now(timezone.utc).isoformat()).alias("generated_at"),
        F.lit(loaded.name).alias("model_name"),
        F.lit(loaded.version).alias("model_version"),
        F.lit(loaded.uri).alias("model_uri"),
    )
