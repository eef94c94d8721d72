"""The whole run: raw rows to forecasts, evaluation and reorder advice."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from shelftide.operators.checks import (
    load_audit,
    observe_rows,
    quality_report,
    require_quality,
    require_schema,
    require_unique_grain,
)
from shelftide.operators.cleaning import anomaly_count, clean
from shelftide.operators.encoding import id_dimensions
from shelftide.operators.evaluation import evaluate, forecast_errors, report_document, stockout_rate
from shelftide.operators.features import feature_table
from shelftide.operators.inventory import recommend, run_summary, unmatched_count
from shelftide.operators.modelling import DemandModel, load_model, model_path, predict, save_model, stamp, train, variant_name
from shelftide.params import Settings
from shelftide.plans.steps import Steps, source_fingerprint
from shelftide.sources.sales_csv import read_sales_csv
from shelftide.sources.sinks import write_forecast, write_inventory, write_parquet, write_text


@dataclass(frozen=True)
class RunResult:
    features: DataFrame
    model: DemandModel
    model_path: str
    scored: DataFrame
    metrics: DataFrame
    stockouts: DataFrame
    recommendations: DataFrame
    summary: DataFrame
    # Counted while the cleaned rows were staged.
    audit: DataFrame
    quality: DataFrame
    anomalies: DataFrame
    # The steps that were taken over from an earlier run.
    reused: tuple[str, ...] = ()


def _staged_rows(raw: DataFrame, steps: Steps) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The cleaned rows, and their reports. One pass over the raw rows: the reports are counted by the write."""
    cleaned = clean(raw)
    require_schema(cleaned, step="clean")
    watched, counts = observe_rows(cleaned)
    rows = steps.table("cleaned", lambda: watched, inputs=(source_fingerprint(raw),))
    reports = ("load_audit", "quality_report", "anomaly_count")
    if "cleaned" not in steps.reused:
        return rows, {name: steps.table(name, getattr(counts, name), inputs=("cleaned",)) for name in reports}
    # Taken over: so are the reports, unless the run was stopped between.
    again = {"load_audit": lambda: load_audit(rows), "quality_report": lambda: quality_report(rows), "anomaly_count": lambda: anomaly_count(rows)}
    return rows, {name: steps.table(name, again[name], inputs=("cleaned",)) for name in reports}


def _trained(features: DataFrame, folder: str, dimensions: dict, steps: Steps, settings: Settings, use_baseline: bool) -> tuple[DemandModel, str]:
    steps.fingerprint("model", [asdict(settings), use_baseline], ("features",))
    if steps.known("model"):
        return load_model(features.sparkSession, f"{folder}/models", use_baseline), model_path(f"{folder}/models", use_baseline)
    model = train(features, settings, use_baseline)
    path = save_model(model, f"{folder}/models", dimensions)
    steps.publish("model", path=path)
    return model, path


def run(
    raw: DataFrame,
    folder: str,
    settings: Settings = Settings(),
    use_baseline: bool = False,
    check_grain: bool = True,
    strict_quality: bool = False,
    resume: bool = False,
) -> RunResult:
    """Runs every step on a frame of raw rows.

    The cleaned rows, the features, the model, the forecasts and the advice are steps in ``folder`` under the name
    of the variant (``steps``), each being read several times: text files are parsed once, windows are
    computed once, and the reports on the rows are counted while they are written. With ``resume`` steps of an earlier run
    on the same files with the same settings are taken over, up to the first that is not there. With ``check_grain`` a
    repeated (date, entity) stops the run, which is also what bounds the length of one series; ``strict_quality`` stops
    it for NULLs and values out of range.
    """
    panel = settings.panel
    steps = Steps(raw.sparkSession, f"{folder}/staged/{variant_name(use_baseline)}", resume)
    cleaned, reports = _staged_rows(raw, steps)
    if strict_quality:
        require_quality(reports["quality_report"])
    if check_grain:
        require_unique_grain(cleaned, panel.grain)
    dimensions = id_dimensions(cleaned, settings.encoding)
    described = [asdict(settings.encoding), asdict(settings.features), asdict(panel)]
    features = steps.table(
        "features", lambda: feature_table(cleaned, settings.encoding, settings.features, panel, dimensions), described, ("cleaned",)
    )
    model, saved = _trained(features, folder, dimensions, steps, settings, use_baseline)
    scored = steps.table("scored", lambda: predict(features, model), inputs=("features", "model"))
    advice = steps.table(
        "recommendations", lambda: recommend(scored, features, settings.policy, panel), asdict(settings.policy), ("scored", "features")
    )
    recommendations = advice.orderBy(*panel.entity)
    unmatched = unmatched_count(scored, features, panel)
    return RunResult(
        features=features,
        model=model,
        model_path=saved,
        scored=scored,
        metrics=evaluate(scored, panel),
        stockouts=stockout_rate(scored, panel),
        recommendations=recommendations,
        summary=run_summary(scored, recommendations, settings.policy, panel, unmatched),
        audit=reports["load_audit"],
        quality=reports["quality_report"],
        anomalies=reports["anomaly_count"],
        reused=tuple(steps.reused),
    )


def run_from_csv(
    spark: SparkSession,
    source: str,
    folder: str,
    settings: Settings = Settings(),
    use_baseline: bool = False,
    run_id: str | None = None,
    model_version: str = "1",
    resume: bool = False,
) -> dict[str, str | dict[str, str]]:
    """Reads the sales file, runs every step and writes the outputs; returns their paths.

    With a ``run_id`` the forecast errors (under their published names) and the summary carry the
    run, the model version and the time of writing. ``resume`` takes over the steps of a run that was stopped.
    """
    result = run(read_sales_csv(spark, source), folder, settings, use_baseline, resume=resume)
    variant = result.model.variant
    stamped = (lambda df: stamp(df, run_id, model_version)) if run_id else (lambda df: df)
    predictions = f"{folder}/predictions/{variant}"
    return {
        "model": result.model_path,
        "metrics": write_text(report_document(result.metrics), f"{folder}/models/{variant}_evaluation_metrics"),
        "forecast": write_forecast(result.scored, predictions, settings.output),
        "inventory": write_inventory(result.recommendations, predictions, settings.output, settings.panel),
        "errors": write_parquet(stamped(forecast_errors(result.scored, settings.panel)), f"{predictions}/forecast_errors"),
        "stockouts": write_parquet(result.stockouts, f"{predictions}/stockout_rates"),
        "summary": write_parquet(stamped(result.summary), f"{predictions}/run_summary"),
        "quality": write_parquet(result.quality, f"{predictions}/quality_report"),
    }
