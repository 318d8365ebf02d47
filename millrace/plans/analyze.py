"""One call from a file to a report."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import union_all
from millrace.operators import evidence as ev
from millrace.operators import quality
from millrace.plans.clean import CleanResult, clean
from millrace.plans.model import ModelResult, model
from millrace.plans.profile import profile
from millrace.sources import sinks
from millrace.sources.tables import load_table


class TargetError(ValueError):
    """The target is not viable."""


@dataclass
class Analysis:
    run_id: str
    cleaned: CleanResult
    target: str
    problem_type: str
    profile: dict[str, DataFrame]
    model: ModelResult
    evidence: DataFrame

    def report(self) -> DataFrame:
        return report_rows(self)


def report_rows(a: Analysis) -> DataFrame:
    """(section, key, value) as text: what a report page is filled from."""
    spark = a.cleaned.table.sparkSession
    scalars = [
        ("dataset_summary", "rows", str(a.cleaned.metrics["rows_after"])),
        ("dataset_summary", "columns", str(len(a.cleaned.table.columns))),
        ("dataset_summary", "features_used", str(len(a.model.selection.features))),
        ("problem_framing", "target_column", a.target),
        ("problem_framing", "problem_type", a.problem_type),
        ("model_training", "best_model", a.model.best.name),
        ("model_training", "baseline_score", f"{a.model.baseline_score:.6f}"),
        ("model_training", "best_score", f"{a.model.best_score:.6f}"),
    ]
    kinds = "section string, key string, value string"

    def rows(frame: DataFrame, section: str, key, value) -> DataFrame:
        return frame.select(F.lit(section).alias("section"), key.alias("key"), value.cast("string").alias("value"))

    strength = ev.model_strength(a.model.metrics)
    told = ev.formatted_evidence(a.evidence)
    return union_all(
        [
            spark.createDataFrame(scalars, kinds),
            rows(strength, "evaluation_metrics", F.col("metric"), F.col("value")),
            rows(strength.limit(1), "model_strength", F.lit("label"), F.col("strength")),
            rows(a.model.sanity, "sanity_check", F.col("check"), F.col("passed")),
            rows(a.model.importance.limit(5), "top_features", F.col("feature"), F.col("importance")),
            rows(a.cleaned.delta(), "data_quality", F.col("metric"), F.col("change")),
            rows(
                told, "evidence", F.col("feature"),
                F.concat_ws(" | ", F.col("observation"), F.col("significance")),
            ),
        ]
    )


def analyze(
    spark: SparkSession,
    source: str | DataFrame,
    kind: str = "parquet",
    target: str | None = None,
    schema: Mapping | None = None,
    rules: Sequence[Mapping] = (),
    keys: Sequence[str] = (),
    context: dict | None = None,
    output: str | None = None,
    max_plots: int = 30,
    challenger: str = "forest",
    trees: int | None = None,
) -> Analysis:
    """Clean, gate the target, profile, model, collect evidence.

    The target defaults to the last column of the readable table, chosen
    before encoding.  With ``output`` the tables, contract, model and run log
    are written below it.
    """
    run_id = uuid.uuid4().hex
    started = datetime.now(timezone.utc).isoformat()
    name = kind if isinstance(source, str) else "table"

    def log(status: str, metrics: Mapping[str, int], **more) -> None:
        if output:
            sinks.append_run(
                spark, f"{output}/runs", run_id=run_id, file_type=name, status=status, started_at=started,
                ended_at=datetime.now(timezone.utc).isoformat(), **metrics, **more,
            )

    metrics: Mapping[str, int] = {}
    try:
        df = load_table(spark, source, kind) if isinstance(source, str) else source
        if name not in ("parquet", "table"):
            df = sinks.stage(df, "loaded")  # read row text or the database once
        if target is None:
            probe = clean(df, None, schema, rules, keys, encode=False)
            target = [c for c in probe.readable.columns if c not in probe.keys][-1]
            df, schema, rules = probe.readable, None, ()
        cleaned = clean(df, target, schema, rules, keys)
        metrics = cleaned.metrics
        target = cleaned.target
        bad = [r["check"] for r in quality.target_gate(cleaned.table, target).collect() if not r["passed"]]
        if bad:
            raise TargetError(f"target {target!r} fails {bad}")
        problem = quality.problem_type(cleaned.table, target)
        features = cleaned.table.drop(*cleaned.keys)
        profiled = profile(features, target, max_plots=max_plots)
        more = {} if trees is None else {"trees": trees}
        fitted = model(cleaned.table, target, problem, cleaned.keys, challenger, **more)
        top = [r["feature"] for r in fitted.importance.limit(ev.MAX_DRIVERS).collect()]
        facts = ev.evidence_table(cleaned.readable, target, source_columns(top, cleaned.readable), problem)
        result = Analysis(run_id, cleaned, target, problem, profiled, fitted, facts)
        if output:
            sinks.save_table(cleaned.table, f"{output}/cleaned")
            sinks.save_table(cleaned.readable, f"{output}/readable")
            sinks.save_artefacts(profiled, f"{output}/profile", run_id)
            sinks.write_contract(spark, f"{output}/contract", target, problem, context)
            sinks.save_model(fitted.best.model, f"{output}/model")
            sinks.save_artefacts({"report": report_rows(result), "evidence": facts}, output, run_id)
    except Exception as e:
        log("FAILED", metrics, error=str(e)[:2000])
        raise
    log("SUCCESS", metrics, output_path=f"{output}/cleaned")
    return result


def source_columns(features: Sequence[str], readable: DataFrame) -> list[str]:
    """Readable columns behind encoded feature names, in order, without repeats.

    ``city_paris`` came from ``city``; the longest matching column wins.
    """
    found: list[str] = []
    for f in features:
        match = [c for c in readable.columns if f == c or f.startswith(f"{c}_")]
        name = max(match, key=len) if match else f
        if name not in found:
            found.append(name)
    return found
