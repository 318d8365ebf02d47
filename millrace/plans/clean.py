"""From a raw table to a readable cleaned table and an encoded, scaled one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from millrace.functions import types as ty
from millrace.functions.types import ref
from millrace.operators import cleaning as cl
from millrace.operators import hypothesis, quality
from millrace.sources.sinks import stage


class GateError(ValueError):
    """The table fails the load gate."""


@dataclass
class CleanResult:
    readable: DataFrame
    table: DataFrame
    target: str | None
    keys: list[str]
    metrics: dict[str, int]
    outliers: DataFrame
    leakage: DataFrame
    violations: DataFrame | None
    actions: list[tuple[str, str | None, int | None]] = field(default_factory=list)

    def log(self) -> DataFrame:
        """(step, action, column, n)."""
        rows = [(i, *a) for i, a in enumerate(self.actions, 1)]
        return self.table.sparkSession.createDataFrame(
            rows, "step bigint, action string, `column` string, n bigint"
        )

    def metadata(self) -> DataFrame:
        return quality.table_metadata(self.table)

    def delta(self) -> DataFrame:
        """(metric, before, after, change)."""
        rows = [
            (m, self.metrics[f"{m}_before"], self.metrics[f"{m}_after"],
             self.metrics[f"{m}_before"] - self.metrics[f"{m}_after"])
            for m in ("rows", "duplicates", "missing")
        ]
        return self.table.sparkSession.createDataFrame(
            rows, "metric string, before bigint, after bigint, change bigint"
        )


def _profile(df: DataFrame, when: str) -> dict[str, int]:
    r = quality.quality_profile(df).first()
    return {
        f"rows_{when}": r["rows"], f"duplicates_{when}": r["duplicates"],
        f"missing_{when}": r["missing_total"],
    }


def prepare(
    df: DataFrame, schema: Mapping | None, actions: list
) -> DataFrame:
    """Types, names, missing values: everything ahead of duplicate removal."""
    typed = cl.correct_types(cl.apply_schema(df, schema) if schema else df)
    changed = [c for c in df.columns if typed.schema[c].dataType != df.schema[c].dataType]
    actions += [("retype", c, None) for c in changed]
    if changed:
        # Parse the text once; every later pass reads typed columns.
        typed = stage(typed, "typed")
    named = cl.normalize_names(typed)
    gaps = cl.missing_by_column(named)
    filled = cl.impute_missing(named, gaps)
    for c, (n, _) in gaps.items():
        actions.append(("fill_missing" if c in filled.columns else "drop_mostly_missing", c, n))
    return filled


def clean(
    df: DataFrame,
    target: str | None = None,
    schema: Mapping | None = None,
    rules: Sequence[Mapping] = (),
    keys: Sequence[str] = (),
    rules_stage: str = "raw",
    encode: bool = True,
    scale_method: str | None = "standard",
    max_categories: int = 1000,
) -> CleanResult:
    """Gate, type, name, fill, deduplicate, standardise; then encode and scale.

    ``keys`` name row identifiers to carry through unscaled; other id-like
    columns are dropped.  Rules run on natural values (``raw``) or on the
    scaled table (``scaled``).
    """
    if rules_stage not in ("raw", "scaled"):
        raise ValueError("rules_stage is 'raw' or 'scaled'")
    failed = [r["check"] for r in quality.validate_table(df).collect() if not r["passed"]]
    if failed:
        raise GateError(f"table rejected by checks: {failed}")
    metrics = _profile(df, "before")
    actions: list[tuple[str, str | None, int | None]] = []
    target = cl.clean_name(target) if target else None
    keys = [cl.clean_name(k) for k in keys]

    filled = prepare(df, schema, actions)
    outliers = quality.iqr_outliers(filled)
    actions += [("outliers", r["column"], r["cnt"]) for r in outliers.collect()]
    # Repeats do not decide whether a column varies, so constants are found
    # before the rows are shuffled for duplicate removal, and duplicates by
    # the remaining columns are the same rows.
    varied = cl.drop_constant(filled)
    actions += [("drop_constant", c, None) for c in filled.columns if c not in varied.columns]
    tidy = cl.standardize_text(quality.drop_duplicate_rows(varied))
    actions += [("standardize_text", c, None) for c in ty.text_columns(tidy)]
    violations = None
    if rules and rules_stage == "raw":
        violations = cl.rule_violations(tidy, rules)
        tidy = cl.apply_rules(tidy, rules)
    readable = stage(tidy, "readable")
    kept = readable.count()
    actions.append(("remove_duplicates_and_rules", None, metrics["rows_before"] - kept))

    if target is not None:
        ty.require_column(readable, target)
    table = readable
    if encode:
        if target is not None:
            table = cl.encode_target(table, target).table
        features = table.drop(*[c for c in (target, *keys) if c])
        out_of = [r["column"] for r in cl.excluded_columns(features, order_by=features.columns).collect()]
        actions += [("exclude", c, None) for c in out_of]
        table = cl.times_to_seconds(table.drop(*out_of))
        table = cl.one_hot(table, [c for c in ty.text_columns(table) if c not in (target, *keys)], max_categories)
        if scale_method:
            nums = [c for c in ty.number_columns(table) if c not in (target, *keys)]
            table = cl.scale(table, nums, scale_method)
        if target is not None:
            table = table.select(*[ref(c) for c in table.columns if c != target], ref(target))
        cl.require_encoded(table.drop(*keys), target)
    if rules and rules_stage == "scaled":
        violations = cl.rule_violations(table, rules)
        table = cl.apply_rules(table, rules)
    table = stage(table, "cleaned")
    leakage = hypothesis.leakage_report(table, target)
    metrics.update(_profile(table, "after"))
    return CleanResult(
        readable, table, target, keys, metrics, outliers, leakage, violations, actions
    )


def clean_steps(df: DataFrame, schema: Mapping | None = None) -> DataFrame:
    """The readable cleaned table alone."""
    filled = prepare(df, schema, [])
    return cl.standardize_text(quality.drop_duplicate_rows(cl.drop_constant(filled)))
