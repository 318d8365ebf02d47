"""Cleaning projections: names, types, text, missing values, encoding, scaling, rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import types as ty
from millrace.functions.expressions import chunks, rows_of
from millrace.functions.sqltext import aggregate_rows, name_sql, text_sql
from millrace.functions.types import ref
from millrace.operators.frequency import distinct_counts, distinct_map, fewer_than, modes
from millrace.operators.quantiles import column_quantiles
from millrace.operators.summary import column_facts, presence

# Thresholds and patterns that results must agree on.
DATE_SHARE = 0.50
NUMBER_SHARE = 0.80
DROP_MISSING_SHARE = 0.50
ENCODE_BELOW = 10
ID_SHARE = 0.95
ID_MIN_ROWS = 10
ID_SAMPLE = 10
ID_VALUE_PATTERN = r"(?i)([a-f0-9]{8,}|[A-Z0-9-]{12,}|^[0-9a-f]{32,})"
NO_MODE = "Unknown"

NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

_CLOCK = r"\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?"


@dataclass(frozen=True)
class DateShape:
    """A declared date format: its shape, and how to write it the ISO way."""

    name: str
    shape: str
    find: str | None = None
    iso: str | None = None


# The accepted formats.  Digit-only strings are never dates.  The shape test
# comes first, so text is not run through a date parser.
DATE_SHAPES = (
    DateShape("yyyy-MM-dd", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    DateShape("yyyy-MM-dd HH:mm:ss", rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}[ T]{_CLOCK}$"),
    DateShape(
        "yyyy/MM/dd", rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}}( {_CLOCK})?$",
        r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3",
    ),
    DateShape(
        "MM/dd/yyyy", rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}( {_CLOCK})?$",
        r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2",
    ),
)


def clean_name(name: str) -> str:
    """Strip, lower-case, blanks to underscores, drop other punctuation."""
    return re.sub(r"\W", "", re.sub(r"\s+", "_", name.strip().lower()))


def normalize_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        clash = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after cleaning: {clash}")
    return df.toDF(*names)


def number_text_sql(c: str) -> str:
    """Text to double, NULL where it is not a plain number."""
    return f"CASE WHEN {c} RLIKE {text_sql(NUMBER_SHAPE)} THEN try_cast(trim({c}) AS double) END"


def time_text_sql(c: str, shapes: Sequence[DateShape] = DATE_SHAPES) -> str:
    """Text to timestamp without time zone by the declared shapes, else NULL."""
    arms = []
    for s in shapes:
        iso = f"trim({c})"
        if s.find:
            iso = f"regexp_replace({iso}, {text_sql(s.find)}, {text_sql(s.iso)})"
        arms.append(f"WHEN trim({c}) RLIKE {text_sql(s.shape)} THEN try_cast({iso} AS timestamp_ntz)")
    return f"CASE {' '.join(arms)} END"


def to_number(column: str) -> Column:
    return F.expr(number_text_sql(name_sql(column)))


def to_time(column: str) -> Column:
    return F.expr(time_text_sql(name_sql(column)))


def apply_schema(df: DataFrame, schema: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Coerce to numeric / datetime / text; what cannot be read becomes NULL.

    Columns the table lacks are skipped.  NULL stays NULL in a text cast.
    """
    casts: dict[str, Column] = {}
    for name, want in schema.items():
        if name not in df.columns:
            continue
        c, text = ref(name), ty.is_text(ty.dtype_of(df, name))
        kind = want.get("dtype")
        if kind == "numeric":
            casts[name] = to_number(name) if text else ty.as_number(df, name)
        elif kind == "datetime":
            casts[name] = to_time(name) if text else c.cast("timestamp_ntz")
        elif kind == "text":
            casts[name] = c.cast("string")
    return df.withColumns(casts) if casts else df


def detect_types(df: DataFrame) -> DataFrame:
    """(column, suggestion, date_frac, num_frac).

    A text column is datetime if over half of all rows read as dates (tested
    first), numeric if over 80 % read as numbers, else text.  Other columns
    report their own type.
    """
    blocks = []
    for block in chunks(df.columns, 100):
        aggregates, records = {"rows": "count(1)"}, []
        for i, c in enumerate(block):
            kind = ty.dtype_of(df, c)
            date = num = "cast(NULL AS double)"
            found = text_sql(kind.simpleString())
            if ty.is_text(kind):
                aggregates[f"d{i}"] = f"count({time_text_sql(name_sql(c))})"
                aggregates[f"n{i}"] = f"count({number_text_sql(name_sql(c))})"
                date, num = f"try_divide(d{i}, rows)", f"try_divide(n{i}, rows)"
                found = (
                    f"CASE WHEN {date} > {DATE_SHARE}D THEN 'datetime' "
                    f"WHEN {num} > {NUMBER_SHARE}D THEN 'numeric' ELSE 'text' END"
                )
            records.append(
                {"column": text_sql(c), "suggestion": found, "date_frac": date, "num_frac": num}
            )
        blocks.append((aggregates, records))
    return aggregate_rows(df, blocks)


def correct_types(df: DataFrame) -> DataFrame:
    """Apply the suggested types; what cannot be read becomes NULL."""
    casts: dict[str, Column] = {}
    if ty.text_columns(df):
        for r in detect_types(df.select(*[ref(c) for c in ty.text_columns(df)])).collect():
            if r["suggestion"] == "numeric":
                casts[r["column"]] = to_number(r["column"])
            elif r["suggestion"] == "datetime":
                casts[r["column"]] = to_time(r["column"])
    return df.withColumns(casts) if casts else df


def standardize_text(df: DataFrame) -> DataFrame:
    """Text columns: blanks collapsed to one space, ends trimmed, lower case."""
    names = ty.text_columns(df)
    if not names:
        return df
    return df.withColumns(
        {c: F.lower(F.trim(F.regexp_replace(ref(c), r"(?U)\s+", " "))) for c in names}
    )


def drop_id_named(df: DataFrame) -> DataFrame:
    """Drop columns whose name ends in ``id``."""
    return df.drop(*[c for c in df.columns if c.lower().endswith("id")])


def _id_name(name: str) -> bool:
    low = name.lower()
    return low.endswith("id") or low.startswith("id_")


def excluded_columns(
    df: DataFrame, target: str | None = None, order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """(column, reason): columns to keep out of encoding and scaling.

    Reasons, first match wins: target, id_name, id_values (one of the first
    ten values by ``order_by`` looks like a hash), id_share (non-float with
    over 95 % distinct values in more than ten rows).
    """
    reasons: dict[str, str] = {}
    for c in df.columns:
        if c == target:
            reasons[c] = "target"
        elif _id_name(c):
            reasons[c] = "id_name"
    rest = [c for c in df.columns if c not in reasons]
    if rest:
        head = df.orderBy(*order_by) if order_by else df
        like = [F.coalesce(F.bool_or(ref(c).cast("string").rlike(ID_VALUE_PATTERN)), F.lit(False)) for c in rest]
        hits = head.limit(ID_SAMPLE).agg(*[x.alias(f"h{i}") for i, x in enumerate(like)]).first()
        reasons.update({c: "id_values" for c, hit in zip(rest, hits) if hit})
    rest = [c for c in rest if c not in reasons and not ty.is_float(ty.dtype_of(df, c))]
    rows = df.count()
    if rest and rows > ID_MIN_ROWS:
        seen = distinct_map(df, rest)
        reasons.update({c: "id_share" for c in rest if seen[c] / rows > ID_SHARE})
    ordered = [(c, reasons[c]) for c in df.columns if c in reasons]
    return df.sparkSession.createDataFrame(ordered, "column string, reason string")


def constant_columns(df: DataFrame) -> DataFrame:
    """(column, n_unique, kept): a column is kept with over one distinct value."""
    return distinct_counts(df).select("column", "n_unique", (F.col("n_unique") > 1).alias("kept"))


def drop_constant(df: DataFrame) -> DataFrame:
    """Drop constant columns; min < max decides it without a distinct count."""
    facts = column_facts(df, df.columns)
    return df.select(*[ref(c) for c in df.columns if facts[c]["varies"]])


def missing_by_column(df: DataFrame) -> dict[str, tuple[int, int]]:
    """(missing, rows) of the columns with missing values."""
    return {r["column"]: (r["missing"], r["rows"]) for r in presence(df).filter("missing > 0").collect()}


def impute_missing(df: DataFrame, gaps: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Fill NULLs; drop columns over half empty.

    Numbers take the exact median, other types the mode (smallest on a tie).
    ``gaps`` are the table's ``missing_by_column``, when known already.
    """
    gaps = missing_by_column(df) if gaps is None else gaps
    drop = [c for c, (lack, rows) in gaps.items() if lack / rows > DROP_MISSING_SHARE]
    fill = [c for c in gaps if c not in drop]
    numeric = [c for c in fill if ty.is_number_like(ty.dtype_of(df, c))]
    others = [c for c in fill if c not in numeric]
    values: dict[str, Column] = {}
    for c, (median,) in column_quantiles(df, numeric, [0.5]).items():
        kind = ty.dtype_of(df, c)
        if ty.is_boolean(kind):
            values[c] = F.lit(bool(median >= 0.5))
        else:
            values[c] = F.lit(median)
    if others:
        found = {r["column"]: r["value"] for r in modes(df, others).collect()}
        for c in others:
            values[c] = F.lit(found.get(c, NO_MODE)).cast(ty.dtype_of(df, c))
    out = df.drop(*drop)
    return out.withColumns({c: F.coalesce(ref(c), v) for c, v in values.items()}) if values else out


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else ty.number_columns(df)
    return df.fillna(0, subset=names) if names else df


@dataclass
class EncodedTarget:
    """A table with its encoded target, and the (value, code) classes."""

    table: DataFrame
    classes: DataFrame | None


def needs_encoding(df: DataFrame, target: str) -> bool:
    """Text always; numbers and booleans with under ten distinct values."""
    kind = ty.dtype_of(df, target)
    if ty.is_text(kind):
        return True
    return ty.is_number_like(kind) and target in fewer_than(df, [target], ENCODE_BELOW)


def encode_target(df: DataFrame, target: str, max_literal: int = 100, position: str | None = None) -> EncodedTarget:
    """Replace the target by the rank of its class, from 0.

    Classes are ranked in sorted order, or with a ``position`` column by the
    row that shows them first.  Missing targets count as the most frequent
    class.  A few classes become a literal lookup inside the projection; very
    many are ranked by a range sort and joined back.
    """
    ty.require_column(df, target)
    if not needs_encoding(df, target):
        return EncodedTarget(df, None)
    c, kind = ref(target), ty.dtype_of(df, target)
    counts = (
        df.filter(c.isNotNull()).groupBy(c.alias("value")).agg(
            F.count(F.lit(1)).alias("cnt"), (F.min(ref(position)) if position else F.lit(0)).cast("long").alias("first")
        )
    )
    # The most frequent class first; all classes, when there are few.
    found = counts.orderBy(F.desc("cnt"), "value").limit(max_literal + 1).collect()
    head = [r["value"] for r in found]
    if not head and ty.is_text(kind):
        head = [NO_MODE]
    filled = F.coalesce(c, F.lit(head[0])) if head else c
    if len(head) <= max_literal:
        first = {r["value"]: r["first"] for r in found}
        pairs = [(v, i) for i, v in enumerate(sorted(head, key=lambda v: (first.get(v, 0), v)))]
        coded = df.sparkSession.createDataFrame(
            pairs, T.StructType([T.StructField("value", kind), T.StructField("code", T.LongType())])
        )
        if not pairs:
            return EncodedTarget(df.withColumn(target, F.lit(None).cast("bigint")), coded)
        lookup = F.create_map(*[F.lit(x).cast(k) for v, i in pairs for x, k in ((v, kind), (i, "bigint"))])
        return EncodedTarget(df.withColumn(target, F.try_element_at(lookup, filled)), coded)
    coded = ranked_codes(counts, "value", ["first", "value"])
    joined = join_codes(df.withColumn("__class", filled), "__class", coded)
    table = joined.select(*[F.col("__code").alias(target) if x == target else ref(x) for x in df.columns])
    return EncodedTarget(table, coded)


def ranked_codes(classes: DataFrame, column: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """(value, code): the distinct values numbered in their own or a given order by a range sort."""
    kind = ty.dtype_of(classes, column)
    numbered = classes.orderBy(*[ref(c) for c in order_by or [column]]).select(ref(column)).rdd.zipWithIndex().map(lambda p: (p[0][0], p[1]))
    return classes.sparkSession.createDataFrame(
        numbered, T.StructType([T.StructField("value", kind), T.StructField("code", T.LongType())])
    )


BROADCAST_CODES = 200_000
CODE_SALTS = 64


def join_codes(df: DataFrame, column: str, coded: DataFrame) -> DataFrame:
    """Add ``__code`` by value.

    A counted small lookup is broadcast.  A large one is repeated over a few
    salts, so the rows of a very frequent value spread over that many tasks.
    """
    lookup = coded.select(F.col("value").alias(column), F.col("code").alias("__code"))
    if coded.count() <= BROADCAST_CODES:
        return df.join(F.broadcast(lookup), column, "left")
    salts = F.explode(F.sequence(F.lit(0), F.lit(CODE_SALTS - 1))).alias("__salt")
    # By the row's own values: a task that runs again deals its rows alike.
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[ref(c).cast("string") for c in df.columns]), F.lit(CODE_SALTS)).cast("int"))
    return salted.join(lookup.select("*", salts), [column, "__salt"], "left").drop("__salt")


def category_values(df: DataFrame, column: str, limit: int) -> list[str] | None:
    """Sorted distinct values, or None when there are more than ``limit``."""
    got = df.select(ref(column)).filter(ref(column).isNotNull()).distinct().limit(limit + 1).collect()
    return None if len(got) > limit else sorted(r[0] for r in got)


def one_hot(
    df: DataFrame, columns: Sequence[str] | None = None, max_categories: int = 1000
) -> DataFrame:
    """Boolean columns ``{col}_{value}`` for all but the first sorted category.

    A missing value is false in all of them.  A column with more than
    ``max_categories`` values would not fit a flat schema; it becomes one
    sparse vector column ``{col}_onehot`` with the same content.
    """
    names = list(columns) if columns is not None else ty.text_columns(df)
    flat: list[Column] = [ref(c) for c in df.columns if c not in names]
    wide: list[str] = []
    for c in names:
        values = category_values(df, c, max_categories)
        if values is None:
            wide.append(c)
            flat.append(ref(c))
            continue
        flat += [F.coalesce(ref(c) == v, F.lit(False)).alias(f"{c}_{v}") for v in values[1:]]
    out = df.select(*flat)
    return _sparse_one_hot(out, wide) if wide else out


def _sparse_one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Vector columns; the category list stays distributed.

    Codes count down from the last category, so the first category and the
    missing value share the last code, which the encoder leaves all zero.
    """
    from pyspark.ml.feature import OneHotEncoder

    out = df
    for c in columns:
        coded = ranked_codes(df.select(ref(c)).filter(ref(c).isNotNull()).distinct(), c)
        last = coded.count() - 1
        down = F.coalesce(F.lit(last) - F.col("__code"), F.lit(last)).cast("double")
        joined = join_codes(out, c, coded).withColumn("__index", down).drop("__code", c)
        encoder = OneHotEncoder(inputCol="__index", outputCol=f"{c}_onehot", dropLast=True)
        out = encoder.fit(joined).transform(joined).drop("__index")
    return out


def scale(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "standard",
    target: str | None = None,
) -> DataFrame:
    """Standard: (x - mean) / population deviation.  minmax: (x - min) / range.

    A column that does not vary keeps divisor 1.  The statistics enter the
    projection as literals, so scaling itself never shuffles.
    """
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling method {method!r}")
    names = [c for c in (columns if columns is not None else ty.number_columns(df)) if c != target]
    facts = column_facts(df, names) if names else {}
    out: dict[str, Column] = {}
    for c in names:
        f = facts[c]
        if not f["present"]:
            continue
        base = f["mean"] if method == "standard" else f["min"]
        width = f["std_pop"] if method == "standard" else f["max"] - f["min"]
        if not f["varies"]:
            base, width = f["min"], 1.0
        out[c] = (ty.as_number(df, c) - F.lit(base)) / F.lit(width or 1.0)
    return df.withColumns(out) if out else df


@dataclass(frozen=True)
class Rule:
    """``column op value``; rows that break it are flagged, dropped or clipped."""

    column: str
    op: str
    value: object
    action: str = "flag"

    @classmethod
    def of(cls, spec: Mapping | Rule) -> Rule:
        if isinstance(spec, Rule):
            return spec
        return cls(spec["column"], spec["op"], spec["value"], spec.get("action", "flag"))

    def broken(self) -> Column:
        """True where violated.  NULL never breaks an inequality but is not equal."""
        c, v = ref(self.column), F.lit(self.value)
        tests = {
            ">=": c < v, "<=": c > v, ">": c <= v, "<": c >= v, "==": ~c.eqNullSafe(v),
        }
        return F.coalesce(tests.get(self.op, F.lit(False)), F.lit(False))

    def label(self) -> str:
        return f"{self.column} {self.op} {self.value}"


def apply_rules(df: DataFrame, rules: Sequence[Mapping | Rule]) -> DataFrame:
    """The table after the rules, in order: drop filters, clip assigns the value."""
    out = df
    for rule in map(Rule.of, rules):
        if rule.column not in out.columns:
            continue
        if rule.action == "drop":
            out = out.filter(~rule.broken())
        elif rule.action == "clip" and ty.is_number(ty.dtype_of(out, rule.column)):
            kind = ty.dtype_of(out, rule.column)
            out = out.withColumn(
                rule.column, F.when(rule.broken(), F.lit(rule.value).cast(kind)).otherwise(ref(rule.column))
            )
    return out


def rule_violations(df: DataFrame, rules: Sequence[Mapping | Rule]) -> DataFrame:
    """(rule, action, violations); NULL violations for a missing column.

    Each rule is counted on the table as the earlier rules left it.  Earlier
    drops become part of the counting condition and earlier clips a
    substituted value, so all rules are counted in one scan.
    """
    parsed = [Rule.of(r) for r in rules]
    staged = df.withColumn("__live", F.lit(True))
    for i, rule in enumerate(parsed):
        if rule.column not in df.columns:
            continue
        staged = staged.withColumn(f"__v{i}", F.col("__live") & rule.broken())
        if rule.action == "drop":
            staged = staged.withColumn("__live", F.col("__live") & ~rule.broken())
        elif rule.action == "clip" and ty.is_number(ty.dtype_of(df, rule.column)):
            staged = apply_rules(staged, [rule])
    counts = staged.agg(
        *[
            (F.count_if(f"__v{i}") if r.column in df.columns else F.lit(None).cast("bigint")).alias(f"n{i}")
            for i, r in enumerate(parsed)
        ]
    )
    return counts.select(
        rows_of(
            [
                F.struct(
                    F.lit(r.label()).alias("rule"), F.lit(r.action).alias("action"),
                    F.col(f"n{i}").alias("violations"),
                )
                for i, r in enumerate(parsed)
            ]
        )
    )


def times_to_seconds(df: DataFrame) -> DataFrame:
    """Timestamps as seconds since 1970, so models and scaling can use them."""
    names = ty.time_columns(df)
    if not names:
        return df
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumns(
        {c: F.timestamp_diff("SECOND", epoch, ref(c).cast("timestamp_ntz")).cast("double") for c in names}
    )


def require_encoded(df: DataFrame, target: str | None = None) -> None:
    """Fail when text feature columns remain."""
    left = [c for c in ty.text_columns(df) if c != target]
    if left:
        raise ValueError(f"non-numeric feature columns remain: {left}")
