"""Exact quantiles with linear interpolation, at any table size.

Columns of few rows use Spark's exact ``percentile``, whose state is one map
entry per distinct value.  Larger columns are narrowed in rounds: a mergeable
sketch proposes edges around the wanted ranks, and one counting pass tells
between (or at) which edges each rank lies.  A rank that falls on an edge is
settled at once, so heavy ties cannot stall the search; otherwise the open
interval between two edges, a few ten-thousandths of the last one, is searched
next.  When an interval holds few rows, its values are counted and the rank
read off.  Only counts per edge and those few values reach the driver.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from millrace.functions.expressions import chunks
from millrace.functions.sqltext import double_sql, inline, number_sql, record

DIRECT_LIMIT = 250_000
FINAL_LIMIT = 2_000
ACCURACY = 10_000


@dataclass(frozen=True)
class _Gap:
    """An open interval of values and the rows below and inside it."""

    low: float = -math.inf
    high: float = math.inf
    before: int = 0
    mass: int = 0

    def condition(self, c: str) -> str:
        tests = [f"{c} IS NOT NULL"]
        if self.low > -math.inf:
            tests.append(f"{c} > {double_sql(self.low)}")
        if self.high < math.inf:
            tests.append(f"{c} < {double_sql(self.high)}")
        return " AND ".join(tests)


@dataclass
class _Column:
    """The ranks still sought in one column, by the gap that holds them."""

    slot: str
    open: dict[_Gap, list[int]] = field(default_factory=dict)
    found: dict[int, float] = field(default_factory=dict)

    def place(self, rank: int, gap: _Gap) -> None:
        self.open.setdefault(gap, []).append(rank)


def _row(df: DataFrame, exprs: Sequence[str]) -> list:
    values: list = []
    for block in chunks(exprs, 200):
        values += list(df.selectExpr(*[f"{e} AS e{i}" for i, e in enumerate(block)]).first())
    return values


def _edges(df: DataFrame, columns: Sequence[_Column], accuracy: int) -> list[list[float]]:
    """Per column, sorted edges around the ranks sought."""
    slack = 2.0 / accuracy
    asked, owners = [], []
    for i, col in enumerate(columns):
        for gap, ranks in col.open.items():
            probs: list[float] = []
            for r in ranks:
                q = (r - gap.before + 0.5) / gap.mass
                probs += [max(0.0, q - slack), min(1.0, q + slack)]
            inside = f"CASE WHEN {gap.condition(col.slot)} THEN {col.slot} END"
            listed = ", ".join(double_sql(p) for p in probs)
            asked.append(f"percentile_approx({inside}, array({listed}), {accuracy})")
            owners.append((i, gap))
    edges: list[set[float]] = [set() for _ in columns]
    for (i, gap), got in zip(owners, _row(df, asked)):
        edges[i].update(got)
        edges[i].update(v for v in (gap.low, gap.high) if not math.isinf(v))
    return [sorted(e) for e in edges]


def _counts(df: DataFrame, columns: Sequence[_Column], edges: Sequence[list[float]]) -> list[dict[int, int]]:
    """Rows per column and position: 2i between edges i-1 and i, 2i+1 at edge i."""
    records = []
    for i, (col, cuts) in enumerate(zip(columns, edges)):
        listed = [double_sql(e) for e in cuts]
        above = " + ".join(f"int({col.slot} > {e})" for e in listed)
        records.append(
            record({"c": str(i), "at": f"2 * ({above}) + int({col.slot} IN ({', '.join(listed)}))"})
        )
    rows = df.selectExpr(inline(records)).filter("at IS NOT NULL").groupBy("c", "at").count().collect()
    out: list[dict[int, int]] = [{} for _ in columns]
    for r in rows:
        out[r["c"]][r["at"]] = r["count"]
    return out


def _narrow(df: DataFrame, columns: Sequence[_Column], accuracy: int) -> None:
    edges = _edges(df, columns, accuracy)
    for col, cuts, counts in zip(columns, edges, _counts(df, columns, edges)):
        ranks = [r for rs in col.open.values() for r in rs]
        col.open = {}
        bounds = [-math.inf, *cuts, math.inf]
        for rank in ranks:
            before = 0
            for at in range(2 * len(cuts) + 1):
                here = counts.get(at, 0)
                if rank < before + here:
                    break
                before += here
            if at % 2:
                col.found[rank] = cuts[at // 2]
            else:
                col.place(rank, _Gap(bounds[at // 2], bounds[at // 2 + 1], before, here))


def _read_off(df: DataFrame, columns: Sequence[_Column]) -> None:
    """Settle ranks in gaps of few rows from the counted values there."""
    records = []
    for i, col in enumerate(columns):
        inside = " OR ".join(f"({g.condition(col.slot)})" for g in col.open)
        records.append(record({"c": str(i), "v": f"CASE WHEN {inside} THEN {col.slot} END"}))
    rows = df.selectExpr(inline(records)).filter("v IS NOT NULL").groupBy("c", "v").count().collect()
    values: dict[int, list[tuple[float, int]]] = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["c"], r["v"])):
        values[r["c"]].append((r["v"], r["count"]))
    for i, col in enumerate(columns):
        for gap, ranks in col.open.items():
            inside = [(v, n) for v, n in values[i] if gap.low < v < gap.high]
            upto, total = [], gap.before
            for _, n in inside:
                total += n
                upto.append(total)
            for rank in ranks:
                col.found[rank] = inside[bisect_left(upto, rank + 1)][0]
        col.open = {}


def _select(df: DataFrame, columns: Sequence[_Column], accuracy: int, final_limit: int) -> None:
    while True:
        wide = [c for c in columns if any(g.mass > final_limit for g in c.open)]
        if not wide:
            break
        _narrow(df, wide, accuracy)
    left = [c for c in columns if c.open]
    if left:
        _read_off(df, left)


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    direct_limit: int = DIRECT_LIMIT,
    accuracy: int = ACCURACY,
    final_limit: int = FINAL_LIMIT,
) -> dict[str, list[float | None]]:
    """Per column the exact quantiles at ``probs``; None for an empty column."""
    names, probs = list(columns), [float(p) for p in probs]
    if not names:
        return {}
    slots = {c: f"c{i}" for i, c in enumerate(names)}
    numbers = df.selectExpr(*[f"{number_sql(df, c)} AS {slots[c]}" for c in names])
    present = dict(zip(names, _row(numbers, [f"count({s})" for s in slots.values()])))
    out: dict[str, list[float | None]] = {}
    small = [c for c in names if present[c] <= direct_limit]
    if small:
        listed = ", ".join(double_sql(p) for p in probs)
        for c, v in zip(small, _row(numbers, [f"percentile({slots[c]}, array({listed}))" for c in small])):
            out[c] = list(v) if v is not None else [None] * len(probs)
    big = {c: _Column(slots[c]) for c in names if c not in small}
    for c, col in big.items():
        ranks = {f(p * (present[c] - 1)) for p in probs for f in (math.floor, math.ceil)}
        for rank in sorted(ranks):
            col.place(rank, _Gap(mass=present[c]))
    if big:
        _select(numbers, list(big.values()), accuracy, final_limit)
    for c, col in big.items():
        out[c] = []
        for p in probs:
            at = p * (present[c] - 1)
            lo, hi = col.found[math.floor(at)], col.found[math.ceil(at)]
            out[c].append(lo + (hi - lo) * (at - math.floor(at)))
    return out
