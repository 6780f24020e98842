"""Even ranges of a skewed column, as SQL predicates for parallel reads (``read_jdbc_snapshot(..., predicates=...)``).

Bounds spread evenly between the least and the largest value give one reader most of a skewed table.  ``even_ranges`` cuts at
quantiles of the values instead (a mergeable sketch), takes values that fill a reader's share or more apart, and cuts those, and
the nulls, by an integer column.  Counts of the cut ranges are exact, and small neighbours are joined.  Every row, rows with nulls
included, is in exactly one range.
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _literal(value) -> str:  # noqa: ANN001
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return str(value) if isinstance(value, decimal.Decimal) else repr(value)


def _split(condition: str, rows: int, target: float, split_by: str | None) -> list[tuple[str, float]]:
    """``condition`` alone, or cut by the remainder of ``split_by`` into parts of about ``target`` rows."""
    parts = max(1, round(rows / target)) if split_by else 1
    if parts == 1:
        return [(condition, rows)]
    return [(f"{condition} AND (MOD(ABS({split_by}), {parts}) = {r}" + (f" OR {split_by} IS NULL)" if r == 0 else ")"), rows / parts)
            for r in range(parts)]


def even_ranges(values: DataFrame, column: str, n: int, split_by: str | None = None, accuracy: int = 100_000) -> list[str]:
    """About ``n`` predicates over ``column`` (a number, date or timestamp) of similar row counts, from ``values``: the column
    itself, or an earlier copy of it, such as the last snapshot.  ``split_by`` names an integer column, preferably a key,
    by which values that hold more than one share are cut; without it they stay whole.  An empty table has one range."""
    if n < 1:
        raise ValueError("n must be at least 1")
    key = F.col(column)
    shares = [i / n for i in range(1, n)]
    total, known, cuts = values.agg(F.count(F.lit(1)), F.count(key),
                                    F.percentile_approx(key, shares or [0.5], accuracy)).first()
    target = max(total / n, 1.0)
    cuts = sorted(cuts or [])
    points = sorted(set(cuts))
    # the rows of every point and of every gap after it, exactly: at most 2n rows
    at = F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda x: x <= key)) if points else F.lit(0)
    on = key == F.get(F.array(*[F.lit(p) for p in points]), at - 1) if points else F.lit(False)
    counts = {(r["at"], r["on"]): r["n"] for r in values.where(key.isNotNull()).groupBy(at.alias("at"), F.coalesce(on, F.lit(False)).alias("on"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    # (condition, rows); conditions without rows stay too, as the table may have changed since
    found = _split(f"{column} IS NULL", total - known, target, split_by)
    low, held = None, counts.get((0, False), 0)   # what is joined so far, and the comparison that it starts with

    def close(high: str | None) -> tuple[str, float]:
        return " AND ".join(s for s in (low, high) if s) or f"{column} IS NOT NULL", held

    for i, p in enumerate(points, start=1):
        here, after = counts.get((i, True), 0), counts.get((i, False), 0)
        if here > target:   # apart, and cut
            found.append(close(f"{column} < {_literal(p)}"))
            found += _split(f"{column} = {_literal(p)}", here, target, split_by)
            low, held = f"{column} > {_literal(p)}", after
        elif held and held + here + after > 1.25 * target:
            found.append(close(f"{column} < {_literal(p)}"))
            low, held = f"{column} >= {_literal(p)}", here + after
        else:
            held += here + after
    found.append(close(None))
    return _joined(found, target)


def _joined(found: list[tuple[str, float]], target: float) -> list[str]:
    """The conditions, small ones joined until they have about a share."""
    out = [x for x in found if x[1] >= target / 2]
    conditions, rows = [], 0.0
    for c, r in sorted((x for x in found if x[1] < target / 2), key=lambda x: -x[1]):
        conditions, rows = [*conditions, c], rows + r
        if rows >= 0.75 * target:
            out.append((" OR ".join(f"({c})" for c in conditions), rows))
            conditions, rows = [], 0.0
    if conditions:
        if out:
            least = min(range(len(out)), key=lambda i: out[i][1])
            conditions, rows = [out[least][0], *conditions], rows + out.pop(least)[1]
        out.append((" OR ".join(f"({c})" for c in conditions), rows))
    return [c for c, _ in out]


def read_ranges(table: DataFrame, predicates: list[str]) -> DataFrame:
    """The rows of every range, one after another, with ``range`` (its number): a reader over ranges for tables without JDBC."""
    out = None
    for i, p in enumerate(predicates):
        part = table.where(p).withColumn("range", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out
