"""Declarative data checks that count violations, and column profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.operators.align import union_all
from tripflow.operators.joins import without_parent

WARN = "warn"
ERROR = "error"


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...]
    severity: str = ERROR
    values: tuple = ()
    parent: DataFrame | None = None
    parent_column: str = ""
    # Column and value: the check looks at these rows only.
    only: tuple[str, str] | None = None


def unique(*columns: str, severity: str = ERROR) -> Check:
    return Check("unique", columns, severity)


def not_null(column: str, severity: str = ERROR) -> Check:
    return Check("not_null", (column,), severity)


def accepted_values(column: str, values: Sequence, severity: str = ERROR) -> Check:
    return Check("accepted_values", (column,), severity, values=tuple(values))


def relationships(
    column: str,
    parent: DataFrame,
    parent_column: str,
    severity: str = ERROR,
    only: tuple[str, str] | None = None,
) -> Check:
    return Check(
        "relationships", (column,), severity, parent=parent, parent_column=parent_column, only=only
    )


def duplicate_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Values held by more than one row, with their row counts; NULLs aside."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count("*").alias("row_count"))
        .filter("row_count > 1")
    )


def _row_violation(check: Check) -> Column:
    column = F.col(check.columns[0])
    if check.kind == "not_null":
        return column.isNull()
    return column.isNotNull() & ~column.isin(list(check.values))


def _label(check: Check) -> list[Column]:
    name = "+".join(check.columns)
    if check.only:
        name += f" ({check.only[0]} = {check.only[1]})"
    return [
        F.lit(check.kind).alias("check"),
        F.lit(name).alias("column_name"),
        F.lit(check.severity).alias("severity"),
    ]


def quality_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: kind, columns, severity, number of violations.

    A violation is a row, except for ``unique`` where it is a repeated value.
    All row checks share one scan; each of the others reads only its column.
    """
    parts = []
    by_row = [c for c in checks if c.kind in ("not_null", "accepted_values")]
    if by_row:
        counted = df.agg(
            *(F.count_if(_row_violation(c)).alias(f"v{i}") for i, c in enumerate(by_row))
        )
        parts.append(
            counted.select(
                F.inline(
                    F.array(
                        *(
                            F.struct(*_label(c), F.col(f"v{i}").alias("violations"))
                            for i, c in enumerate(by_row)
                        )
                    )
                )
            )
        )
    for check in checks:
        if check.kind == "unique":
            found = duplicate_keys(df, *check.columns).agg(F.count("*").alias("violations"))
        elif check.kind == "relationships":
            rows = df.filter(F.col(check.only[0]) == check.only[1]) if check.only else df
            orphans = without_parent(rows, check.columns[0], check.parent, check.parent_column)
            found = orphans.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations"))
        else:
            continue
        parts.append(found.select(*_label(check), "violations"))
    return union_all(*parts)


class QualityError(Exception):
    """An error-severity check found violations."""


def enforce(report: DataFrame) -> DataFrame:
    """Raise if a check of severity ``error`` has violations; warnings pass.

    Only failed checks come to the driver, at most one row per declared check.
    """
    failed = report.filter((F.col("severity") == ERROR) & (F.col("violations") > 0)).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.check}({r.column_name}): {r.violations}" for r in failed)
        )
    return report


def column_profile(df: DataFrame) -> DataFrame:
    """Type, non-NULL count and row count of every column, in one pass."""
    counted = df.agg(
        F.count("*").alias("rows"),
        *(F.count(F.col(name)).alias(f"c{i}") for i, name in enumerate(df.columns)),
    )
    return counted.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f"c{i}").alias("non_null"),
                        F.col("rows").alias("row_count"),
                    )
                    for i, f in enumerate(df.schema.fields)
                )
            )
        )
    )
