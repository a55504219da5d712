"""Writers: panels as CSV, evidence as JSON lines, reports as one document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from evidencepanel.operators.groups import ROW, need


def write_panel(
    df: DataFrame,
    path: str,
    cols: Sequence[str] | None = None,
    order: str | None = None,
    keep_empty: bool = False,
) -> bool:
    """CSV with a fixed column order, all or nothing through the job committer.

    An empty table writes nothing unless ``keep_empty``; returns whether it wrote.
    """
    if order is None and ROW in df.columns:
        order = ROW
    cols = list(cols) if cols is not None else [c for c in df.columns if c != order]
    need(df, *cols)
    if not keep_empty and df.isEmpty():
        return False
    rows = df.orderBy(order) if order in df.columns else df
    rows.select(*cols).write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        nullValue="",
        encoding="UTF-8",
        # A cell keeps its own white space.
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return True


def write_evidence(df: DataFrame, path: str) -> None:
    """One JSON object per row, null members kept."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row document as a single JSON file; more rows are an error."""
    if df.limit(2).count() > 1:
        raise ValueError("a report is one row; use write_evidence for many")
    df.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)
