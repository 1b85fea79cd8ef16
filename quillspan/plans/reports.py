"""Text reports of the validation statistics. The statistics are a few rows each; lists are capped before they are collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table(title: str, rows: DataFrame, cap: int = 60) -> str:
    """A heading and one line a row, up to ``cap``, then how many more there are."""
    got = [r.asDict() for r in rows.orderBy(*[F.col(c).cast("string") for c in rows.columns]).limit(cap + 1).collect()]
    lines = [title, "-" * len(title)]
    for r in got[:cap]:
        lines.append("  " + ", ".join(f"{k}={v}" for k, v in r.items()))
    if len(got) > cap:
        lines.append(f"  + {rows.count() - cap} more")
    return "\n".join([*lines, ""])


def rendered(parts: dict[str, DataFrame], cap: int = 60) -> str:
    return "\n".join(table(title, rows, cap) for title, rows in parts.items())
