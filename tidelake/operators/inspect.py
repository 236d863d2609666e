"""What access path a query takes, read from Spark's own plan text."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

JOINS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"]


def plan_text(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def plan_summary(df: DataFrame) -> dict[str, list[str] | int]:
    """Pushed filters, partition filters, columns read, joins and shuffles of a query."""
    text = plan_text(df)
    tree = text.split("\n\n")[0]

    def lists(label: str) -> list[str]:
        return [m.strip() for m in re.findall(rf"{label}: (.*)", text) if m.strip() not in ("[]", "")]

    return {
        "pushed_filters": lists("PushedFilters"),
        "partition_filters": lists("PartitionFilters"),
        "read_schema": lists("ReadSchema"),
        "joins": [j for j in JOINS for _ in range(tree.count(j))],
        "shuffles": len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange \(", tree)),
        "python": len(re.findall(r"(?:Python|Pandas|InArrow)", tree)),
    }
