"""Scalar functions as SQL text: each takes and returns the text of a Spark SQL expression.

Text composes as Columns do and costs one call to the JVM per expression instead of one per
operator, which for the wide projections of this job is most of the time to build a plan. Use
`F.expr(as_text("v"))` where a Column is wanted.
"""

from __future__ import annotations


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_list(texts: list[str]) -> str:
    return ", ".join(quoted(t) for t in texts)
