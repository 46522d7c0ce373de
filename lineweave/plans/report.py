"""Text reports: titled result tables, each small enough to print."""

from __future__ import annotations

from pyspark.sql import DataFrame


def render(sections: list[tuple[str, DataFrame]], rows: int = 50) -> str:
    """The sections as text, the first ``rows`` rows of each."""
    out = []
    for title, df in sections:
        found = df.limit(rows).toPandas()
        out.append(f"========== {title} ==========\n{found.to_string(index=False, na_rep='') if len(found) else '(none)'}\n")
    return "\n".join(out)
