"""Reports as JSON and Markdown, made from small aggregates on the driver."""

from __future__ import annotations

import datetime
from typing import Any

from pyspark.sql import DataFrame

from quern.sources.writers import write_json, write_text


def as_dicts(df: DataFrame, limit: int = 10_000) -> list[dict[str, Any]]:
    """The rows of an aggregate; more than ``limit`` are an error, as a report is no export."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"an aggregate of more than {limit} rows is no report")
    return [r.asDict(recursive=True) for r in rows]


def quality(similarity: float) -> str:
    """The label of a split's similarity."""
    return "excellent" if similarity >= 0.95 else "good" if similarity >= 0.85 else "fair" if similarity >= 0.75 else "poor"


def split_report(path: str, counts: dict[str, int], similarity: float, tags: list[dict[str, Any]]) -> dict[str, Any]:
    """The report of a split as JSON and Markdown: rows and shares of each split, how like they are, with its label, and counts of tags; the figures."""
    total = sum(counts.values())
    figures = {"splits": [{"split": k, "n": n, "percent": n * 100 / total if total else 0.0} for k, n in sorted(counts.items())], "quality": {"similarity": similarity, "label": quality(similarity)}, "tags": tags}
    write(path, "Split", figures)
    return figures


def corpus_report(path: str, totals: dict[str, Any], books: list[dict[str, Any]], authors: list[dict[str, Any]], keywords: list[dict[str, Any]]) -> dict[str, Any]:
    """The report of a corpus of passages as JSON and Markdown; the figures."""
    figures = {"totals": totals, "books": books, "authors": authors, "keywords": keywords}
    write(path, "Corpus", figures)
    return figures


def markdown(title: str, sections: dict[str, list[dict[str, Any]] | dict[str, Any]]) -> str:
    """A report with a table per section."""
    lines = [f"# {title}", ""]
    for name, rows in sections.items():
        rows = [{"name": k, "value": v} for k, v in rows.items()] if isinstance(rows, dict) else rows
        lines += [f"## {name}", ""]
        if rows:
            head = list(rows[0])
            lines += ["| " + " | ".join(head) + " |", "|" + " --- |" * len(head)]
            lines += ["| " + " | ".join(shown(r[h]) for h in head) + " |" for r in rows]
        else:
            lines.append("(none)")
        lines.append("")
    return "\n".join(lines)


def shown(value: Any) -> str:
    return f"{value:.4g}" if isinstance(value, float) else str(value).replace("|", "\\|")


def write(path: str, title: str, sections: dict[str, Any], when: datetime.datetime | None = None) -> list[str]:
    """The report as JSON and Markdown at path (without suffix; {timestamp} is filled in); the files' names."""
    stamp = (when or datetime.datetime.now()).strftime("%Y%m%d_%H%M%S")
    base = path.replace("{timestamp}", stamp)
    write_json(f"{base}.json", {"title": title, "timestamp": stamp, **sections})
    write_text(f"{base}.md", markdown(title, sections))
    return [f"{base}.json", f"{base}.md"]
