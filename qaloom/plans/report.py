"""The reports as text, rendered on the driver from one-row results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame


def _heading(title: str) -> str:
    return f"{title}\n{'-' * len(title)}"


def render_run(report: DataFrame, now: datetime | None = None) -> str:
    r = report.first().asDict()
    lines = [
        _heading("Acquisition"), f"Finished: {(now or datetime.now()):%Y-%m-%d %H:%M:%S}",
        f"Rows: {r['total_rows']:,}; with documents: {r['ok_rows']:,}; without: {r['failed_rows']:,} ({r['failed_percent'] or 0:.2f} %)",
        f"Requests: {r['total_requests']:,}; answered by an earlier one: {r['cached_requests']:,} ({r['cache_efficiency'] or 0:.2f} %)",
        f"Downloads: {r['successful_downloads']:,}; failed: {r['failed_downloads']:,}", f"Encyclopedia API: {r['api_requests']:,} requests, {r['api_success']:,} answered",
    ]
    return "\n".join(lines) + "\n"


def render_statistics(summary: DataFrame, histogram: DataFrame) -> str:
    r = summary.first().asDict()
    four = lambda name, last: f"mean {r[f'{name}_avg']:.2f}, median {r[f'{name}_median']:.2f}, most {r[f'{name}_max']:.{last}f}, least {r[f'{name}_min']:.{last}f}"
    lines = [
        _heading("Documents a question"), four("documents", 0) + f", deviation {r['documents_sd']:.2f}",
        _heading("Questions without documents"), f"{r['without_documents']:,} ({r['without_documents_percent'] or 0:.2f} %)",
        _heading("Words a document"), four("length", 0), _heading("Answers found"), f"{r['answers_found']:,} ({r['answers_found_percent'] or 0:.2f} %); place in words: " + four("position", 0), _heading("Formats"),
    ]
    lines += [f"{f['format']}: {f['n']:,} ({f['percent']:.2f} %)" for f in sorted(histogram.collect(), key=lambda f: (-f["n"], f["format"]))]
    return "\n".join([*lines, f"Rows: {r['rows']:,}"]) + "\n"
