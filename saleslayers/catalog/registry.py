"""All queries by name."""

from __future__ import annotations

from saleslayers.catalog import evolution, files, raw, refined, reports, upserts

QUERIES = {
    **raw.QUERIES,
    **files.QUERIES,
    **refined.QUERIES,
    **upserts.QUERIES,
    **reports.QUERIES,
    **evolution.QUERIES,
}
