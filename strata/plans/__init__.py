"""Whole jobs: landing, cleaned tables, aggregated tables, the flat twin, evaluation, report."""
