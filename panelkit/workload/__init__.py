"""Queries that run every operator on the given tables, each with the same result in plain SQL where SQL has one."""

from __future__ import annotations


def cases() -> dict:
    """Name -> (query(spark, sf_dir), SQL or None)."""
    import importlib

    out: dict = {}
    for module in ("panel_cases", "series_cases", "label_cases", "score_cases", "source_cases"):
        found = importlib.import_module(f"panelkit.workload.{module}").CASES
        twice = out.keys() & found.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        out |= found
    return out
