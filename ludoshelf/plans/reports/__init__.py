"""Reports over the test tables: each runs library operators and has a plain SQL statement of the same result."""

from __future__ import annotations

from importlib import import_module

GROUPS = ("catalogue", "details", "pages", "reviews", "matching", "assembly", "incremental")


def all_reports() -> dict:
    found: dict = {}
    for group in GROUPS:
        found.update(import_module(f"ludoshelf.plans.reports.{group}").REPORTS)
    return found
