"""Queries bound to the driver tables, each with its DuckDB counterpart."""

from importlib import import_module

MODULES = ["q_facts", "q_analytics", "q_ordered", "q_checks", "q_text", "q_reports", "q_sources"]


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"ledgerloom.plans.{name}")
