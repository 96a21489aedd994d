"""Registered queries: every operator and job run over the given tables, with an independent SQL check."""

from importlib import import_module

MODULES = ["sources", "relational", "scalar", "records", "jobs_people", "jobs_visits", "jobs_forms", "documents", "facts"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"chartlift.queries.{name}")
