"""All oracle statements."""

from importlib import import_module

MODULES = ("ledger", "corpus", "curriculum", "workload", "grading", "metrics", "preparation", "layout", "synthesis", "streaming")


def oracles():
    found = {}
    for name in MODULES:
        for key, sql in import_module(f"oracle.{name}").ORACLE.items():
            if key in found:
                raise KeyError(f"two oracles are named {key}")
            found[key] = sql
    return found
