"""Name -> query over a table folder, collected from the operator modules."""

from importlib import import_module

MODULES = (
    "operators.ledger", "operators.corpus", "operators.curriculum", "operators.workload", "operators.grading",
    "operators.metrics", "operators.validation", "operators.preparation", "operators.datasets",
    "operators.layout", "operators.skipping", "operators.profiles", "operators.synthesis", "streaming.episodes",
)


def queries():
    found = {}
    for name in MODULES:
        for key, run in import_module(f"tunewright.{name}").QUERIES.items():
            if key in found:
                raise KeyError(f"two queries are named {key}")
            found[key] = run
    return found
