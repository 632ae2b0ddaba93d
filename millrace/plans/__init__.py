"""Registered queries: each is named after its function and reads given tables."""

from importlib import import_module

MODULES = (
    "projecting",
    "nesting",
    "reading",
    "writing",
    "joining",
    "summarizing",
    "ordering",
    "arranging",
    "database",
)


def load_all() -> None:
    """Import the modules, which registers their queries."""
    for module in MODULES:
        import_module(f"{__name__}.{module}")
