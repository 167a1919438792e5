"""Query catalogue of the core: named plans with their SQL counterparts."""

from importlib import import_module

MODULES = ("census", "texts", "state")


def load() -> None:
    """Import the modules that register queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
