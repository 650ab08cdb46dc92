"""Listing analytics expressed as Spark DataFrame, SQL and streaming plans.

``Engine`` holds a listing table and does with it what the command line does; ``Settings`` are
a run's settings, ``LISTING`` the row type.
"""

from __future__ import annotations

from typing import TYPE_CHECKING, Any

__version__ = "0.2.0"
__all__ = ["LISTING", "Engine", "Settings", "__version__"]

_HOMES = {"Engine": "engine", "Settings": "sources.config", "LISTING": "schemas"}

if TYPE_CHECKING:
    from .engine import Engine
    from .schemas import LISTING
    from .sources.config import Settings


def __getattr__(name: str) -> Any:
    if name not in _HOMES:
        raise AttributeError(name)
    from importlib import import_module

    return getattr(import_module(f"{__name__}.{_HOMES[name]}"), name)
