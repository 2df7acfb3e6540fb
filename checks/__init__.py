"""Checked queries over the given tables, and the comparison with a second engine."""

from __future__ import annotations

import importlib

MODULES = ("scoring", "tasks", "chats", "trials", "flows", "files")


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        importlib.import_module(f"checks.{name}")
