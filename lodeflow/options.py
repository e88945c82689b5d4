"""Options: defaults, files and command-line settings merged with checks of names and types."""

from __future__ import annotations

import ast
from collections.abc import Iterable


def merged(base: dict, over: dict, place: str = "") -> dict:
    """``base`` with the values of ``over``: unknown names raise KeyError, values of another type TypeError.

    Groups merge name by name; whole numbers may stand for fractions, lists and tuples for each other.
    """
    out = dict(base)
    for name, value in over.items():
        if name not in base:
            raise KeyError(f"{place}{name} is no option")
        old = base[name]
        if isinstance(old, dict) and isinstance(value, dict):
            out[name] = merged(old, value, f"{place}{name}.")
        elif old is None or isinstance(value, type(old)) and isinstance(value, bool) == isinstance(old, bool):
            out[name] = value
        elif isinstance(old, float) and type(value) is int:
            out[name] = float(value)
        elif isinstance(old, (list, tuple)) and isinstance(value, (list, tuple)):
            out[name] = type(old)(value)
        else:
            raise TypeError(f"{place}{name} must be {type(old).__name__}, not {type(value).__name__}")
    return out


def with_settings(base: dict, settings: Iterable[str]) -> dict:
    """``base`` with settings such as ``group.name=value``; a value that is no Python literal is text."""
    for s in settings:
        path, _, text = s.partition("=")
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError):
            value = text
        for name in reversed(path.split(".")):
            value = {name: value}
        base = merged(base, value)
    return base
