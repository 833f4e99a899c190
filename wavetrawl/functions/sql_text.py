"""Helpers for expressions written as Spark SQL text.

Expressions with many nested lambdas are kept as SQL text: it reads better than nested Python lambdas
and reaches the analyzer in one call instead of thousands.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

_names = count()


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, body: str) -> str:
    """``body`` with ``$it`` standing for ``value``, which is worked out once however often it is used.

    A ``$it`` inside ``value`` belongs to an enclosing ``let``.
    """
    name = f"it{next(_names)}"
    return f"transform(array({value}), {name} -> {body.replace('$it', name)})[0]"


def bind(value: str, body: Callable[[str], str]) -> str:
    """``body`` of a name for ``value``, which is worked out once.

    As :func:`let`, but only the value is copied; ``let`` copies the result with all it holds.
    """
    name = f"it{next(_names)}"
    return f"aggregate(array(0), {value}, ({name}, {name}_) -> {name}, {name} -> {body(name)})"
