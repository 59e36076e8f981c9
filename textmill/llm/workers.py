"""The one large object that a Python worker keeps between its tasks."""

from __future__ import annotations

from collections.abc import Callable

_held: dict[tuple, object] = {}


def kept_by_worker(factory: Callable, *arguments):
    """``factory(*arguments)``, made at the first task that asks for it.

    Workers outlive stages, so an object for other work is given up first: vocabularies and caches of
    several operators do not add up.
    """
    key = (factory, *arguments)
    if key not in _held:
        _held.clear()
        _held[key] = factory(*arguments)
    return _held[key]
