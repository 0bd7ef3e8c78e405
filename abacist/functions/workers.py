"""What a Python worker keeps between its tasks."""

from __future__ import annotations

from collections.abc import Callable

_LOADED: dict[str, Callable] = {}


def loaded(name: str, load: Callable[[], Callable]) -> Callable:
    """The result of ``load``, kept for later tasks of the same worker."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = load()
    return _LOADED[name]
