"""Caches of a Python worker that outlive a task, and are dropped when no task uses them any more."""

from __future__ import annotations

import threading
import time

IDLE_S = 4               # seconds without use after which everything held is dropped

_HELD: dict[str, object] = {}
_USED = [0.0]
_LOCK = threading.Lock()
_SWEEPER: list[threading.Thread] = []


def held(name: str, make):
    """The object held under a name, made when there is none. A caller keeps its own reference while it works."""
    with _LOCK:
        _USED[0] = time.monotonic()
        if name not in _HELD:
            _HELD[name] = make()
        if not _SWEEPER or not _SWEEPER[0].is_alive():
            _SWEEPER[:] = [threading.Thread(target=_sweep, daemon=True)]
            _SWEEPER[0].start()
        return _HELD[name]


def _sweep() -> None:
    while True:
        time.sleep(IDLE_S / 4)
        with _LOCK:
            if time.monotonic() - _USED[0] > IDLE_S:
                _HELD.clear()
                return
