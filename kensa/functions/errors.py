"""Per-call error capture (C20): a failure becomes text in an ``error``
column of that row instead of failing the task; the row gets no value."""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import Any


def capture_error(fn: Callable[..., Any]) -> Callable[..., tuple[Any, str | None]]:
    """Wrap ``fn`` so it returns ``(value, None)`` or ``(None, "Type: message")``."""
    @functools.wraps(fn)
    def run(*args, **kwargs):
        try:
            return fn(*args, **kwargs), None
        except Exception as e:  # noqa: BLE001 - the point is to report it per row
            return None, f"{type(e).__name__}: {e}"
    return run
