"""Objects that a Python worker makes once and keeps from task to task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any


def once(name: str, make: Callable[[], Any]) -> Any:
    """``make()`` at the first call in this process, the same object later.

    The package's functions travel with each task by value, so a cache of their own would not outlive it.
    """
    store = sys.modules.setdefault("_docgroups_once", types.ModuleType("_docgroups_once"))
    if name not in vars(store):
        setattr(store, name, make())
    return getattr(store, name)
