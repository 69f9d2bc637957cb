"""Concurrent submission of independent Spark jobs from driver threads.

Fits of different tables, or of different folds, do not depend on each
other; submitting them together lets the scheduler fill idle executor slots
instead of running many small jobs one after the other.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")
R = TypeVar("R")

MAX_THREADS = int(os.environ.get("RISKFRAME_DRIVER_THREADS", "6"))


def pmap(fn: Callable[[T], R], items: Iterable[T], max_workers: int | None = None) -> list[R]:
    """``[fn(x) for x in items]`` with the calls running on driver threads (order kept)."""
    items = list(items)
    if len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(len(items), max_workers or MAX_THREADS)) as ex:
        return list(ex.map(fn, items))
