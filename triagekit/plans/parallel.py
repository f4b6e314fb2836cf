"""Concurrent Spark jobs from a small driver thread pool.

Independent model fits (folds, restarts, configurations) are separate Spark
jobs; submitting a few at once keeps executors busy when each fit alone
cannot fill the cluster. Results come back in input order.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

MAX_WORKERS = int(os.environ.get("TRIAGEKIT_FIT_THREADS", "4"))


def parallel_map(fn, items, workers: int | None = None):
    items = list(items)
    w = min(workers or MAX_WORKERS, len(items)) or 1
    if w <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=w) as ex:
        return list(ex.map(fn, items))
