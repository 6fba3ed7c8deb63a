"""Actions that do not depend on each other, run side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_together(*actions: Callable[[], object]) -> list:
    """The results of the actions. All are waited for; then the first failure, if any, is raised.

    Spark fills executors that one small job leaves idle with tasks of others.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(action) for action in actions]
    return [r.result() for r in running]
