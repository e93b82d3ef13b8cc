"""Tables in the order of what they need; those that do not need each other are built at the same time.

A job is an ordinary Spark action of its own thread. Each has a scheduler pool of its own, so that with the FAIR
mode (see :mod:`novalake.session`) a small table does not wait behind all tasks of a large one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from pyspark.sql import SparkSession

AT_ONCE = 4


class TablesFailed(RuntimeError):
    """Some tables failed, others were left out because they need them; all the rest was built."""

    def __init__(self, failed: Mapping[str, BaseException], skipped: Sequence[str]):
        reasons = "; ".join(f"{name}: {error}" for name, error in sorted(failed.items()))
        left = f"; not tried: {', '.join(sorted(skipped))}" if skipped else ""
        super().__init__(reasons + left)
        self.failed, self.skipped = dict(failed), sorted(skipped)


def levels(needs: Mapping[str, Sequence[str]]) -> list[list[str]]:
    """Tables by level: each needs only tables of the levels before its own. A cycle is refused."""
    sorter, out = TopologicalSorter(needs), []
    sorter.prepare()
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        out.append(ready)
        sorter.done(*ready)
    return out


def build_all(
    spark: SparkSession,
    needs: Mapping[str, Sequence[str]],
    steps: Mapping[str, Callable[[], None]],
    at_once: int = AT_ONCE,
) -> None:
    """Runs each step as soon as those it needs are done, ``at_once`` at most at a time.

    A step that fails stops only the steps that need it, directly or not. At the end
    :class:`TablesFailed` tells what failed and what was not tried.
    """
    if set(steps) != set(levels_flat := [n for level in levels(needs) for n in level]):
        raise ValueError(f"steps and dependencies differ: {sorted(set(steps) ^ set(levels_flat))}")
    failed: dict[str, BaseException] = {}
    skipped: list[str] = []
    running: dict[Future, str] = {}

    def job(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        steps[name]()

    sorter = TopologicalSorter(needs)
    sorter.prepare()
    with ThreadPoolExecutor(at_once, thread_name_prefix="table") as pool:
        while sorter.is_active():
            for name in sorter.get_ready():
                if any(n in failed or n in skipped for n in needs.get(name, ())):
                    skipped.append(name)
                    sorter.done(name)
                else:
                    running[pool.submit(job, name)] = name
            if not running:
                continue
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                name = running.pop(future)
                if error := future.exception():
                    failed[name] = error
                sorter.done(name)
    if failed:
        raise TablesFailed(failed, skipped) from next(iter(failed.values()))
