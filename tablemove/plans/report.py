"""Running a batch of applying operators and keeping its report."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession

from tablemove.operators.outcome import REPORT, Outcome

DEFAULT_WORKERS = 4
FLUSH_ROWS = 1000


def to_frame(spark: SparkSession, outcomes: Iterable[Outcome]) -> DataFrame:
    """Report rows as a DataFrame; an empty batch gives an empty report."""
    return spark.createDataFrame([outcome.row() for outcome in outcomes], REPORT)


def write_report(spark: SparkSession, outcomes: Iterable[Outcome], table: str) -> None:
    """Append report rows to a table."""
    to_frame(spark, outcomes).write.mode("append").saveAsTable(table)


def run_batch(
    spark: SparkSession,
    steps: Iterable[Callable[[], Outcome]],
    on_error: str = "stop",
    workers: int = DEFAULT_WORKERS,
    report_table: str | None = None,
) -> list[Outcome]:
    """Run steps from a bounded thread pool; each is its own distributed job.

    After a FAILED step no further one is started with ``on_error='stop'``; those
    already running are finished. Records are returned in the order of the steps, and
    appended to ``report_table`` along the way.
    """
    if on_error not in ("stop", "continue"):
        raise ValueError("on_error is 'stop' or 'continue'")
    if workers < 1:
        raise ValueError("workers must be positive")
    done: dict[int, Outcome] = {}
    unwritten: list[Outcome] = []
    stopped = False

    def collect(futures: dict[Future, int]) -> dict[Future, int]:
        nonlocal stopped
        finished, _ = wait(futures, return_when=FIRST_COMPLETED)
        for future in finished:
            outcome = future.result()
            done[futures[future]] = outcome
            unwritten.append(outcome)
            stopped = stopped or (outcome.failed and on_error == "stop")
        if report_table and len(unwritten) >= FLUSH_ROWS:
            write_report(spark, unwritten, report_table)
            unwritten.clear()
        return {future: position for future, position in futures.items() if future not in finished}

    with ThreadPoolExecutor(workers) as pool:
        running: dict[Future, int] = {}
        for position, step in enumerate(steps):
            while len(running) >= workers:
                running = collect(running)
            if stopped:
                break
            running[pool.submit(step)] = position
        while running:
            running = collect(running)
    if report_table and unwritten:
        write_report(spark, unwritten, report_table)
    return [done[position] for position in sorted(done)]
