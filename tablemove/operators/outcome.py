"""One record per object handled: what was done and how it ended."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import astuple, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import types as T

SUCCESS = "SUCCESS"
FAILED = "FAILED"

COPY = "COPY"
CLONE = "CLONE"
CONVERT = "CONVERT"

REPORT = T.StructType(
    [
        T.StructField("operation", T.StringType()),
        T.StructField("source_object_type", T.StringType()),
        T.StructField("source_full_name", T.StringType()),
        T.StructField("target_full_name", T.StringType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("statement", T.StringType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("target_rows", T.LongType()),
        T.StructField("at", T.TimestampType()),
    ]
)


@dataclass
class Outcome:
    """A row of :data:`REPORT`."""

    operation: str
    source_object_type: str | None
    source_full_name: str
    target_full_name: str
    status_code: str = FAILED
    action: str | None = None
    description: str | None = None
    statement: str | None = None
    source_rows: int | None = None
    target_rows: int | None = None
    at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def row(self) -> tuple:
        return astuple(self)

    @property
    def failed(self) -> bool:
        return self.status_code == FAILED


def attempt(
    operation: str, source: object, target: object, work: Callable[[Outcome], None]
) -> Outcome:
    """Run ``work``, which fills the record; an exception becomes a FAILED record."""
    outcome = Outcome(operation, None, str(source), str(target))
    try:
        work(outcome)
        outcome.status_code = SUCCESS
    except Exception as error:  # a batch reports every object, whatever went wrong
        outcome.description = f"{type(error).__name__}: {error}"
    return outcome
