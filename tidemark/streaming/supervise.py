"""A stream that goes on after failures: the sink's breaker in a running job."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery


def supervise(start: Callable[[], StreamingQuery], most: int = 5, first: float = 1.0, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Start the query and, where it fails, start it again from its checkpoint, until it ends by itself. Returns the failures.

    After each failure in a row the pause is twice as long, `longest` at most; a run that has finished a batch sets it back.
    After `most` failures in a row the last one is raised. A batch that fails runs again with the same number, and
    sinks.Table counts nothing twice."""
    in_a_row = failures = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return failures
        except StreamingQueryException:
            failures += 1
            in_a_row = 1 if any(p["numInputRows"] for p in query.recentProgress) else in_a_row + 1
            if in_a_row >= most:
                raise
            sleep(min(first * 2 ** (in_a_row - 1), longest))
