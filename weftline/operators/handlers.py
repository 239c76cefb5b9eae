"""User handlers for deliveries: a Python callable over Arrow batches, as a column of statuses."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.queues import PERMANENT


class PermanentError(Exception):
    """Raised by a handler to end a message with one of the permanent statuses."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(message)
        self.status = status


def handle(messages: DataFrame, handler: Callable[[str, dict], float | None], prefix: str = "", body: str = "body") -> DataFrame:
    """Messages with the ``status`` and ``timeout_s`` of one delivery each.

    ``handler(body, {attempt, queueName, messageId})`` returns nothing for 200
    or a number of seconds for 503; a PermanentError keeps its status, any other
    exception is 500. A queue name without the prefix is 400, and the handler is
    not called. The attempt told is the stored one plus one. Handlers may run
    more than once for a message when a task is tried again.
    """
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in messages.schema if f.name not in ('status', 'timeout_s'))}, status int, timeout_s double"
    kept = [c for c in messages.columns if c not in ("status", "timeout_s")]

    def one(row) -> tuple[int, float | None]:
        if not str(row["queue_name"]).startswith(prefix):
            return 400, None
        try:
            wait = handler(row[body], {"attempt": int(row["attempt"]) + 1, "queueName": row["queue_name"], "messageId": row["message_id"]})
        except PermanentError as e:
            return (e.status if e.status in PERMANENT else 500), None
        except Exception:  # noqa: BLE001  whatever a user's handler raises is a failed delivery
            return 500, None
        return (200, None) if wait is None else (503, float(wait))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            told = [one(r) for r in frame.to_dict("records")]
            yield frame.assign(status=[s for s, _ in told], timeout_s=[t for _, t in told])

    return messages.select(*map(F.col, kept)).mapInPandas(run, schema)
