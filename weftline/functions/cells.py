"""One queue cell's life: what enqueues, answers and alarms do to its messages.

A cell holds the messages that are alive, each waiting for its due time or in
flight under a lease. The same transitions serve batch and stream.
"""

from __future__ import annotations

#: See ``weftline.operators.queues``.
PERMANENT = (404, 409, 410, 422)
BACKOFF_CAP_S = 60

Message = list  # [idempotency key, failed attempts, due time, number of the last lease, end of the lease or None]


class Cell:
    """Messages by id and holders by idempotency key, with the transitions over both.

    ``changed`` and ``freed`` name the messages and keys that have been written since they were last cleared, so
    that a store need write no others.
    """

    def __init__(self, in_flight: int, lease_ms: int, max_attempts: int, *, alarms: bool = False):
        self.in_flight, self.lease_ms, self.max_attempts, self.alarms = in_flight, lease_ms, max_attempts, alarms
        self.messages: dict[int, Message] = {}
        self.keys: dict[str, int] = {}
        self.changed: set[int] = set()
        self.freed: set[str] = set()

    def act(self, a: dict) -> list[tuple]:
        """Rows (seq, at_ms, message_id, what, original_id, attempt, lease, due_ms) that one action makes."""
        rows = self.advance(a["at_ms"] - 1) if self.alarms else []
        if a["action"] == "tick":
            return rows + self.tick(a["at_ms"], a["seq"])
        return rows + [(self.enqueue if a["action"] == "enqueue" else self.answer)(a)]

    def advance(self, until: int) -> list[tuple]:
        """The cell's own alarms up to a time."""
        rows = []
        while (at := self.next_alarm()) is not None and at <= until:
            rows += self.tick(at, None)
        return rows

    def next_alarm(self) -> int | None:
        """The earliest end of a lease, or due time if there is room in flight."""
        ends = [m[4] for m in self.messages.values() if m[4] is not None]
        waiting = [m[2] for m in self.messages.values() if m[4] is None] if len(ends) < self.in_flight else []
        return min(ends + waiting, default=None)

    def enqueue(self, a: dict) -> tuple:
        """While a message with its key, or the message itself, is alive, an enqueue gives that one's id."""
        message, key, at = a["message_id"], a["idempotency_key"], a["at_ms"]
        holder = message if message in self.messages else self.keys.get(key) if key is not None else None
        if holder is not None:
            m = self.messages[holder]
            return a["seq"], at, message, "deduped", holder, m[1], m[3], m[2]
        due = at + max(0, a["delay_s"] or 0) * 1000
        self.messages[message] = [key, 0, due, 0, None]
        self.changed.add(message)
        if key is not None:
            self.keys[key] = message
            self.freed.add(key)
        return a["seq"], at, message, "enqueued", message, 0, 0, due

    def tick(self, at: int, seq: int | None) -> list[tuple]:
        """Lost leases are due again with their attempt unchanged; then due messages are claimed by (due, id) while there is room."""
        rows = []
        for i, m in sorted(self.messages.items()):
            if m[4] is not None and m[4] <= at:
                m[2], m[4] = at, None
                self.changed.add(i)
                rows.append((seq, at, i, "lost", None, m[1], m[3], at))
        room = self.in_flight - sum(m[4] is not None for m in self.messages.values())
        due = sorted((m[2], i) for i, m in self.messages.items() if m[4] is None and m[2] <= at)
        for _, i in due[: max(0, room)]:
            m = self.messages[i]
            m[3], m[4] = m[3] + 1, at + self.lease_ms
            self.changed.add(i)
            rows.append((seq, at, i, "claimed", None, m[1], m[3], m[4]))
        return rows

    def answer(self, a: dict) -> tuple:
        """What a delivery's answer does; without the message's present lease it does nothing."""
        message, at, status = a["message_id"], a["at_ms"], a["status"]
        m = self.messages.get(message)
        if m is None or m[4] is None or m[3] != a["lease"]:
            return a["seq"], at, message, "late", None, None, a["lease"], None
        attempt, due = m[1], None
        if status is not None and 200 <= status <= 299:
            what = "ack"
        elif status in PERMANENT:
            what = "drop"
        elif status == 503 and a["timeout_s"] is not None:
            what, due = "redeliver", at + a["timeout_s"] * 1000
        else:
            attempt += 1
            what, due = ("dead", None) if attempt >= self.max_attempts else ("retry", at + min(BACKOFF_CAP_S, 2**attempt) * 1000)
        self.changed.add(message)
        if due is None:
            del self.messages[message]
            if m[0] is not None and self.keys.get(m[0]) == message:
                del self.keys[m[0]]
                self.freed.add(m[0])
        else:
            m[1], m[2], m[4] = attempt, due, None
        return a["seq"], at, message, what, None, attempt, a["lease"], due
