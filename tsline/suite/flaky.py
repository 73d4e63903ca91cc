"""A transport for the delivery queries that fails on purpose and delivers each payload for good.

Every delivered payload is a file of its own in ``path``, so that one sent twice shows.
``transport.fail-first``: the first attempt of every payload fails. ``transport.slow-s``: the
second attempt of a task's first payload takes that long and then fails.
``transport.die-after``: after so many payloads the task's transport is gone for good.
"""

from __future__ import annotations

import time
import uuid
from collections import Counter

from tsline.sources.sink import write_file


class Flaky:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.fail_first = options.get("transport.fail-first") == "true"
        self.slow_s = float(options.get("transport.slow-s", "0"))
        self.die_after = int(options.get("transport.die-after", "-1"))
        self.calls: Counter = Counter()
        self.delivered = 0

    def __call__(self, database: str, rp: str | None, body: bytes, name: str) -> None:
        self.calls[name] += 1
        if self.delivered == self.die_after:
            raise ConnectionError("injected: the connection is gone")
        if self.fail_first and self.calls[name] == 1:
            raise ConnectionError(f"injected: first attempt of {name}")
        if self.slow_s and self.delivered == 0 and self.calls[name] == 2:
            time.sleep(self.slow_s)
            raise ConnectionError("injected: too slow")
        write_file(self.path, f"database={database}/rp={rp or 'autogen'}/{name}-{uuid.uuid4().hex[:8]}.lp", body + b"\n")
        self.delivered += 1


def transport(options: dict) -> Flaky:
    return Flaky(options)
