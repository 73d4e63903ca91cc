"""Transports that fail on purpose, for the sink's retries, timeouts and task retries.

Select one with ``transport="faults:flaky"`` (or ``:slow``, ``:broken``, ``:half``) after
``spark.sparkContext.addPyFile`` of this file.  State that must survive retries
lives in marker files next to the payloads, because each attempt may run in
another worker process.
"""

import os
import time

from tsline.sources.sink import DirectoryTransport


class _Marked(DirectoryTransport):
    def __init__(self, options):
        super().__init__(options["path"], options["task"], options["attempt"])
        self.options = options

    def seen(self, name):
        """How often ``name`` was marked, this time included."""
        marks = os.path.join(self.root, "_attempts")
        os.makedirs(marks, exist_ok=True)
        with open(os.path.join(marks, name), "a") as f:
            f.write("x")
        return os.path.getsize(os.path.join(marks, name))


class _Flaky(_Marked):
    """Fails the first ``transport.fail-times`` attempts of every payload, then writes it."""

    def __call__(self, database, rp, body, name):
        if self.seen(name) <= int(self.options.get("transport.fail-times", "1")):
            raise ConnectionError(f"injected failure for {name}")
        super().__call__(database, rp, body, name)


class _Half(_Marked):
    """The first attempt of every task writes its first payload and then breaks for good."""

    def __call__(self, database, rp, body, name):
        super().__call__(database, rp, body, name)
        if self.seen(self.task) == 2:
            self.broken = ConnectionError("injected: gone after two payloads")
            raise self.broken


class _Slow(_Marked):
    """Sleeps ``transport.delay-s`` seconds before writing (to trip the request timeout)."""

    def __call__(self, database, rp, body, name):
        time.sleep(float(self.options.get("transport.delay-s", "5")))
        super().__call__(database, rp, body, name)


class _Broken:
    """Always fails."""

    def __call__(self, database, rp, body, name):
        raise ConnectionError("injected permanent failure " + "x" * 2000)


def flaky(options):
    return _Flaky(options)


def half(options):
    return _Half(options)


def slow(options):
    return _Slow(options)


def broken(options):
    return _Broken()
