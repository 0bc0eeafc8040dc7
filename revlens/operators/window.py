"""Concurrent requests within a task: a window of calls in flight.

A task that sends one request at a time leaves a model server idle while
answers travel. :class:`Windowed` keeps up to ``in_flight`` calls of a backend
running, gives answers in the order of the prompts, and backs off together:
a failed call that may pass later (no connection, a time-out, HTTP 429 or
5xx) halves the window and makes new calls wait, twice as long each time;
every answer opens the window again, by one for each windowful.

Failures stay with their prompt, after ``retries`` more attempts.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.error import HTTPError

FIRST_WAIT = 0.25
LONGEST_WAIT = 30.0


class Busy(Exception):
    """A backend raises this to say: later."""


def may_pass_later(exc: BaseException) -> bool:
    if isinstance(exc, HTTPError):
        return exc.code in (408, 425, 429) or exc.code >= 500
    return isinstance(exc, Busy | ConnectionError | TimeoutError | OSError)


class Gate:
    """How many calls may run now, and from when."""

    def __init__(self, most: int, first_wait: float = FIRST_WAIT, clock: Callable[[], float] = time.monotonic) -> None:
        self.most, self.first_wait, self.clock = most, first_wait, clock
        self.open, self.running, self.wait, self.resume_at = float(most), 0, 0.0, 0.0
        self.changed = threading.Condition()

    def enter(self) -> None:
        with self.changed:
            while True:
                left = self.resume_at - self.clock()
                if left <= 0 and self.running < max(1, int(self.open)):
                    self.running += 1
                    return
                self.changed.wait(timeout=left if left > 0 else None)

    def leave(self, refused: bool) -> None:
        with self.changed:
            self.running -= 1
            if not refused:
                self.open, self.wait = min(self.most, self.open + 1 / max(1.0, self.open)), 0.0
            elif self.clock() >= self.resume_at:  # the calls that were under way count as one refusal
                self.open = max(1.0, self.open / 2)
                self.wait = min(LONGEST_WAIT, 2 * self.wait or self.first_wait)
                self.resume_at = self.clock() + self.wait
            self.changed.notify_all()


class Windowed:
    """A backend (built by ``factory``) that is called for single prompts, up
    to ``in_flight`` at once. The backend must bear calls from many threads."""

    def __init__(self, factory: Callable, in_flight: int, retries: int = 3, first_wait: float = FIRST_WAIT) -> None:
        if in_flight < 1 or retries < 0:
            raise ValueError("in_flight must be 1 or more, retries 0 or more")
        self.backend, self.retries = factory(), retries
        self.gate = Gate(in_flight, first_wait)
        self.pool = ThreadPoolExecutor(max_workers=in_flight)

    def _one(self, prompt: str) -> tuple[str | None, Exception | None]:
        for attempt in range(self.retries + 1):
            self.gate.enter()
            refused = False
            try:
                (answer,) = self.backend.generate([prompt])
                return answer, None
            except Exception as exc:  # noqa: BLE001 - given back with its prompt
                refused = may_pass_later(exc)
                if not refused or attempt == self.retries:
                    return None, exc
            finally:
                self.gate.leave(refused)
        raise AssertionError("unreachable")

    def generate_each(self, prompts: list[str]) -> list[tuple[str | None, Exception | None]]:
        """(answer, error) of every prompt, in order."""
        return list(self.pool.map(self._one, prompts))

    def generate(self, prompts: list[str]) -> list[str | None]:
        found = self.generate_each(prompts)
        for _, error in found:
            if error is not None:
                raise error
        return [answer for answer, _ in found]
