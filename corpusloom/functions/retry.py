"""Clients of outside services: where they are, how often to ask, when to ask again."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

# Requests in flight per task, the address of a service that names none.
DEFAULT_IN_FLIGHT = 32
DEFAULT_ENDPOINT = "http://localhost:50051"


class TransientError(Exception):
    """A service answered that it is unavailable for now; the call may be repeated."""


# What counts as "no connection" or "took too long".
CONNECT_ERRORS = (ConnectionError, TimeoutError)


@dataclass(frozen=True)
class RetryPolicy:
    """``retries`` further attempts with waits of ``first_wait``, doubled each time (seconds)."""

    retries: int = 3
    first_wait: float = 0.1
    retry_connect: bool = True

    def wait(self, attempt: int) -> float:
        return self.first_wait * 2**attempt

    def call(self, function: Callable, *args, sleep: Callable[[float], None] = time.sleep):
        """Call until it succeeds; the last error is raised."""
        for attempt in range(self.retries + 1):
            try:
                return function(*args)
            except (TransientError, *CONNECT_ERRORS) as error:
                fatal = isinstance(error, CONNECT_ERRORS) and not self.retry_connect
                if fatal or attempt == self.retries:
                    raise
                sleep(self.wait(attempt))


class Clients:
    """The clients a task has made, one per endpoint; NULL stands for the default endpoint."""

    def __init__(self, factory: Callable[[str], Callable]) -> None:
        self._factory = factory
        self._made: dict[str, Callable] = {}

    def __getitem__(self, endpoint: str | None) -> Callable:
        endpoint = endpoint or DEFAULT_ENDPOINT
        if endpoint not in self._made:
            self._made[endpoint] = self._factory(endpoint)
        return self._made[endpoint]


def rows_by_endpoint(texts: list, endpoints: list) -> dict[str | None, list[int]]:
    """The numbers of the rows that have a text, by endpoint."""
    groups: dict[str | None, list[int]] = {}
    for row, (text, endpoint) in enumerate(zip(texts, endpoints)):
        if text is not None:
            groups.setdefault(endpoint, []).append(row)
    return groups


class AnswerError(ValueError):
    """A client answered with more or fewer values than it was given texts."""


class InFlight:
    """Calls running ahead of their results, bounded in number and in bytes held.

    A call that learns how much it will hold says so with ``claim(n)`` and waits while calls
    before it and beside it hold too much; the oldest one never waits, so work always goes on.
    """

    def __init__(self, calls: int, max_bytes: int | None = None) -> None:
        self._pool = ThreadPoolExecutor(calls)
        self._calls, self._max_bytes = calls, max_bytes
        self._held: dict[int, int] = {}
        self._oldest = 0
        self._changed = threading.Condition()

    def __enter__(self) -> InFlight:
        return self

    def __exit__(self, *error) -> None:
        with self._changed:
            self._max_bytes = None
            self._changed.notify_all()
        self._pool.shutdown(cancel_futures=True)

    def _claim(self, number: int, size: int) -> None:
        with self._changed:
            self._changed.wait_for(
                lambda: self._max_bytes is None
                or number == self._oldest
                or sum(self._held.values()) + size <= self._max_bytes
            )
            self._held[number] = size

    def map(self, call: Callable, items: Iterator | list, claims: bool = False) -> Iterator:
        """The results of ``call(item)``, or ``call(item, claim)``, in the order of the items."""
        running: deque = deque()
        if not claims:
            for item in items:
                running.append(self._pool.submit(call, item))
                if len(running) >= 2 * self._calls:
                    yield running.popleft().result()
            while running:
                yield running.popleft().result()
            return
        first = self._oldest
        for count, item in enumerate(items):
            number = first + count
            running.append(
                self._pool.submit(call, item, lambda size, number=number: self._claim(number, size))
            )
            if len(running) >= self._calls:
                yield self._take(running)
        while running:
            yield self._take(running)

    def _take(self, running: deque):
        result = running.popleft().result()
        with self._changed:
            self._held.pop(self._oldest, None)
            self._oldest += 1
            self._changed.notify_all()
        return result


# texts and characters in one call to a service
CALL_TEXTS = 64
CALL_CHARS = 1 << 20


def calls_of(texts: list[str], size: int = CALL_TEXTS, chars: int = CALL_CHARS) -> Iterator[list[str]]:
    """The texts in runs of at most ``size`` texts and ``chars`` characters, one text at least."""
    call, held = [], 0
    for text in texts:
        if call and (len(call) >= size or held + len(text) > chars):
            yield call
            call, held = [], 0
        call.append(text)
        held += len(text)
    if call:
        yield call


def ask_all(
    flight: InFlight, ask: Callable[[list[str]], list], texts: list[str], retry: RetryPolicy,
    size: int = CALL_TEXTS, chars: int = CALL_CHARS,
) -> list:
    """One answer per text, asked in bounded calls; each call must answer for all its texts."""

    def checked(call: list[str]) -> list:
        answers = list(retry.call(ask, call))
        if len(answers) != len(call):
            raise AnswerError(f"the client gave {len(answers)} answers to {len(call)} texts")
        return answers

    return [answer for answers in flight.map(checked, calls_of(texts, size, chars)) for answer in answers]


# Three attempts, waits of 1 and 2 seconds; counting fails at once without a connection.
EMBED_RETRY = RetryPolicy(retries=2, first_wait=1.0)
TOKEN_RETRY = RetryPolicy(retries=2, first_wait=1.0, retry_connect=False)
NO_RETRY = RetryPolicy(retries=0)
