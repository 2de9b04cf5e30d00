"""Calls of outside services at a bounded rate, tried again where that may help."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class Retry:
    """When and how often a call is made again.

    Statuses of ``again`` (a number, or "5xx" for a class) and exceptions are tried up to
    ``attempts`` times in all; any other status is an answer. The wait before try n is
    drawn between 0 and ``first * 2**(n-1)`` seconds, at most ``longest``: tasks that fail
    together do not come back together.
    """

    attempts: int = 5
    first: float = 0.5
    longest: float = 60.0
    again: tuple[int | str, ...] = (408, 425, 429, "5xx")

    def worth(self, status: int | None) -> bool:
        return status in self.again or (status is not None and f"{status // 100}xx" in self.again)

    def wait(self, tried: int, draw: Callable[[], float] = random.random) -> float:
        return draw() * min(self.longest, self.first * 2 ** (tried - 1))


@dataclass(frozen=True)
class RateLimit:
    """At most ``per_second`` calls a second by all tasks of a job together.

    Each of ``tasks`` tasks gets its share and may save up ``burst`` calls while it waits for
    answers. A task that Spark runs a second time has a share of its own.
    """

    per_second: float
    burst: int = 1

    def bucket(self, tasks: int, **clock: Callable) -> TokenBucket:
        return TokenBucket(self.per_second / max(tasks, 1), self.burst, **clock)


class TokenBucket:
    """Lets calls pass at ``rate`` a second; up to ``burst`` at once after a pause."""

    def __init__(
        self,
        rate: float,
        burst: int = 1,
        now: Callable[[], float] = time.monotonic,
        sleep: Callable[[float], None] = time.sleep,
    ):
        if rate <= 0 or burst < 1:
            raise ValueError("the rate must be above 0 and the burst at least 1")
        self.rate, self.burst, self.now, self.sleep = rate, burst, now, sleep
        self.tokens, self.seen = float(burst), now()

    def take(self) -> None:
        """Wait until a call may be made."""
        while True:
            at = self.now()
            self.tokens = min(self.burst, self.tokens + (at - self.seen) * self.rate)
            self.seen = at
            # a little less than one: waits end a rounding error early
            if self.tokens >= 1 - 1e-9:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)


def polite(
    client: Callable[[Any], Any],
    retry: Retry | None = None,
    bucket: TokenBucket | None = None,
    status: Callable[[Any], int | None] = lambda answer: None,
    sleep: Callable[[float], None] = time.sleep,
) -> Callable[[Any], Any]:
    """``client`` held to the rate of ``bucket``, every try of a call counted.

    ``status`` takes the status out of an answer. When tries run out, the last answer is
    given or the last exception raised.
    """
    tries = retry.attempts if retry else 1

    def call(asked: Any) -> Any:
        for tried in range(1, tries + 1):
            if bucket:
                bucket.take()
            try:
                answer = client(asked)
            except Exception:
                if tried == tries:
                    raise
            else:
                if retry is None or tried == tries or not retry.worth(status(answer)):
                    return answer
            sleep(retry.wait(tried))

    return call
