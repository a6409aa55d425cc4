"""Requests to catalogue services: retry, spacing, cooldown. The transport is passed in; none is called here by itself."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable


def retryable(status: int | None, kind: str | None = None) -> bool:
    """429, 5xx, and errors of the transport."""
    return status == 429 or status >= 500 if status is not None else kind in ("timeout", "transport")


def error_class(status: int | None, kind: str | None = None) -> str:
    """T31."""
    if status is None:
        return "timeout" if kind == "timeout" else "error"
    return {404: "missing", 429: "429"}.get(status) or ("5xx" if status >= 500 else "4xx")


class LookupFailed(Exception):
    def __init__(self, status: int | None = None, kind: str | None = None) -> None:
        super().__init__(f"{status or kind}")
        self.status, self.kind = status, kind


def with_backoff(call: Callable[[], object], attempts: int = 3, base_s: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """``call`` with waits of base, twice base and so on between attempts; what can't be mended by waiting is raised at once."""
    for i in range(max(1, attempts)):
        try:
            return call()
        except LookupFailed as failed:
            if i + 1 >= attempts or not retryable(failed.status, failed.kind):
                raise
            sleep(base_s * 2**i)
    raise AssertionError


class Client:
    """Lookups of one provider: cache, cooldown, spacing, retries; None on failure, and failures aren't cached."""

    def __init__(self, provider: str, transport: Callable[[str], object], cache: dict | None = None, spacing_s: float = 0.0, attempts: int = 3, after: int = 3, cooldown_s: float = 600.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.provider, self.transport, self.cache = provider, transport, cache if cache is not None else {}
        self.spacing_s, self.attempts, self.after, self.cooldown_s, self.clock, self.sleep = spacing_s, attempts, after, cooldown_s, clock, sleep
        self.last = self.until = float("-inf")
        self.streak = 0
        self.outcomes: Counter[str] = Counter()

    def get(self, url: str, attempts: int | None = None) -> object | None:
        """The answer for ``url``. Calls with their own ``attempts`` (lists) don't count for the cooldown but keep to it."""
        key = url.split("&mailto=")[0]
        if key in self.cache:
            return self.cache[key]
        if self.clock() < self.until:
            self.outcomes["cooling"] += 1
            return None

        def once() -> object:
            wait = self.last + self.spacing_s - self.clock()
            if wait > 0:
                self.sleep(wait)
            self.last = self.clock()
            return self.transport(url)

        limited = False
        try:
            self.cache[key] = made = with_backoff(once, attempts or self.attempts, sleep=self.sleep)
            self.outcomes["ok"] += 1
        except LookupFailed as failed:
            made, limited = None, failed.status == 429
            self.outcomes[error_class(failed.status, failed.kind)] += 1
        if attempts is None:
            self.streak = self.streak + 1 if limited else 0
            if self.streak >= self.after and self.cooldown_s > 0:
                self.streak, self.until = 0, self.clock() + self.cooldown_s
        return made
