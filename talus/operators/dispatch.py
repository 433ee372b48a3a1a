"""Driver-side scheduling of rate-limited judges over the small remainder of a cascade.

Never part of a query: tasks may be retried, and calls cost money.  The clock is a parameter.
"""

from __future__ import annotations

import re
import threading
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

DAY = 86_400.0
#: A wait beyond this many seconds counts a provider as exhausted for the run.
EXHAUST = 90.0
ATTEMPTS = 8
#: Seconds without an ended or returned job after which the waiting ones are given up.
IDLE = 300.0
REVIEW = {"job_family": "OTHER", "method": "manual_review"}


class RateLimited(Exception):
    """Raised by a provider's call; ``wait`` in seconds, if known."""

    def __init__(self, message: str = "", headers: dict | None = None):
        super().__init__(message)
        self.headers = headers or {}


def parse_duration(text: str | None, default: float = 5.0) -> float:
    """Seconds of ``250ms``, ``1h2m3.5s`` or bare numbers; else the default."""
    t = (text or "").strip().lower()
    if m := re.fullmatch(r"(\d+(?:\.\d+)?)ms", t):
        return float(m[1]) / 1000
    if re.fullmatch(r"\d+(?:\.\d+)?", t):
        return float(t)
    if t and (m := re.fullmatch(r"(?:(\d+(?:\.\d+)?)h)?(?:(\d+(?:\.\d+)?)m)?(?:(\d+(?:\.\d+)?)s)?", t)):
        return sum(float(x or 0) * f for x, f in zip(m.groups(), (3600, 60, 1)))
    return default


def is_rate_limit(error: Exception) -> bool:
    text = str(error).lower()
    return isinstance(error, RateLimited) or "429" in text or "rate limit" in text or "quota" in text or "too many requests" in text


def reset_after(error: Exception) -> float:
    """Seconds until a limit ends: headers first, then the message; a daily quota is a day."""
    headers = {k.lower(): v for k, v in getattr(error, "headers", {}).items()}
    for name in ("retry-after", "x-ratelimit-reset-requests", "x-ratelimit-reset-tokens"):
        if name in headers:
            return parse_duration(headers[name])
    text = str(error).lower()
    if "per day" in text or "perday" in text or "daily" in text:
        return DAY
    if m := re.search(r"(?:try again in|retry in|retrydelay\W+)\s*([\d.]+m?s|(?:[\d.]+h)?(?:[\d.]+m)?[\d.]+s)", text):
        return parse_duration(m[1])
    return 5.0


@dataclass
class Provider:
    name: str
    call: Callable[[dict], dict]
    interval: float = 0.0
    cap: int = 10**9
    free_at: float = 0.0
    used: int = 0
    flying: int = 0
    spent: bool = field(default=False)


def dispatch(
    jobs: list[dict], providers: list[Provider], cache: dict[str, dict] | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, workers: int = 1, idle: float = IDLE,
) -> list[dict]:
    """An answer for every job: from the cache, from the soonest free provider, or manual review.

    A job goes back to the queue when its provider fails, ATTEMPTS times at most; a provider over its
    daily cap of successful calls or with a long wait is out.  ``workers`` threads call providers at
    once (``pool`` says how many suit); equal content is asked for once.  If for ``idle`` seconds no job
    ends or goes back, those still waiting go to manual review.  Every job ends exactly once.
    """
    cache = {} if cache is None else cache
    queue, out, asked = deque((j, 0) for j in jobs), [], set()
    state, moved = threading.Condition(), clock()

    def end(job: dict, answer: dict) -> None:
        nonlocal moved
        out.append({"job_id": job["job_id"], **answer})
        moved = clock()

    def take() -> tuple[dict, int, str, Provider, float] | None:
        """The next call to make; None if there is none left."""
        while queue or asked:
            if queue and clock() - moved > idle:
                while queue:
                    end(queue.popleft()[0], REVIEW)
            if not queue:
                state.wait(0.02)
                continue
            job, tries = queue.popleft()
            key = job.get("content_hash", job["job_id"])
            for p in providers:
                p.spent = p.spent or p.used >= p.cap
            ready = [p for p in providers if not p.spent and p.used + p.flying < p.cap]
            if key in cache:
                end(job, cache[key])
            elif key in asked or not ready and any(p.flying and not p.spent for p in providers):
                queue.append((job, tries))
                state.wait(0.02)
            elif not ready or tries >= ATTEMPTS:
                end(job, REVIEW)
            else:
                p = min(ready, key=lambda x: x.free_at)
                start = max(p.free_at, clock())
                p.free_at, p.flying = start + p.interval, p.flying + 1
                asked.add(key)
                return job, tries, key, p, start - clock()
        return None

    def work() -> None:
        nonlocal moved
        while True:
            with state:
                call = take()
            if call is None:
                return
            job, tries, key, p, wait = call
            if wait > 0:
                sleep(wait)
            answer = error = None
            try:
                answer = p.call(job) | {"method": f"llm:{p.name}"}
            except Exception as e:  # a provider's failure never loses a job
                error = e
            with state:
                asked.discard(key)
                p.flying -= 1
                if answer is not None:
                    p.used += 1
                    cache[key] = answer
                    end(job, answer)
                else:
                    if is_rate_limit(error):
                        reset = reset_after(error)
                        p.spent = p.spent or reset > EXHAUST
                        p.free_at = max(p.free_at, clock() + reset)
                    queue.append((job, tries + 1))
                    moved = clock()
                state.notify_all()

    if workers <= 1:
        work()
    else:
        threads = [threading.Thread(target=work) for _ in range(workers)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    return out


def pool(providers: list[Provider]) -> int:
    """Threads that suit so many providers."""
    return max(3, min(12, 2 * len(providers)))


def retrying(call: Callable[[dict, str], dict], attempts: int = 3, longest: float = 30.0, between: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[dict], dict | None]:
    """A judge for single jobs: ``call(job, note)`` is tried ``attempts`` times; the note of a later try
    says what was wrong with the one before.  None if all fail.  It waits a limit out, ``longest``
    seconds at most."""

    def judge(job: dict) -> dict | None:
        note = ""
        for _ in range(attempts):
            try:
                return call(job, note)
            except Exception as e:  # noqa: BLE001 -- any failure is a reason to try again
                note = f"Prev invalid: {str(e)[:140]}. Return a valid CODE."
                sleep(min((reset_after(e) if is_rate_limit(e) else between) + 0.5, longest))
        return None

    return judge
