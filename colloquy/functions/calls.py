"""Calling a remote judge from inside an Arrow batch (UDF-1, UDF-2), in plain Python.

No Spark objects here: the module is shipped to the Python workers by value.
"""

from __future__ import annotations

import sys
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import cloudpickle


def concurrent_answer(call: Callable[[str], str | None], max_workers: int = 8) -> Callable[[pd.Series], pd.Series]:
    """Wrap a one-prompt call (e.g. an HTTP request to a model) for a whole batch.

    Up to ``max_workers`` calls run at once inside the batch; a call that raises
    is isolated and answers None (a failed call, retried by the next run), so one
    bad request never fails the task or its neighbours.
    """

    def answer(prompts: pd.Series) -> pd.Series:
        def one(prompt):
            if prompt is None:
                return None
            try:
                return call(prompt)
            except Exception:  # noqa: BLE001 - any failure of one call is that call's failure
                return None

        with ThreadPoolExecutor(max_workers=max_workers) as pool:
            out = list(pool.map(one, prompts.tolist()))
        return pd.Series(out, index=prompts.index, dtype=object)

    return answer


class _Call:
    """One prompt's call: its answer once it is done, or None once its time is over."""

    __slots__ = ("answer", "deadline", "done")

    def __init__(self, deadline: float):
        self.deadline, self.done, self.answer = deadline, False, None


class CallWindow:
    """At most ``in_flight`` calls at once, each with a time limit and retries.

    A call is a thread of its own. One that overstays its limit is given up: it counts as failed, its place is free for the next, and
    whatever it still returns is dropped. ``most_lost`` such threads may hang on; beyond, the window refuses to start more.
    """

    def __init__(self, call: Callable[[str], str | None], in_flight: int, retries: int, backoff: float, limit: float, most_lost: int):
        self.call, self.in_flight, self.retries, self.backoff, self.limit, self.most_lost = call, in_flight, retries, backoff, limit, most_lost
        self.turn = threading.Condition()
        self.running: set[_Call] = set()
        self.lost = 0

    def start(self, prompt: str) -> _Call:
        """Begin a call as soon as there is a place for it."""
        with self.turn:
            self._wait(lambda: len(self.running) < self.in_flight)
            if self.lost > self.most_lost:
                raise TimeoutError(f"{self.lost} calls did not return in {self.limit} s each")
            one = _Call(time.monotonic() + self.limit)
            self.running.add(one)
        threading.Thread(target=self._run, args=(one, prompt), daemon=True).start()
        return one

    def finish(self, calls: list[_Call | None]) -> list[str | None]:
        """The answers of ``calls`` when all are done or given up."""
        with self.turn:
            self._wait(lambda: all(c is None or c.done for c in calls))
        return [None if c is None else c.answer for c in calls]

    def _run(self, one: _Call, prompt: str) -> None:
        answer = None
        for n in range(self.retries + 1):
            try:
                answer = self.call(prompt)
                break
            except Exception:  # noqa: BLE001 - any failure of one call is that call's failure
                wait = self.backoff * 2**n
                if n == self.retries or time.monotonic() + wait >= one.deadline:
                    break
                time.sleep(wait)
        with self.turn:
            if one.done:
                self.lost -= 1  # it came back, too late
            else:
                one.answer, one.done = answer, True
                self.running.discard(one)
            self.turn.notify_all()

    def _wait(self, ready: Callable[[], bool]) -> None:
        """Wait for ``ready``, giving up calls whose time is over meanwhile; the lock is held."""
        while True:
            now = time.monotonic()
            for c in [c for c in self.running if c.deadline <= now]:
                c.done = True
                self.running.discard(c)
                self.lost += 1
            if ready():
                return
            self.turn.wait(max(0.0, min((c.deadline for c in self.running), default=now + self.limit) - now))


def windowed_answers(
    call: Callable[[str], str | None],
    in_flight: int = 16,
    retries: int = 2,
    backoff: float = 0.5,
    limit: float = 120.0,
    ahead: int = 4,
    most_lost: int = 64,
) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    """Wrap a one-prompt call for a task's whole stream of batches.

    Calls of up to ``ahead`` further batches go on while an earlier batch waits for its slowest one, so a slow call
    holds up its own batch's answers and nobody's calls. A call that raises is made again up to ``retries`` times, after ``backoff`` seconds,
    twice as many and so on, all within ``limit`` seconds from its start; then it answers None. Every prompt has one answer.
    """

    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        window = CallWindow(call, in_flight, retries, backoff, limit, most_lost)
        open_: deque[tuple[pd.Index, list[_Call | None]]] = deque()

        def first() -> pd.Series:
            index, calls = open_.popleft()
            return pd.Series(window.finish(calls), index=index, dtype=object)

        for prompts in batches:
            open_.append((prompts.index, [None if p is None else window.start(p) for p in prompts]))
            while len(open_) > ahead or (open_ and all(c is None or c.done for c in open_[0][1])):
                yield first()
        while open_:
            yield first()

    return answers


cloudpickle.register_pickle_by_value(sys.modules[__name__])
