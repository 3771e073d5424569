"""The sliding window of judge calls."""

import threading
import time

import pandas as pd
import pytest

from colloquy.functions.calls import windowed_answers
from colloquy.operators import audit as au


def _run(call, batches, **how):
    answers = windowed_answers(call, **{"in_flight": 4, "backoff": 0.01, "limit": 5.0, **how})
    return [list(x) for x in answers(iter([pd.Series(b, dtype=object) for b in batches]))]


def test_every_prompt_has_one_answer_in_order():
    asked = []
    got = _run(lambda p: asked.append(p) or p.upper(), [["a", None, "b"], [], ["c"], ["d", "e"]])
    assert got == [["A", None, "B"], [], ["C"], ["D", "E"]]
    assert sorted(asked) == ["a", "b", "c", "d", "e"]
    assert _run(str.upper, []) == []


def test_a_slow_call_holds_up_no_other_batch():
    done, slow = [], threading.Event()

    def call(p):
        if p == "slow":
            slow.wait(5)
        else:
            done.append(p)
            if len(done) == 6:
                slow.set()  # only now: the other batches' calls were not waiting for this one
        return p

    assert _run(call, [["slow", "a"], ["b", "c"], ["d", "e"], ["f"]], ahead=3) == [["slow", "a"], ["b", "c"], ["d", "e"], ["f"]]


def test_calls_in_flight_are_bounded_over_batches():
    now, most, lock = [0], [0], threading.Lock()

    def call(p):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return p

    batches = [[f"{i}-{j}" for j in range(5)] for i in range(6)]
    assert _run(call, batches, in_flight=3) == batches
    assert most[0] == 3


def test_failures_are_retried_with_back_off_then_given_up():
    tries: dict[str, list[float]] = {}

    def call(p):
        tries.setdefault(p, []).append(time.monotonic())
        if p == "never" or len(tries[p]) < 3 and p == "third":
            raise ConnectionError(p)
        return p

    assert _run(call, [["once", "third", "never"]], retries=2, backoff=0.05) == [["once", "third", None]]
    assert {p: len(t) for p, t in tries.items()} == {"once": 1, "third": 3, "never": 3}
    t = tries["never"]
    assert t[1] - t[0] >= 0.05 and t[2] - t[1] >= 0.1


def test_a_call_that_hangs_is_given_up_and_its_place_freed():
    hang = threading.Event()
    got = _run(lambda p: hang.wait(3) and None if p == "hang" else p, [["hang", "a"], ["b"]], in_flight=1, limit=0.2)
    assert got == [[None, "a"], ["b"]]
    with pytest.raises(TimeoutError):
        _run(lambda p: hang.wait(3), [["x"] * 9], in_flight=2, limit=0.05, most_lost=3)
    hang.set()


def test_windowed_judge_calls_once_per_transcript(spark):
    calls = spark.sparkContext.accumulator(0)

    def call(prompt):
        calls.add(1)
        if "line 3" in prompt:
            raise ConnectionError
        return '{"errors":[{"lines":[1,1],"reason":"r"}]}'

    rows = spark.createDataFrame([(i, f"line {i}.") for i in range(9)], "id int, dialogue string").repartition(2)
    judges = [au.windowed_judge("remote", call, in_flight=3, retries=0), au.windowed_judge("second", lambda p: None)]
    wide = au.fan_out(au.build_prompts(rows), judges)
    got = {(r.id, r.model): r.status for r in au.verdicts_long(wide, ["id"], ()).collect()}
    assert len(got) == 18 and calls.value == 9
    assert [got[i, "remote"] for i in range(9)] == ["ok"] * 3 + ["failed"] + ["ok"] * 5
    assert {got[i, "second"] for i in range(9)} == {"failed"}
