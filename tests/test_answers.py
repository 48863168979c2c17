"""Answers of a foreign function: asked once, kept over failures and reruns."""

from __future__ import annotations

from collections import Counter

import pytest

from firmweave.operators import answers


def counting(folder):
    """A scorer that writes down each call."""
    folder.mkdir()

    def scorer(prompt: str) -> str:
        import os
        import uuid

        with open(os.path.join(str(folder), uuid.uuid4().hex), "w") as out:
            out.write(prompt)
        return prompt.upper()

    return scorer, lambda: Counter(p.read_text() for p in folder.iterdir())


def prompts(spark, n, copies=3):
    return spark.createDataFrame([(i, f"p{i % n}") for i in range(n * copies)] + [(-1, None)], "id long, prompt string").repartition(5)


def test_each_different_prompt_is_asked_once(spark, tmp_path):
    scorer, calls = counting(tmp_path / "calls")
    store = str(tmp_path / "store")
    out = answers.with_answers(prompts(spark, 50), scorer, store)
    rows = {r.id: r.answer for r in out.collect()}
    assert out.collect() and rows == {i: f"P{i % 50}" for i in range(150)} | {-1: None}
    assert calls() == Counter(f"p{i}" for i in range(50))
    # A later run asks for what is new only; another label has answers of its own.
    again = answers.with_answers(prompts(spark, 60), scorer, store).collect()
    assert len(again) == 181 and calls() == Counter(f"p{i}" for i in range(60))
    answers.with_answers(prompts(spark, 2), scorer, store, label="other").collect()
    assert calls()["p0"] == 2 and calls()["p5"] == 1


def test_a_task_that_fails_half_way(spark, tmp_path):
    scorer, calls = counting(tmp_path / "calls")
    switch, store = tmp_path / "mended", str(tmp_path / "store")

    def failing(prompt: str) -> str:
        if prompt == "p41" and not switch.exists():
            raise SystemExit("the worker is told to stop")
        return scorer(prompt)

    with pytest.raises(Exception, match="ended the task"):
        answers.with_answers(prompts(spark, 80), failing, store, tasks=1)
    half = calls()
    assert 0 < len(half) < 80 and set(half.values()) == {1}
    switch.touch()
    rows = {r.id: r.answer for r in answers.with_answers(prompts(spark, 80), failing, store, tasks=3).collect()}
    assert all(rows[i] == f"P{i % 80}" for i in range(240))
    assert calls() == Counter(f"p{i}" for i in range(80))


def test_earlier_attempts_of_a_task_are_read(tmp_path):
    folder = str(tmp_path / "run" / "0")
    assert answers._answered(folder) == set()
    answers._keep(folder, [("a", "1"), ("b", "zwei\n")])
    answers._keep(folder, [("c", "3")])
    assert answers._answered(folder) == {"a", "b", "c"}


def test_failed_calls_and_pace(spark, tmp_path):
    scorer, calls = counting(tmp_path / "calls")

    def moody(prompt: str) -> str | None:
        scorer(prompt)
        if prompt == "p1":
            raise ValueError("never")
        return None if prompt == "p2" else prompt

    rows = {r.id: r.answer for r in answers.with_answers(prompts(spark, 4, 1), moody, str(tmp_path / "s"), retries=1).collect()}
    assert rows == {0: "p0", 1: None, 2: None, 3: "p3", -1: None}
    assert calls() == Counter({"p0": 1, "p1": 2, "p2": 1, "p3": 1})
    pace = answers._Pace(50.0)
    import time

    begin = time.monotonic()
    for _ in range(6):
        pace.wait()
    assert time.monotonic() - begin >= 0.09
    assert answers.with_answers(prompts(spark, 4, 1).limit(0), moody, None).count() == 0
