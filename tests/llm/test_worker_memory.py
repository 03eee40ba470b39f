"""What a worker keeps between tasks is small."""

from __future__ import annotations

from tablekit.llm import words


def test_powers_of_a_worker_are_few():
    assert sum(x.nbytes for x in words._powers(100)) < 4 << 20
