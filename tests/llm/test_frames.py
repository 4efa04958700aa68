import sys

from isotherm.llm.frames import lean, per_process


def test_a_lean_task_keeps_nothing_of_other_operators():
    made = per_process("table of another operator", lambda: [1] * 1000)
    assert per_process("table of another operator", list) is made
    seen = []

    def task(batches):
        for batch in batches:
            seen.append("table of another operator" in sys.__dict__["_isotherm_llm"])
            yield per_process("own", lambda: batch) + batch

    assert list(lean(task)([1, 2, 3])) == [2, 3, 4] and seen == [False] * 3
    assert per_process("table of another operator", list) == [] and len(made) == 1000
