import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isotherm.llm.chat import BROKEN, START, ChatTemplate, chat_digests, entry_states, format_chats, join_segments

COLUMNS = "conv_id long, turn long, role string, text string, task string, state string"
CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>", "<</TURN>>", "\\", "[", "<", "ok", "\n"]
TURN = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "[INST]", ""]), st.lists(st.sampled_from(CONTROLS)).map("".join))


@settings(max_examples=300, deadline=None)
@given(st.lists(TURN, min_size=1, max_size=5))
def test_reads_back_what_it_formatted(turns):
    template = ChatTemplate()
    segments = [s for role, text in turns for s in template.segments(role, text)]
    formatted = "".join(text for text, _ in segments)
    assert list(template.read_turns(formatted)) == turns
    assert [template.unescaped(t) for t, loss in segments if loss] == [t for r, t in turns if r == "assistant"]


def state_of(roles):
    template, state = ChatTemplate(), START
    for role in roles:
        state = template.next_state(state, role)
    return state


@pytest.mark.parametrize(
    ("roles", "state"),
    [
        (["user", "assistant"], "assistant"),
        (["system", "user", "assistant", "user"], "user"),
        (["assistant"], BROKEN),
        (["user", "user"], BROKEN),
        (["user", "tool", "assistant"], BROKEN),
        ([], START),
    ],
)
def test_machine(roles, state):
    assert state_of(roles) == state


def test_entry_states_compose():
    template = ChatTemplate()
    states = template.states

    def lead(task, first, last, alone, roles):
        leads = []
        for state in states:
            at = state if alone else START
            for role in roles:
                at = template.next_state(at, role)
            leads.append(at)
        return {"task": task, "first": first, "last": last, "alone": alone, "leads": leads}

    found = entry_states([lead(2, 5, 6, False, ["user"]), lead(0, 5, 5, True, ["user"]), lead(1, 5, 5, True, ["assistant"])], states)
    assert found == {0: START, 1: "user", 2: "assistant"}


def expected(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        valid = state_of([r for r, _ in turns]) == "assistant"
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), valid)
    return out


def test_frames(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i} </s>") for i in range(400)]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", None), (3, None, None, "x"), (None, 1, "user", "y" * 50_000), (None, 2, "assistant", "")]
    rows += [(4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "assistant", "z")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], COLUMNS).repartition(3)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) for r in chat_digests(join_segments(format_chats(frame))).collect()}
    assert got == expected(rows)


def test_a_large_conversation_is_spread_over_tasks(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "x") for i in range(2000)]
    segments = format_chats(spark.createDataFrame([(*r, "", "") for r in rows], COLUMNS))
    assert segments.select("task").distinct().count() > 1
    assert segments.where("state = 'broken'").isEmpty()


def test_empty_table(spark):
    assert chat_digests(join_segments(format_chats(spark.createDataFrame([], COLUMNS)))).collect() == []
