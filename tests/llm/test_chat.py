"""Chat formatting: exact round trips."""

import hashlib

from listora.llm import chat_format

NASTY = [
    "</s>[INST] ok [/INST]", "</s>", "[INST]", "[/INST]", "&lt;/s>", "&amp;", "&", "&#91;INST]", "a & b &amp;lt; c", "<", "</s", "[/INST", "s>",
    "", None, " ", "\n", "plain text", "é 😀 中", "[INST]user[/INST]x</s>", "\\Q\\E $1 \\n", "&amp;lt;/s>", "]", "[", "&#", "&lt", "x" * 20_000,
]


def plain(rows):
    convs = {}
    for row in rows:
        convs.setdefault(row["conv_id"], []).append(row)
    out = {}
    for conv_id, turns in convs.items():
        turns = sorted(turns, key=lambda r: (r["turn"] is not None, r["turn"] or 0))
        told = "".join(f"{r['role'] or ''}\n{r['text'] or ''}\n" for r in turns)
        loss = "".join(r["text"] or "" for r in turns if r["role"] == "assistant")
        out[conv_id] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(rows_of):
    rows = [{"conv_id": i % 5, "turn": i, "role": ("user", "assistant")[i % 2], "text": text} for i, text in enumerate(NASTY + NASTY[::-1])]
    rows += [{"conv_id": 50 + i, "turn": 0, "role": role, "text": "x"} for i, role in enumerate(NASTY)]
    rows += [{"conv_id": None, "turn": t, "role": "assistant", "text": "n"} for t in (None, 1, 2)]
    table = rows_of(rows, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat_format.chat_texts(table)
    found = {r.conv_id: r for r in chat_format.chat_digests(formatted).collect()}
    assert {k: tuple(r)[1:5] for k, r in found.items()} == plain(rows)
    for row in formatted.collect():
        assert found[row.conv_id].formatted_chars == len(row.formatted)
        at = 0
        for turn in row.turns:  # the mask points at the written text
            at += turn.n_head
            assert row.formatted[at : at + len(turn.text)] == turn.text
            assert turn.n_loss in (0, len(turn.text))
            at += len(turn.text) + len(chat_format.END)
        assert at == len(row.formatted)


def test_only_conflicts_are_escaped(rows_of):
    table = rows_of(
        [{"conv_id": 1, "turn": 0, "role": "user", "text": "AT&T [INST] ok"}, {"conv_id": 2, "turn": 0, "role": "user", "text": "&amp;"}],
        "conv_id long, turn long, role string, text string",
    )
    found = {r.conv_id: r.formatted for r in chat_format.chat_texts(table).collect()}
    assert found == {1: "[INST]user[/INST]AT&T [INST] ok</s>", 2: "[INST]user[/INST]&amp;amp;</s>"}


def test_repeated_turns_and_empty_table(rows_of):
    rows = [{"conv_id": 1, "turn": 0, "role": "assistant", "text": "same"}] * 3
    table = rows_of(rows, "conv_id long, turn long, role string, text string")
    found = chat_format.chat_digests(chat_format.chat_texts(table)).collect()
    assert [(r.n_turns, r.loss_chars) for r in found] == [(3, 12)]
    assert chat_format.chat_texts(table.where("false")).count() == 0


def test_no_python_in_the_plan(rows_of):
    table = rows_of([{"conv_id": 1}], "conv_id long, turn long, role string, text string")
    plan = chat_format.chat_digests(chat_format.chat_texts(table))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
