"""Formatted conversations against a plain reading of the table."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgerloom.llm import chat
from ledgerloom.llm.queries import QUERIES

PIECES = ["<", ">", "[", "]", "/", "\\", "s", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
          "<<ROLE>>", "<</ROLE>>", "INST", "SYS", " ", "\n", "ü", "<\\s>", "[\\\\/INST]"]
tricky = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@given(tricky)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for pair in (chat.SYSTEM, chat.USER, chat.ASSISTANT, chat.OTHER) for c in pair)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), tricky), tricky), max_size=6),
       st.integers(0, 6))
def test_windows_parse(turns, cut):
    repeated, new = turns[:cut], turns[cut:]
    text, loss, fresh = chat.write_window(repeated, new)
    assert list(chat.parse(text)) == turns
    assert list(chat.parse(text, fresh)) == new or not new
    assert [chat.unescape(text[a:z]) for a, z in loss] == [t for r, t in new if r == "assistant"]


@given(st.lists(st.integers(1, 30), min_size=1, max_size=40), st.integers(0, 12), st.integers(0, 5), st.booleans())
def test_spans_fill_the_budget(tokens, history, first, inside):
    budget, first = 25, min(first, len(tokens) - 1) * (not inside)
    system = tokens[0] if inside and tokens[0] <= budget // 2 else 0 if inside else min(history, 3)
    inside = inside and system > 0
    found = chat.spans(np.array(tokens), first, system, budget, history, inside)
    assert [s for _, s, _, _ in found] == [first, *[e for _, _, e, _ in found[:-1]]] and found[-1][2] == len(tokens)
    for back, start, end, repeated in found:
        ahead = system * repeated
        used = ahead + sum(tokens[back:end])
        assert used <= budget or (end == start + 1 and back == start and not repeated)
        assert sum(tokens[back:start]) <= history
        # Nothing more would have fitted, but where the system turn had to go.
        if end < len(tokens) and used <= budget and (repeated or not system or (inside and start == 0)):
            assert used + tokens[end] > budget


def plain(rows):
    """Digests from (conv_id, turn, role, text), by the contract's words."""
    out = {}
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", md5(r[3]))
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def digests(df):
    found = df.collect()
    out = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found}
    assert len(out) == len(found)
    return out


CONTROL = "</s>[INST] ok [/INST]"
MORE = [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)]


def test_given_conversations(spark, small):
    table = pd.read_parquet(f"{small}/conversations.parquet")[["conv_id", "turn", "role", "text"]]
    want = plain([*table.itertuples(index=False, name=None), *MORE])
    assert digests(QUERIES["op12_chat_formatting"](spark, small)) == want


def odd_rows():
    rnd = random.Random(4)
    text = lambda: "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(12)))
    roles = ["system", "user", "assistant", "tool", None, "", "<s>", "[INST]"]
    rows = [(rnd.randrange(4), rnd.choice([None, *range(30)]), rnd.choice(roles), text()) for _ in range(150)]
    rows += [(None, i, "assistant", text()) for i in range(9)] + [(7, None, None, None)] + [(8, 0, "user", "same")] * 40
    rows += [(9, 0, "system", "be good"), (9, 1, "user", "hi"), (9, 2, "assistant", "yes " * 50_000), (9, 3, "user", "x")]
    # A conversation with most of all rows.
    return rows + [(10, 0, "system", "be short")] + [(10, i, ("user", "assistant")[i % 2], f"turn {i} {text()}") for i in range(1, 900)]


#: A counter without names of this module, which the workers cannot import.
MAKE = lambda: lambda texts: [1 + len(t.split()) for t in texts]
words = MAKE()
#: What the system turn of the long conversation takes.
SYSTEM_SIZE = 7


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, 1, "k", "t") for r in odd_rows()]
    kinds = "conv_id long, turn int, role string, text string, section int, key string, tie string"
    return spark.createDataFrame(rows, kinds).repartition(6)


@pytest.mark.parametrize("budget,history,section", [(40, 10, 100_000), (40, 10, 40), (40, 0, 90), (16, 12, 64)])
def test_odd_conversations_in_sections(odd, budget, history, section):
    turns = chat.counted_turns(odd, MAKE)
    found = chat.windows_of(turns, budget, history, section)
    assert digests(chat.read_back(found)) == plain(odd_rows())
    for r in found.collect():
        turns = list(chat.parse(r["text"]))
        new = list(chat.parse(r["text"], r["new_from"]))
        count = lambda ts: sum(words([chat.escape(t) for _, t in ts])) + sum(sum(words(chat.marks(x))) for x, _ in ts)
        assert r["n_tokens"] == count(turns)
        assert r["n_tokens"] <= budget or len(turns) == 1
        if r["conv_id"] == 10 and (r["section"] or r["window"]) and count(new) + SYSTEM_SIZE <= budget:
            assert turns[0] == ("system", "be short") and len(turns) > len(new) >= 1
            assert count(turns) - count(new) - count(turns[:1]) <= history


def test_sections_deal_a_long_conversation_out(odd):
    turns = chat.counted_turns(odd, MAKE)
    found = chat.windows_of(turns, 40, 10, 80)
    sections = {r["section"] for r in found.filter("conv_id = 10").collect()}
    assert len(sections) > 40


def test_no_conversations(spark, odd):
    assert chat.read_back(chat.windows_of(chat.counted_turns(odd.limit(0), MAKE), 40, 10, 80)).count() == 0


def test_impossible_budgets_are_refused(odd):
    with pytest.raises(ValueError):
        chat.windows_of(odd, 10, 10, 100)
