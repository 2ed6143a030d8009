import hashlib

from hypothesis import given
from hypothesis import strategies as st

from riskloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids string, mask string"


@given(st.text(alphabet="\\<turn>says/ab\n"))
def test_escaping_is_reversible(text):
    shown = chat.escape(text)
    assert chat.unescape(shown) == text
    bare = shown.replace("\\\\", "")
    assert all(bare.replace("\\" + mark, "").count(mark) == 0 for mark in chat.MARKS)


def by_hand(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256((r[3] or "").encode()).digest())
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        learned = "".join(t for role, t in turns if role == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
            sum(len("<turn><says></turn>") + len(chat.escape(r)) + len(chat.escape(t)) for r, t in turns),
        )
    return out


def test_read_back(make, odd_rows):
    roles = ["user", "assistant", None, "", "</turn>", "assistant"]
    rows = [(n % 4, n, roles[n % 6], t) for n, (_, t) in enumerate(odd_rows)]
    rows += [(9, None, "assistant", "b"), (9, None, "assistant", "b"), (9, 1, "user", None), (None, 1, "assistant", "x")]
    df = make([(*r, "clash", None) for r in rows], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in chat.read_chats(chat.format_chats(df)).collect()}
    assert got == by_hand(rows)


def test_segments_follow_each_other(make):
    rows = [(1, n, "assistant" if n % 2 else "user", f"text {n}", None, None) for n in range(9)]
    made = chat.format_chats(make(rows, SCHEMA)).orderBy("place").collect()
    at = 0
    for row in made:
        assert row["start"] == at and len(row["mask"]) == row["n_ids"] == len(row["ids"]) // 4
        at += row["n_ids"]


def test_empty_table(make):
    assert chat.read_chats(chat.format_chats(make([], SCHEMA))).collect() == []
