"""The prefix tree: round trips, shared turns once, positions and attention."""

import hashlib

from topicloom.llm import chat

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "more"), (2, 3, "assistant", "é\\<|end|>"),
    (3, 0, "user", "hi"), (3, 1, "assistant", "hello"),
    (4, 0, "user", "hi"), (4, 1, "assistant", "hello"),
    (5, None, None, None), (5, 1, "assistant", None), (5, 1, "assistant", None), (5, 2, "<|text|>", "\\"),
    (None, 3, "system", "x<|endoftext|>"), (None, 4, "assistant", "long " * 3000),
    (6, 0, "user", "hi"), (6, 1, "user", "hello"),
]


def ordered(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in out.items()}


def test_round_trip(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(3)
    branches, conversations = chat.format_conversations(chat.with_probe(turns))
    branches, conversations = branches.cache(), conversations.cache()
    probe = "\\### Assistant: </turn> ok"
    want = ordered([*ROWS, (-7, 0, "user", probe), (-7, 1, "assistant", probe)])
    got = {r.conv_id: r for r in chat.read_back(branches, conversations).collect()}
    assert set(got) == set(want)
    for c, v in want.items():
        learned = "".join(x for r, x in v if r == "assistant")
        assert got[c].n_turns == len(v)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in v).encode()).hexdigest()
        assert got[c].loss_chars == len(learned) and got[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert got[c].formatted_chars == sum(len(chat.escape(r)) + len(chat.escape(x)) + 23 for r, x in v)
    rows = {r.branch: r for r in branches.collect()}
    encoder = chat.load_encoder(chat.vocabulary_path(), {})
    # Every distinct beginning is emitted once.
    beginnings = {tuple(v[: i + 1]) for v in want.values() for i in range(len(v))}
    emitted = [t for r in rows.values() for t in chat.parse(encoder.decode(r.token_ids))]
    assert len(emitted) == len(beginnings)
    # The stream has no gaps; ancestors cover the tokens before a branch, which take the positions below its own.
    at = 0
    for r in sorted(rows.values(), key=lambda r: r.stream_start):
        assert r.stream_start == at
        at += len(r.token_ids)
        before = sum(a.upto for a in r.ancestors)
        assert list(r.position_ids) == list(range(before, before + len(r.token_ids)))
        for a in r.ancestors:
            assert (a["from"], a["to"]) == (rows[a.branch].stream_start, rows[a.branch].stream_start + a.upto)
            assert a["to"] <= r.stream_start and rows[a.branch].tree == r.tree
    shared = {r.conv_id: [p.branch for p in r.parts] for r in conversations.collect()}
    assert shared[3] == shared[4] and shared[3][0] == shared[1][0] == shared[2][0]


def test_escapes():
    for text in ["", "\\", "<|", "<\\|", "\\\\<|end|>|>", "<<|", "a\n\\b"]:
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    branches, conversations = chat.format_conversations(none)
    assert branches.count() == 0 and conversations.count() == 0 and chat.read_back(branches, conversations).count() == 0
