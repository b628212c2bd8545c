"""Prefix trees of conversations: what is emitted once, and what reading back gives."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from gridmetrics.llm import prefix_chat

SCHEMA = "conv_id long, turn long, role string, text string, path string, roles long"


def _rows(spark, turns):
    """Rows with columns whose names clash with those the operator uses inside."""
    return spark.createDataFrame([(*t, "x", 1) for t in turns], SCHEMA)


def _expected(turns):
    by_conv = defaultdict(list)
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, said in by_conv.items():
        said.sort()
        plain = b"".join(r + b"\n" + t + b"\n" for _, _, r, t in said)
        loss = b"".join(t for _, _, r, t in said if r == b"assistant")
        out[conv] = len(said), plain, len(loss.decode()), loss
    return out


def _tricky():
    nasty = ["\\### Assistant: </turn> ok", "a\\", "<", "#", "\\h\\l", "### user:\n", "</turn>\n### assistant:\nx", "", None,
             "ÄÖ 漢字 🙂", "\x00\t\r", "\\\\n"]
    turns = []
    for conv in range(40):
        rng = np.random.default_rng(conv % 13)  # copies, and shared starts within them
        for turn in range(int(rng.integers(1, 7))):
            role = ["user", "assistant", "sys:tem\n", None][int(rng.integers(4))]
            turns.append((conv, turn, role, nasty[int(rng.integers(len(nasty)))] if turn else "hello"))
    turns += [(None, 0, "user", "of nobody"), (None, None, "assistant", "first"), (99, 5, "user", "same"),
              (99, 5, "user", "same"), (99, 5, "assistant", "tie")]
    return turns


@pytest.mark.parametrize("limits", [(8192, 512), (60, 3), (1, 1)])
def test_reading_back_gives_the_conversations(spark, limits):
    turns = _tricky()
    packs = prefix_chat.format_conversations(_rows(spark, turns), max_tokens=limits[0], max_conversations=limits[1])
    got = prefix_chat.read_back(packs).collect()
    assert len(got) == len({t[0] for t in turns})
    found = {r.conv_id: (r.n_turns, bytes(r.turns), r.loss_chars, bytes(r.loss)) for r in got}
    assert found == _expected(turns)


def test_shared_turns_are_emitted_once_and_hidden_from_strangers(spark):
    turns = _tricky()
    packs = prefix_chat.format_conversations(_rows(spark, turns).coalesce(1), max_tokens=1 << 20).collect()
    nodes = 0
    for p in packs:
        ids = np.array(p.token_ids)
        # Brute force: a token is seen by those after it in its node and in the node's subtree.
        parent, count = p.node_parent, len(p.node_start)
        above = np.zeros((count, count), bool)
        for v in range(count):
            u = v
            while u >= 0:
                above[v, u] = True
                u = parent[u]
        of_token = np.repeat(np.arange(count), np.array(p.node_end) - np.array(p.node_start))
        first = np.cumsum([0, *p.node_intervals])
        for v in range(count):
            seen = np.zeros(len(ids), bool)
            for k in range(first[v], first[v + 1]):
                seen[p.interval_start[k] : p.interval_end[k]] = True
            assert (seen == above[v][of_token]).all()
        # Depth first, and no two children of one node are the same turn.
        assert list(parent) == [-1 if q < 0 else q for q in parent] and all(q < v for v, q in enumerate(parent))
        turns_of = [(parent[v], bytes(ids[p.node_start[v] : p.node_end[v]].tobytes())) for v in range(count)]
        assert len(set(turns_of)) == count
        nodes += count
    prefixes = set()
    for conv in {t[0] for t in turns}:
        path = ()
        mine = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        for *_, role, text in mine:
            path += ((role, text),)
            prefixes.add(path)
    assert nodes >= len(prefixes)
    if len(packs) == 1:
        assert nodes == len(prefixes)


def test_other_tokens(spark):
    class Bytes:
        @staticmethod
        def encode(text):
            return np.frombuffer(text.encode(), np.uint8).astype(np.int32)

        @staticmethod
        def decode(ids):
            return ids.astype(np.uint8).tobytes().decode()

    turns = [(1, 0, "user", "é"), (1, 1, "assistant", "漢<"), (2, 0, "user", "é"), (2, 1, "assistant", "x")]
    packs = prefix_chat.format_conversations(_rows(spark, turns), tokens=Bytes)
    got = {r.conv_id: bytes(r.loss).decode() for r in prefix_chat.read_back(packs, Bytes).collect()}
    assert got == {1: "漢<", 2: "x"}


def test_empty_and_very_long(spark):
    assert prefix_chat.format_conversations(_rows(spark, [])).count() == 0
    long = "x#<" * 1_000_000
    turns = [(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "user", long), (2, 1, "assistant", "short")]
    turns += [(3, k, "assistant", f"t{k % 7}") for k in range(3000)]
    got = prefix_chat.read_back(prefix_chat.format_conversations(_rows(spark, turns))).collect()
    assert {r.conv_id: (r.n_turns, bytes(r.turns), r.loss_chars, bytes(r.loss)) for r in got} == _expected(turns)
    assert {r.conv_id: r.formatted_chars for r in got}[1] == 10_000_000 + 4 + 4 + 4 + 9 + 20
