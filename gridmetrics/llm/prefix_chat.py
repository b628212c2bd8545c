"""Chat formatting by prefix trees: turns that conversations share at their start are emitted once.

Conversations are ordered by the digests of their turns, so those with a common start are
neighbours, and each task walks its range of that order. The walk keeps the branch it is on;
where the next conversation leaves it (turns are compared as texts, never by digest alone), only the
remaining turns are appended. The tokens of a pack are therefore its prefix tree in depth-first
order. Every token has the position it has in its own conversation, and every node the merged
intervals of its ancestors and itself: a token sees those intervals up to its own place, which is
the conversation that leads to it and nothing of its neighbours.

A pack ends before ``max_tokens`` or ``max_conversations`` would be passed, so memory is bounded
by them or by one conversation, and a first turn or whole conversation that very many rows share
spreads over many packs and tasks; each pack holds it once. A conversation is one training example:
its turns meet in one task, sorted by Spark and read as a stream.

The template is ``### role:``, a line break, the text, ``</turn>`` and a line break. Backslash, ``#`` and ``<`` of
texts (in roles also colon and line break) are written as a backslash and a letter, so that no
control string can occur in a text. The texts of assistant turns carry the loss.

Defined results: null role or text counts as ''; null ids make one conversation; turns of equal
number are ordered by role, then text, null numbers first; repeated rows are repeated turns; other
columns are ignored; an empty table gives no packs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import STEP_BYTES, ship, table, text_bytes

LEARNED_ROLE = "assistant"
MAX_TOKENS, MAX_CONVERSATIONS = 8192, 512
#: Turns whose digests place a conversation in the global order; the order inside tasks uses all.
_PLACED_BY = 64

# The escapes of the template: character, letter written after a backslash.
ESCAPES = {"\\": "\\", "#": "h", "<": "l", ":": "c", "\n": "n"}
_TEXT = str.maketrans({c: "\\" + ESCAPES[c] for c in "\\#<"})
_ROLE = str.maketrans({c: "\\" + letter for c, letter in ESCAPES.items()})
_LETTERS = {letter: c for c, letter in ESCAPES.items()}
_ESCAPED = re.compile(r"\\(.)")
_TURN = re.compile(r"### ([^:]*):\n([^<]*)</turn>\n")


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """Header, escaped text and end of a turn."""
    return f"### {role.translate(_ROLE)}:\n", text.translate(_TEXT), "</turn>\n"


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: _LETTERS[m[1]], text) if "\\" in text else text


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(text):
        turn = _TURN.match(text, at)
        if turn is None:
            raise ValueError(f"not a turn at character {at}")
        turns.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return turns


class CodePoints:
    """The default tokens: one a code point."""

    @staticmethod
    def encode(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)

    @staticmethod
    def decode(ids: np.ndarray) -> str:
        return ids.astype("<i4").tobytes().decode("utf-32-le", "surrogatepass")


class Pack:
    """A prefix tree under construction, its nodes (turns) in depth-first order."""

    def __init__(self, tokens) -> None:
        self.tokens = tokens
        self.size = 0
        self.pieces: list[np.ndarray] = []
        self.masks: list[np.ndarray] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.position: list[int] = []
        self.parent: list[int] = []
        self.intervals: list[list[tuple[int, int]]] = []
        self.branch: list[tuple[int, str, str]] = []  # node, role and text of the current branch
        self.conversations: list[tuple[object, int]] = []

    def shared(self, turns: list[tuple[str, str]]) -> int:
        """Turns at the start that the current branch has as well."""
        n = 0
        for (_, *ours), theirs in zip(self.branch, turns):
            if tuple(ours) != theirs:
                break
            n += 1
        return n

    def add(self, conv_id, turns: list[tuple[str, str]], pieces: list) -> None:
        """Append a conversation; ``pieces`` are the tokens of the turns that are not shared."""
        kept = len(turns) - len(pieces)
        del self.branch[kept:]
        for (role, text), (ids, mask) in zip(turns[kept:], pieces):
            parent = self.branch[-1][0] if self.branch else -1
            node, start, end = len(self.start), self.size, self.size + len(ids)
            seen = list(self.intervals[parent]) if parent >= 0 else []
            if seen and seen[-1][1] == start:
                seen[-1] = (seen[-1][0], end)
            else:
                seen.append((start, end))
            above = self.position[parent] + self.end[parent] - self.start[parent] if parent >= 0 else 0
            self.start.append(start)
            self.end.append(end)
            self.position.append(above)
            self.parent.append(parent)
            self.intervals.append(seen)
            self.pieces.append(ids)
            self.masks.append(mask)
            self.size = end
            self.branch.append((node, role, text))
        self.conversations.append((conv_id, self.branch[-1][0]))

    def pieces_of(self, turns: list[tuple[str, str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tokens of turns and which of them carry the loss."""
        out = []
        for role, text in turns:
            parts = [self.tokens.encode(part) for part in formatted(role, text)]
            loss = [np.full(len(ids), k == 1 and role == LEARNED_ROLE) for k, ids in enumerate(parts)]
            out.append((np.concatenate(parts), np.concatenate(loss)))
        return out

    def row(self) -> tuple:
        ids = np.concatenate(self.pieces)
        places = np.concatenate(
            [np.arange(p, p + e - s) for p, s, e in zip(self.position, self.start, self.end)]
        )
        spans = [span for seen in self.intervals for span in seen]
        name = xxhash.xxh3_128(ids.tobytes())
        name.update(repr(self.conversations).encode())
        return (
            name.hexdigest(), ids, places, np.concatenate(self.masks), self.start, self.end, self.parent,
            [len(seen) for seen in self.intervals], [s for s, _ in spans], [e for _, e in spans],
            [c for c, _ in self.conversations], [leaf for _, leaf in self.conversations],
        )


def _pack_schema(kind: str) -> str:
    return (
        "pack string, token_ids array<int>, position_ids array<int>, loss_mask array<boolean>, "
        "node_start array<int>, node_end array<int>, node_parent array<int>, "
        "node_intervals array<int>, interval_start array<int>, interval_end array<int>, "
        f"conv_ids array<{kind}>, leaves array<int>"
    )


def conversations_of(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: id, digests of its turns as a path, roles and texts in order."""
    ship(rows.sparkSession)
    named = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        text_bytes(role).alias("role"), text_bytes(text).alias("text"),
    )
    ordered = named.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = f"conv_id {dict(named.dtypes)['conv_id']}, path binary, roles array<binary>, texts array<binary>"

    names, lists = ["conv_id", "path", "roles", "texts"], pa.list_(pa.binary())

    def run(batches):
        types = []
        current, roles, texts, started = None, [], [], False
        done, held = [], 0

        for batch in batches:
            types = [batch.schema.field("conv_id").type, pa.binary(), lists, lists]
            columns = (batch[name].to_pylist() for name in ("conv_id", "role", "text"))
            for conv, role, text in zip(*columns):
                if started and conv != current:
                    done.append((current, _path(roles, texts), roles, texts))
                    roles, texts = [], []
                    if held >= STEP_BYTES:
                        yield _columns(done, names, types)
                        done, held = [], 0
                current, started = conv, True
                roles.append(role)
                texts.append(text)
                held += len(role) + len(text)
        if started:
            yield _columns([*done, (current, _path(roles, texts), roles, texts)], names, types)

    return ordered.mapInArrow(run, schema)


def _path(roles: list[bytes], texts: list[bytes]) -> bytes:
    return b"".join(xxhash.xxh64_digest(r + b"\0" + t) for r, t in zip(roles, texts))


def format_conversations(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    max_tokens: int = MAX_TOKENS,
    max_conversations: int = MAX_CONVERSATIONS,
    tokens=CodePoints,
) -> DataFrame:
    """Packs: ``token_ids`` of a prefix tree in depth-first order with ``position_ids`` and ``loss_mask``.

    Nodes are ``node_start`` to ``node_end`` with ``node_parent`` (-1: a root). ``node_intervals`` counts a
    node's entries in ``interval_start`` and ``interval_end``, the tokens it may see. ``conv_ids`` end at
    the nodes ``leaves``. ``tokens`` has ``encode(str)`` and ``decode(ids)``.
    """
    whole = conversations_of(rows, conv_id, turn, role, text)
    kind = dict(whole.dtypes)["conv_id"]
    near = F.substring("path", 1, 8 * _PLACED_BY)
    ordered = whole.repartitionByRange(near, "conv_id").sortWithinPartitions("path", "conv_id")

    def run(batches):
        pack, done, held, of_id = Pack(tokens), [], 0, None
        for batch in batches:
            of_id = batch.schema.field("conv_id").type
            for row in _rows(batch):
                turns = [(r.decode(errors="surrogateescape"), t.decode(errors="surrogateescape"))
                         for r, t in zip(row["roles"], row["texts"])]
                pieces = pack.pieces_of(turns[pack.shared(turns) :])
                more = sum(len(ids) for ids, _ in pieces)
                full = pack.size + more > max_tokens or len(pack.conversations) >= max_conversations
                if full and pack.conversations:
                    done.append(pack.row())
                    held += pack.size
                    pack = Pack(tokens)
                    pieces = pack.pieces_of(turns)
                    if held >= STEP_BYTES // 8:
                        yield _packed(done, of_id)
                        done, held = [], 0
                pack.add(row["conv_id"], turns, pieces)
        if pack.conversations:
            yield _packed([*done, pack.row()], of_id)

    return ordered.select("conv_id", "roles", "texts").mapInArrow(run, _pack_schema(kind))


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _packed(rows: list[tuple], of_id: pa.DataType) -> pa.RecordBatch:
    names = [part.split()[0] for part in _pack_schema("long").split(", ")]
    columns = list(zip(*rows))
    types = [pa.int32()] * 2 + [pa.bool_()] + [pa.int32()] * 6 + [of_id, pa.int32()]
    arrays = [pa.array(columns[0], pa.string())]
    for lists, kind in zip(columns[1:], types):
        offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        if isinstance(lists[0], np.ndarray):
            values = pa.array(np.concatenate(lists), kind)
        else:
            values = pa.array([x for some in lists for x in some], kind)
        arrays.append(pa.ListArray.from_arrays(pa.array(offsets), values))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def read_back(packs: DataFrame, tokens=CodePoints) -> DataFrame:
    """Conversations as the attention intervals of their last turns show them.

    ``turns`` holds role and text of every turn, each followed by a line break; ``loss`` the text
    under the loss mask, unescaped. Positions that do not run on are an error.
    """
    ship(packs.sparkSession)
    kind = dict(packs.dtypes)["conv_ids"].removeprefix("array<").removesuffix(">")
    schema = f"conv_id {kind}, n_turns long, turns binary, loss_chars long, loss binary, formatted_chars long"
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]

    def run(batches):
        for batch in batches:
            of_id = batch.schema.field("conv_ids").type.value_type
            done, held = [], 0
            for i in range(batch.num_rows):
                for row in _read(batch, i, tokens):
                    done.append(row)
                    held += len(row[2]) + len(row[4])
                    if held >= STEP_BYTES:
                        yield _columns(done, names, [of_id, *types])
                        done, held = [], 0
            if done:
                yield _columns(done, names, [of_id, *types])

    return packs.mapInArrow(run, schema)


def _columns(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _read(batch: pa.RecordBatch, i: int, tokens) -> Iterator[tuple]:
    """The conversations of one pack; the last one read serves its copies, which follow it."""
    of = lambda name: batch[name][i].values.to_numpy(zero_copy_only=False)
    ids, places, mask = of("token_ids"), of("position_ids"), of("loss_mask").astype(bool)
    starts, ends = of("interval_start"), of("interval_end")
    first = np.cumsum(np.append(0, of("node_intervals")))
    raw = lambda text: text.encode(errors="surrogateescape")
    known, found = -1, ()
    for conv, leaf in zip(batch["conv_ids"][i].as_py(), batch["leaves"][i].as_py()):
        if leaf != known:
            spans = range(first[leaf], first[leaf + 1])
            see = np.concatenate([np.arange(starts[k], ends[k]) for k in spans])
            if not np.array_equal(places[see], np.arange(len(see))):
                raise ValueError(f"positions of pack {batch['pack'][i]}, node {leaf} do not run on")
            text = tokens.decode(ids[see])
            loss = unescaped(tokens.decode(ids[see[mask[see]]]))
            turns = parsed(text)
            plain = "".join(f"{role}\n{said}\n" for role, said in turns)
            known, found = leaf, (len(turns), raw(plain), len(loss), raw(loss), len(text))
        yield conv, *found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: ``conversations`` and one more that holds control strings, formatted and read back."""
    said = r"\### Assistant: </turn> ok"
    columns = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], columns)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(format_conversations(rows))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        "loss_chars",
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
         ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text)
         FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(regexp_replace(role, '[\\#<:\n]', '..', 'g')) + 2
         + length(regexp_replace(text, '[\\#<]', '..', 'g')) + 8) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
