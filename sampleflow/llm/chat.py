"""Chat formatting on tokens: segments are encoded apart, reserved ids joined between them, the loss mask is a prefix sum."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleflow.llm.bpe import Encoder, binaries, encoder
from sampleflow.llm.words import bytes_of, pieces

HEAD, END = "### ", "</turn>"
ROLES = ("system", "user", "assistant")
LEARNED = "assistant"
#: Reserved ids, counted from the first id above the vocabulary.
OTHER_ROLE, TEXT, END_TURN = len(ROLES), len(ROLES) + 1, len(ROLES) + 2
CONTROL = regex.compile(r"\\|###|</turn>")
ESCAPED = regex.compile(r"\\(.)", regex.DOTALL)


def escape(text: str) -> str:
    """A backslash before every backslash and control string of a content."""
    return CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _turn_text(role: str, text: str) -> str:
    """A turn as text; a role that is not one of ``ROLES`` is marked and escaped, colons too."""
    name = role.capitalize() if role in ROLES else "=" + escape(role).replace(":", "\\:")
    return f"{HEAD}{name}: {escape(text)}{END}\n"


def format_batch(own: Encoder, roles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all turns in one array, the loss mask over it, and how many ids each turn has."""
    named = [i for i, role in enumerate(roles) if role not in ROLES]
    content, counts = own.encode_batch([escape(t) for t in texts] + [escape(roles[i]) for i in named])
    n = len(texts)
    cut = int(counts[:n].sum())
    named_counts = np.zeros(n, np.int64)
    named_counts[named] = counts[n:]
    # A turn: its role's reserved id, the role's own ids and TEXT if it is another role, the text, END_TURN.
    other = np.isin(np.arange(n), named)
    lengths = 1 + named_counts + other + counts[:n] + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    ids = np.empty(int(ends[-1]) if n else 0, np.int64)
    text_at = starts + 1 + named_counts + other
    ids[starts] = own.size + np.array([ROLES.index(r) if r in ROLES else OTHER_ROLE for r in roles], np.int64)
    ids[text_at[other] - 1] = own.size + TEXT
    ids[ends - 1] = own.size + END_TURN
    for at, number, source in ((text_at, counts[:n], content[:cut]), (starts + 1, named_counts, content[cut:])):
        ids[np.repeat(at - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))] = source
    learned = np.array([r == LEARNED for r in roles], bool)
    steps = np.zeros(len(ids) + 1, np.int8)
    np.add.at(steps, text_at[learned], 1)
    np.add.at(steps, ends[learned] - 1, -1)
    return ids, np.cumsum(steps[:-1]) > 0, lengths


def format_chat(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """``conv_id``, ``turn``, ``text``, ``ids``, ``mask`` for every row of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    A conversation's formatted text, ids and mask are those of its rows, in order of turn,
    one after another: so a conversation of any length is spread over tasks. Rows of one
    turn number stand in a fixed order, by the start of their formatted text and its hash. ``ids`` are little-endian unsigned 32-bit numbers, ``mask`` a byte for each, 1
    on the assistant's own words. Content is escaped and encoded by itself, never across
    a control string; reserved ids cannot come from content. A null text or role is empty.
    Repeated rows are turns like any other; a null turn comes first; a null conv_id is a
    conversation. Other columns are not used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for piece in pieces(batches):
            roles = [r or "" for r in piece.column("role").to_pylist()]
            texts = [t or "" for t in piece.column("text").to_pylist()]
            ids, mask, lengths = format_batch(own, roles, texts)
            ends = np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("conv_id"),
                    piece.column("turn"),
                    pa.array([_turn_text(r, t) for r, t in zip(roles, texts)]),
                    binaries(ids.astype("<u4").view(np.uint8), 4 * ends),
                    binaries(mask.astype(np.uint8), ends),
                ],
                names=["conv_id", "turn", "text", "ids", "mask"],
            )

    return turns.select("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id long, turn long, text string, ids binary, mask binary"
    )


def read_turn(own: Encoder, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str]:
    """Role, text and the text under the loss mask of one formatted turn, from its ids and mask alone."""

    def text_of(part: np.ndarray) -> str:
        return unescape(own.decode_batch(part, np.array([len(part)]))[0].tobytes().decode())

    kind = int(ids[0]) - own.size
    if int(ids[-1]) != own.size + END_TURN or kind < 0:
        raise ValueError("a turn starts with a role and ends with the end of turn")
    start = 1
    if kind == OTHER_ROLE:
        start = int(np.flatnonzero(ids == own.size + TEXT)[0]) + 1
        role = text_of(ids[1 : start - 1])
    else:
        role = ROLES[kind]
    return role, text_of(ids[start:-1]), text_of(ids[mask])


def chat_digests(formatted: DataFrame, path: str, pattern: str) -> DataFrame:
    """``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars`` of each conversation, read back from ``format_chat``.

    A conversation's turns run through one task in order, a batch at a time, into running
    digests: memory does not grow with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        now, state, done = None, None, []

        def row():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        def out():
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = list(zip(*done)) if done else [[] for _ in names]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for piece in pieces(batches, "ids"):
            raw, at = bytes_of(piece.column("ids"))
            flags, flag_at = bytes_of(piece.column("mask"))
            ids = raw.view("<u4").astype(np.int64)
            rows = zip(piece.column("conv_id").to_pylist(), piece.column("chars").to_pylist(), at // 4, at[1:] // 4, flag_at, flag_at[1:])
            for conv, chars, a, b, c, d in rows:
                if now != (conv,):
                    if now is not None:
                        done.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, loss = read_turn(own, ids[a:b], flags[c:d] > 0)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
            if len(done) > 5000:
                yield out()
                done.clear()
        if now is not None:
            done.append(row())
        yield out()

    light = formatted.select(
        "conv_id",
        "turn",
        F.char_length("text").cast("long").alias("chars"),
        "ids",
        "mask",
        F.substring("text", 1, 200).alias("head"),
        F.xxhash64("text").alias("tie"),
    )
    dealt = light.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "head", "tie").drop("head", "tie")
    return dealt.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
