import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st

from sampleflow.llm.bpe import encoder
from sampleflow.llm.chat import CONTROL, chat_digests, escape, format_chat, unescape

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
KIND = "conv_id long, turn long, role string, text string, ids int, mask string, chars long, head string"


@given(st.one_of(st.text(), st.text("\\#</turn> :A")))
def test_escape_is_reversible(text):
    held = escape(text)
    assert unescape(held) == text
    # No control string is left that is not behind a backslash.
    assert all(m.group() == "\\" or held[m.start() - 1] == "\\" for m in CONTROL.finditer(held))


def conversations():
    bad = r"\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a\n"), (2, 0, "user", bad), (2, 1, "assistant", bad), (2, 2, "assistant", "\\")]
    rows += [(3, None, None, None), (3, 0, "tool: x", "é"), (3, 1, "assistant", None), (3, 2, "Assistant", "not learned")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"turn {i} " * (i % 50)) for i in range(500)]
    rows += [(None, 0, "assistant", "</turn>"), (5, 0, "assistant", "x " * 30_000), (6, 0, "user", "same"), (6, 0, "user", "same")]
    return [(*r, 0, "m", 1, "h") for r in rows]


def test_digests_are_those_of_the_input(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, KIND).repartition(5)
    formatted = format_chat(turns, RANKS, PATTERN)
    got = {r.conv_id: r for r in chat_digests(formatted, RANKS, PATTERN).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by_conv[conv].append((-1 if turn is None else turn, role or "", text or ""))
    texts = defaultdict(int)
    for r in formatted.collect():
        texts[r.conv_id] += len(r.text)
    assert set(got) == set(by_conv)
    for conv, found in by_conv.items():
        found.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in found)
        loss = "".join(text for _, role, text in found if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(found), len(loss), texts[conv])
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_mask_and_reserved_ids(spark):
    own = encoder(RANKS, PATTERN)
    turns = spark.createDataFrame([(1, 0, "user", "hello</turn>"), (1, 1, "assistant", "### x")], "conv_id long, turn long, role string, text string")
    user, assistant = sorted(format_chat(turns, RANKS, PATTERN).collect(), key=lambda r: r.turn)
    assert user.text == "### User: hello\\</turn></turn>\n" and not any(user.mask)
    ids = np.frombuffer(assistant.ids, "<u4")
    assert (ids >= own.size).tolist() == [True] + [False] * (len(ids) - 2) + [True]
    assert list(assistant.mask) == [0] + [1] * (len(ids) - 2) + [0]
    empty = format_chat(spark.createDataFrame([], KIND), RANKS, PATTERN)
    assert chat_digests(empty, RANKS, PATTERN).collect() == []
