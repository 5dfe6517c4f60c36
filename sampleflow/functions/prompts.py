"""Column expressions that build and undo prompts."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleflow.functions.text import input_text

# Chat markers around a user turn, and the opening of a thinking block.
USER_START = "<|im_start|>user\n"
USER_END = "<|im_end|>\n<|im_start|>assistant\n"
THINK_START = "<think>\n\n"


def build_prompt(
    text: Column | str, template: str | None = None, system: str | None = None
) -> Column:
    """Put the text into ``{text}`` of a template, after an optional system prompt.

    Without a template the text is returned as it is, and the system prompt is
    not used.  Doubled braces stand for one brace.
    """
    text = F.col(text) if isinstance(text, str) else text
    if not template:
        return text
    parts = [F.lit(f"{system}\n\n")] if system else []
    for literal, field, spec, conversion in Formatter().parse(template):
        parts.append(F.lit(literal))
        if field is None:
            continue
        if field != "text" or spec or conversion:
            raise ValueError(f"a prompt template may only refer to {{text}}, not {field!r}")
        parts.append(input_text(text))
    return F.concat(*parts)


def chat_wrap(
    text: Column | str,
    prefix: str | None = USER_START,
    suffix: str = USER_END,
    opening: str = THINK_START,
) -> Column:
    """One user turn in chat form, ready for the answer; no prefix means no template."""
    text = F.col(text) if isinstance(text, str) else text
    if prefix is None:
        return text
    return F.concat(F.lit(prefix), text, F.lit(suffix + opening))


def think_start(text: Column | str) -> Column:
    """A text followed by the opening of a thinking block."""
    text = F.col(text) if isinstance(text, str) else text
    return F.concat(text, F.lit(THINK_START))


def chat_unwrap(text: Column | str, prefix: str = USER_START, suffix: str = USER_END) -> Column:
    """The user text of a chat prompt: after the last prefix, before the first suffix."""
    text = F.col(text) if isinstance(text, str) else text
    return F.substring_index(F.substring_index(text, prefix, -1), suffix, 1)
