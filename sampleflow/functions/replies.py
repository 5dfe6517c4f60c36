"""The shape of a raw model reply and how to read its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPLY_SCHEMA = (
    "choices ARRAY<STRUCT<text STRING, thinking_text STRING, finish_reason STRING, index INT>>, "
    "usage STRUCT<prompt_tokens INT, completion_tokens INT, total_tokens INT>, "
    "model STRING, id STRING, created BIGINT, error STRING, text STRING"
)


def parse_reply(json_text: Column | str) -> Column:
    """A reply held as JSON text, as a struct."""
    return F.from_json(json_text, REPLY_SCHEMA)


def extract_reply(df: DataFrame, column: str, field: str = "text") -> Column:
    """The answer in a reply column.

    The first choice wins; a reply without choices is read at its top-level
    ``field``; a plain string is the answer itself; anything missing reads empty.
    A reply can be a struct, a variant, or a map of texts (read at ``field``).
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(column), F.lit(""))
    if isinstance(kind, T.VariantType):
        first = F.try_variant_get(column, "$.choices[0]", "variant")
        text = F.try_variant_get(first, "$.text", "string")
        top = F.try_variant_get(column, f"$.{field}", "string")
        return F.coalesce(F.when(first.isNotNull(), F.coalesce(text, F.lit(""))).otherwise(top), F.lit(""))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.valueType, T.AtomicType):
            raise TypeError(f"a map of {kind.valueType.simpleString()} is no reply; give a struct or a variant")
        return F.coalesce(F.try_element_at(F.col(column), F.lit(field)).cast("string"), F.lit(""))
    if not isinstance(kind, T.StructType):
        return F.lit("")
    names = kind.fieldNames()
    top = F.coalesce(F.col(f"{column}.{field}").cast("string"), F.lit("")) if field in names else F.lit("")
    if "choices" not in names:
        return top
    choices = F.col(f"{column}.choices")
    first = F.coalesce(F.get(choices, F.lit(0)).getField("text"), F.lit(""))
    return F.when(F.size(choices) > 0, first).otherwise(top)
