"""Rows as ``(key, value)`` messages of a broker, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from strataloom.functions.formats import JSON_TIMES

CORRUPT = "_corrupt"


def encode_messages(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """``key`` and ``value`` as JSON text, ready for a broker's sink."""
    return df.select(
        F.to_json(F.struct(*key_cols), JSON_TIMES).alias("key"),
        F.to_json(F.struct(*df.columns), JSON_TIMES).alias("value"),
    )


def decode_messages(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (),
                    corrupt: bool = False) -> DataFrame:
    """The rows inside the messages, with the message columns ``keep``.

    With ``corrupt``, a column holds the text of a message that does not parse;
    its other columns are null then.
    """
    options = dict(JSON_TIMES)
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
    row = F.from_json(F.col("value").cast("string"), schema, options).alias("row")
    return df.select(*keep, row).select(*keep, "row.*")
