"""Landed payloads: API pages, nested documents, JSON columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from strataloom.functions.formats import JSON_TIMES


def _struct(df: DataFrame, schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return df.sparkSession.createDataFrame([], schema).schema


def flatten_pages(df: DataFrame, payload: str, schema: T.StructType | str) -> DataFrame:
    """One row per record of landed pages; each page is one JSON array of records.

    A page that does not parse gives no rows; ``rejected_pages`` has it.
    """
    page = F.from_json(payload, T.ArrayType(_struct(df, schema)), JSON_TIMES)
    return df.select(F.inline(page))


def rejected_pages(df: DataFrame, payload: str, schema: T.StructType | str) -> DataFrame:
    """The pages, with their text, of which ``flatten_pages`` gives no rows as they do not parse."""
    page = F.from_json(payload, T.ArrayType(_struct(df, schema)), JSON_TIMES)
    return df.where(F.col(payload).isNotNull() & page.isNull())


def flatten_docs(df: DataFrame, path: str, pos: str = "pos", item: str = "item", outer: bool = False) -> DataFrame:
    """One row per element of the nested array at ``path``.

    Everything else of the document is kept, beside the element's position from 0:
    the other columns, and the other fields of the structs that hold the array.
    Elements that are structs become columns; one with a taken name is called after
    ``item`` too.  ``outer`` keeps documents without elements, with nulls.
    """
    top, _, inner = path.partition(".")
    explode = F.posexplode_outer if outer else F.posexplode
    rest = []
    for f in df.schema.fields:
        if f.name != top:
            rest.append(F.col(f.name))
        elif inner and (isinstance(f.dataType, T.StructType) and (len(f.dataType.fields) > 1 or "." in inner)):
            rest.append(F.col(top).dropFields(inner).alias(top))
    rows = df.select(*rest, explode(path).alias(pos, item))
    kind = rows.schema[item].dataType
    if not isinstance(kind, T.StructType):
        return rows
    taken = {c.lower() for c in rows.columns if c != item}
    fields = [F.col(item)[f.name].alias(f"{item}_{f.name}" if f.name.lower() in taken else f.name) for f in kind.fields]
    return rows.select(*[c for c in rows.columns if c != item], *fields)


def extract_json(df: DataFrame, col: str, schema: T.StructType | str, corrupt: str | None = None) -> DataFrame:
    """Adds the fields of the JSON text in ``col`` as typed columns, in its place.

    The fields of a text that does not parse are null; ``corrupt`` names a column
    that then holds the text.
    """
    kind, options = _struct(df, schema), dict(JSON_TIMES)
    if corrupt:
        kind = T.StructType([*kind.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = df.withColumn(col, F.from_json(col, kind, options))
    return parsed.select(*[c for c in df.columns if c != col], f"{col}.*")
