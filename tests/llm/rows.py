"""Documents with every odd case, and the columns whose names operators use themselves."""

from pyspark.sql import functions as F, types as T

LONG = "the quick brown fox jumps over the lazy dog again and again " * 4000
TEXTS = [
    None, "", " ", "a", "The quick brown fox jumps over the lazy dog.", "The quick brown fox jumps over the lazy dog.",
    "le chat  noir\n dort sur le tapis ", "▁odd▁marks ▁", "ünïcödé 漢字 кириллица \x00\t", "12 345 !!", LONG, LONG + "the end", "x" * 50_000,
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
OWN = (
    "ids", "decoded", "lang_pred", "score", "n_words", "n_tokens", "n_unknown", "secrets", "leaks", "set", "tokens", "copies", "root", "size",
    "key", "shard", "slot", "place", "first", "spans", "vid", "v", "pair", "node", "best", "n", "url", "at", "listed", "entry", "n_active", "kept", "_kept",
)


def odd_documents(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "no id at all here", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def with_clashes(df, *keep):
    """``df`` with further columns of the names that operators use, but for ``keep``."""
    return df.withColumns({c: F.lit("clash") for c in OWN if c not in keep and c not in df.columns})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
