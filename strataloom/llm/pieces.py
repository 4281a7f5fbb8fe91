"""Encoding with a public sentence-piece model, and decoding.

No piece of the model goes on past a white-space marker, so a text falls into
*marked words* (markers, then anything else) that are segmented independently.  A
task keeps a table of the distinct marked words it has met, segments each once and
joins the ids back by position.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from strataloom.llm.texts import add_columns, column, filled, lists

MARK = "▁"
# A task's table is emptied between parts beyond this many words or characters.
TABLE_WORDS = 150_000
TABLE_CHARS = 8_000_000
PART_BYTES = 1024 * 1024
MARKED = re.compile(" +[^ ]*")


def load(model: str):
    """The model, if its pieces and its treatment of spaces allow marked words."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    for i in range(sp.get_piece_size()):
        if MARK in sp.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a white-space marker")
    for probe in (" a  b ", "a", "  "):
        if sp.decode(sp.encode(probe)) != probe:
            raise ValueError("the model does not keep spaces as they are")
    return sp


def marked_words(text: str) -> list[str]:
    """The marked words, each without its first marker, which the model adds itself."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [m[1:] for m in MARKED.findall(" " + text)]
    return text.split(" ")


class Segmenter:
    """Segments words of many texts through one table of distinct words."""

    def __init__(self, model: str, end: bool):
        self.sp = load(model)
        self.tail = np.array([self.sp.eos_id()] if end else [], np.int32).tobytes()
        # A marker at the end of a text is a word without anything behind the marker.
        self.single = np.array(self.sp.encode("a ")[len(self.sp.encode("a")):], np.int32).tobytes()
        self.table = {"": self.single}
        self.chars = 0

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [marked_words(t) for t in texts]
        if len(self.table) > TABLE_WORDS or self.chars > TABLE_CHARS:
            self.table, self.chars = {"": self.single}, 0
        table = self.table
        fresh = list({w for ws in split for w in ws if w not in table})
        for w, ids in zip(fresh, self.sp.encode(fresh, num_threads=1)):
            table[w] = np.array(ids, np.int32).tobytes()
        self.chars += sum(map(len, fresh))
        return [b"".join(map(table.__getitem__, ws)) + self.tail for ws in split]


def encode(df: DataFrame, model: str, text: str = "text", out: str = "ids", end: bool = True, decoded: str | None = None) -> DataFrame:
    """``df`` with the ids of each whole text, as the library's ``encode`` gives them.

    ``end`` appends the end id.  A null or empty text has only that.  ``decoded`` names
    a further column for what ``decode`` makes of the ids, in the same pass.
    """

    def make():
        segment = Segmenter(model, end)

        def work(part):
            coded = segment(filled(part, text).to_pylist())
            columns = [lists(np.frombuffer(b"".join(coded), np.int32), [len(c) // 4 for c in coded], pa.int32())]
            if decoded:
                ids = [np.frombuffer(c, np.int32).tolist() for c in coded]
                columns.append(pa.array(segment.sp.decode(ids, num_threads=1), pa.string()))
            return columns

        return work

    fields = [T.StructField(out, T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))
    return add_columns(df, text, fields, make, PART_BYTES)


def decode(df: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each row's ids; null ids give the empty text."""
    kept = [f for f in df.schema.fields if f.name.lower() != out.lower()]
    names = [f.name for f in kept]

    def run(batches):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = sp.decode([x or [] for x in column(part, ids).to_pylist()], num_threads=1)
                yield pa.RecordBatch.from_arrays([column(part, n) for n in names] + [pa.array(texts, pa.string())], names=[*names, out])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.StringType())]))
