"""Secrets in texts: fixed patterns, and strings that a tokenizer spells expensively.

Random strings have few characters for each token of a vocabulary learned from
written language.  Known digests and identifiers are as expensive but no secrets,
and are excluded first.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.llm.texts import add_columns, column

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ASSIGN_LENGTH = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "dense")

# A run of such characters can hold an access key, a long hex string or a candidate.
RUN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
CHARS_PER_TOKEN = 2.1
# Lengths in hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
KNOWN = re.compile(
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # a UUID
    r"|[0-9_+/=-]+"  # numbers, dates, rules of dashes
)
# Strings of such a form are identifiers if their parts are likely words.
NAMED = re.compile(
    r"[A-Za-z]?[a-z]+([A-Z][a-z]+)*\d{0,4}"  # words, camelCase
    r"|[A-Z]+\d{0,4}"
    r"|([A-Za-z]{2,}|\d+)([_/+=-]+([A-Za-z]{2,}\d{0,4}|\d+))*[_/+=-]*"  # snake_case, kebab-case, paths
)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]")
HEXADECIMAL = re.compile(r"[0-9a-fA-F]+")
SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def known(candidate: str, tokens: Callable[[str], int], ratio: float = CHARS_PER_TOKEN) -> bool:
    """Whether a string is a digest or an identifier.

    An identifier has the form of one, and its words have ``ratio`` characters a
    token or more.  ``tokens`` counts a string's tokens; a word in capitals is also
    tried in small letters, as vocabularies know few capitalised words.
    """
    if HEXADECIMAL.fullmatch(candidate) and len(candidate) in DIGESTS:
        return True
    if KNOWN.fullmatch(candidate):
        return True
    if not NAMED.fullmatch(candidate):
        return False
    words = WORD.findall(candidate)
    return sum(map(len, words)) >= ratio * sum(min(tokens(w), tokens(w.lower())) for w in words)


def base_spans(text: str, runs: list[re.Match]) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns; ``runs`` are those of ``RUN`` in the text."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    for run in runs:
        if "AKIA" in run[0]:
            found += [("access", *m.span()) for m in ACCESS.finditer(text, *run.span()) if m.end() - m.start() >= ACCESS_LENGTH]
        found += [("hex", *m.span()) for m in HEX.finditer(text, *run.span())]
    return found


def vocabulary(ranks: str, pattern: str):
    """A tiktoken encoding from a file of ranks."""
    import base64

    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def merged(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, in order."""
    starts, ends = [], []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """The text with each stretch of overlapping spans replaced by ``mark``."""
    starts, ends = merged(spans)
    return mark.join(text[e:s] for s, e in zip([*starts, len(text)], [0, *ends]))


def find(df: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "secrets", ratio: float = CHARS_PER_TOKEN, clean: str | None = None) -> DataFrame:
    """``df`` with the spans (kind, start, end in code points) of each whole text.

    Kinds are assignments, access keys, long hex strings, and ``dense``: other runs
    of 16 and more characters with under ``ratio`` characters a token.  Spans of
    one kind do not overlap; a dense one overlaps none.  They are in order of start,
    then kind.  A null or empty text has none.  ``clean`` names a further column for
    the text in which ``[secret]`` stands for each stretch of spans (null if it is null).
    """

    def make():
        encoding = vocabulary(ranks, pattern)
        tokens = lambda t: len(encoding.encode_ordinary(t))

        def spans(value: str):
            runs = list(RUN.finditer(value))
            found = base_spans(value, runs)
            starts, ends = merged(found)
            dense = []
            for run in runs:
                for m in CANDIDATE.finditer(value, *run.span()):
                    s, e = m.span()
                    # The last stretch that begins before the candidate's end.
                    before = bisect_left(starts, e) - 1
                    if before >= 0 and ends[before] > s or e - s >= ratio * tokens(m[0]):
                        continue
                    if not known(m[0].rstrip("="), tokens, ratio):
                        dense.append(("dense", s, e))
            return sorted(found + dense, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))

        def work(part):
            values = column(part, text).to_pylist()
            found = [spans(v) if v else [] for v in values]
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in own] for own in found]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            columns = [pa.array(rows, kind)]
            if clean:
                columns.append(pa.array([redact(v, own) if own else v for v, own in zip(values, found)], pa.string()))
            return columns

        return work

    fields = [T.StructField(out, SPANS)]
    if clean:
        fields.append(T.StructField(clean, T.StringType()))
    return add_columns(df, text, fields, make)


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
