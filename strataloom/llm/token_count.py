"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie.  A node's failure link leads to where matching goes on
once the longest pieces at the front of the node's string are popped; the number
of popped pieces is stored beside the link.  So each character of a word is read
once, and no piece is built.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from strataloom.llm.texts import add_columns, filled

MARK = "▁"
# A task's table of counted words is emptied between parts beyond this size.
TABLE_WORDS = 400_000
TABLE_CHARS = 16_000_000


class LongestMatch:
    """Counts the pieces of a string that greedy longest match would take."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = self.next[node][c]
            ends[node] = True
        self.link = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = [0]
        for u in queue:
            for c, v in self.next[u].items():
                if ends[v]:
                    self.link[v], self.popped[v] = 0, 1
                else:
                    z, n = self.link[u], self.popped[u]
                    while z >= 0 and c not in self.next[z]:
                        n += self.popped[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[v], self.popped[v] = self.next[z][c], n
                queue.append(v)

    def count(self, string: str) -> int:
        """The number of pieces, or -1 if no pieces make up the string."""
        nexts, link, popped = self.next, self.link, self.popped
        node = n = 0
        for c in string:
            to = nexts[node].get(c)
            while to is None:
                if link[node] < 0:
                    return -1
                n += popped[node]
                node = link[node]
                to = nexts[node].get(c)
            node = to
        while node:
            if link[node] < 0:
                return -1
            n += popped[node]
            node = link[node]
        return n


def vocabulary(model: str) -> list[str]:
    """The written pieces of a sentence-piece model; a word's first piece has the marker."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = range(sp.get_piece_size())
    return [sp.id_to_piece(i) for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def count_tokens(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_tokens`` and ``n_unknown`` of each whole text.

    Words are what white space separates.  A word with a character that no piece
    has is one unknown token, and counts as one token.  A null or empty text has
    none.
    """

    def make():
        automaton, table, chars = LongestMatch(vocabulary(model)), {}, 0

        def work(part):
            nonlocal table, chars
            if len(table) > TABLE_WORDS or chars > TABLE_CHARS:
                table, chars = {}, 0
            split = pc.utf8_split_whitespace(filled(part, text))
            sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
            coded = split.flatten().dictionary_encode()
            counts = np.zeros(len(coded.dictionary), np.int64)
            full = np.ones(len(counts), np.int64)
            for i, word in enumerate(coded.dictionary.to_pylist()):
                if not word:
                    full[i] = 0
                    continue
                n = table.get(word)
                if n is None:
                    n = table[word] = automaton.count(MARK + word)
                    chars += len(word)
                counts[i] = n
            at = coded.indices.to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)

            def total(per_word):
                run = np.concatenate([[0], np.cumsum(per_word[at])]).astype(np.int64)
                return pa.array(run[ends] - run[ends - sizes])

            unknown = (counts < 0).astype(np.int64)
            return [total(full), total(np.where(unknown, 1, counts)), total(unknown)]

        return work

    return add_columns(df, text, [T.StructField(n, T.LongType()) for n in ("n_words", "n_tokens", "n_unknown")], make)
