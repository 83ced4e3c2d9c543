"""Word-piece counts by a linear longest-match automaton.

Words (runs without white space, as ``str.split`` sees it) are split greedily into the longest pieces of a vocabulary
whose word-initial pieces start with a mark. The automaton is the trie of the pieces. Where no child
fits, a node's failure link leads to the node of what is left after the pieces decided so far are popped; only
their number is kept. One pass over the characters gives the number of pieces, and none is built. A word that
cannot be split counts as one unknown piece.

Null and blank texts have no words and no pieces. Every row is counted on its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

MARK = "▁"    # starts the pieces that begin a word
KEPT = 500_000     # words in each table of a worker
LONGEST = 64       # longer words are not kept
UNKNOWN = 1 << 40  # added to a count for each unknown word
SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"


class Automaton:
    """Nodes are numbers: ``child[node]`` maps characters, ``link`` and ``pops`` are what follows a mismatch."""

    def __init__(self, pieces: Iterable[str], mark: str = MARK):
        self.mark = mark
        child: list[dict[str, int]] = [{}]
        whole: set[int] = set()
        for piece in pieces:
            at = 0
            for c in piece:
                if c not in child[at]:
                    child[at][c] = len(child)
                    child.append({})
                at = child[at][c]
            if at:
                whole.add(at)
        link: list[int | None] = [None] * len(child)
        pops = [0] * len(child)
        level = [0]
        while level:
            below = []
            for parent in level:
                for c, node in child[parent].items():
                    below.append(node)
                    if node in whole:
                        link[node], pops[node] = 0, 1
                        continue
                    at, popped = link[parent], pops[parent]
                    while at is not None and c not in child[at]:
                        popped += pops[at]
                        at = link[at]
                    if at is not None:
                        link[node], pops[node] = child[at][c], popped
            level = below
        self.child, self.link, self.pops = child, link, pops

    def count(self, word: str) -> int | None:
        """The number of pieces of a word, None if it has no split."""
        child, link, pops, at, total = self.child, self.link, self.pops, 0, 0
        for c in self.mark + word:
            while c not in child[at]:
                total += pops[at]
                at = link[at]
                if at is None:
                    return None
            at = child[at][c]
        while at:
            total += pops[at]
            at = link[at]
            if at is None:
                return None
        return total


class Counter:
    """Counts of words, kept in two tables of bounded size so that frequent words stay."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.new, self.old = automaton, {}, {}

    def of(self, words: list[str]) -> int:
        """Pieces of all words, and UNKNOWN for each that has no split."""
        if len(self.new) > KEPT:
            self.new, self.old = {}, self.new
        new, total = self.new, 0
        for w in words:
            n = new.get(w)
            if n is None:
                n = self.old.get(w)
                if n is None:
                    n = self.automaton.count(w)
                    n = UNKNOWN + 1 if n is None else n
                if len(w) <= LONGEST:
                    new[w] = n
            total += n
        return total


def pieces_of(path: str) -> list[str]:
    model = SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


@cache
def _counter(path: str) -> Counter:
    return Counter(Automaton(pieces_of(path)))


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter = _counter(path)
    for batch in batches:
        n_words, n_tokens, n_unknown = [], [], []
        for text in batch.column("text"):
            words = (text.as_py() or "").split()
            unknown, pieces = divmod(counter.of(words), UNKNOWN)
            n_words.append(len(words))
            n_tokens.append(pieces)
            n_unknown.append(unknown)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown))],
            ["doc_id", "n_words", "n_tokens", "n_unknown"])


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens (unknown words count one each) and n_unknown of each row; no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_count, path=path), SCHEMA)
