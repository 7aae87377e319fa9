"""Token counts by a linear longest-match automaton (operator 1).

Greedy word pieces of a word are counted without building them. The vocabulary's
byte strings form a trie. For every node, ``fail`` is the node that holds what is
left of its string after the greedy pieces that fit are popped, and ``pops`` counts
those pieces; both are computed once, in breadth-first order. A word is then read
byte by byte: on a missing edge the precomputed count is added and reading goes on
at the failure node, so the time is linear in the word's length.

A word (a maximal run without white space) is matched with a space before it, as
byte-level vocabularies mark word starts. Bytes that the vocabulary lacks count one
piece each. The vocabulary file's path is a parameter; the automaton, of the
vocabulary's size, is built on the driver and broadcast. Counts of words already seen
are kept in a dictionary of at most ``MEMO_WORDS`` entries a worker.

Defined cases: null or empty text: no words, no tokens. Null ids are kept. Every
row has a row in the result, repeated rows one each. Texts are read whole, a few
megabytes at a time; a word of any length is one word. Ties cannot occur: of the pieces
that fit, the longest is one. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tokens import text_bytes

MEMO_WORDS = 200_000
MEMO_BYTES = 64
ROOT = 0


def read_ranks(path: str) -> list[bytes]:
    """Byte strings of a vocabulary file with one base64 piece and its rank a line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    def __init__(self, edge: dict[int, int], fail: list[int], pops: list[int]):
        self.edge, self.fail, self.pops = edge, fail, pops  # edge: node << 8 | byte -> node

    @classmethod
    def of(cls, vocabulary: Iterable[bytes]) -> Automaton:
        self = cls({}, [], [])
        pieces = {p for p in vocabulary if p} | {bytes([b]) for b in range(256)}
        ends = set()
        for piece in pieces:
            at = ROOT
            for byte in piece:
                at = self.edge.setdefault(at << 8 | byte, len(self.edge) + 1)
            ends.add(at)
        children: list[list[tuple[int, int]]] = [[] for _ in range(len(self.edge) + 1)]
        for key, node in self.edge.items():
            children[key >> 8].append((key & 255, node))
        self.fail, self.pops = [ROOT] * len(children), [0] * len(children)
        queue = deque([ROOT])
        while queue:
            parent = queue.popleft()
            for byte, node in children[parent]:
                if node in ends:
                    self.pops[node] = 1
                else:
                    self.fail[node], self.pops[node] = self._step(self.fail[parent], byte, self.pops[parent])
                queue.append(node)
        return self

    def _step(self, at: int, byte: int, count: int) -> tuple[int, int]:
        edge = self.edge
        while (to := edge.get(at << 8 | byte)) is None:
            count += self.pops[at]
            at = self.fail[at]
        return to, count

    def count(self, data: bytes) -> int:
        """Number of greedy longest-match pieces of a byte string."""
        at, count = ROOT, 0
        for byte in data:
            at, count = self._step(at, byte, count)
        while at != ROOT:
            count += self.pops[at]
            at = self.fail[at]
        return count


class Counts(dict):
    """Pieces by word, computed when first asked for."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = n
        return n


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens`` per row of ``docs``."""
    automaton = Automaton.of(read_ranks(vocabulary_path))
    shared = docs.sparkSession.sparkContext.broadcast((automaton.edge, automaton.fail, automaton.pops))

    def run(batches):
        counts = Counts(Automaton(*shared.value))
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            words, tokens = [], []
            for a, b in zip(offsets, offsets[1:]):
                own = data[a:b].tobytes().split()
                words.append(len(own))
                tokens.append(sum(map(counts.__getitem__, own)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             ["doc_id", "n_words", "n_tokens"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
