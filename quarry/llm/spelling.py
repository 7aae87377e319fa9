"""Spelling variants by a frequency-vector trie (operator 12).

Two words are near if one inserted, deleted or replaced code point makes one of the other.
A word's variant form is its near word that occurs most, if that occurs ``min_ratio`` times
as often or more; forms followed to the last give the root.

A word's frequency vector counts its letters in ``GROUPS`` groups (code point modulo
``GROUPS``; the groups in order of falling variance over all words). The trie's levels are
the word's length, then the count of each group in turn; a leaf holds the words of equal
vectors. An edit adds one to a count (a surplus), takes one away (a deficit), or both.
Each pair is looked for once: by the shorter word, with a surplus of one and no deficit to
spend; or, at equal lengths, with one of each, the first difference being the surplus (by
the smaller word, in its own leaf).

1. *Subtrees.* The trie's top is cut into subtrees by ``DEPTHS``: a subtree of more than
   ``limit`` words is cut again further down. The last cut is by half of a word: one edit
   leaves either the first or the last half as it is, so a leaf of many words is dealt out
   by its words' halves. A word is stored in one subtree (in a leaf that is dealt out, in
   four parts of it) and looked up in each that its budget reaches and that has words.
2. *Search.* Rows are dealt by subtree, sorted, stored words first, and streamed. A task
   builds one subtree at a time, of ``limit`` words at most (but for words that share length,
   vector and a half), and goes through it depth first with a block of the words to look up;
   in leaves, and where few words are left, each remaining pair's edit is verified.
3. *Forms.* Pairs are summed per word (partial aggregates, so a word near to very many is
   no hot group), and roots are found by pointer doubling, as written tables.

Words are counted before anything is dealt out by word, so a frequent word is one row a task.

Defined cases: null text: no words. Null id: an empty string in the digest. Repeated rows
count again. Ties of the largest count: the smallest word by code points. Empty table:
empty result. Very long runs are words like others. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import materialize, remove
from quarry.operators.joins import broadcast_if_bounded

RUN = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GROUPS = 16
DEPTHS = (3, 6, 10, GROUPS)
LIMIT = 4096             # words of a subtree
BLOCK = 4096             # words looked up at a time
PAIRS = 1 << 14          # pairs that are tried without going further down
CELLS = 1 << 21          # code points compared at a time
_ROW = "key binary, looked_up boolean, word string, n long"
_ARROW = pa.schema([("key", pa.binary()), ("looked_up", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 6, min_count: int = 5,
                drop_every: int | None = None) -> DataFrame:
    """``word, n`` of the letter runs of all texts, ``A``-``Z`` lower-cased.

    With ``drop_every`` a run whose crc32 with its text's id is a multiple loses one code point.
    """
    lower = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    word = F.col("run")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    if drop_every:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % drop_every == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(word)
    return (runs.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)


def _vectors(words: list[str], order: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and counts of the letter groups in the trie's order."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), size)
    counts = np.bincount(owner * GROUPS + _codes(words) % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return size, counts[:, order]


def _variances(words: DataFrame) -> list[int]:
    """The groups' numbers by falling variance over all words."""
    def sums(batches):
        total = np.zeros((3, GROUPS))
        for batch in batches:
            _, v = _vectors(batch.column(0).to_pylist(), list(range(GROUPS)))
            total += [np.full(GROUPS, len(v)), v.sum(0), (v.astype(float) ** 2).sum(0)]
        yield pa.RecordBatch.from_arrays([pa.array(range(GROUPS)), *map(pa.array, total)], ["g", "c", "s", "q"])

    rows = (words.select("word").mapInArrow(sums, "g long, c double, s double, q double").groupBy("g")
            .agg(F.sum("c").alias("c"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect())
    return [r.g for r in sorted(rows, key=lambda r: (-(r.q / (r.c or 1) - (r.s / (r.c or 1)) ** 2), r.g))]


def _key(numbers: np.ndarray) -> pa.Array:
    """Rows of numbers as binary keys."""
    flat = np.ascontiguousarray(numbers, np.int32)
    width = 4 * flat.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _numbers(keys: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(keys.to_pylist()), np.int32).reshape(-1, width)


def _steps(width: int) -> list[np.ndarray]:
    """Differences that a budget of one surplus and one deficit allows over some levels."""
    one = np.eye(width, dtype=np.int64)
    return [np.zeros(width, np.int64), *one, *-one, *(one[i] - one[k] for i in range(width) for k in range(width) if i != k)]


def _budget(size: np.ndarray, own: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Surplus and deficit left after a prefix ``target`` (length, counts), and whether there was a difference."""
    difference = target[:, 1:] - own[:, :target.shape[1] - 1]
    up, down = difference.clip(0).sum(1), (-difference).clip(0).sum(1)
    return 1 - up, 1 - (target[:, 0] - size) - down, up + down == 0


def _descend(order: list[int], start: int, end: int):
    """From states ``(key, looked_up, word, n)`` at depth ``start`` to those at depth ``end``."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not len(batch):
                continue
            words = batch.column("word").to_pylist()
            size, own = _vectors(words, order)
            target = _numbers(batch.column("key"), start + 1).astype(np.int64)
            look = np.array(batch.column("looked_up").to_pylist())
            surplus, deficit, same = _budget(size, own, target)
            undecided = same & (target[:, 0] == size)
            for step in _steps(end - start):
                up, down = int(step.clip(0).sum()), int((-step).clip(0).sum())
                ok = look & (surplus >= up) & (deficit >= down) if up + down else look | ~look
                if down and not (up and step.argmax() < step.argmin()):
                    ok &= ~undecided  # the first difference is a surplus
                new = own[:, start:end] + step
                ok &= (new >= 0).all(1)
                if end == GROUPS:  # at the leaf the counts add up to the length
                    ok &= ~look | (target[:, 1:].sum(1) + new.sum(1) == target[:, 0])
                at = np.flatnonzero(ok)
                if len(at):
                    keys = _key(np.concatenate([target[at], new[at]], 1))
                    yield pa.RecordBatch.from_arrays([keys, *(batch.column(c).take(pa.array(at)) for c in ("looked_up", "word", "n"))], schema=_ARROW)
    return run


def _halves(batches: Iterator[pa.RecordBatch]):
    """States of leaves dealt out by the halves of the shorter word of a pair; the key gets which half, and whether one is inserted."""
    for batch in batches:
        target = _numbers(batch.column("key"), GROUPS + 1)
        rows = []
        for key, length, look, word, n in zip(batch.column("key").to_pylist(), target[:, 0], *(batch.column(c).to_pylist() for c in ("looked_up", "word", "n"))):
            for inserted in ([int(length) - len(word)] if look else [0, 1]):
                short = int(length) - inserted
                for last, half in enumerate((word[:short // 2], word[len(word) - (short - short // 2):])):
                    rows.append((key + bytes([0, inserted, 0, last]) + half.encode("utf-8", "surrogatepass"), look, word, n))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one replaced, or one inserted, code point."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(1) == 1
    first = np.logical_and.accumulate(short == long[:, :-1], 1).sum(1)
    last = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], 1).sum(1)
    return first + last >= short.shape[1]


class Subtree:
    """The part of the trie below one key, and its search."""

    def __init__(self, key: bytes, words: list[str], counts: list[int], order: list[int]):
        self.order = order
        self.half = key[4 * (GROUPS + 1) + 3] if len(key) > 4 * (GROUPS + 1) else None
        self.prefix = np.frombuffer(key[:4 * (GROUPS + 1)], np.int32).astype(np.int64)
        self.depth = len(self.prefix) - 1
        self.length = int(self.prefix[0])
        _, vectors = _vectors(words, order)
        vectors = vectors[:, self.depth:]
        by = np.lexsort(vectors.T[::-1]) if vectors.shape[1] else np.arange(len(words))
        self.vectors = vectors[by]
        self.words, self.counts = [words[i] for i in by], [counts[i] for i in by]
        self.codes = _codes(self.words).reshape(-1, self.length)

    def search(self, words: list[str], counts: list[int]) -> Iterator[tuple]:
        """``(word, n, near word, n)`` of each pair, ``words`` all being as long as or one shorter than the subtree's."""
        for size in (self.length - 1, self.length):
            some = [i for i, w in enumerate(words) if len(w) == size]
            if some:
                own = [words[i] for i in some]
                lengths, vectors = _vectors(own, self.order)
                surplus, deficit, same = _budget(lengths, vectors, np.broadcast_to(self.prefix, (len(own), len(self.prefix))))
                self.found: list[tuple[np.ndarray, np.ndarray]] = []
                codes = _codes(own).reshape(len(own), size)
                undecided = same & (size == self.length)
                self._visit(0, 0, len(self.words), vectors[:, self.depth:], codes, np.arange(len(own)), surplus, deficit, undecided)
                for left, right in self.found:
                    for i, k in zip(left.tolist(), right.tolist()):
                        a, b = own[i], self.words[k]
                        # equal vectors: the smaller word finds the pair; two equal halves: the first finds it
                        if (size < self.length or a < b or not (vectors[i, self.depth:] == self.vectors[k]).all() or not same[i]) \
                                and not (self.half and a[:size // 2] == b[:size // 2]):
                            yield a, counts[some[i]], b, self.counts[k]

    def _visit(self, level, lo, hi, vectors, codes, q, surplus, deficit, undecided) -> None:
        """Words ``q``, with what is left of their budgets, at the node of the stored words ``lo:hi``."""
        if not len(q):
            return
        if level == self.vectors.shape[1] or (hi - lo) * len(q) <= PAIRS:
            self._leaf(level, lo, hi, vectors, codes, q, surplus, deficit, undecided)
            return
        column = self.vectors[lo:hi, level]
        edges = np.flatnonzero(np.diff(column)) + 1
        for a, b in zip([0, *edges], [*edges, hi - lo]):
            step = column[a] - vectors[q, level]
            ok = (step == 0) | ((step == 1) & (surplus > 0)) | ((step == -1) & (deficit > 0) & ~undecided)
            step = step[ok]
            self._visit(level + 1, lo + int(a), lo + int(b), vectors, codes, q[ok], surplus[ok] - (step == 1), deficit[ok] - (step == -1),
                        undecided[ok] & (step == 0))

    def _leaf(self, level, lo, hi, vectors, codes, q, surplus, deficit, undecided) -> None:
        """Verify all pairs of ``q`` and ``lo:hi`` that the rest of their vectors allows."""
        block = max(1, CELLS // (max(self.length, GROUPS) * (hi - lo)))
        for at in range(0, len(q), block):
            part = slice(at, at + block)
            step = self.vectors[None, lo:hi, level:] - vectors[q[part], None, level:]
            ok = (step.clip(0).sum(2) <= surplus[part, None]) & ((-step).clip(0).sum(2) <= deficit[part, None])
            differs = step != 0
            first = np.take_along_axis(step, differs.argmax(2)[:, :, None], 2)[:, :, 0] if step.shape[2] else np.zeros(ok.shape)
            ok &= ~(undecided[part, None] & (first < 0))
            left, right = np.nonzero(ok)
            left, right = q[part][left], right + lo
            for k in range(0, len(left), max(1, CELLS // self.length)):
                a, b = left[k:k + max(1, CELLS // self.length)], right[k:k + max(1, CELLS // self.length)]
                near = _one_edit(codes[a], self.codes[b])
                if near.any():
                    self.found.append((a[near], b[near]))


_PAIR = pa.schema([("a", pa.string()), ("n_a", pa.int64()), ("b", pa.string()), ("n_b", pa.int64())])


def _search(order: list[int]):
    def run(batches: Iterator[pa.RecordBatch]):
        key, stored, tree, wanted = None, ([], []), None, ([], [])

        def found():
            nonlocal tree, wanted
            if wanted[0] and stored[0]:
                tree = tree or Subtree(key, *stored, order)
                rows = list(tree.search(*wanted))
                for k in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k:k + 10_000]), _PAIR)], schema=_PAIR)
            wanted = ([], [])

        for batch in batches:
            for new, look, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "looked_up", "word", "n"))):
                if new != key:
                    yield from found()
                    key, stored, tree = new, ([], []), None
                into = wanted if look else stored
                into[0].append(word)
                into[1].append(n)
                if len(wanted[0]) >= BLOCK:
                    yield from found()
        yield from found()
    return run


def near_pairs(words: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """``a, n_a, b, n_b``: each pair of near words once, from a written table of distinct ``word, n``."""
    order = _variances(words)
    length = F.length("word")

    def at_length(batches):
        for batch in batches:
            size = np.array(batch.column("size").to_pylist(), np.int64).reshape(-1, 1)
            yield pa.RecordBatch.from_arrays([_key(size), *(batch.column(c) for c in ("looked_up", "word", "n"))], schema=_ARROW)

    states = (words.select(F.inline(F.array(*[F.struct((length + more).alias("size"), F.lit(look).alias("looked_up"), F.col("word"), F.col("n"))
                                              for more, look in ((0, False), (0, True), (1, True))])))
              .mapInArrow(at_length, _ROW))
    ready, depth = [], 0
    for end in (*DEPTHS, None):
        if end is None:
            states = states.mapInArrow(_halves, _ROW)
        else:
            states = states.mapInArrow(_descend(order, depth, end), _ROW)
        states, depth = materialize(states, "states"), end
        sizes = states.where("not looked_up").groupBy("key").agg(F.count(F.lit(1)).alias("stored"))
        sizes = materialize(sizes.withColumn("hot", (F.col("stored") > limit) & F.lit(end is not None)).select("key", "hot"), "subtrees")
        placed = states.join(broadcast_if_bounded(sizes, 20_000), "key")
        ready.append(placed.where("not hot").select(*_ARROW.names))
        if end is None or sizes.where("hot").isEmpty():
            break
        states = placed.where("hot").select(*_ARROW.names)
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.union(more)
    return (rows.repartition("key").sortWithinPartitions("key", "looked_up")
            .mapInArrow(_search(order), "a string, n_a long, b string, n_b long"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words of ``forms`` (``word, form``), by pointer doubling."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        over = links.select(F.col("word").alias("root"), F.col("root").alias("over"))
        moved = materialize(links.join(over, "root", "left")
                            .select("word", F.coalesce("over", "root").alias("root"), F.col("over").isNotNull().alias("moved")), "links")
        remove(links)
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 6, min_count: int = 5,
                      min_ratio: int = 5, drop_every: int | None = None, limit: int = LIMIT) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word that occurs ``min_count`` times or more."""
    words = materialize(count_words(docs, id_col, text_col, min_length=min_length, min_count=min_count, drop_every=drop_every), "words")
    pairs = near_pairs(words, limit=limit)
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= min_ratio * F.col("n")
    found = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
