"""Katz backoff language model over word pairs (operator 5).

Tokens are the words of a text, ``A``-``Z`` lower-cased, then one end token.
``P(w | h)`` is the discounted share of the pair where it was seen, and
``alpha(h) * P(w)`` otherwise (recursion to the shorter history):

* ``P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))``: a distribution over the V known
  tokens and one class for all others;
* pairs seen up to ``katz_k`` times get Good-Turing discounts from counts of counts
  (where these are not between 0 and 1, half a count is taken off); pairs seen less
  than ``min_count`` times are left to backoff altogether;
* ``alpha(h)`` is what the discounts of h leave, over the unigram mass of the words
  not seen after h, so ``P(. | h)`` sums to exactly 1. A history that no discount
  leaves anything is counted once more in its denominator.

The logarithm of a seen pair is that of ``kept(c(h, w)) / below(h)``, of another
``log P(w) + log alpha(h)``: of a pair only its count is needed, the rest belongs to
its words. So neither the model nor its pairs are ever joined as rows:

1. Texts are written in chunks of about ``CHUNK`` bytes.
2. Each chunk sends its distinct words and pairs, as 64-bit hashes, with their number
   in its training texts. They are added up by buckets of keys, which answer with one
   array of counts for each chunk, and mark each key in one of the chunks that sent it.
3. Each chunk meets its counts. Of the pairs marked in it, it sends what ``alpha`` is
   made of, by history. It sums up what it knows of its texts, and asks for histories
   of unseen pairs, or of which it sees no discounted pair (which tells that
   ``below(h)`` is ``c(h)``). A bucket of histories answers with one row for a chunk.
4. The answers of one chunk are added up.

Rows hold arrays, in key order, their bytes regrouped by position and compressed. A task
holds one chunk, or one bucket of about ``BUCKET`` tokens' keys: a chunk sends a key once,
however often it occurs.

Defined cases: null or empty text: the end token alone. Rows with a null id are
scored and may be learned from as the caller's column says. Repeated rows are scored
each. With nothing to learn from, N and V are 0 and every token is unknown. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import materialize
from quarry.llm.tokens import Words, mix, words

END, START = 1, 2  # stand for the end token, and for the history of a text's first token
HEAVY = 1 << 18
CHUNK = 6 << 20    # bytes of text to a chunk
BUCKET = 1 << 21   # tokens to a bucket of keys
PACKED = 1 << 19   # entries of the model that are packed together
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _tokens(part: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, history and token of every token of a run of texts, ends included."""
    sizes = np.diff(part.ptr) + 1
    owner = np.repeat(np.arange(part.count), sizes)
    last = np.cumsum(sizes) - 1
    token = np.full(int(sizes.sum()), END, np.uint64)
    inner = np.ones(len(token), bool)
    inner[last] = False
    token[inner] = part.hashes()
    history = np.concatenate([[np.uint64(START)], token[:-1]]) if len(token) else token
    history[last - sizes + 1] = START
    return owner, history, token


def pair_key(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(history * _PAIR + token)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _planes(x: np.ndarray) -> bytes:
    """The array's bytes, the first of every element, then the second, and so on: compressed, behind their number."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel() if raw else np.empty(0, kind)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a key by its upper half, ascending with the key."""
    return (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _slices(bucket: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, int)
    return list(zip(cut[:-1].tolist(), cut[1:].tolist()))


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [_from_planes(x.as_py(), kind) for x in column]


def _joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, kind)


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


# A chunk of texts: its number, tokens, texts that are learned from, ids, which texts are learned from, bytes of each and all bytes.
_CHUNK = ["at", "tokens", "learned", "ids", "learn", "sizes", "texts"]
_CHUNK_SQL = "at long, tokens long, learned long, ids array<long>, learn binary, sizes binary, texts binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_CHUNK`` from rows ``doc_id, text, learn``."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for part in words(batch.column("text"), CHUNK):
            ids, learn = (batch.column(c).slice(part.first, part.count) for c in ("doc_id", "learn"))
            learn = learn.to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(part.begin) + part.count]), pa.array([int(learn.sum())]),
                 pa.ListArray.from_arrays(pa.array([0, part.count], pa.int32()), pa.concat_arrays([ids])),
                 _binary([_planes(learn)]), _binary([_planes(np.diff(part.text_ptr))]), _binary([_planes(part.data)])], _CHUNK)
            number += 1


@dataclass
class Chunk:
    """Tokens of a chunk, their words and pairs as positions among its distinct ones, which ascend by key."""

    texts: int
    learn: np.ndarray    # bool, of each text
    owner: np.ndarray    # of each token its text,
    token: np.ndarray    # its word
    at: np.ndarray       # and its pair
    word: np.ndarray     # uint64, key of each word; START is one
    start: int           # where START is
    pair: np.ndarray     # uint64, key of each pair,
    h: np.ndarray        # its history's word
    w: np.ndarray        # and its own

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each word and each pair is in texts that are learned from; START once a text."""
        n = self.learn[self.owner]
        word = np.bincount(self.token, n, len(self.word)).astype(np.int64)
        word[self.start] += self.learn.sum()
        return word, np.bincount(self.at, n, len(self.pair)).astype(np.int64)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, a position of each, and which of them every element is."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    which = np.empty(len(x), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], which


def _read(rows: pa.RecordBatch | pa.Table, i: int = 0) -> Chunk:
    learn, sizes, data = (_from_planes(rows.column(c)[i].as_py(), kind) for c, kind in (("learn", bool), ("sizes", np.int64), ("texts", np.uint8)))
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    column = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data))
    owner, history, token = _tokens(next(words(column, len(data))))
    pair, place, at = _distinct(pair_key(history, token))
    first = history == START
    del history
    word, _, token = _distinct(np.append(token, np.uint64(START)))
    start, token = int(token[-1]), token[:-1]
    before = np.append(np.int32(start), token[:-1])
    before[first] = start
    return Chunk(len(sizes), learn, owner.astype(np.int32), token, at, word, start, pair, before[place], token[place])


_KEYS = ["slot", "at", "keys", "ns"]
_KEYS_SQL = "slot long, at long, keys binary, ns binary"


def _key_rows(buckets: int):
    """Rows of ``_KEYS`` from rows of ``_CHUNK``. slot: twice the bucket, and one more for pairs; keys are the steps between them."""
    def rows(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        chunk, out = _read(batch, i), []
        for kind, (key, n) in enumerate(zip((chunk.word, chunk.pair), chunk.counts())):
            bucket = bucket_of(key, buckets)
            out += [(int(bucket[a]) * 2 + kind, _planes(np.diff(key[a:b], prepend=np.uint64(0))), _planes(n[a:b])) for a, b in _slices(bucket)]
        slot, keys, ns = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array([batch.column("at")[i].as_py()] * len(out), pa.int64()),
                                           _binary(keys), _binary(ns)], _KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a chunk's arrays end with the call, before the next chunk's are made
            yield from (rows(batch, i) for i in range(len(batch)))
    return run


# Of each row of _KEYS the counts of its keys and which of them are marked there (bits). seen, in one row of a slot: how many distinct
# keys it has, what their counts add up to, and how many of them are counted once, twice and so on.
_COUNTS = ["slot", "at", "counts", "own", "seen"]
_COUNTS_SQL = "slot long, at long, counts binary, own binary, seen array<long>"


def _key_counts(most: int):
    """Rows of ``_COUNTS`` of one slot; counts of counts up to ``most``."""
    def run(rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(x, dtype=np.uint64) for x in _arrays(rows.column("keys"), np.uint64)]
        n = np.concatenate(_arrays(rows.column("ns"), np.int64))
        cuts = np.cumsum([len(x) for x in keys])[:-1]
        values, place, which = _distinct(np.concatenate(keys))
        total = np.bincount(which, n, len(values)).astype(np.int64)
        own = np.zeros(len(n), bool)
        own[place] = True
        some = total[total > 0]
        seen = [len(some), int(some.sum()), *np.bincount(np.minimum(some, most + 1), minlength=most + 2)[1:most + 1].tolist()]
        return pa.Table.from_arrays(
            [rows.column("slot"), rows.column("at"), _binary([_planes(x) for x in np.split(total[which], cuts)]),
             _binary([_planes(np.packbits(x)) for x in np.split(own, cuts)]),
             pa.array([seen] + [None] * (len(keys) - 1), pa.list_(pa.int64()))], _COUNTS)
    return run


# Rows of the histories' step. slot: twice the bucket, and one more for what comes after the model's rows. Arrays are compressed.
# Model rows hold entries of one bucket: keys, and in texts and ns what their v and base add up from. Others have at, the number of a
# chunk: one for each bucket with the histories that the chunk asks for, the count of each and its number of entries (parts), and of
# each entry twice the text, and one more for seen pairs, and its tokens (ns); and one with ids, tokens (ns) and sums of its texts.
_STREAM = pa.schema([("slot", pa.int64()), ("at", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("parts", pa.binary()),
                     ("texts", pa.binary()), ("ns", pa.binary()), ("ids", pa.list_(pa.int64())), ("sums", pa.binary())])
_STREAM_SQL = "slot long, at long, keys binary, counts binary, parts binary, texts binary, ns binary, ids array<long>, sums binary"
# What that step makes: of a chunk and a bucket the texts and what their scores gain, and the rows with ids as they came.
_PARTS = ["at", "texts", "ns", "ids", "sums"]
_PARTS_SQL = "at long, texts binary, ns binary, ids array<long>, sums binary"
_TEXT_SQL = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _batch(size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in _STREAM], schema=_STREAM)


def _entries(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, v and base of rows ``h, w, v, base`` of the model; ``w`` is null where the key is of one word."""
    h, w = (pc.fill_null(rows.column(c), 0).to_numpy(zero_copy_only=False).view(np.uint64) for c in "hw")
    pairs = pc.is_valid(rows.column("w")).to_numpy(zero_copy_only=False)
    v, base = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("v", "base"))
    return np.where(pairs, pair_key(h, w), h), v, base


def _model_rows(buckets: int):
    """Rows of ``_STREAM`` from rows ``h, w, v, base`` of the model, ``PACKED`` entries at a time."""
    def rows(held: list) -> pa.RecordBatch:
        key, v, base = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(key)
        key, v, base = key[order], v[order], base[order]
        bucket = bucket_of(key, buckets)
        cuts = _slices(bucket)
        return _batch(len(cuts), slot=pa.array([int(bucket[i]) * 2 for i, _ in cuts], pa.int64()),
                      **{name: pa.array([_planes(x[i:j]) for i, j in cuts], pa.binary())
                         for name, x in (("keys", key), ("texts", v), ("ns", base))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(_entries(batch))
            size += len(batch)
            if size >= PACKED:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)
    return run


def _find(key: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the ascending table, and where those are."""
    if not len(table):
        return np.zeros(len(key), bool), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    hit = table[at] == key
    return hit, at[hit]


@dataclass
class Constants:
    scale: float               # N + 0.5 * (V + 1)
    factors: dict[int, float]  # Good-Turing factor of each count that has one
    min_count: int
    buckets: int

    def kept(self, c: np.ndarray) -> np.ndarray:
        """Counts less their discounts; 0 where the pair is not in the model."""
        factor = np.ones(max(self.factors, default=0) + 2)
        factor[list(self.factors)] = list(self.factors.values())
        return np.where(c >= max(1, self.min_count), c * factor[np.minimum(c, len(factor) - 1)], 0.0)


def _text_rows(constant: Constants):
    """Rows of ``_STREAM`` of one chunk, from its row of ``_CHUNK`` and its rows of ``_COUNTS``."""
    def run(rows: pa.Table, counts: pa.Table) -> pa.Table:
        chunk, number, buckets = _read(rows), rows.column("at")[0].as_py(), constant.buckets
        counts = counts.sort_by("slot")
        pairs = pc.equal(pc.bit_wise_and(counts.column("slot"), 1), 1)
        word_c = np.concatenate(_arrays(counts.filter(pc.invert(pairs)).column("counts"), np.int64))
        counts = counts.filter(pairs)
        by_row = _arrays(counts.column("counts"), np.int64)
        own = np.concatenate([np.unpackbits(bits, count=len(c)) for bits, c in zip(_arrays(counts.column("own"), np.uint8), by_row)]).astype(bool)
        c = np.concatenate(by_row)
        mass = 2 * word_c + 1  # of a word's P, in units of half a token
        base = np.log10(mass / 2 / constant.scale)
        kept = constant.kept(c)
        seen, many, c_h = kept > 0, len(chunk.word), word_c[chunk.h]

        mine = own & seen
        h = chunk.h[mine]
        has = np.bincount(h, minlength=many) > 0
        sums = [np.bincount(h, x, many)[has] for x in (kept[mine], mass[chunk.w[mine]].astype(float))]
        out = [pa.Table.from_batches(_model_rows(buckets)(iter([pa.RecordBatch.from_arrays(
            [_long(chunk.word[has]), pa.nulls(int(has.sum()), pa.int64()), *map(pa.array, sums)], ["h", "w", "v", "base"])])), _STREAM)]

        # a discounted pair leaves its history something, whatever the other pairs are; far from the bound in _alphas
        plain = np.bincount(chunk.h[seen & (c - kept > 2e-9 * c_h)], minlength=many) > 0
        plain = plain[chunk.h]
        value = base[chunk.w]
        value[seen] = np.log10(kept[seen] / c_h[seen])
        sums = [np.bincount(chunk.owner, x, chunk.texts) for x in (value[chunk.at], base[chunk.token], word_c[chunk.token] > 0)]
        sizes = np.bincount(chunk.owner, minlength=chunk.texts).astype(np.int64)
        out.append(pa.Table.from_batches([_batch(1, slot=pa.array([number % buckets * 2 + 1]), at=pa.array([number]), ns=_binary([_planes(sizes)]),
                                                 ids=rows.column("ids").combine_chunks(), sums=_binary([_planes(np.concatenate(sums))]))]))

        asked = np.where(seen, ~plain, c_h > 0)[chunk.at]
        at = chunk.at[asked]
        entry, n = np.unique(chunk.h[at].astype(np.int64) << 33 | chunk.owner[asked].astype(np.int64) << 1 | seen[at], return_counts=True)
        which, first, parts = np.unique(entry >> 33, return_index=True, return_counts=True)
        texts, key = entry & (1 << 33) - 1, chunk.word[which]
        bucket = bucket_of(key, buckets)
        cuts, ends = _slices(bucket), np.append(first, len(entry))
        columns = {"keys": (key, False), "counts": (word_c[which], False), "parts": (parts, False), "texts": (texts, True), "ns": (n, True)}
        out.append(pa.Table.from_batches([_batch(
            len(cuts), slot=pa.array([int(bucket[i]) * 2 + 1 for i, _ in cuts], pa.int64()), at=pa.array([number] * len(cuts), pa.int64()),
            **{name: _binary([_planes(x[ends[i]:ends[j]] if inner else x[i:j]) for i, j in cuts]) for name, (x, inner) in columns.items()})]))
        return pa.concat_tables(out)
    return run


def _find(key: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the ascending table, and where those are."""
    if not len(table):
        return np.zeros(len(key), bool), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    hit = table[at] == key
    return hit, at[hit]


def _alphas(scale: float):
    """Rows of ``_PARTS``, from the rows of ``_STREAM`` of one bucket."""
    def run(rows: pa.Table) -> pa.Table:
        of_model = pc.is_null(rows.column("at"))
        model, whole = rows.filter(of_model), rows.filter(pc.is_valid(rows.column("ids")))
        asking = rows.filter(pc.and_(pc.invert(of_model), pc.is_null(rows.column("ids"))))
        table, _, which = _distinct(_joined(_arrays(model.column("keys"), np.uint64), np.uint64)) if len(model) else (np.empty(0, np.uint64),) * 3
        kept_of, mass_of = (np.bincount(which, _joined(_arrays(model.column(c), float), float), len(table)) if len(table) else np.empty(0) for c in ("texts", "ns"))
        out = []
        for i in range(len(asking)):
            key, c, parts, texts, n = (_from_planes(asking.column(name)[i].as_py(), kind) for name, kind in
                                       (("keys", np.uint64), *((x, np.int64) for x in ("counts", "parts", "texts", "ns"))))
            hit, at = _find(key, table)
            kept, mass = np.zeros(len(key)), np.zeros(len(key))
            kept[hit], mass[hit] = kept_of[at], mass_of[at]
            below = np.where(c - kept > 1e-9 * c, c, c + 1.0)
            alpha = np.log10((below - kept) / below / (1 - mass / 2 / scale))
            gain = n * np.where(texts & 1, np.repeat(np.log10(c / below), parts), np.repeat(alpha, parts))
            some, which = np.unique(texts >> 1, return_inverse=True)
            out.append((asking.column("at")[i].as_py(), _planes(some), _planes(np.bincount(which, gain, len(some)))))
        at, texts, sums = zip(*out) if out else ((), (), ())
        gains = pa.Table.from_arrays([pa.array(at, pa.int64()), _binary(texts), pa.nulls(len(at), pa.binary()),
                                      pa.nulls(len(at), pa.list_(pa.int64())), _binary(sums)], _PARTS)
        return pa.concat_tables([gains, pa.Table.from_arrays([whole.column(c).cast(gains.schema.field(c).type) for c in _PARTS], _PARTS)])
    return run


def _per_text(rows: pa.Table) -> pa.Table:
    """The texts of one chunk with their sums, from its rows of ``_PARTS``."""
    whole = rows.filter(pc.is_valid(rows.column("ids")))
    sizes, sums = (_from_planes(whole.column(c)[0].as_py(), kind) for c, kind in (("ns", np.int64), ("sums", float)))
    score, base, known = sums.reshape(3, -1)
    gains = rows.filter(pc.is_null(rows.column("ids")))
    if len(gains):
        score = score + np.bincount(np.concatenate(_arrays(gains.column("texts"), np.int64)), np.concatenate(_arrays(gains.column("sums"), float)), len(sizes))
    return pa.Table.from_arrays([pa.concat_arrays([whole.column("ids")[0].values]), pa.array(sizes), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)],
                                ["doc_id", "n_tokens", "n_known", "base_score", "score"])


def discounts(count_of_counts: dict[int, int], katz_k: int, min_count: int) -> dict[int, float]:
    """Good-Turing factor of each count up to ``katz_k``; counts below ``min_count`` are not in the model."""
    n = count_of_counts
    common = (katz_k + 1) * n.get(katz_k + 1, 0) / n[1] if n.get(1) else 1.0
    out = {}
    for r in range(min_count, katz_k + 1):
        factor = (r + 1) * n.get(r + 1, 0) / n[r] / r if n.get(r) else 0.0
        d = (factor - common) / (1 - common) if common < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def score(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", *, min_count: int = 1,
          katz_k: int = 5, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``, learned from rows of ``may_learn``.

    ``heavy`` is accepted and not used: no key is broadcast, as a chunk sends a frequent key once like any other.
    """
    chunks = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                                     F.coalesce(may_learn, F.lit(False)).alias("learn")).mapInArrow(_chunks, _CHUNK_SQL), "chunks")
    tokens, texts = chunks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0))).first()
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(tokens) // BUCKET)
    counts = materialize(chunks.select("at", "learn", "sizes", "texts").mapInArrow(_key_rows(buckets), _KEYS_SQL)
                         .groupBy("slot").applyInArrow(_key_counts(katz_k + 1), _COUNTS_SQL), "counts")
    sums = counts.where("seen IS NOT NULL").groupBy((F.col("slot") % 2).alias("kind")).agg(
        *[F.sum(F.col("seen")[i]).alias(f"s{i}") for i in range(katz_k + 3)]).collect()
    by_kind = {r.kind: list(r)[1:] for r in sums}
    # START is among the words, once for each text
    distinct, total = (by_kind[0][0] - (texts > 0), by_kind[0][1] - texts) if by_kind else (0, 0)
    factors = discounts(dict(enumerate(by_kind[1][2:], 1)) if by_kind else {}, katz_k, min_count)
    constant = Constants(total + 0.5 * (distinct + 1), factors, min_count, buckets)
    return (chunks.groupBy("at").cogroup(counts.select("at", "slot", "counts", "own").groupBy("at")).applyInArrow(_text_rows(constant), _STREAM_SQL)
            .groupBy(F.shiftright("slot", 1)).applyInArrow(_alphas(constant.scale), _PARTS_SQL)
            .groupBy("at").applyInArrow(_per_text, _TEXT_SQL)
            .select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))
