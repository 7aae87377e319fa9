"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 8).

Features of a text are the hashes, folded to ``bits`` bits, of its distinct words,
word pairs, and pairs with one or two words between; a feature counts once
however often it occurs, and every word of the text is read. Learning goes over a
bounded sample of labelled rows (``max_positive`` and ``max_negative``, those of
smallest seeded id hash, so reruns agree) ``epochs`` times, a coordinate at its own
rate, with L1 keeping most weights at exactly zero. One task learns: the sample's
features come to it sorted by round and seeded hash, in rows of at most ``PIECE``
features, so it holds one batch of those, the features of one text (at most
``2 ** bits``) and the learner's state, whatever the texts' lengths. Only the weights
that are not zero go to the driver and from there to the executors, at most ``2 ** bits``
pairs of index and weight.

Defined cases: null or empty text: no feature, the score of the bias alone. Null
ids: scored, never learned from. Labels other than 0 and 1, or null: ignored; a
document labelled several times counts as toxic if any label is 1. With no label at
all (or labels of one kind) the model still scores. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tokens import Words, list_array, mix, words

PIECE = 256  # features to a row on the way to the learning task; Spark sends 10,000 rows to a worker at once
TEXT_BYTES = 1 << 19  # of text at a time: each word has four features of 16 bytes, copied to be sorted
BLOCK = 1 << 16  # coordinates at a time when all weights are read
_STEP = np.uint64(0x9E3779B97F4A7C15)


def features(part: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text index, feature)`` of every word, pair and skip-pair, repeats included."""
    h = part.hashes()
    owner = np.repeat(np.arange(part.count), np.diff(part.ptr))
    shift = np.uint64(64 - bits)
    owners, found = [owner], [mix(h + _STEP) >> shift]
    for gap in (1, 2, 3):
        same = owner[:-gap] == owner[gap:]
        pair = mix(h[:-gap] * _STEP + h[gap:] + np.uint64(gap))
        owners.append(owner[:-gap][same])
        found.append(pair[same] >> shift)
    return np.concatenate(owners), np.concatenate(found).astype(np.int64)


@dataclass
class Model:
    bits: int
    index: np.ndarray   # features of non-zero weight, ascending
    weight: np.ndarray
    bias: float

    def score(self, part: Words, table: np.ndarray) -> np.ndarray:
        owner, feature = features(part, self.bits)
        some = table[feature] != 0
        pairs = np.unique(owner[some] << self.bits | feature[some])
        total = np.bincount(pairs >> self.bits, weights=table[pairs & (1 << self.bits) - 1], minlength=part.count)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -40, 40)))

    def table(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float64)
        out[self.index] = self.weight
        return out


def learn(rows: Iterable[tuple[np.ndarray, int]], bits: int, *, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0,
          l2: float = 1.0) -> Model:
    """FTRL-proximal over ``(features, label)`` in the order given; the bias is the last coordinate and is not shrunk."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    threshold = np.full(size + 1, l1, np.float32)
    threshold[size] = 0

    def weights(i):
        zi = z[i]
        active = np.abs(zi) > threshold[i]
        return np.where(active, -(zi - np.sign(zi) * threshold[i]) / ((beta + np.sqrt(n[i])) / alpha + l2), 0.0)

    for i, label in rows:
        i = np.append(i, size)
        w = weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -40, 40))) - label
        sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
        z[i] += g - sigma * w
        n[i] += g * g
    index, weight = [], []
    for k in range(0, size, BLOCK):
        w = weights(np.arange(k, min(k + BLOCK, size)))
        some = np.flatnonzero(w)
        index.append(some + k)
        weight.append(w[some])
    return Model(bits, np.concatenate(index), np.concatenate(weight), float(weights(np.array([size]))[0]))


def _pieces(bits: int):
    """Rows ``id, label, digest, size, text, piece, features``: each text's distinct features, ``PIECE`` to a row, one row at least."""
    most = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in words(batch.column("text"), TEXT_BYTES):
                owner, feature = features(part, bits)
                pairs = np.unique(owner << bits | feature)
                ptr = np.searchsorted(pairs, np.arange(part.count + 1) << bits)
                size = np.diff(ptr)
                rows = np.maximum(1, -(-size // most))
                text = np.repeat(np.arange(part.count), rows)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(rows) - rows, rows)
                begin = ptr[:-1][text] + piece * most
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.first, part.count).take(pa.array(text)) for c in ("id", "label", "digest")]
                    + [pa.array(size[text]), pa.array(number + text), pa.array(piece),
                       list_array((pairs & (1 << bits) - 1).astype(np.int32), np.append(begin, ptr[-1]))],
                    ["id", "label", "digest", "size", "text", "piece", "features"])
                number += part.count
    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
    """Features and label of each text, from its pieces one behind the other."""
    held, now = [], 0
    for batch in batches:
        lists = batch.column("features")
        flat, ptr = lists.values.to_numpy(), lists.offsets.to_numpy()
        for k, (size, label) in enumerate(zip(batch.column("size").to_pylist(), batch.column("label").to_pylist())):
            held.append(flat[ptr[k]:ptr[k + 1]].astype(np.int64))
            now += len(held[-1])
            if now == size:
                yield np.concatenate(held), label
                held, now = [], 0


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        bits: int = 20, max_positive: int = 3000, max_negative: int = 6000, epochs: int = 3, seed: int = 3, **settings) -> Model:
    """A model from a bounded sample of the labelled documents.

    ``labels`` holds ``id_col`` and ``label_col``, only rows that may be learned from.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).groupBy("id").agg(F.max("label").alias("label")))
    taken = None
    for label, most in ((1, max_positive), (0, max_negative)):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64(F.lit(17), "id"), "id").limit(most)
        taken = part if taken is None else taken.union(part)
    text = F.col(text_col).cast("string")
    sample = (docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"))
              .join(F.broadcast(taken), "id"))  # at most max_positive + max_negative rows of two numbers
    pieces = sample.select("id", "label", "digest", "text").mapInArrow(
        _pieces(bits), "id long, label int, digest long, size long, text long, piece long, features array<int>")
    turns = (pieces.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).withColumn("turn", F.xxhash64(F.lit(seed), "epoch", "id"))
             .repartition(1).sortWithinPartitions("epoch", "turn", "id", "size", "digest", "text", "piece"))

    def run(batches):
        model = learn(_texts(batches), bits, **settings)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(model.index, 1 << bits)), pa.array(np.append(model.weight, model.bias))],
                                         ["index", "weight"])

    found = turns.select("label", "size", "features").mapInArrow(run, "index long, weight double").toArrow()
    index, weight = found.column("index").to_numpy(), found.column("weight").to_numpy()
    return Model(bits, index[:-1], weight[:-1], float(weight[-1]) if len(weight) else 0.0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
          carry: Sequence[str] | None = None) -> DataFrame:
    """``doc_id, score, predicted`` per row of ``docs``; ``carry`` names columns to pass on, as a struct ``row``, instead of the id.

    A text that is carried goes to the worker once, and rows come back as the texts are scored, ``TEXT_BYTES`` at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.index, model.weight))
    model_bits, model_bias = model.bits, model.bias

    def run(batches):
        own = Model(model_bits, *shared.value, model_bias)
        table = own.table()
        for batch in batches:
            rows = batch.column("_row")
            for part in words(rows.field(text_col) if carried else batch.column("_text"), TEXT_BYTES):
                p = own.score(part, table)
                yield pa.RecordBatch.from_arrays([rows.slice(part.first, part.count), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                                 ["_row", "score", "predicted"])

    row = F.struct(*carry) if carry else F.struct(F.col(id_col).cast("long").alias("doc_id"))
    carried = text_col in (carry or ()) and dict(docs.dtypes).get(text_col) == "string"
    slim = docs.select(row.alias("_row"), *([] if carried else [F.col(text_col).cast("string").alias("_text")]))
    out = slim.mapInArrow(run, f"_row {slim.schema['_row'].dataType.simpleString()}, score double, predicted int")
    return out.withColumnRenamed("_row", "row") if carry else out.select("_row.*", "score", "predicted")
