"""Language identification with a string kernel (operator 3).

The kernel of two texts is the number of character n-grams (1 to 3, blended
spectrum) that both hold, over the geometric mean of their own numbers. Letters are
lower-cased; every other character is a boundary. Landmark texts of each language
span the kernel's Nyström feature map, on which one ridge regression per language
(one against the rest) is solved. A batch of texts is scored by matrix products:
presence of the landmarks' n-grams, times the landmarks, times the solved weights.

The model is fitted on a bounded sample: ``per_language`` rows of each language, of
smallest seeded id hash, whole texts of any length. The first ``landmarks`` of each are
landmarks, fewer where that would be over ``most_landmarks`` in all (one at least). n-grams are exact: three
code points packed into one number, whatever the script. The driver gets the landmarks'
n-grams and, for each sampled row, its kernel with each landmark.

Defined cases: text null or without a letter: ``und``, score 0. Ties: the language
first in code-point order. No row to learn from: ``und`` for all. Rows with a null
language or id are not learned from; rows equal in id, language and text are learned from once. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.scratch import materialize
from quarry.llm.tokens import list_array, runs
from quarry.operators.joins import broadcast_if_bounded

BATCH_TEXTS = 256


def _letters() -> np.ndarray:
    """Lower-cased code point of each letter of the basic plane, 0 for other characters."""
    out = np.zeros(1 << 16, np.int64)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters(data: np.ndarray, text_ptr: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters (0: another character) of UTF-8 texts, and where each text starts."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    low = table[np.minimum(points, 0xFFFF)]
    for c in np.unique(points[points > 0xFFFF]):
        low[points == c] = ord(chr(c).lower()) if chr(c).isalpha() else 0
    return low, np.minimum(lead[text_ptr], len(low))


def grams(code: np.ndarray) -> np.ndarray:
    """Distinct n-grams of a text of code points plus one (1: boundary): three 21-bit numbers each, absent ones 0."""
    two = code[:-1] << 21 | code[1:]
    return np.unique(np.concatenate([code, two, two[:-1] << 21 | code[2:]]))


def _texts(batch: pa.RecordBatch, table: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, n-grams)`` of the texts that hold a letter."""
    for first, count, data, text_ptr in runs(batch.column("text")):
        low, at = letters(data, text_ptr, table)
        code = low + 1
        for i in range(count):
            c = code[at[i]:at[i + 1]]
            if len(c) and c.max() > 1:
                yield first + i, grams(c)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _letters()
    for batch in batches:
        for row, own in _texts(batch, table):
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(row, 1), batch.column("r").slice(row, 1),
                                              list_array(own, np.array([0, len(own)]))], ["lang", "r", "grams"])


@dataclass
class Landmarks:
    """n-grams of the landmarks, ascending, and which landmarks hold each: ``post[start[k]:start[k + 1]]`` for ``column[k]``."""

    column: np.ndarray
    start: np.ndarray
    post: np.ndarray
    norm: np.ndarray  # number of n-grams of each landmark

    @classmethod
    def of(cls, lists: list[np.ndarray]) -> Landmarks:
        sizes = np.array([len(x) for x in lists])
        flat, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), sizes)
        order = np.lexsort((owner, flat))
        column, start = np.unique(flat[order], return_index=True)
        return cls(column, np.append(start, len(flat)), owner[order].astype(np.int32), sizes.astype(float))

    def kernel(self, lists: list[np.ndarray]) -> np.ndarray:
        """Texts by landmarks: the sparse product of n-gram presences, over the geometric mean of their numbers."""
        shared = np.zeros((len(lists), len(self.norm)))
        for i, own in enumerate(lists):
            at = np.searchsorted(self.column, own)
            at = at[np.take(self.column, at, mode="clip") == own]
            begin, length = self.start[at], self.start[at + 1] - self.start[at]
            inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            shared[i] = np.bincount(self.post[np.repeat(begin, length) + inside], minlength=len(self.norm))
        sizes = np.array([len(x) for x in lists], float)
        return shared / np.sqrt(sizes[:, None] * self.norm[None, :])


@dataclass
class Model:
    languages: list[str]
    landmarks: Landmarks
    weight: np.ndarray      # landmarks by languages
    bias: np.ndarray

    def decide(self, lists: list[np.ndarray]) -> np.ndarray:
        return self.landmarks.kernel(lists) @ self.weight + self.bias


def solve(landmarks: Landmarks, chosen: np.ndarray, langs: list[str], kernel: np.ndarray, ridge: float) -> Model:
    """Nyström map and ridge weights from the kernel of the sampled rows with the landmarks (their rows ``chosen``)."""
    languages = sorted(set(langs))
    among = kernel[chosen]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    some = values > 1e-6 * values.max()
    root = vectors[:, some] / np.sqrt(values[some])
    z = kernel @ root
    target = np.where(np.array(langs)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    mean_z, mean_t = z.mean(0), target.mean(0)
    solved = np.linalg.solve((z - mean_z).T @ (z - mean_z) + ridge * np.eye(z.shape[1]), (z - mean_z).T @ (target - mean_t))
    return Model(languages, landmarks, root @ solved, mean_t - mean_z @ solved)


def fit(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
        per_language: int = 300, landmarks: int = 32, most_landmarks: int = 1024, ridge: float = 1.0) -> Model | None:
    """A model from a bounded sample of the rows of ``may_learn`` that have a language."""
    slim = docs.where(may_learn).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                                        F.col(text_col).cast("string").alias("text"))
    fits = slim.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(29), "id"), "id", "key")
    keyed = fits.withColumn("key", F.xxhash64("text"))
    ranked = materialize(keyed.select("id", "lang", "key").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language), "ranked")
    sample = keyed.join(broadcast_if_bounded(ranked), ["id", "lang", "key"]).select("lang", "r", "text").dropDuplicates(["lang", "r"])
    rows = materialize(sample.mapInArrow(_distinct, "lang string, r int, grams array<long>"), "sample")
    n_languages = rows.select("lang").distinct().count()
    if not n_languages:
        return None
    each = max(1, min(landmarks, most_landmarks // n_languages))
    marks = sorted(rows.where(F.col("r") <= each).select("lang", "r", "grams").toPandas().itertuples(index=False), key=lambda x: x[:2])
    found = Landmarks.of([np.asarray(x[2], np.int64) for x in marks])
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(found).values()))

    def kernels(batches):
        own = Landmarks(*shared.value)
        for batch in batches:
            if len(batch):
                k = own.kernel([np.asarray(x, np.int64) for x in batch.column("grams").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("r"), list_array(k.reshape(-1), np.arange(len(k) + 1) * k.shape[1])],
                                                 ["lang", "r", "kernel"])

    table = rows.mapInArrow(kernels, "lang string, r int, kernel array<double>").toPandas().sort_values(["lang", "r"])
    number = {x: i for i, x in enumerate(zip(table["lang"], table["r"]))}
    chosen = np.array([number[x[:2]] for x in marks])
    return solve(found, chosen, list(table["lang"]), np.stack(list(table["kernel"])), ridge)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` per row of ``docs``; score is the winner's output from [-1, 1] moved to [0, 1]."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return slim.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, tuple(vars(model.landmarks).values()), model.weight, model.bias))

    def run(batches):
        languages, found, weight, bias = shared.value
        own, table, names = Model(languages, Landmarks(*found), weight, bias), _letters(), np.array(languages, object)
        for batch in batches:
            langs, scores = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            texts = _texts(batch, table)
            while some := list(islice(texts, BATCH_TEXTS)):
                index = [row for row, _ in some]
                out = own.decide([x for _, x in some])
                best = out.argmax(1)
                langs[index] = names[best]
                scores[index] = np.clip((out[np.arange(len(index)), best] + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    return slim.mapInArrow(run, "doc_id long, lang_pred string, score double")
