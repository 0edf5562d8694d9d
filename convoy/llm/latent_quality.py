"""Quality of texts by votes of their nearest labelled neighbours in a latent-semantic space.

A text's terms are hashed byte trigrams and a few marks of its words (repeated, upper case, decorated).
Damped, weighted counts of a bounded sample of labelled texts are reduced by a singular value
decomposition; the labelled vectors are broadcast. Every text is projected the same way, cosine
products with all labelled vectors are computed block by block, and the nearest vote by similarity.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.words import LOWER, NOT_SPACE, flat, runs, words

#: Labelled texts of each class that are learnt from at most, chosen by a hash of their ids.
#: Their term vectors (4 KB each) go to the driver, 12 MB in all; what is broadcast stays below 1 MB.
SAMPLE_PER_CLASS = 1500
DIMENSIONS = 48
TERMS = 1024
MARKS = 16
NEIGHBOURS = 25
BLOCK = 512
#: Texts whose term counts are held at once: a batch may have ten thousand short ones.
TEXTS_AT_ONCE = 1024
PREDICT_AT = 0.3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "!#$%&*+/<=>?@[]^_`{|}~\\"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(values)]
    return sums[offsets[1:]] - sums[offsets[:-1]]


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the hashed terms of each text, as shares of its bytes or words."""
    n, terms = len(offsets) - 1, TERMS
    lowered = LOWER[data].astype(np.uint32)
    text = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros((n, terms), np.float32)
    if len(data) > 2:
        gram = lowered[:-2] | lowered[1:-1] << np.uint32(8) | lowered[2:] << np.uint32(16)
        slot = (gram * np.uint32(2654435761)) >> np.uint32(16)
        one = text[:-2] == text[2:]
        flat_slot = text[:-2][one] * terms + slot[one] % (terms - MARKS)
        out = np.bincount(flat_slot, minlength=n * terms).reshape(n, terms).astype(np.float32)
    size = np.maximum(np.diff(offsets), 1)[:, None]
    out = np.sqrt(out / size).astype(np.float32)
    w = words(data, offsets, NOT_SPACE)
    count = np.maximum(np.diff(w.first), 1)
    own = np.repeat(np.arange(n), np.diff(w.first))
    same = np.zeros(len(own))
    if len(own) > 1:
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (own[1:] == own[:-1])
    order = np.lexsort((w.hashes, own))
    again = np.zeros(len(own))
    if len(own) > 1:
        again[1:] = (w.hashes[order][1:] == w.hashes[order][:-1]) & (own[order][1:] == own[order][:-1])
    symbols = np.r_[0, np.cumsum(_SYMBOL[data])]
    decorated = (symbols[w.ends] > symbols[w.starts]).astype(float)
    lengths = (w.ends - w.starts).astype(float)
    marks = [
        _per_text(same, w.first) / count,
        _per_text(again, w.first) / count,
        _per_text(decorated, w.first) / count,
        _per_text(_SYMBOL[data].astype(float), offsets) / size[:, 0],
        _per_text(_UPPER[data].astype(float), offsets) / size[:, 0],
        _per_text(_DIGIT[data].astype(float), offsets) / size[:, 0],
        _per_text((lengths > 12).astype(float), w.first) / count,
        1 / (1 + count / 8.0),
    ]
    for i, mark in enumerate(marks):
        out[:, terms - MARKS + i] = 2 * np.sqrt(mark)
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def fit(x: np.ndarray, labels: np.ndarray, prior: float, dimensions: int = DIMENSIONS) -> Model:
    """Latent space and labelled vectors of the sample's term counts; ``prior`` is the share of label 1 in
    all labels."""
    seen = (x > 0).sum(axis=0)
    weights = np.log1p(len(x) / np.maximum(seen, 1)).astype(np.float32)
    weights[TERMS - MARKS :] = 1
    x = x * weights
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = axes[:, ::-1][:, :dimensions].astype(np.float32)
    return Model(weights, axes, unit(x @ axes), labels.astype(np.float32), prior)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def scores(model: Model, texts: pa.Array, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest, each class weighed back to its share of all labels."""
    data, offsets = flat(texts)
    found = np.full(len(offsets) - 1, model.prior)
    if not len(model.labels):
        return found
    ones = model.labels.mean()
    weigh = np.where(model.labels > 0, model.prior / max(ones, 1e-9), (1 - model.prior) / max(1 - ones, 1e-9))
    # no more neighbours than half of the smaller class, or it could never win
    smaller = int(min((model.labels > 0).sum(), (model.labels <= 0).sum()))
    k = max(1, min(neighbours, smaller // 2))
    for a, b in runs(offsets, texts=TEXTS_AT_ONCE):
        part = offsets[a : b + 1]
        x = term_counts(data[part[0] : part[-1]], part - part[0]) * model.weights
        x = unit(x @ model.axes)
        for i in range(0, len(x), BLOCK):
            near = x[i : i + BLOCK] @ model.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            similar = np.maximum(np.take_along_axis(near, best, axis=1), 0) ** 8 * weigh[best]
            total = similar.sum(axis=1)
            votes = (similar * model.labels[best]).sum(axis=1)
            found[a + i : a + i + len(near)] = np.where(total > 1e-12, votes / np.maximum(total, 1e-12), model.prior)
    return found


def _vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        data, offsets = flat(batch)
        for_texts = [
            term_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in runs(offsets, texts=TEXTS_AT_ONCE)
        ]
        x = np.concatenate(for_texts) if for_texts else np.zeros((0, TERMS), np.float32)
        yield pa.array([row.tobytes() for row in x], pa.binary())


def held_out(id_column: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id as text falls into ``fold``; rows without an id are always held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % folds == fold, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Model from ``labels`` (doc_id, label 0 or 1) and the texts of ``docs``.

    The prior counts every label. Labels that are null or of unknown documents teach nothing; without
    any label every score is 0.5.
    """
    labels = labels.filter("label in (0, 1) and doc_id is not null")
    prior = labels.agg(F.avg(F.col("label").cast("double"))).first()[0]
    order = F.xxhash64("doc_id"), "doc_id"
    sample = [labels.filter(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(sample[0].unionByName(sample[1]))  # at most 2 * per_class ids
    vector = F.arrow_udf(_vectors, "binary")(F.col("text"))
    found = docs.select("doc_id", F.col("text").cast("string")).join(chosen, "doc_id")
    rows = found.select("label", vector.alias("vector")).collect()
    # the order of the rows must not matter
    pairs = sorted((bytes(r["vector"]), r["label"]) for r in rows)
    x = np.frombuffer(b"".join(v for v, _ in pairs), np.float32).reshape(-1, TERMS)
    return fit(x, np.array([y for _, y in pairs]), 0.5 if prior is None else prior)


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with column ``out``: 0 to 1, higher when label 1 is likelier.

    Null counts as empty; an empty text is scored like any other, by its marks. Only ``text`` is read. Equal
    texts get equal scores; an empty table stays empty. ``out`` replaces a column of its name, others pass through.
    """
    # plain arrays: an object's class would have to be on the workers' path
    arrays = (model.weights, model.axes, model.vectors, model.labels, model.prior)
    sent = docs.sparkSession.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*sent.value)
        for batch in batches:
            yield pa.array(scores(own, batch), pa.float64())

    return docs.withColumn(out, F.arrow_udf(run, "double")(F.col("text").cast("string")))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from 0.3 on).

    ``labels`` has doc_id and quality; those of held-out ids are not learnt from.
    """
    known = labels.select("doc_id", F.col("quality").alias("label")).filter(~held_out(F.col("doc_id"), 5, 0))
    scored = score(docs.select("doc_id", "text"), learn(docs, known))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
