"""Quality of texts by attention over their passages (multiple-instance learning).

Every passage of a text is encoded; a gated attention weighs the codes, and the weighted mean is
classified. Only whole documents are labelled: which passages give a document away is learned by
the attention.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import labelled_sample, small_batches, text_or_empty, unused
from notewright.llm.passages import FEATURES, Passages, sections

FIT_DOCUMENTS = 2000  # labelled documents of each class
FIT_CHARACTERS = 50_000  # of a document to learn from; longer ones are not in the sample
CODE = 24
GATE = 12
EPOCHS = 300

Weights = dict[str, np.ndarray]


def _start(random: np.random.Generator) -> Weights:
    draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape)
    return {
        "encode": draw(FEATURES, CODE), "encode0": np.zeros(CODE), "look": draw(CODE, GATE),
        "gate": draw(CODE, GATE), "weigh": draw(GATE, 1), "judge": draw(CODE, 1), "judge0": np.zeros(1),
    }


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def _forward(w: Weights, x: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
    code = np.tanh(x @ w["encode"] + w["encode0"])
    look = np.tanh(code @ w["look"])
    gate = 1 / (1 + np.exp(-np.clip(code @ w["gate"], -30, 30)))
    force = np.exp(np.clip((look * gate) @ w["weigh"], -30, 30))
    attention = force / _sums(force, starts)[owner]
    whole = _sums(attention * code, starts)
    score = 1 / (1 + np.exp(-np.clip(whole @ w["judge"] + w["judge0"], -30, 30)))
    return {"code": code, "look": look, "gate": gate, "attention": attention, "whole": whole, "score": score[:, 0]}


def _gradient(w: Weights, x: np.ndarray, starts: np.ndarray, owner: np.ndarray, label: np.ndarray,
              weight: np.ndarray, decay: float) -> Weights:
    f = _forward(w, x, starts, owner)
    error = ((f["score"] - label) * weight)[:, None]
    whole = error @ w["judge"].T  # d loss / d weighted code
    by_passage = whole[owner]
    slope = (by_passage * (f["code"] - f["whole"][owner])).sum(axis=1, keepdims=True) * f["attention"]
    both = slope @ w["weigh"].T
    look = both * f["gate"] * (1 - f["look"] ** 2)
    gate = both * f["look"] * f["gate"] * (1 - f["gate"])
    code = (by_passage * f["attention"] + look @ w["look"].T + gate @ w["gate"].T) * (1 - f["code"] ** 2)
    out = {
        "encode": x.T @ code, "encode0": code.sum(axis=0), "look": f["code"].T @ look,
        "gate": f["code"].T @ gate, "weigh": (f["look"] * f["gate"]).T @ slope,
        "judge": f["whole"].T @ error, "judge0": error.sum(axis=0),
    }
    return {k: g + decay * w[k] * (not k.endswith("0")) for k, g in out.items()}


def train(features: np.ndarray, owner: np.ndarray, label: np.ndarray, epochs: int = EPOCHS) -> Weights:
    """Weights, with mean and spread of the features, from passages of labelled texts.

    owner: text of each passage, ascending and without gaps. With one class only, or no texts, every
    text gets that class, or quality 1. Full-batch steps with running moments of the gradient.
    """
    w = _start(np.random.default_rng(13))
    if len(label) == 0 or label.min() == label.max():
        w = {k: np.zeros_like(v) for k, v in w.items()}
        w["judge0"] += 3.0 if len(label) == 0 or label[0] == 1 else -3.0
        return w | {"mean": np.zeros(FEATURES), "spread": np.ones(FEATURES)}
    mean, spread = features.mean(axis=0), features.std(axis=0)
    spread = np.where(spread > 1e-6, spread, 1.0)
    x = np.clip((features - mean) / spread, -8, 8)
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, epochs + 1):
        grown = _gradient(w, x, starts, owner, label, weight, 1e-4)
        rate = 0.02 if step < 0.7 * epochs else 0.005
        for k, g in grown.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return w | {"mean": mean, "spread": spread}


def passages_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features and owners of all passages of texts."""
    found, owners = [np.zeros((0, FEATURES))], [np.zeros(0, dtype=np.int64)]
    for start, end in sections(texts):
        part = Passages(texts[start:end])
        found.append(part.features)
        owners.append(part.owner + start)
    return np.concatenate(found), np.concatenate(owners)


def scores(w: Weights, texts: list[bytes]) -> np.ndarray:
    """Scores of texts, as learned by train."""
    if not texts:
        return np.zeros(0)
    x, owner = passages_of(texts)
    x = np.clip((x - w["mean"]) / w["spread"], -8, 8)
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    return _forward(w, x, starts, owner)["score"]


def training_passages(docs: DataFrame, labels: DataFrame, keep: Column,
                      per_class: int = FIT_DOCUMENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, owner, label) of a bounded sample of labelled documents, none over FIT_CHARACTERS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, owner = passages_of(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(owner)), batch.column("label").take(pa.array(owner)),
                 pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))],
                ["doc", "label", "features"])

    small_batches(docs.sparkSession)
    short = docs.where(F.length(text_or_empty()) <= FIT_CHARACTERS)
    rows = labelled_sample(short, labels, "quality", keep, per_class).select(
        F.xxhash64("doc_id").alias("doc"), "label", F.col("text").cast("binary").alias("text")
    ).mapInArrow(run, "doc long, label int, features array<double>").toArrow()
    if not rows.num_rows:
        return np.zeros((0, FEATURES)), np.zeros(0, dtype=np.int64), np.zeros(0)
    x = rows.column("features").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    doc, label = rows.column("doc").to_numpy(), rows.column("label").to_numpy().astype(float)
    # order by document and content, so that the fit does not depend on how rows arrive
    order = np.lexsort((*x.T[::-1], doc))
    names, first, owner = np.unique(doc[order], return_index=True, return_inverse=True)
    return x[order], owner, label[order][first]


def _model(docs: DataFrame, labels: DataFrame, keep: Column):
    small_batches(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast(  # its size is fixed
        train(*training_passages(docs, labels, keep)))


def quality(docs: DataFrame, labels: DataFrame, keep: Column) -> DataFrame:
    """doc_id, score, predicted (1 from 0.5 on) of every row of docs, one row for each.

    keep: which labels (by their doc_id) may be learned from. Texts are read whole. Null texts count
    as empty; an empty text has one passage without words. Ids may be null or repeated and other
    columns of docs are not read. Labels that are null, contradict each other or belong to no
    document are not used; without labels all is of quality 1. An empty table gives an empty result.
    """
    shared = _model(docs, labels, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double"
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def of_quality(docs: DataFrame, labels: DataFrame, keep: Column) -> DataFrame:
    """The rows of docs, all columns as they are, whose text is predicted to be of quality 1; see quality."""
    shared = _model(docs, labels, keep)
    extra = unused(docs, "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = scores(shared.value, batch.column(extra).to_pylist()) >= 0.5
            yield batch.select([c for c in batch.schema.names if c != extra]).filter(pa.array(good))

    return docs.withColumn(extra, text_or_empty().cast("binary")).mapInArrow(run, docs.schema)
