"""Mixing documents to target domain weights, with soft membership.

A classifier learned from a labelled table gives every document a probability for each domain. Each
document gets a rate r >= 0, how often it is to be seen, and the expected tokens of a domain are
the sum of r * tokens * probability. Rates are fitted to target totals by projected gradient on

    sum over domains (expected - target)^2 / max(available, target)
        +  STAY * sum over documents tokens * (r - 1)^2

where STAY only decides between rates that reach the targets equally well. From rates of 1, weighing
documents by tokens, every step moves a document along its own probabilities and is projected to
r >= 0, so rates are always max(0, 1 - p . pull) for one pull per domain: that is all an iteration
carries. Steps are scaled by the Hessian over the documents that are not at 0 (domains x domains), and
shortened until the dual falls; each is one aggregate over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import durable, labelled_sample, small_batches, text_or_empty, unused
from notewright.llm.passages import FEATURES, Passages, sections

HASHED = 1 << 16  # word and stem features, half each
FIT_DOCUMENTS = 1500  # labelled documents of each domain
FIT_CHARACTERS = 20_000  # of a document to learn from; longer ones are not in the sample
EPOCHS = 12
STAY = 1e-5
ROUNDS = 100  # aggregates at most; a fit takes some ten
TOLERANCE = 1e-7  # of the mixture's size, by which the slope may differ from 0


def describe(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For sections of texts: mean passages, hashed features, the text of each feature, word counts."""
    half = HASHED // 2
    for start, end in sections(texts):
        p = Passages(texts[start:end])
        hashed = np.concatenate([p.words % np.uint64(half), p.stems % np.uint64(half) + np.uint64(half)])
        yield (p.texts_mean(end - start), hashed.astype(np.int64), np.concatenate([p.word_owner] * 2),
               np.bincount(p.word_owner, minlength=end - start))


class Classifier:
    """A softmax over mean passages and hashed words; plain arrays."""

    def __init__(self, classes: int):
        self.dense = np.zeros((FEATURES + 1, classes))
        self.sparse = np.zeros((HASHED, classes))
        self.mean, self.spread = np.zeros(FEATURES), np.ones(FEATURES)

    def fit(self, texts: list[bytes], label: np.ndarray) -> Classifier:
        """Adaptive stochastic gradient over texts in a fixed random order."""
        if not texts:
            return self
        rows = []
        for dense, hashed, owner, words in describe(texts):
            order = np.argsort(owner, kind="stable")
            parts = np.split(hashed[order], np.cumsum(np.bincount(owner, minlength=len(dense)))[:-1])
            rows += [(d, np.unique(p), n) for d, p, n in zip(dense, parts, words, strict=True)]
        x = np.stack([r[0] for r in rows])
        self.mean, spread = x.mean(axis=0), x.std(axis=0)
        self.spread = np.where(spread > 1e-6, spread, 1.0)
        x = self._dense(x)
        classes = self.dense.shape[1]
        used, used_dense = np.full((HASHED, classes), 1e-3), np.full(self.dense.shape, 1e-3)
        random = np.random.default_rng(17)
        for _ in range(EPOCHS):
            for i in random.permutation(len(rows)):
                at = rows[i][1]
                scale = 1 / np.sqrt(max(1, len(at)))
                p = _softmax((x[i] @ self.dense + scale * self.sparse[at].sum(axis=0))[None])[0]
                p[label[i]] -= 1
                step = scale * p + 1e-4 * self.sparse[at]
                used[at] += step**2
                self.sparse[at] -= 0.1 * step / np.sqrt(used[at])
                step = np.outer(x[i], p) + 1e-4 * self.dense
                used_dense += step**2
                self.dense -= 0.05 * step / np.sqrt(used_dense)
        return self

    def _dense(self, x: np.ndarray) -> np.ndarray:
        scaled = np.clip((x - self.mean) / self.spread, -8, 8) / np.sqrt(FEATURES)
        return np.concatenate([scaled, np.ones((len(x), 1))], axis=1)

    def posteriors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the classes, and word counts, of texts; distinct features count once."""
        found, counts = [np.zeros((0, self.dense.shape[1]))], [np.zeros(0, dtype=np.int64)]
        for dense, hashed, owner, words in describe(texts):
            pair = np.unique(owner * HASHED + hashed)
            owner, hashed = pair // HASHED, pair % HASHED
            n = np.bincount(owner, minlength=len(dense))
            total = np.stack([
                np.bincount(owner, weights=w[hashed], minlength=len(dense)) for w in self.sparse.T], axis=1)
            found.append(_softmax(self._dense(dense) @ self.dense + total / np.sqrt(np.maximum(1, n))[:, None]))
            counts.append(words)
        return np.concatenate(found), np.concatenate(counts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def learn(docs: DataFrame, labelled: DataFrame, domains: list[str], per_domain: int = FIT_DOCUMENTS) -> Classifier:
    """From a bounded sample of labelled (doc_id, domain): per_domain documents of each domain.

    The sample holds about as many documents of each domain; how common domains are among all
    labelled documents is put back afterwards, or rare domains would be predicted too often.
    """
    short = docs.where(F.length(text_or_empty()) <= FIT_CHARACTERS)
    labelled = (
        labelled.groupBy("doc_id").agg(F.min("domain").alias("domain"), F.max("domain").alias("other"))
        .where("domain = other").join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    common = dict(labelled.where(F.col("domain").isin(domains)).groupBy("domain").count().collect())
    rows = []
    for number, domain in enumerate(domains):
        as_class = labelled.withColumn("of", F.when(F.col("domain") == domain, 1))
        sample = labelled_sample(short, as_class, "of", F.lit(True), per_domain).select(
            F.xxhash64("doc_id").alias("doc"), F.col("text").cast("binary").alias("text")).toArrow()
        rows += [(doc, number, text) for doc, text in zip(
            sample.column("doc").to_pylist(), sample.column("text").to_pylist(), strict=True)]
    rows.sort()
    label = np.array([r[1] for r in rows], dtype=np.int64)
    learned = Classifier(len(domains)).fit([r[2] for r in rows], label)
    if rows:
        sampled = np.bincount(label, minlength=len(domains))
        learned.dense[-1] += np.log((np.array([common.get(d, 0) for d in domains]) + 0.5) / (sampled + 0.5))
    return learned


def memberships(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, text_key (a hash of the text), tokens (words) and p (a probability for each domain)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(  # its size is fixed
        (classifier.dense, classifier.sparse, classifier.mean, classifier.spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, sparse, mean, spread = shared.value
        own = Classifier(dense.shape[1])
        own.dense, own.sparse, own.mean, own.spread = dense, sparse, mean, spread
        for batch in batches:
            p, tokens = own.posteriors(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(tokens),
                 pa.array(p.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "text_key", "tokens", "p"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        "doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().cast("binary").alias("text")
    ).mapInArrow(run, f"doc_id {kind}, text_key long, tokens long, p array<double>")


def fit_rates(member: DataFrame, targets: list[float], stay: float = STAY, rounds: int = ROUNDS) -> DataFrame:
    """member (row, tokens, p) with rate: projected gradient to target shares of all its tokens.

    targets are shares of the mixture's size, which is the tokens of member; they need not add up
    to 1. Targets that no rates reach are met as nearly as the least squares allow. Nothing is fitted
    where there are no tokens: rates are then 1.
    """
    k = len(targets)
    p = [F.col("p")[d] for d in range(k)]

    def rate(pull: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), sum((-p[d] * float(pull[d]) for d in range(k)), F.lit(1.0)))

    def at(pull: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Tokens times squared rates, expected totals, and the Hessian."""
        r = F.col("r")
        active = F.when(r > 0, F.col("tokens")).otherwise(0)
        found = member.withColumn("r", rate(pull)).agg(
            F.sum(F.col("tokens") * r * r), *[F.sum(F.col("tokens") * p[d] * r) for d in range(k)],
            *[F.sum(active * p[c] * p[d]) for c in range(k) for d in range(k)]).first()
        numbers = np.array([v or 0.0 for v in found], dtype=float)
        return numbers[0], numbers[1:k + 1], numbers[k + 1:].reshape(k, k)

    pull = np.zeros(k)
    squares, available, bend = at(pull)
    whole = available.sum()
    if not whole:
        return member.withColumn("rate", F.lit(1.0))
    wanted = np.array(targets) * whole
    softness = stay * np.maximum(np.maximum(available, wanted), 1e-9 * whole)

    def dual(squares: float, pull: np.ndarray) -> float:
        return squares / 2 + wanted @ pull + softness @ pull**2 / 2

    now, value = available, dual(squares, pull)
    left = rounds - 1
    while left > 0:
        slope = wanted - now + softness * pull
        if np.abs(slope).max() <= TOLERANCE * whole:
            break
        step = -np.linalg.solve(bend + np.diag(softness), slope)
        length = 1.0
        while left > 0:
            left -= 1
            squares, expected, hessian = at(pull + length * step)
            there = dual(squares, pull + length * step)
            if there <= value + 1e-4 * length * (slope @ step) + 1e-12 * abs(value):
                pull, now, bend, value = pull + length * step, expected, hessian, there
                break
            length /= 2
    return member.withColumn("rate", rate(pull))


def mixture(fitted: DataFrame, targets: dict[str, float]) -> DataFrame:
    """One row per domain of fitted rates: target, expected and drawn shares of the tokens there are."""
    whole = F.sum("tokens")
    share = lambda times, d: F.try_divide(F.sum(F.col("tokens") * F.col("p")[d] * F.col(times)), whole)
    return fitted.agg(F.array(*[
        F.struct(F.lit(name).alias("domain"), F.lit(float(targets[name])).alias("target"),
                 share("rate", d).alias("expected"), share("copies", d).alias("drawn"))
        for d, name in enumerate(sorted(targets))]).alias("rows")).select(F.inline("rows"))


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], stay: float = STAY) -> DataFrame:
    """One row per row of docs: doc_id, text_key, tokens, p (domains in order of name), rate, copies.

    labelled: (doc_id, domain), from which the domains of targets are learned; null or other
    domains and ids that contradict themselves are not used, and a domain without labels is hardly
    ever predicted. copies is rate rounded down or up, up with the probability of the rest, drawn
    from a hash of doc_id and text: the same each time. Texts are read whole; null and empty ones
    have no tokens, so they have no say in the fit. Ids may be null or repeated, other columns of
    docs are not read. An empty table gives an empty result.
    """
    domains = sorted(targets)
    member = durable(memberships(docs, learn(docs, labelled, domains)))
    fitted = fit_rates(member, [targets[d] for d in domains], stay)
    draw = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "text_key"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return fitted.withColumn("copies", (
        F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def thin(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], stay: float = STAY) -> DataFrame:
    """The rows of docs, all columns, that the mixture takes; see rates.

    Nothing is repeated: a document of a rate above 1 is there once, one below 1 with that
    probability. Where targets ask for more of a domain than there is, its documents all stay.
    """
    drawn = rates(docs, labelled, targets, stay).where("copies = 0").select("doc_id", "text_key").distinct()
    key = unused(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(text_or_empty()))
    same = keyed["doc_id"].eqNullSafe(drawn["doc_id"]) & (keyed[key] == drawn["text_key"])
    return keyed.join(drawn, same, "left_anti").drop(key)


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a labels table: harsh (toxic), rough (of low quality) or refined."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "harsh").when(
        F.col("quality") == 0, "rough").when(F.col("quality") == 1, "refined").alias("domain"))
