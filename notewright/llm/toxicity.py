"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words counts the subsequences of three characters that they share, gaps allowed,
each weighted by DECAY for every character it spans, and is normalised. An insult with characters
inserted, dropped or between separators, or with an unseen ending, still shares most of them.

A word may also be cut by white space: neighbouring tokens of a sentence that are short are joined in
every way as well, so 'gr um bo ld' holds the word it spells among its units.

Units of labelled sentences, words and joined ones, give Nystrom landmarks; on them the kernel has an explicit feature map,
in which a linear support vector machine is trained. A toxic document only says that some word in
it is to blame, so training alternates: take each toxic document's highest word as its witness, then
fit witnesses against the words of clean sentences, the highest ones among them. A document is
scored by a logistic curve over its highest decisions and how many words pass some levels.

As machine and landmarks are linear in subsequence counts, they fold into one weight for every
subsequence; a word costs one look-up for each subsequence that it has.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import labelled_sample, small_batches, text_or_empty

DECAY = 0.6
SPAN = 6  # characters a subsequence may reach over
SYMBOLS = 64
FIT_DOCUMENTS = 1500  # labelled documents of each class
FIT_CHARACTERS = 20_000  # of a document to learn from; longer ones are not in the sample
LANDMARKS = 192
ALIKE = 0.7  # landmarks of more kernel than this with one another add nothing
SUSPECT = 3.5  # log odds from which a first guess is taken at its word
LIFT = 5.0  # how much oftener than in clean documents a word to blame must stand in toxic ones
ROUNDS = 4
DOUBT = 5.0  # weight of a witness's use in clean documents
NOTHING = -2.0  # decision where there is no word
LEVELS = (-0.5, -0.25, 0.0, 0.25, 0.5, 0.75, 1.0)
SHORT = 3  # characters of tokens that are joined with their neighbours
JOINED = (4, 16)  # letters and digits of what they join to, least and most
_WINDOW = 32  # longer words are met in overlapping pieces
_REMEMBERED = 400_000

_SPELLED = re.compile(r"(?:(?<=\s)|^)\S(?:\s+\S){3,}(?=\s|$)")
_SHORT_RUN = re.compile(rf"(?<!\S)\S{{1,{SHORT}}}(?:(?<![.!?])[^\S\n]+\S{{1,{SHORT}}})+(?!\S)")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n")


class Model(NamedTuple):
    weights: np.ndarray  # of every subsequence, float32
    bias: float
    reader: np.ndarray  # logistic weights of a document's features, the last one constant


def units(tokens: Iterable[str]) -> dict[str, str]:
    """For each token that has letters or digits: these alone, lower-cased."""
    return {t: w for t in tokens if (w := "".join(filter(str.isalnum, t)))}


def spelled_out(text: str) -> list[str]:
    """Words written as single characters with white space between: 'w o r d' gives 'word'."""
    return [w for m in _SPELLED.findall(text) if (w := "".join(filter(str.isalnum, m)))]


def joined(text: str) -> set[str]:
    """What neighbouring short tokens of one sentence join to: 'a gr um bo' gives 'agrum', 'grum', 'grumbo', ..."""
    least, most = JOINED
    found = set()
    for run in _SHORT_RUN.findall(text):
        parts = [w for t in run.split() if (w := "".join(filter(str.isalnum, t)))]
        for i, word in enumerate(parts):
            for part in parts[i + 1:]:
                word += part
                if len(word) > most:
                    break
                if len(word) >= least:
                    found.add(word)
    return found


def _codes(words: list[str]) -> np.ndarray:
    """Symbols of words of one length, with a start mark: 0 start, a-z, one for digits, then others."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)
    out = np.where((points >= 97) & (points <= 122), points - 96, 28 + points % (SYMBOLS - 28))
    out = np.where((points >= 48) & (points <= 57), 27, out).astype(np.int64)
    return np.concatenate([np.zeros((len(words), 1), dtype=np.int64), out], axis=1)


def _positions(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    triples = [
        (i, j, k) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, min(n, i + SPAN))]
    at = np.array(triples, dtype=np.int64).reshape(-1, 3)
    return at[:, 0], at[:, 1], at[:, 2], DECAY ** (at[:, 2] - at[:, 0]).astype(float)


def subsequences(words: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(rows, subsequence numbers, normalised counts) for words of up to _WINDOW characters.

    One item for each word length. A subsequence that a word holds several times has its whole
    count at one of them and 0 at the others.
    """
    by_size: dict[int, list[int]] = {}
    for row, word in enumerate(words):
        by_size.setdefault(len(word), []).append(row)
    for size, rows in by_size.items():
        i, j, k, weight = _positions(size + 1)
        for low in range(0, len(rows), 4000):
            part = rows[low:low + 4000]
            code = _codes([words[r] for r in part])
            number = (code[:, i] * SYMBOLS + code[:, j]) * SYMBOLS + code[:, k]
            order = np.argsort(number, axis=1, kind="stable")
            number = np.take_along_axis(number, order, axis=1)
            total = np.cumsum(weight[order], axis=1)
            if number.shape[1]:
                last = np.ones(number.shape, dtype=bool)
                last[:, :-1] = number[:, 1:] != number[:, :-1]
                upto = np.where(last, total, 0.0)
                before = np.maximum.accumulate(upto, axis=1)
                before = np.concatenate([np.zeros((len(part), 1)), before[:, :-1]], axis=1)
                count = np.where(last, total - before, 0.0)
                count /= np.maximum(np.sqrt((count**2).sum(axis=1, keepdims=True)), 1e-12)
            else:
                count = np.zeros(number.shape)
            yield part, number, count


def _pieces(word: str) -> list[str]:
    if len(word) <= _WINDOW:
        return [word]
    half = _WINDOW // 2
    return [word[i:i + _WINDOW] for i in range(0, len(word) - half, half)]


def decisions(model: Model, words: list[str]) -> np.ndarray:
    """The machine's decision on each word: above 0 for insults."""
    owners, pieces = [], []
    for row, word in enumerate(words):
        for piece in _pieces(word):
            owners.append(row)
            pieces.append(piece)
    out = np.full(len(words), -np.inf)
    owner = np.array(owners, dtype=np.int64)
    for rows, number, count in subsequences(pieces):
        value = np.einsum("ij,ij->i", model.weights[number], count) + model.bias
        np.maximum.at(out, owner[rows], value)
    return out


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of words with landmarks."""
    at = np.full(SYMBOLS**3, -1, dtype=np.int64)
    seen = [(rows, number, count) for rows, number, count in subsequences(landmarks)]
    known = np.unique(np.concatenate([n[c > 0] for _, n, c in seen]))
    at[known] = np.arange(len(known))
    table = np.zeros((len(known) + 1, len(landmarks)))
    for rows, number, count in seen:
        for row, n, c in zip(rows, number, count, strict=True):
            table[at[n[c > 0]], row] = c[c > 0]
    table = table.astype(np.float32)
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for rows, number, count in subsequences(words):
        for low in range(0, len(rows), 500):
            part = slice(low, low + 500)
            out[rows[part]] = np.einsum("ij,ijk->ik", count[part].astype(np.float32), table[at[number[part]]])
    return out


def _fit_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(15):
        inside = y * (x @ w) < 1
        a, t, c = x[inside], y[inside], weight[inside, None]
        new = np.linalg.solve((a * c).T @ a + np.diag(penalty), (a * c).T @ t)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def document_features(decision: np.ndarray) -> np.ndarray:
    """What a document is scored by: its three highest decisions, and word counts above LEVELS."""
    distinct = np.unique(np.round(decision, 6))[::-1]
    top = np.full(3, NOTHING)
    top[: len(distinct)] = distinct[:3]
    above = np.array([(distinct > level).sum() for level in LEVELS], dtype=float)
    share = 10 * above / np.sqrt(len(distinct) + 20)
    return np.concatenate([np.clip(top, NOTHING, 2), np.log1p(above), share, [1.0]])


def _fit_logistic(x: np.ndarray, label: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Weights of a logistic curve through the labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(h, x.T @ (p - label) + penalty * w)
        w = w - step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(sentences: list[tuple[int, int, list[str]]], landmarks: int = LANDMARKS) -> Model:
    """A model from labelled sentences: (document number, label, words), one or more for a document.

    With no toxic or no clean sentences, or no word in the toxic ones, every document scores as not
    toxic.
    """
    sentences = _without_copies(sentences)
    owner_label = {doc: label for doc, label, _ in sentences}
    blamed = any(words for _, label, words in sentences if label == 1)
    if set(owner_label.values()) != {0, 1} or not blamed:
        never = np.zeros(len(document_features(np.zeros(0))))
        never[-1] = -3.0
        return Model(np.zeros(SYMBOLS**3, dtype=np.float32), -1.0, never)
    at: dict[str, int] = {}
    by_doc: dict[int, set[int]] = {}
    for doc, _, words in sentences:
        by_doc.setdefault(doc, set()).update(
            at.setdefault(piece, len(at)) for w in words for piece in _pieces(w))
    vocabulary = sorted(at)
    renamed = np.zeros(len(at), dtype=np.int64)
    renamed[[at[w] for w in vocabulary]] = np.arange(len(at))
    docs = sorted(owner_label)
    held = [renamed[sorted(by_doc[d])] for d in docs]
    label = np.array([owner_label[d] for d in docs])
    doc = np.repeat(np.arange(len(docs)), [len(h) for h in held])
    word = np.concatenate([np.sort(h) for h in held]).astype(np.int64)
    toxic = label[doc] == 1

    first = _suspicion(held, vocabulary, label)
    blame = _witnesses(first, doc, word, toxic, len(docs))
    often = np.bincount(word[toxic], minlength=len(vocabulary))
    cleanly = np.bincount(word[~toxic], minlength=len(vocabulary))
    ratio = label.sum() / (1 - label).sum()
    lift = often / ((cleanly + 0.5) * ratio)
    apart = (often > 0) & (lift >= LIFT)  # words that clean documents hardly use
    accused = np.union1d(blame[blame >= 0], np.flatnonzero(apart & (first >= SUSPECT)))
    random = np.random.default_rng(11)
    clean = np.unique(word[~toxic])
    chosen = _unlike(accused[np.argsort(-often[accused], kind="stable")][:1500], vocabulary, landmarks // 2)
    chosen += [w for w in random.permutation(clean).tolist() if w not in set(chosen)][: landmarks - len(chosen)]
    marks = [vocabulary[i] for i in chosen]

    among = _kernel(marks, marks).astype(float)
    values, vectors = np.linalg.eigh(among)
    root = (vectors / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    features = _kernel(vocabulary, marks)
    for low in range(0, len(features), 10_000):
        features[low:low + 10_000] = features[low:low + 10_000] @ root.astype(np.float32)
    decision = first
    for _ in range(ROUNDS):
        witness = np.union1d(blame[apart[blame] & (blame >= 0)], accused)
        if not len(witness):
            witness = np.unique(blame[blame >= 0])
        hard = clean[np.argsort(-decision[clean], kind="stable")[:4000]]
        easy = random.choice(clean, min(len(clean), 8000), replace=False)
        against = np.setdiff1d(np.union1d(hard, easy), witness)
        rows = np.concatenate([witness, against])
        # a witness that clean documents use as well counts on both sides
        both = witness[cleanly[witness] > 0]
        rows = np.concatenate([rows, both])
        y = np.concatenate([np.ones(len(witness)), -np.ones(len(against) + len(both))])
        whole = often[witness].sum()
        weight = 0.5 * np.concatenate([
            often[witness] / whole, np.full(len(against), 1 / max(1, len(against))),
            DOUBT * ratio * cleanly[both] / whole])
        w, bias = _fit_machine(features[rows].astype(float), y, weight)
        decision = features @ w + bias
        blame = _witnesses(decision, doc, word, toxic, len(docs))
        accused = np.flatnonzero(apart & ((first >= SUSPECT) | (decision > 0.5)))
    order = np.argsort(doc, kind="stable")
    parts = np.split(decision[word[order]], np.cumsum(np.bincount(doc, minlength=len(docs)))[:-1])
    reader = _fit_logistic(np.stack([document_features(p) for p in parts]), label)
    folded = np.zeros(SYMBOLS**3)
    for rows, numbers, counts in subsequences(marks):
        np.add.at(folded, numbers, counts * (root @ w)[rows][:, None])
    return Model(folded.astype(np.float32), bias, reader)


def _without_copies(sentences: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, list[str]]]:
    """Without documents most of whose words an earlier one has: what copies share tells nothing.

    Of 16 minimum hashes of a document's words, more than half must agree.
    """
    words: dict[int, set[str]] = {}
    for doc, _, found in sentences:
        words.setdefault(doc, set()).update(found)
    salts = np.random.default_rng(5).integers(1, 2**63, 16).astype(np.uint64) | np.uint64(1)
    met: dict[tuple[int, int], set[int]] = {}
    copies = set()
    for doc in sorted(words):
        hashes = np.array([zlib.crc32(w.encode()) for w in words[doc]], dtype=np.uint64)
        if not len(hashes):
            continue
        least = ((hashes + np.uint64(1)) * salts[:, None] >> np.uint64(20)).min(axis=1).tolist()
        shared: dict[int, int] = {}
        for slot in enumerate(least):
            for other in met.get(slot, ()):
                shared[other] = shared.get(other, 0) + 1
        if any(n > 8 for n in shared.values()):
            copies.add(doc)
            continue
        for slot in enumerate(least):
            met.setdefault(slot, set()).add(doc)
    return [s for s in sentences if s[0] not in copies]


def _unlike(words: np.ndarray, vocabulary: list[str], most: int) -> list[int]:
    """The first words, in order, without those too much like an earlier one."""
    among = _kernel([vocabulary[i] for i in words], [vocabulary[i] for i in words])
    chosen: list[int] = []
    for i in range(len(words)):
        if len(chosen) < most and all(among[i, j] <= ALIKE for j in chosen):
            chosen.append(i)
    return [int(words[i]) for i in chosen]


def _suspicion(held: list[np.ndarray], vocabulary: list[str], label: np.ndarray) -> np.ndarray:
    """A first guess for each word: how much oftener its most telling beginning or middle of four
    characters stands in toxic documents. held: the words of each document.
    """
    at: dict[str, int] = {}
    flat, sizes = [], []
    for word in vocabulary:
        grams = {f"^{word}"[i:i + 4] for i in range(max(1, len(word) - 2))}
        flat += [at.setdefault(g, len(at)) for g in sorted(grams)]
        sizes.append(len(grams))
    flat, size = np.array(flat, dtype=np.int32), np.array(sizes)
    start = np.cumsum(size) - size
    bad, good = np.zeros(len(at)), np.zeros(len(at))
    for words, toxic in zip(held, label, strict=True):
        n = size[words]
        grams = flat[np.repeat(start[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        (bad if toxic else good)[np.unique(grams)] += 1
    odds = np.log((bad + 0.01) / label.sum()) - np.log((good + 0.5) / max(1, (1 - label).sum()))
    odds[bad < 2] = -9.0
    return np.maximum.reduceat(odds[flat], start)


def _witnesses(decision: np.ndarray, doc: np.ndarray, word: np.ndarray, toxic: np.ndarray, n: int) -> np.ndarray:
    """The highest word of each toxic document, -1 for others."""
    out = np.full(n, -1, dtype=np.int64)
    rows = np.flatnonzero(toxic)
    rows = rows[np.argsort(decision[word[rows]], kind="stable")]
    out[doc[rows]] = word[rows]  # the last, highest one stays
    return out


def training_sentences(docs: DataFrame, labels: DataFrame, keep: Column,
                       per_class: int = FIT_DOCUMENTS) -> list[tuple[int, int, list[str]]]:
    """(document, label, distinct units of its sentences) of a bounded sample: per_class documents of
    each class, none over FIT_CHARACTERS.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, label, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "label", "text")),
                                        strict=True):
                found: set[str] = set()
                for sentence in _SENTENCE_END.split(text.lower()):
                    found.update(units(sentence.split()).values(), spelled_out(sentence), joined(sentence))
                rows.append((doc, label, sorted(found)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("doc", "label", "words"), r, strict=True)) for r in rows],
                schema=pa.schema([("doc", pa.int64()), ("label", pa.int32()), ("words", pa.list_(pa.string()))]))

    small_batches(docs.sparkSession)
    short = docs.where(F.length(text_or_empty()) <= FIT_CHARACTERS)
    found = labelled_sample(short, labels, "toxic", keep, per_class).select(
        F.xxhash64("doc_id").alias("doc"), "label", "text"
    ).mapInArrow(run, "doc long, label int, words array<string>").toArrow()
    rows = zip(*(found.column(c).to_pylist() for c in ("doc", "label", "words")), strict=True)
    return sorted(rows)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs; null and empty texts have no word to blame."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tuple(model))  # its size is fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        seen: dict[str, float] = {}
        for batch in batches:
            if len(seen) > _REMEMBERED:
                seen.clear()
            tokens = []
            for text in batch.column("text").to_pylist():
                low = text.lower()
                found = set(low.split())
                if sum(len(t) == 1 for t in found) > 1:
                    found |= set(spelled_out(low))
                found |= joined(low)
                tokens.append(found)
            new = set().union(*tokens).difference(seen)
            words = units(new)
            names = list(set(words.values()))
            value = dict(zip(names, decisions(own, names).tolist(), strict=True))
            seen.update((t, value[words[t]] if t in words else NOTHING) for t in new)
            features = [
                document_features(np.fromiter(map(seen.__getitem__, t), dtype=float, count=len(t)))
                for t in tokens]
            result = _logistic(np.array(features).reshape(len(features), -1) @ own.reader)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(result, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, keep: Column) -> DataFrame:
    """doc_id, score, predicted (1 from 0.5 on) of every row of docs, one row for each.

    keep: which labels (by their doc_id) may be learned from. Texts are read whole. Null texts count
    as empty. Ids may be null or repeated and other columns of docs are not read. Labels that are
    null, contradict each other or belong to no document are not used; without labels of both
    classes nothing is toxic. An empty table gives an empty result.
    """
    model = train(training_sentences(docs, labels, keep))
    return score(docs, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
