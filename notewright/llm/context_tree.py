"""Language-model scores by context-tree weighting over bytes.

A text is its bytes, A-Z lower-cased, and an end mark. A byte is eight binary decisions; each of the
255 decisions (the bits of the byte known so far) has a context tree of its own, whose nodes are the
last 0, 1, ... DEPTH bytes. A node holds the zeros and ones seen below it and estimates by
Krichevsky and Trofimov; weighting mixes a node's own estimate with the product of its children's,
half and half, which is the mixture of all trees of that depth. What is learned are the counts, so
the next bit has the probability that the mixture gives it after all that was learned:

    weight(node) = own / (own + children)     the posterior of a tree that ends here
    P(1) = w0 k0 + (1 - w0) (w1 k1 + (1 - w1) (...))     k the estimates along the context

and a node never seen answers 1/2. Counts are one table row per distinct run of DEPTH + 1 bytes, and
trees are built from it upwards by sums and downwards by joins; runs that end alike lie in one task,
with the lower levels of the trees, and neither the driver nor a task holds the whole. Every run that
occurs in a text gets one logarithm. A text is the
sum of its runs: the HEAD_GRAMS most frequent travel to all tasks, as a table of that size; the
others of a text are joined to theirs.

Beside it stands the plain base: unigrams of words with one added to every count.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.llm.common import durable, small_batches, text_or_empty
from notewright.session import scratch_path

DEPTH = 5  # bytes of context; at most 6, so that a run fits a positive long
HEAD_GRAMS = 1 << 20  # 16 MB
HEAD_TOKENS = 1 << 18
HEAD_TOKEN_BYTES = 32  # longer words are always joined, so that the head has a bound in bytes
START, END = 0xFF, 0xFE  # bytes that UTF-8 never holds
_FOLD = bytes(range(256)).lower()[:END] + bytes([0xFD, 0xFD])
_WINDOW = 1 << 20  # positions worked on at a time
_HELD = 1 << 22  # entries merged before they leave a task
SPLIT = 3  # levels of the trees that are tables; deeper ones are built where their runs are
_GROUP = 1 << 17


# ---------------------------------------------------------------- texts to runs of bytes

def _joined(texts: list[bytes], depth: int) -> np.ndarray:
    """The texts one after the other, each after depth start marks and before an end mark."""
    between = bytes([END]) + bytes([START]) * depth
    return np.frombuffer(
        bytes([START]) * depth + between.join(texts) + bytes([END]), dtype=np.uint8)


def _runs(buffer: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first position, runs, whether a run ends in a byte of a text), a window at a time."""
    for low in range(depth, len(buffer), _WINDOW):
        high = min(len(buffer), low + _WINDOW)
        runs = np.zeros(high - low, dtype=np.int64)
        for back in range(depth, -1, -1):
            runs <<= 8
            runs |= buffer[low - back:high - back]
        yield low, runs, buffer[low:high] != START


def _tallied(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    runs = np.sort(runs)
    first = np.flatnonzero(np.append(True, runs[1:] != runs[:-1])) if len(runs) else np.zeros(0, int)
    return runs[first], np.diff(np.append(first, len(runs)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return [(keys[first], np.add.reduceat(counts, first) if len(first) else counts)]


def _folded(batch: pa.RecordBatch) -> list[bytes]:
    return [t.translate(_FOLD) for t in batch.column("text").to_pylist()]


def _written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: counts are small numbers, and compress."""
    path = scratch_path(df.sparkSession, "context-tree")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


COUNTS = "gram long, token binary, learned boolean, n long"


def _counting(depth: int):
    """Counts of runs of bytes and of words, of texts to learn from and of others."""

    def rows(learned, grams=None, tokens=None) -> pa.RecordBatch:
        if tokens is None:
            keys, counts = grams
            n = len(keys)
            columns = [pa.array(keys), pa.nulls(n, pa.binary()), pa.array([learned] * n, pa.bool_()), pa.array(counts, pa.int64())]
        else:
            n = len(tokens)
            columns = [pa.nulls(n, pa.int64()), pa.array(list(tokens), pa.binary()), pa.array([learned] * n, pa.bool_()),
                       pa.array(list(tokens.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["gram", "token", "learned", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = {True: [], False: []}
        tokens = {True: Counter(), False: Counter()}
        for batch in batches:
            texts, learned = _folded(batch), batch.column("learned").to_pylist()
            for side in (True, False):
                own = [t for t, x in zip(texts, learned, strict=True) if x is side]
                if not own:
                    continue
                for _, runs, real in _runs(_joined(own, depth), depth):
                    grams[side].append(_tallied(runs[real]))
                if sum(len(k) for k, _ in grams[side]) > _HELD:
                    grams[side] = _merged(grams[side])
                    if len(grams[side][0][0]) > _HELD // 2:
                        yield rows(side, grams=grams[side][0])
                        grams[side] = []
                for text in own:
                    tokens[side].update(text.split())
                    if len(tokens[side]) > _HELD // 16:
                        yield rows(side, tokens=tokens[side])
                        tokens[side] = Counter()
        for side in (True, False):
            if grams[side]:
                yield rows(side, grams=_merged(grams[side])[0])
            if tokens[side]:
                yield rows(side, tokens=tokens[side])

    return run


def counts_of(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, token, trained, seen): how often a run or a word was learned, and how often it occurs.

    docs: text binary, learned boolean. One of gram and token is null.
    """
    return (
        docs.select("text", "learned").mapInArrow(_counting(depth), COUNTS)
        .groupBy("gram", "token")
        .agg(F.sum(F.when(F.col("learned"), F.col("n")).otherwise(0)).alias("trained"), F.sum("n").alias("seen")))


# ---------------------------------------------------------------- trees

def log_gamma(z, log):
    """The logarithm of the gamma function, for z > 0: Stirling's series after six steps up.

    z and log are a Column and F.log, or an array and np.log.
    """
    y = z + 6
    series = (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (
        1260 * y * y * y * y * y)
    return series - log(z) - log(z + 1) - log(z + 2) - log(z + 3) - log(z + 4) - log(z + 5)


def log_kt(zeros, ones, log):
    """The logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5, log) + log_gamma(ones + 0.5, log) - log_gamma(zeros + ones + 1.0, log) - math.log(math.pi)


def _mask(depth: int) -> int:
    """Of a node (context, bits so far): the same decision after only the last `depth` bytes."""
    return (1 << (8 * depth + 8)) - 1


class _Nodes:
    """The nodes of some runs from the deepest level up to level `split`; all runs of these belong here.

    A run that was not learned counts 0: its nodes change no weight, and answer as if they were not there.
    """

    def __init__(self, runs: np.ndarray, times: np.ndarray, depth: int, split: int):
        byte, context, n = runs & 255, runs >> 8 << 8, len(runs)
        so_far = [context | 1 << k | byte >> 8 - k for k in range(8)]
        self.bits = np.stack([byte >> 7 - k & 1 for k in range(8)])
        node, self.of_run = np.unique(np.concatenate(so_far), return_inverse=True)
        ones = np.bincount(self.of_run, (self.bits * times).ravel(), len(node)) if n else np.zeros(0)
        zeros = np.bincount(self.of_run, np.tile(times, 8), len(node)) - ones if n else np.zeros(0)
        weighted = log_kt(zeros, ones, np.log)
        self.levels = [(node, zeros, ones, np.ones(len(node)), None)]  # from the deepest up
        for d in range(depth - 1, split - 1, -1):
            node, up = np.unique(node & _mask(d), return_inverse=True)
            zeros, ones, below = (np.bincount(up, x, len(node)) for x in (zeros, ones, weighted))
            own = log_kt(zeros, ones, np.log)
            weighted = np.logaddexp(own, below) - math.log(2)
            self.levels.append((node, zeros, ones, np.exp(own - np.logaddexp(own, below)), up))
        self.top = (node, zeros, ones, weighted)

    def values(self, above: np.ndarray, left: np.ndarray) -> np.ndarray:
        """log10 of each run's probability; above and left: what reaches the nodes of level split."""
        for at in range(len(self.levels) - 1, -1, -1):
            _, zeros, ones, weight, _ = self.levels[at]
            above = above + left * weight * (ones + 0.5) / (zeros + ones + 1)
            left = left * (1 - weight)
            if at:
                above, left = above[self.levels[at][4]], left[self.levels[at][4]]
        one = above[self.of_run].reshape(8, -1)
        return np.log10(np.where(self.bits == 1, one, 1 - one)).sum(axis=0)


def _groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Sorted rows in tables of about `rows`, cut only where the column short changes."""
    held: pa.Table | None = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if held.num_rows < rows:
            continue
        short = held.column("short").to_numpy()
        cut = int(np.searchsorted(short, short[-1]))
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


NODE = "node long, zeros double, ones double, weighted double"


def _upper(depth: int, split: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, _GROUP):
            nodes = _Nodes(rows.column("gram").to_numpy(), rows.column("trained").to_numpy(), depth, split)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in nodes.top], ["node", "zeros", "ones", "weighted"])

    return run


def _valued(depth: int, split: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, _GROUP):
            from_above = rows.column("trained").is_null().to_numpy()
            gram, trained = rows.column("gram").to_numpy()[~from_above], rows.column("trained").to_numpy()[~from_above]
            order = np.argsort(rows.column("gram").to_numpy()[from_above])  # as np.unique sorts nodes
            above, left = (rows.column(c).to_numpy()[from_above][order] for c in ("above", "rest"))
            nodes = _Nodes(gram, trained.astype(np.int64), depth, split)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array(rows.column("seen").to_numpy()[~from_above].astype(np.int64)),
                 pa.array(nodes.values(above, left))], ["gram", "seen", "value"])

    return run


def _inner(level: DataFrame, split: int) -> DataFrame:
    """The nodes of level split with what reaches them from the levels above: node, above, rest."""
    own, below = F.col("own"), F.col("below")
    levels: list[DataFrame] = []
    for d in range(split - 1, -1, -1):
        level = (
            level.groupBy(F.col("node").bitwiseAND(F.lit(_mask(d))).alias("node"))
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
            .withColumn("own", log_kt(F.col("zeros"), F.col("ones"), F.log))
            .select("node", "zeros", "ones",
                    (F.greatest(own, below) + F.log1p(F.exp(-F.abs(own - below))) - math.log(2)).alias("weighted"),
                    (1 / (1 + F.exp(below - own))).alias("weight")))
        level = durable(level)
        levels.insert(0, level)
    estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    reached: DataFrame | None = None
    for d, level in enumerate(levels):
        down = _below(level, reached, d)
        reached = durable(down.select(
            "node", (F.col("above") + F.col("rest") * F.col("weight") * estimate).alias("above"),
            (F.col("rest") * (1 - F.col("weight"))).alias("rest")))
    return reached


def _below(level: DataFrame, reached: DataFrame | None, depth: int) -> DataFrame:
    """The nodes of a level with above and rest of their parents; the root has the whole weight."""
    if reached is None:
        return level.withColumns({"above": F.lit(0.0), "rest": F.lit(1.0)})
    parents = reached.withColumnRenamed("node", "parent")
    return level.withColumn("parent", F.col("node").bitwiseAND(F.lit(_mask(depth - 1)))).join(parents, "parent")


def run_values(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, seen, value): the log10 probability of each run's last byte after the others.

    grams: gram, trained, seen. Runs that share their last SPLIT bytes of context lie in one task, and
    with them all nodes of the levels from there down; the few nodes above are tables of their own.
    """
    split = min(SPLIT, depth)
    short = lambda c: F.shiftrightunsigned(c, 8).bitwiseAND(F.lit((1 << 8 * split) - 1)).alias("short")
    runs = grams.select(short("gram"), "gram", "trained", "seen")
    dealt = runs.repartition("short").sortWithinPartitions("short")
    top = durable(dealt.mapInArrow(_upper(depth, split), NODE))
    reached = _below(top, _inner(top, split) if split else None, split)
    none = lambda kind: F.lit(None).cast(kind)
    both = runs.select("*", none("double").alias("above"), none("double").alias("rest")).unionByName(reached.select(
        short("node"), F.col("node").alias("gram"), none("long").alias("trained"), none("long").alias("seen"), "above", "rest"))
    return both.repartition("short").sortWithinPartitions("short").mapInArrow(
        _valued(depth, split), "gram long, seen long, value double")


# ---------------------------------------------------------------- scores

class Head:
    """Values of the most frequent runs: tables of slots, a run that loses its slot goes to the next."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        """keys: from most to least frequent."""
        self.levels = []
        keys, values = keys[::-1], values[::-1]  # of two in a slot the last written stays
        while len(keys):
            bits = max(4, int(len(keys)).bit_length() + 1)
            slot = self._slot(keys, bits)
            held = np.full(1 << bits, -1, dtype=np.int64)
            own = np.zeros(1 << bits)
            held[slot], own[slot] = keys, values
            self.levels.append((bits, held, own))
            lost = held[slot] != keys
            keys, values = keys[lost], values[lost]

    def _slot(self, keys: np.ndarray, bits: int) -> np.ndarray:
        odd = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.levels))
        return ((keys.astype(np.uint64) * odd) >> np.uint64(64 - bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, whether it was found) of each key."""
        out, missing = np.zeros(len(keys)), np.arange(len(keys))
        levels, self.levels = self.levels, []
        for bits, held, own in levels:
            slot = self._slot(keys[missing], bits)
            hit = held[slot] == keys[missing]
            out[missing[hit]] = own[slot[hit]]
            missing = missing[~hit]
            self.levels.append((bits, held, own))
        found = np.ones(len(keys), dtype=bool)
        found[missing] = False
        return out, found


def _scoring(depth: int, keys: np.ndarray, values: np.ndarray, words: dict[bytes, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Head(keys, values)
        for batch in batches:
            texts = _folded(batch)
            n = len(texts)
            if not n:
                continue
            ends = np.cumsum([len(t) + depth + 1 for t in texts])  # behind each end mark
            score = np.zeros(n)
            rare: list[dict[int, int]] = [{} for _ in texts]
            for low, runs, real in _runs(_joined(texts, depth), depth):
                value, found = head(runs)
                value[~real] = 0.0
                first, last = np.searchsorted(ends, [low, low + len(runs) - 1], side="right")
                cuts = np.append(0, ends[first:last] - low)
                score[first:last + 1] += np.add.reduceat(value, cuts)
                for at in np.flatnonzero(~found & real):
                    own = rare[int(np.searchsorted(ends, low + at, side="right"))]
                    run_ = int(runs[at])
                    own[run_] = own.get(run_, 0) + 1
            tokens, unknown, logs, others = [], [], [], []
            for text in texts:
                split = text.split()
                found = list(map(words.get, split))
                other = Counter(t for t, v in zip(split, found, strict=True) if v is None) if None in found else {}
                tokens.append(len(split))
                unknown.append(found.count(0.0))
                logs.append(math.fsum(v for v in found if v))
                others.append(other)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("learned"), batch.column("digest"),
                pa.array([len(t) for t in texts], pa.int64()), pa.array(score),
                pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64()), pa.array(logs, pa.float64()),
                pa.array([list(r.items()) for r in rare], pa.map_(pa.int64(), pa.int64())),
                pa.array([list(o.items()) for o in others], pa.map_(pa.binary(), pa.int64())),
            ], ["doc_id", "learned", "digest", "n_bytes", "score", "words", "unknown", "logs", "rare", "others"])

    return run


def _summed(marked: DataFrame, column: str, key: str, table: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Of each text: sums over the entries of a map column, joined to the table of their keys."""
    asked = (
        marked.where(F.size(column) > 0).groupBy("digest").agg(F.first(F.map_entries(column)).alias("entries"))
        .select("digest", F.explode("entries").alias("e")).select("digest", F.col("e.key").alias(key), F.col("e.value").alias("times")))
    return asked.join(table, key).groupBy("digest").agg(*[c.alias(n) for n, c in sums.items()])


def lm_scores(docs: DataFrame, learn: Column, depth: int = DEPTH) -> DataFrame:
    """One row per row of docs (doc_id, text): what it costs under the trees and under the base.

    learn: over docs' columns, whether a row is learned from; null means no. Returns doc_id,
    learned, n_tokens (words and one end), n_known (of these, learned at least once), train_tokens,
    base_score, score (both log10 probabilities of the whole text), n_bytes and bits_per_byte (the
    code length, the end mark counted as a byte). A null text is an empty one, which costs its end
    mark. Texts are read whole. Rows may repeat and count as often; ids may be null. Without a row
    to learn from every bit costs one bit and the base is 0. Other columns are not returned; an empty
    table gives an empty result.
    """
    if not 0 <= depth <= 6:
        raise ValueError("depth must lie between 0 and 6")
    spark = docs.sparkSession
    small_batches(spark)
    text = text_or_empty().cast("binary")
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(learn, F.lit(False)).alias("learned"))
    counted = _written(counts_of(rows, depth))
    grams, words = counted.where("gram is not null").drop("token"), counted.where("token is not null").drop("gram")
    values = durable(run_values(grams, depth))
    learned = rows.agg(F.count_if("learned")).first()[0]
    total, distinct = words.agg(F.sum("trained"), F.count_if(F.col("trained") > 0)).first()
    total, distinct = (total or 0) + learned, distinct + (learned > 0)

    log_count = F.log10(F.col("trained") + 1.0)
    head = values.orderBy(F.col("seen").desc(), "gram").limit(HEAD_GRAMS).select("gram", "value").toArrow()
    frequent = (
        words.where(F.octet_length("token") <= HEAD_TOKEN_BYTES)
        .orderBy(F.col("seen").desc(), "token").limit(HEAD_TOKENS).select("token", log_count.alias("log")).toArrow())
    scoring = _scoring(
        depth, head.column("gram").to_numpy(), head.column("value").to_numpy(),
        dict(zip(frequent.column("token").to_pylist(), frequent.column("log").to_pylist(), strict=True)))
    schema = T.StructType([
        docs.select("doc_id").schema[0], *T.StructType.fromDDL(
            "learned boolean, digest string, n_bytes long, score double, words long, unknown long, logs double, "
            "rare map<bigint,bigint>, others map<binary,bigint>").fields])
    marked = durable(rows.withColumn("digest", F.md5("text")).mapInArrow(scoring, schema))

    more = _summed(marked, "rare", "gram", values.select("gram", "value"), {"more": F.sum(F.col("times") * F.col("value"))})
    base = _summed(marked, "others", "token", words.select("token", "trained"), {
        "more_logs": F.sum(F.col("times") * log_count),
        "more_unknown": F.sum(F.when(F.col("trained") == 0, F.col("times")).otherwise(0))})
    or_zero = lambda name: F.coalesce(name, F.lit(0))
    n_tokens = F.col("words") + 1
    score = F.col("score") + or_zero("more")
    each = math.log10(total + distinct + 1)
    return marked.join(more, "digest", "left").join(base, "digest", "left").select(
        "doc_id", "learned", n_tokens.alias("n_tokens"),
        (F.col("words") - F.col("unknown") - or_zero("more_unknown") + int(learned > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + or_zero("more_logs") + math.log10(learned + 1) - n_tokens * each).alias("base_score"),
        score.alias("score"), "n_bytes",
        (-score * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
