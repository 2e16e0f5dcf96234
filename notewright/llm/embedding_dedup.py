"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

For each length of vectors, on a bounded sample, rotations of the principal axes are learned, each so
that the signs of the rotated coordinates lose least against the coordinates themselves. The signs
are a vector's code. Codes are cut into pieces of at most TABLE_BITS, each posted in a table of its
own; two vectors meet if they have one length and label and a piece agrees. Pairs whose whole codes
are close enough stay, and only vectors with such a partner are met again, with their original
components, for the exact cosine. How many rotations a length needs follows from the chance that a
pair at the wanted cosine agrees in no piece, which is to be at most MISSED. Copies of a vector are
one posting. Pairs are counted and linked within bounded blocks and are never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.common import durable
from notewright.llm.components import components
from notewright.llm.groups import BLOCK, by_group, forest, in_blocks

COSINE = 0.98
MOST_CODE_BITS = 64  # of one rotation
TABLE_BITS = 16
LEAST_TABLE_BITS = 12  # short vectors put several rotations in a table
MISSED = 0.05  # of pairs at the wanted cosine; closer ones are missed less
CODE_SHARE = 0.2  # of all code bits may differ at least
FIT_ROWS = 10_000  # vectors of a length the rotations are learned from
FIT_ROUNDS = 40
FIT_PARTS = 16  # the sample is picked in so many parts
LINKS = "class_id long, links long, root long"
_STRIP = 512


class Plan:
    """Rotations, tables and bounds for vectors of a length, at a cosine."""

    def __init__(self, size: int, cosine: float):
        bits = min(size, MOST_CODE_BITS)
        self.flips = math.acos(min(1.0, max(-1.0, cosine))) / math.pi  # chance that a bit differs
        together = math.ceil(LEAST_TABLE_BITS / bits)  # rotations in a table
        cuts = math.ceil(bits / TABLE_BITS) if together == 1 else 1  # tables in a rotation
        widest = math.ceil(bits / cuts) * together
        tables = math.log(MISSED) / math.log1p(-min((1 - self.flips) ** widest, 1 - 1e-9))
        self.rotations = together * math.ceil(tables / cuts)
        self.bits = bits * self.rotations
        rotation = np.split(np.arange(self.bits), self.rotations)
        self.pieces = (
            [p for r in rotation for p in np.array_split(r, cuts)] if together == 1
            else [np.concatenate(rotation[i:i + together]) for i in range(0, self.rotations, together)])

    def most(self) -> int:
        """Bits of the whole code that may differ: what all but a few pairs at the cosine keep to."""
        spread = 4 * math.sqrt(self.bits * self.flips * (1 - self.flips))
        return math.ceil(max(CODE_SHARE * self.bits, self.bits * self.flips + spread))


def learn_rotations(sample: np.ndarray, rotations: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): the code of unit vectors x is (x - mean) @ projection > 0."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    bits = min(sample.shape[1], MOST_CODE_BITS)
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
    flat = centred @ axes
    random = np.random.default_rng(7)
    learned = []
    for place in range(rotations):
        turn = np.linalg.qr(random.normal(size=(bits, bits)))[0]
        # in few dimensions all starts end in much the same rotation; later ones stay near theirs
        for _ in range(max(1, FIT_ROUNDS >> place)):
            left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        learned.append(axes @ turn)
    return mean, np.concatenate(learned, axis=1)


def usable(vector: str, label: str) -> Column:
    """Whether a row can have links: a label, and finite components that are not all 0."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(
        F.col(label).isNotNull() & (F.size(x) > 0) & finite
        & F.exists(x, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fitted(classes: DataFrame, cosine: float) -> DataFrame:
    """(size, mean, projection): what is learned for each length, from at most FIT_ROWS vectors."""

    def learn(rows: pa.Table) -> pa.Table:
        size = len(rows.column("vector")[0])
        sample = _units(_matrix(rows.column("vector").combine_chunks(), size))
        mean, projection = learn_rotations(sample, Plan(size, cosine).rotations)
        return pa.table({"size": pa.array([size], pa.int32()), "mean": [mean.tobytes()], "projection": [projection.tobytes()]})

    order = F.xxhash64("label", "class_id")
    part = Window.partitionBy("size", F.pmod(order, F.lit(FIT_PARTS))).orderBy(order, "class_id")
    sample = classes.withColumn("place", F.row_number().over(part)).where(F.col("place") <= FIT_ROWS // FIT_PARTS)
    return sample.select("size", "vector").groupBy("size").applyInArrow(learn, "size int, mean binary, projection binary")


def codes(classes: DataFrame, learned: DataFrame, cosine: float) -> DataFrame:
    """classes with (class_id, label, size, code, parts): packed code, and its pieces in all tables.

    Rows of a length are dealt over parts; what was learned for the length comes before them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = mean = projection = None
        for batch in batches:
            models = np.flatnonzero(batch.column("mean").is_valid().to_numpy(zero_copy_only=False))
            for start, end in zip(np.append(0, models), np.append(models, batch.num_rows), strict=True):
                rows = batch.slice(start, end - start)
                if rows.num_rows and rows.column("mean")[0].is_valid:
                    size = rows.column("size")[0].as_py()
                    plan = Plan(size, cosine)
                    mean = np.frombuffer(rows.column("mean")[0].as_py())
                    projection = np.frombuffer(rows.column("projection")[0].as_py()).reshape(size, -1)
                    rows = rows.slice(1)
                if not rows.num_rows:
                    continue
                on = (_units(_matrix(rows.column("vector"), projection.shape[0])) - mean) @ projection > 0
                parts = np.stack([on[:, p] @ (1 << np.arange(len(p))) for p in plan.pieces], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("class_id"), rows.column("label"), rows.column("size"),
                     pa.array([row.tobytes() for row in np.packbits(on, axis=1)], pa.binary()),
                     pa.array(parts.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                    ["class_id", "label", "size", "code", "parts"])

    keys = ["size", "part"]
    parts = classes.sparkSession.sparkContext.defaultParallelism
    rows = classes.select("size", F.pmod("class_id", F.lit(parts)).alias("part"), "class_id", "label", "vector")
    models = learned.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(0))
    both = models.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, "kind").select(
        "class_id", "label", "size", "vector", "mean", "projection").mapInArrow(
        run, "class_id long, label string, size int, code binary, parts array<int>")


def _codes_of(rows: pa.Table) -> np.ndarray:
    joined = b"".join(rows.column("code").to_pylist())
    return np.frombuffer(joined, dtype=np.uint8).reshape(rows.num_rows, -1)


def _groups(rows: pa.Table, starts: np.ndarray) -> Iterator[tuple[int, pa.Table]]:
    """(first row, rows) of every group of two or more."""
    for start, end in zip(starts, np.append(starts[1:], rows.num_rows), strict=True):
        if end - start > 1:
            yield int(start), rows.slice(start, end - start)


def _strips(n: int) -> Iterator[slice]:
    for low in range(0, n, _STRIP):
        yield slice(low, min(n, low + _STRIP))


def _close(code: np.ndarray, strip: slice, most: int) -> np.ndarray:
    apart = np.zeros((strip.stop - strip.start, len(code)), dtype=np.uint16)
    for byte in range(code.shape[1]):
        apart += np.bitwise_count(code[strip, byte][:, None] ^ code[:, byte])
    near = apart <= most
    near[np.arange(strip.stop - strip.start), np.arange(strip.start, strip.stop)] = False
    return near


def _with_partner(cosine: float):
    def work(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        keep = np.zeros(rows.num_rows, dtype=bool)
        for first, group in _groups(rows, starts):
            code, most = _codes_of(group), Plan(group.column("size")[0].as_py(), cosine).most()
            for strip in _strips(len(code)):
                keep[first + strip.start:first + strip.stop] |= _close(code, strip, most).any(axis=1)
        kept = rows.filter(pa.array(keep)).select(["key", "table", "class_id"]).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in kept.columns], kept.column_names)

    return work


def _counted(cosine: float):
    """Per row of a group: copies linked to it, and its smallest linked row."""

    def work(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        ids, copies = rows.column("class_id").to_numpy(), rows.column("copies").to_numpy()
        links, root = np.zeros(rows.num_rows, dtype=np.int64), np.arange(rows.num_rows)
        for first, group in _groups(rows, starts):
            n = group.num_rows
            size = group.column("size")[0].as_py()
            most = Plan(size, cosine).most()
            code, x = _codes_of(group), _matrix(group.column("vector").combine_chunks(), size)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            norms = np.linalg.norm(x, axis=1)
            own = group.column("own").to_numpy()
            within = group.column("one")[0].as_py() == group.column("two")[0].as_py()
            parts = np.array(group.column("parts").to_pylist(), dtype=np.int32).reshape(n, -1)
            tree, every = np.arange(n), np.arange(n)
            for strip in _strips(n):
                near = _close(code, strip, most)
                # a pair counts in the first of its tables, and in one pair of blocks
                for t in range(group.column("table")[0].as_py()):
                    near &= parts[strip, t][:, None] != parts[:, t]
                if not within:
                    near &= own[strip][:, None] != own
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                a = a + strip.start
                dots = np.concatenate([
                    np.einsum("ij,ij->i", x[a[i:i + 65536]], x[b[i:i + 65536]]) for i in range(0, len(a), 65536)])
                linked = dots / (norms[a] * norms[b]) >= cosine
                a, b = a[linked], b[linked]
                np.add.at(links, first + a, copies[first + b])
                tree = forest(n, np.concatenate([every, a]), np.concatenate([tree, b]))
            root[first:first + n] = first + tree
        hit = np.flatnonzero(links)
        return pa.RecordBatch.from_pydict({"class_id": ids[hit], "links": links[hit], "root": ids[root[hit]]})

    return work


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """(class_id, links, root) of distinct vectors (class_id, label, size, vector, copies)."""
    coded = durable(codes(classes, fitted(classes, cosine), cosine))
    postings = coded.select("class_id", "code", "size", "label", F.posexplode("parts").alias("table", "part")).select(
        "class_id", "code", "size", "table", F.concat_ws("/", "size", "table", "part", "label").alias("key"))
    members = by_group(
        in_blocks(postings, "class_id", BLOCK), _with_partner(cosine), "key string, table int, class_id long").distinct()
    met = in_blocks(durable(
        members.join(coded.select("class_id", "size", "code", "parts"), "class_id")
        .join(classes.select("class_id", "vector", "copies"), "class_id")), "class_id", BLOCK)
    return by_group(met, _counted(cosine), LINKS)


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors are compared only if their labels are equal and not null, and their lengths are equal;
    labels are of any type that casts to text. A vector that is null, empty, zero, or that holds a
    null or non-finite component links with nothing, not even with its copies. Every length has
    rotations and tables of its own, and all its vectors go through them. n_links counts the other rows
    linked directly; component_id is the smallest vec_id reachable. Ids should be unique and not
    null; rows that repeat an id count as so many vectors, and a row without id has no component.
    Other columns are not read. An empty table gives an empty result.
    """
    rows = vectors.select(
        "vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").alias("vector"),
    ).withColumn("ok", usable("vector", "label"))
    classes = durable(
        rows.where("ok").groupBy("label", "vector")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .withColumn("class_id", F.xxhash64("label", "vector")))
    linked = _links(classes.withColumn("size", F.size("vector")), cosine)
    linked = durable(linked)
    joined = components(linked.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("class_id").agg(F.sum("links").alias("links"))
    named = (
        classes.join(counts, "class_id", "left")
        .join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
        .withColumn("component", F.coalesce("component", "class_id")))
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "component").select(
        F.col("label").alias("own_label"), F.col("vector").alias("own_vector"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = rows.join(
        named, F.col("ok") & (rows.label == named.own_label) & (rows.vector == named.own_vector), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
