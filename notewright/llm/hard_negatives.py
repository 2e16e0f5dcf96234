"""Hard negatives of anchor vectors, from Hilbert-ordered blocks with zone maps.

Vectors become whole numbers, and are ordered by length, label and place on a Hilbert curve, so that
neighbours share a block. Blocks go to Parquet, one row each: ids, vectors, and the smallest and
largest value of every dimension. A score is an inner product; over a block it lies between

    sum_i min(a_i low_i, a_i high_i)  and  sum_i max(a_i low_i, a_i high_i)

so an anchor need not read a block that can't reach what it looks for:

1. Writing blocks, every anchor is scored against its own block. Its POSITIVES-th best row of its
   label is a floor for its positives.
2. Blocks of its label that may reach the floor are read; that gives its positives.
3. Every positive opens a window of scores. Blocks of other labels that may hold a score of one of
   the windows are read; the best NEGATIVES of each window stay.

Bounds are computed from pages of zone maps, never from the vectors. Anchors are dealt in groups, and
a group's blocks in parts, so that a task holds one group and one block at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.common import durable, small_batches
from notewright.session import scratch_path

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
SCALE = 256
BLOCK_ROWS = 256
PAGE_BLOCKS = 256
GROUP_ANCHORS = 2048
TASK_BLOCKS = 64  # of one group, read by one task
TASK_PAGES = 16
CURVE_BITS, CURVE_DIMENSIONS = 5, 12
_LARGEST = 1 << 28  # length of a vector in whole numbers: scores stay below 2^56
_STRIP = 512
_TRIPLES = 1 << 18


# ---------------------------------------------------------------- the curve

def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (n x dimensions, 0 <= cell < 2^bits) on the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    if not n:
        return np.zeros(cells.shape[0], dtype=np.int64)
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:
        low = bit - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = top
    while bit > 1:
        flip = np.where((x[n - 1] & bit) != 0, flip ^ (bit - 1), flip)
        bit >>= 1
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def _cells(q: np.ndarray) -> np.ndarray:
    """Length (by powers of two) and direction (in some dimensions) of whole vectors, as cells."""
    size, most = q.shape[1], (1 << CURVE_BITS) - 1
    norm = np.linalg.norm(q.astype(float), axis=1)
    long = np.clip(np.floor(np.log2(np.maximum(norm, 1))), 0, most)
    picked = np.unique(np.linspace(0, size - 1, min(size, CURVE_DIMENSIONS - 1)).astype(int)) if size else []
    turned = q[:, picked] / np.maximum(norm, 1)[:, None] * math.sqrt(max(size, 1))
    return np.column_stack([long, np.clip((turned + 3) / 6 * (most + 1), 0, most)]).astype(np.int64)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = np.zeros(batch.num_rows, dtype=np.int64)
        lists = batch.column("q")
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            q = lists.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(len(own), size)
            place[own] = hilbert(_cells(q), CURVE_BITS)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])


# ---------------------------------------------------------------- rows, blocks, pages, groups

ROW = "vec_id long, label string, anchor boolean, size int, q array<int>"
BLOCK = ("block long, size int, label string, ids array<long>, q binary, low binary, high binary, "
         "anchors array<int>, floors array<long>")


def whole_rows(vectors: DataFrame, anchors: Column, scale: int) -> DataFrame:
    """The rows that take part, each once, with their vectors in whole numbers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    # in doubles, for a vector that is too long may not fit whole numbers at all
    largest = F.coalesce(F.array_max(F.transform(x, lambda v: F.abs(v.cast("double")) * float(scale))), F.lit(0.0))
    floors = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    return (
        vectors.where(
            F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
            & ((largest + 1) * F.sqrt(F.size(x)) <= float(_LARGEST)))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
            F.coalesce(anchors, F.lit(False)).alias("anchor"), F.size(x).alias("size"),
            floors.cast("array<int>").alias("q"))
        .distinct())


def _matrix(data: bytes, size: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int32).reshape(rows, size)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exactly."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if reach < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _runs_of(columns: list[np.ndarray], most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of equal values of all columns, of at most `most` rows."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(new)
    for start, end in zip(starts, np.append(starts[1:], n), strict=True):
        for low in range(start, end, most):
            yield low, min(end, low + most)


def _whole_runs(batches: Iterator[pa.RecordBatch], by: list[str], most: int) -> Iterator[pa.Table]:
    """Tables of at most `most` rows that agree in `by`, of sorted rows; no run is cut by a batch."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        cuts = list(_runs_of([held.column(c).to_numpy() for c in by], most)) if held.num_rows else []
        for start, end in cuts[:-1]:
            yield held.slice(start, end - start).combine_chunks()
        if cuts:
            held = held.slice(cuts[-1][0])
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _floor_of_own(own: np.ndarray, ids: np.ndarray, anchors: np.ndarray, positives: int) -> list[int | None]:
    scores = _products(own[anchors], own)
    out = []
    for at, row in zip(anchors, scores, strict=True):
        others = row[ids != ids[at]]
        out.append(int(np.sort(others)[-positives]) if len(others) >= positives else None)
    return out


def _packed(positives: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in _whole_runs(batches, ["size", "label"], block_rows):
            ids = rows.column("vec_id").to_numpy()
            size = int(rows.column("size")[0].as_py())
            q = rows.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), size).astype(np.int32)
            anchors = np.flatnonzero(rows.column("anchor").to_numpy())
            yield pa.RecordBatch.from_pylist([{
                "block": number, "size": size, "label": rows.column("label")[0].as_py(), "ids": ids, "q": q.tobytes(),
                "low": q.min(axis=0).tobytes(), "high": q.max(axis=0).tobytes(), "anchors": anchors.astype(np.int32),
                "floors": _floor_of_own(q, ids, anchors, positives)}], schema=_BLOCK_ARROW)
            number += 1

    return run


_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("size", pa.int32()), ("label", pa.string()), ("ids", pa.list_(pa.int64())),
    ("q", pa.binary()), ("low", pa.binary()), ("high", pa.binary()),
    ("anchors", pa.list_(pa.int32())), ("floors", pa.list_(pa.int64()))])


def write_blocks(rows: DataFrame, positives: int = POSITIVES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows in the order of the curve, as Parquet blocks in the shared folder."""
    spark = rows.sparkSession
    order = ["size", "label", "place", "vec_id"]
    path = scratch_path(spark, "hilbert-blocks")
    (rows.mapInArrow(_places, f"{ROW}, place long").repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(_packed(positives, block_rows), BLOCK).write.parquet(path))
    return spark.read.parquet(path)


PAGE = "page long, size int, blocks array<long>, labels array<string>, low binary, high binary"


def zone_pages(blocks: DataFrame, page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """The zone maps of up to page_blocks blocks a row; vectors are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for zones in _whole_runs(batches, ["size"], page_blocks):
            yield pa.RecordBatch.from_pylist([{
                "page": number, "size": zones.column("size")[0].as_py(), "blocks": zones.column("block").to_pylist(),
                "labels": zones.column("label").to_pylist(), "low": b"".join(zones.column("low").to_pylist()),
                "high": b"".join(zones.column("high").to_pylist())}], schema=pa.schema([
                    ("page", pa.int64()), ("size", pa.int32()), ("blocks", pa.list_(pa.int64())),
                    ("labels", pa.list_(pa.string())), ("low", pa.binary()), ("high", pa.binary())]))
            number += 1

    return (blocks.select("size", "block", "label", "low", "high").repartitionByRange("size", "block")
            .sortWithinPartitions("size", "block").mapInArrow(run, PAGE))


GROUP = "group long, size int, ids array<long>, labels array<string>, q binary, floors array<long>"


def anchor_groups(blocks: DataFrame, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """The anchors of neighbouring blocks, up to group_anchors a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in _whole_runs(batches, ["size"], group_anchors):
            yield pa.RecordBatch.from_pylist([{
                "group": number, "size": rows.column("size")[0].as_py(), "ids": rows.column("id").to_pylist(),
                "labels": rows.column("label").to_pylist(), "q": b"".join(rows.column("vector").to_pylist()),
                "floors": rows.column("floor").to_pylist()}], schema=pa.schema([
                    ("group", pa.int64()), ("size", pa.int32()), ("ids", pa.list_(pa.int64())),
                    ("labels", pa.list_(pa.string())), ("q", pa.binary()), ("floors", pa.list_(pa.int64()))]))
            number += 1

    width = F.col("size") * 4
    anchors = (
        blocks.where(F.size("anchors") > 0).withColumn("both", F.explode(F.arrays_zip("anchors", "floors")))
        .select(
            "size", "block", "label", F.col("ids")[F.col("both.anchors")].alias("id"),
            F.substring("q", F.col("both.anchors") * width + 1, width).alias("vector"), F.col("both.floors").alias("floor")))
    return anchors.repartitionByRange("size", "block", "id").sortWithinPartitions("size", "block", "id").mapInArrow(run, GROUP)


# ---------------------------------------------------------------- a group against its blocks

class _Anchors:
    """A group of anchors in a task."""

    def __init__(self, row: dict):
        self.group, self.size = row["group"], row["size"]
        self.ids = np.array(row["ids"], dtype=np.int64)
        self.labels = np.array(row["labels"], dtype=object)
        self.q = _matrix(row["q"], self.size, len(self.ids))
        self.low = np.array([np.iinfo(np.int64).min if v is None else v for v in row["low"]], dtype=np.int64)
        self.high = np.array(row["high"], dtype=np.int64)
        self.owner = np.array(row["owner"], dtype=np.int64)  # the anchor of each window
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.least = self.low.copy()  # of a window, what still can enter its best


def _met(groups: DataFrame, items: DataFrame, work: Callable[[_Anchors, dict], list[dict]],
         last: Callable[[_Anchors], list[dict]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Run work(anchors, item) for all items (group, part, ...) of a group, then last(anchors).

    A group's row comes before its items; what a task holds is one group and one batch of items.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Anchors | None = None
        for batch in batches:
            out: list[dict] = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if row.column("anchors")[0].is_valid:
                    out += last(anchors) if anchors else []
                    anchors = _Anchors(row.column("anchors")[0].as_py())
                else:
                    out += work(anchors, row.column("item")[0].as_py())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if anchors and (out := last(anchors)):
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    keys = ["group", "part"]
    own = items.select(*keys).distinct().join(
        groups.select("group", F.struct(*groups.columns).alias("anchors")), "group")
    item = F.struct(*[c for c in items.columns if c not in keys]).alias("item")
    both = own.select(*keys, F.lit(0).alias("kind"), "anchors").unionByName(
        items.select(*keys, F.lit(1).alias("kind"), item), allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(run, schema)


NEED = "group long, block long, members array<int>"
_NEED_ARROW = pa.schema([("group", pa.int64()), ("block", pa.int64()), ("members", pa.list_(pa.int32()))])


def _bounded(same_label: bool):
    """Which windows of a group may find a score in which blocks of a page."""

    def work(anchors: _Anchors, page: dict) -> list[dict]:
        n = len(page["blocks"])
        low, high = (_matrix(page[x], anchors.size, n).astype(float) for x in ("low", "high"))
        labels = np.array(page["labels"], dtype=object)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for start in range(0, len(anchors.owner), _STRIP):
            owner = anchors.owner[start:start + _STRIP]
            a = anchors.q[owner].astype(float)
            up, down = np.maximum(a, 0), np.minimum(a, 0)
            most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
            slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T)  # beyond 2^53 sums are rounded
            fits = (most + slack >= anchors.low[start:start + _STRIP, None]) & (
                least - slack <= anchors.high[start:start + _STRIP, None])
            fits &= (anchors.labels[owner][:, None] == labels) == same_label
            window, block = np.nonzero(fits)
            out.append((window + start, block))
        windows, blocks = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 2
        if not len(blocks):
            return []
        order = np.argsort(blocks, kind="stable")
        windows, blocks = windows[order], blocks[order]
        first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        return [{"group": anchors.group, "block": page["blocks"][blocks[s]], "members": windows[s:e].astype(np.int32)}
                for s, e in zip(first, np.append(first[1:], len(blocks)), strict=True)]

    return work


def needed_blocks(groups: DataFrame, pages: DataFrame, same_label: bool) -> DataFrame:
    """(group, block, members): the blocks a group must read, and for which of its windows."""
    parts = max(1, math.ceil(pages.count() / TASK_PAGES))
    items = pages.join(groups.select("group", "size"), "size").withColumn("part", F.pmod(F.xxhash64("page"), F.lit(parts)))
    return durable(_met(groups, items.select("group", "part", "blocks", "labels", "low", "high"),
                        _bounded(same_label), lambda anchors: [], NEED, _NEED_ARROW))


FOUND = "group long, window int, owner long, score long, vec_id long"
_FOUND_ARROW = pa.schema([("group", pa.int64()), ("window", pa.int32()), ("owner", pa.int64()),
                          ("score", pa.int64()), ("vec_id", pa.int64())])


def _first(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (window, score, id) the first `most` of each window: higher scores, then smaller ids."""
    window, score, ids = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, -score, window))
    window, score, ids = window[order], score[order], ids[order]
    start = np.searchsorted(window, window, side="left")
    keep = np.arange(len(window)) - start < most
    return window[keep], score[keep], ids[keep]


def _reading(most: int):
    def settle(anchors: _Anchors) -> None:
        window, score, ids = _first(anchors.best, most)
        anchors.best = [(window, score, ids)]
        full = np.flatnonzero(np.append(window[1:] != window[:-1], True))
        full = full[np.arange(len(window))[full] - np.searchsorted(window, window[full]) == most - 1]
        anchors.least[window[full]] = np.maximum(anchors.low[window[full]], score[full])

    def work(anchors: _Anchors, block: dict) -> list[dict]:
        ids = np.array(block["ids"], dtype=np.int64)
        q = _matrix(block["q"], anchors.size, len(ids))
        members = np.array(block["members"], dtype=np.int64)
        for start in range(0, len(members), _STRIP):
            window = members[start:start + _STRIP]
            owner, turn = np.unique(anchors.owner[window], return_inverse=True)
            score = _products(anchors.q[owner], q)[turn]
            fits = (score >= anchors.least[window][:, None]) & (score <= anchors.high[window][:, None])
            fits &= anchors.ids[anchors.owner[window]][:, None] != ids
            w, r = np.nonzero(fits)
            if len(w):
                anchors.best.append((window[w], score[w, r], ids[r]))
                if sum(len(x[0]) for x in anchors.best) > _TRIPLES:
                    settle(anchors)
        if len(anchors.best) > 1:
            settle(anchors)
        return []

    def last(anchors: _Anchors) -> list[dict]:
        if not anchors.best:
            return []
        return [{"group": anchors.group, "window": int(w), "owner": int(anchors.owner[w]), "score": int(s), "vec_id": int(i)}
                for w, s, i in zip(*_first(anchors.best, most), strict=True)]

    return work, last


def best_of_needed(groups: DataFrame, needs: DataFrame, blocks: DataFrame, most: int) -> DataFrame:
    """(group, window, owner, score, vec_id, rank): the best rows of every window."""
    parts = max(1, math.ceil(blocks.count() / TASK_BLOCKS))
    items = needs.join(blocks.select("block", "ids", "q"), "block").select(
        "group", F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), "ids", "q", "members")
    work, last = _reading(most)
    found = _met(groups, items, work, last, FOUND, _FOUND_ARROW)
    order = Window.partitionBy("group", "window").orderBy(F.col("score").desc(), "vec_id")
    return durable(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most))


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST, most: int = MOST, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors: vec_id, label, embedding; anchors: over its columns, which rows are anchors (null: no).
    Components become floor(scale * x); scores are inner products of these. An anchor's positives
    are its best other rows of its label; for each, the best rows of other labels are returned that
    score between least and most percent of it. Ties go to the smaller vec_id. Vectors meet only
    if they have the same length. Rows with a null vec_id, label or vector, or a null or non-finite
    component take no part, nor do vectors so long (2^28 in whole numbers) that scores would leave a
    long. Equal rows count once; other rows that share an id count each, and are no negatives or
    positives of one another. Other columns are not read; an empty table gives an empty result.
    """
    small_batches(vectors.sparkSession)
    blocks = write_blocks(whole_rows(vectors, anchors, scale), positives, block_rows)
    pages, groups = durable(zone_pages(blocks)), durable(anchor_groups(blocks))
    top = F.lit((1 << 62)).cast("long")
    base = ["group", "size", "ids", "labels", "q"]
    asking = groups.select(
        *base, F.col("floors").alias("low"), F.transform("floors", lambda _: top).alias("high"),
        F.transform("floors", lambda _, i: i.cast("long")).alias("owner"))
    own = best_of_needed(asking, needed_blocks(asking, pages, True), blocks, positives)
    # least * p <= 100 * score <= most * p, in whole numbers; div rounds towards zero
    up = f"({least}L * score) div 100L + if({least}L * score > 0 and ({least}L * score) % 100L <> 0, 1L, 0L)"
    down = f"({most}L * score) div 100L - if({most}L * score < 0 and ({most}L * score) % 100L <> 0, 1L, 0L)"
    window = F.struct("owner", "rank", F.expr(up).alias("low"), F.expr(down).alias("high"))
    windows = own.groupBy("group").agg(F.array_sort(F.collect_list(window)).alias("w"))
    asked = durable(groups.join(windows, "group").select(
        *base, *[F.col(f"w.{n}").alias(n) for n in ("low", "high", "owner")], "w"))
    seeking = asked.drop("w")
    found = best_of_needed(seeking, needed_blocks(seeking, pages, False), blocks, negatives)
    named = asked.select("group", "ids", F.posexplode("w").alias("window", "w")).select(
        "group", "window", F.col("ids")[F.col("w.owner").cast("int")].alias("anchor_id"), F.col("w.owner").alias("owner"),
        F.col("w.rank").alias("place"))
    chosen = own.select("group", "owner", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return (
        found.select("group", "window", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                     F.col("score").alias("negative_score"))
        .join(named, ["group", "window"]).join(chosen, ["group", "owner", "place"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
