"""Groups of an inverted index, met in bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import durable

BLOCK = 4096
HELD_BYTES = 64 << 20  # rows may carry texts


def in_blocks(postings: DataFrame, member: str, block: int = BLOCK) -> DataFrame:
    """postings (key, member, ...) with columns own, one and two: a row's block, the pair it meets in.

    A key of at most block rows is one block, (0, 0). A larger key is dealt over n blocks by a hash
    of the member, and a row of block i comes once for every pair (i, j): any two rows of a key
    meet in exactly one pair of blocks if their blocks differ, and in n if they are the same, of
    which (i, i) is the one that counts.
    """
    spark = postings.sparkSession
    hot = durable(
        postings.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > block)
        .select("key", F.ceil(F.col("rows") / block).cast("int").alias("blocks")))
    zero = F.lit(0)
    if hot.isEmpty():  # the same rows as below, without the join
        return postings.select("*", zero.alias("own"), zero.alias("one"), zero.alias("two"))
    spread = (
        postings.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
        .withColumn("met", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    )
    return spread.select(
        *postings.columns, "own", F.least("own", "met").alias("one"), F.greatest("own", "met").alias("two"))


def by_group(postings: DataFrame, work: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None],
             schema: str) -> DataFrame:
    """Run work over rows of whole (key, one, two) groups: many small groups at a time.

    work gets a table sorted by group and the first row of each group. Rows stream through in
    batches; what is held is a batch and one group, and in_blocks bounds groups.
    """
    group = ["key", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows < 20_000 and held.nbytes < HELD_BYTES:
                continue
            starts = _starts(held, group)
            if len(starts) == 1:
                continue
            done = held.slice(0, int(starts[-1]))
            out = work(done.combine_chunks(), starts[:-1])
            if out is not None and out.num_rows:
                yield out
            held = held.slice(int(starts[-1])).combine_chunks()
        if held is not None and held.num_rows:
            out = work(held.combine_chunks(), _starts(held, group))
            if out is not None and out.num_rows:
                yield out

    return (
        postings.repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(run, schema)
    )


def _starts(rows: pa.Table, group: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    new[0] = True
    for name in group:
        values = rows.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest linked row of each of n rows, links being (a[i], b[i])."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, before):
            return root
