"""Near-duplicate texts by SimHash, found through an inverted index of fingerprint bytes.

Two 64-bit fingerprints that differ in at most 4 bits agree in at least 4 of their 8 bytes. The
index posts a fingerprint under its bytes at three positions; the 20 position triples are chosen
so that any 4 positions hold one of them, and so every pair with 4 equal bytes meets. Of each pair
that meets the equal bytes are tallied, pairs below the guaranteed number go, and the rest is
verified by counting bits.

Only distinct fingerprints are indexed, so copies of a text cost one posting list entry. Links are
reduced to a forest within each posting list before they leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import durable, small_batches, text_or_empty
from notewright.llm.components import components
from notewright.llm.groups import by_group, forest, in_blocks

WORDS = 4  # in a shingle
MOST_BITS = 4
SEED = 42
BYTES = 8
_FLUSH = 200_000  # shingles counted at a time


def position_triples() -> list[tuple[int, int, int]]:
    """Triples of byte positions of which any 4 positions contain one (a Turan system).

    Positions fall into three classes; taken are triples within a class, and triples of two
    positions of a class and one of the next class.
    """
    triples = []
    for x in range(BYTES):
        for y in range(x + 1, BYTES):
            for z in range(y + 1, BYTES):
                classes = sorted((x % 3, y % 3, z % 3))
                if classes[0] == classes[2]:
                    triples.append((x, y, z))
                elif len(set(classes)) == 2:
                    twice = classes[1]
                    once = classes[0] + classes[2] - twice
                    if once == (twice + 1) % 3:
                        triples.append((x, y, z))
    return triples


def fingerprints_of(texts: list[bytes], words: int = WORDS) -> np.ndarray:
    """SimHash of each text as uint64; a bit is set if more than half of the shingles set it."""
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    many = np.zeros(len(texts), dtype=np.int64)
    owners: list[int] = []
    sizes: list[int] = []
    hashes: list[int] = []

    def flush() -> None:
        if not hashes:
            return
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
        owners.clear(), sizes.clear(), hashes.clear()

    for row, text in enumerate(texts):
        tokens = text.lower().split()
        if not tokens:
            continue
        joined = memoryview(b" ".join(tokens))
        ends = (np.cumsum([len(t) + 1 for t in tokens]) - 1).tolist()
        starts = [0, *(e + 1 for e in ends)]
        last = min(words, len(tokens)) - 1
        count = len(tokens) - last
        many[row] = count
        for begin in range(0, count, _FLUSH):
            end = min(count, begin + _FLUSH)
            hashes += [
                xxhash.xxh64_intdigest(joined[starts[i]:ends[i + last]], SEED)
                for i in range(begin, end)]
            owners.append(row)
            sizes.append(end - begin)
            if len(hashes) >= _FLUSH:
                flush()
    flush()
    return np.packbits(2 * ones > many[:, None], axis=1).view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fingerprint (a long) of every row; null texts count as empty, which gives 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = fingerprints_of(batch.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))],
                ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    small_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, fingerprint long")


def _linked(prints: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs are linked: those short of the guaranteed tally of equal bytes go, the rest is verified."""
    differing = prints[a] ^ prints[b]
    kept = np.count_nonzero(differing.view(np.uint8).reshape(-1, BYTES) == 0, axis=1) >= BYTES - bits
    kept[kept] = np.bitwise_count(differing[kept]) <= bits
    return kept


def _links(bits: int):
    """Links within groups of fingerprints, as a forest: each row's smallest linked row."""

    def work(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        prints = rows.column("fingerprint").to_numpy().view(np.uint64)
        n = len(prints)
        sizes = np.diff(np.append(starts, n))
        ahead = np.repeat(starts + sizes, sizes) - np.arange(n) - 1  # rows after this one, in its group
        large = np.repeat(sizes > 64, sizes)
        found_a, found_b = [], []
        step = 1
        small = np.flatnonzero((ahead >= step) & ~large)
        while len(small):
            keep = _linked(prints, small, small + step, bits)
            found_a.append(small[keep])
            found_b.append(small[keep] + step)
            step += 1
            small = small[ahead[small] >= step]
        for start, size in zip(starts[sizes > 64], sizes[sizes > 64], strict=True):
            a, b = _spread(prints[start:start + size], bits)
            found_a.append(a + start)
            found_b.append(b + start)
        if not found_a:
            return pa.RecordBatch.from_pydict({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        root = forest(n, np.concatenate(found_a), np.concatenate(found_b))
        moved = np.flatnonzero(root != np.arange(n))
        signed = prints.view(np.int64)
        return pa.RecordBatch.from_pydict({"a": signed[moved], "b": signed[root[moved]]})

    return work


def _spread(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one large group: from each reached row to the rows not yet reached."""
    rest = np.arange(len(prints))
    a, b = [], []
    while len(rest):
        front = [rest[0]]
        rest = rest[1:]
        while front and len(rest):
            at = front.pop()
            hit = _linked(prints, np.full(len(rest), at), rest, bits)
            reached = rest[hit]
            a.append(np.full(len(reached), at))
            b.append(reached)
            front += reached.tolist()
            rest = rest[~hit]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def near_links(prints: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """(a, b): fingerprints that links of at most `bits` differing bits connect, as a forest.

    prints: one column, fingerprint, without repeats. The rows connect exactly those fingerprints
    that links of all such pairs would connect; a row itself may stand for a chain of links.
    """
    if not 0 <= bits <= MOST_BITS:
        raise ValueError(f"the index finds pairs of at most {MOST_BITS} differing bits")
    byte = lambda i: F.shiftrightunsigned("fingerprint", 8 * i).bitwiseAND(F.lit(255))
    keys = [
        F.lit(n << 24).bitwiseOR(F.shiftleft(byte(x), 16)).bitwiseOR(F.shiftleft(byte(y), 8))
        .bitwiseOR(byte(z))
        for n, (x, y, z) in enumerate(position_triples())]
    postings = prints.select("fingerprint", F.explode(F.array(*keys)).alias("key"))
    return by_group(in_blocks(postings, "fingerprint"), _links(bits), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = MOST_BITS) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space. Texts without words,
    null ones too, have fingerprint zero and are linked like any other. component_id is the
    smallest doc_id reachable; rows without doc_id get their component's, null if it has none.
    Rows may repeat. Other columns of docs are not read; an empty table gives an empty result.
    """
    marked = durable(fingerprints(docs, words))
    distinct = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    joined = components(near_links(distinct.select("fingerprint"), bits))
    named = distinct.join(
        joined, distinct.fingerprint == joined.node, "left"
    ).select("fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component"))
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "component").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
