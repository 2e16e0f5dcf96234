"""Repeated runs of lines across and within texts, by winnowing over line hashes.

From every line two windows are taken: the shortest stretch from it onwards that holds MIN_WORDS
words, and the shortest stretch up to it that does. Of each window the first line with the smallest
hash is selected; the selected lines, fewer than the lines, are the fingerprints of a text. Any run
of MIN_WORDS words or more that stands in two places contains a whole window, and the same line of
it is selected in both: the guarantee of winnowing.

Positions are joined by their fingerprint. A line selected in one place only matches nothing, and
its text costs no more than that. From each position that meets others a match is extended both
ways, by the windows that selected it: a window is a match where it equals, line by line, the one
around an earlier position, and its first occurrence stands for all earlier ones. So a line that
thousands of texts share makes no match by itself, and no pairs of a frequent line are listed.
Matches that go on from one another in both texts are then one run, as long as the texts agree.

Every line of a repeated run of MIN_WORDS words lies in a window of either kind inside the run, so
the matches cover whole runs and nothing but runs. Their lines are deleted where they come later. A
line goes only in favour of an equal earlier one, so the first occurrence of every line stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.common import durable, small_batches, text_or_empty, unused

MIN_WORDS = 50


def _lines(text: bytes) -> list[list[bytes]]:
    return [line.split() for line in text.split(b"\n")]


def windows_of(text: bytes, min_words: int) -> list[tuple[int, int, int, int, int]]:
    """The windows of a text: position and hash of the selected line, first line, last line, content hash.

    Sorted by position. Lines that hold no words are not counted. A window that is both kinds comes
    once.
    """
    lines = [tokens for tokens in _lines(text) if tokens]
    if not lines:
        return []
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(t)) for t in lines], dtype=np.uint64)
    content, signed = hashes.tobytes(), hashes.view(np.int64)
    sums = np.concatenate(([0], np.cumsum([len(t) for t in lines])))
    n = len(lines)
    onward = np.searchsorted(sums, sums[:-1] + min_words)  # the window ends before this line
    backward = np.searchsorted(sums, sums[1:] - min_words, side="right") - 1
    spans = {(i, e) for i, e in enumerate(onward.tolist()) if e <= n}
    spans |= {(i, e + 1) for e, i in enumerate(backward.tolist()) if i >= 0}
    found = []
    for i, e in spans:
        at = i + int(signed[i:e].argmin())  # the first of equal ones
        found.append((at, int(signed[at]), i, e - 1, xxhash.xxh64_intdigest(content[8 * i:8 * e], 1) - (1 << 63)))
    return sorted(found)


def _doc() -> Column:
    return F.struct("doc_id", F.xxhash64(text_or_empty()).alias("text_key"))


def fingerprints(docs: DataFrame, min_words: int) -> DataFrame:
    """One row for each selected line: doc (struct of doc_id and a key of the text), position, line (its hash).

    starts, ends and contents are arrays that list the windows which selected it, as windows_of does.
    """
    names = ["doc", "position", "line", "starts", "ends", "contents"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [windows_of(t, min_words) for t in batch.column("text").to_pylist()]
            position, line, start, end, content = np.array(
                [w for f in found for w in f], dtype=np.int64).reshape(-1, 5).T
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            new = np.ones(len(owner), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (position[1:] != position[:-1])
            first = np.flatnonzero(new)
            offsets = pa.array(np.append(first, len(owner)), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(values, kind))
                for values, kind in ((start, pa.int32()), (end, pa.int32()), (content, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(owner[first])), pa.array(position[first], pa.int32()),
                 pa.array(line[first]), *lists], names)

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(_doc().alias("doc"), text_or_empty().cast("binary").alias("text")).mapInArrow(
        run, f"doc struct<doc_id: {kind}, text_key: bigint>, position int, line long, starts array<int>, "
             "ends array<int>, contents array<bigint>")


def matches(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, start, end, source, source_start): later windows and the earlier place they repeat.

    start and end count the lines that hold words, from 0, both included.
    """
    selected = durable(fingerprints(docs, min_words))
    shared = selected.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").select("line")
    around = durable(
        selected.join(shared, "line", "left_semi")
        .select("doc", "line", F.explode(F.arrays_zip("starts", "ends", "contents")).alias("window"))
        .select("doc", "line", F.col("window.starts").alias("start"), F.col("window.ends").alias("end"),
                F.col("window.contents").alias("content")))
    first = (
        around.groupBy("line", "content")
        .agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n"))
    return around.join(first, ["line", "content"]).where(F.struct("doc", "start") != F.col("first")).select(
        "doc", "start", "end", F.col("first.doc").alias("source"), F.col("first.start").alias("source_start"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, source, start, end, source_start): matches that go on from one another, as one run each.

    The lines start to end of doc equal those of source from source_start on. Runs of one document
    may overlap where their sources differ.
    """
    along = Window.partitionBy("doc", "source", "shift").orderBy("start", "end")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("start") > F.max("end").over(before) + 1, F.lit(True))
    return (
        matches(docs, min_words).withColumn("shift", F.col("source_start") - F.col("start"))
        .withColumn("apart", apart).withColumn("run", F.sum(F.col("apart").cast("int")).over(along))
        .groupBy("doc", "source", "shift", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("doc", "source", "start", "end", (F.col("start") + F.col("shift")).alias("source_start")))


def _without(text: bytes, runs: list[dict]) -> tuple[bytes, int, int, int]:
    """The text without its runs; lines that hold words, of them deleted, and words deleted."""
    lines = text.split(b"\n")
    gone = np.zeros(len(lines) + 1, dtype=np.int64)
    for r in runs:
        gone[r["start"]] += 1
        gone[r["end"] + 1] -= 1
    gone = np.cumsum(gone) > 0
    kept, seen, removed, words = [], 0, 0, 0
    for line in lines:
        tokens = line.split()
        if tokens:
            if gone[seen]:
                removed += 1
                words += len(tokens)
            else:
                kept.append(line)
            seen += 1
        else:
            kept.append(line)
    return b"\n".join(kept), seen, removed, words


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of docs, text without repeated runs, and n_lines, n_removed, words_removed.

    Only lines that hold words count and are compared, by their words: white space at the ends and
    the kind of white space between words make no difference. Blank lines stay. Documents are
    ordered by doc_id, nulls first, then by a hash of the text; rows repeated with the same id and
    text are one document and get the same text. A null text stays null, an empty one empty, and a
    text all of whose lines go becomes empty; no row is dropped. Columns of docs named like the
    added ones are replaced. An empty table gives an empty result.
    """
    added = ["n_lines", "n_removed", "words_removed"]
    docs = docs.drop(*added)
    # at most two matches for each line of the text
    runs = repeated_runs(docs, min_words).groupBy("doc").agg(
        F.collect_set(F.struct("start", "end")).alias("runs"))
    names = docs.columns
    key, whole, cut = (unused(docs, n) for n in ("doc", "bytes", "runs"))
    keyed = docs.withColumn(key, _doc())
    wide = keyed.join(runs, keyed[key] == runs["doc"], "left").select(
        *(keyed[n] for n in names), keyed["text"].cast("binary").alias(whole),
        F.coalesce(runs["runs"], F.array()).alias(cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [
                (None, 0, 0, 0) if text is None else _without(text, found)
                for text, found in zip(batch.column(whole).to_pylist(), batch.column(cut).to_pylist(), strict=True)]
            texts, *counts = zip(*done, strict=True) if done else ((),) * 4
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            for name, values in zip(added, counts, strict=True):
                columns[name] = pa.array(values, pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    schema = docs.schema
    for name in added:
        schema = schema.add(name, "long")
    return wide.withColumn("text", F.lit(None).cast("string")).mapInArrow(run, schema)
