"""Encoding and decoding with a SentencePiece vocabulary, by N-best segmentation.

A text becomes a lattice: every piece that stands at a place is an edge, weighted by its score. A
forward Viterbi pass gives the best score from the start to every place. That is the exact rest of
a path built from the end backwards, so A-star search with it as heuristic takes paths off its
queue in the order of their full scores: the first N complete ones are the N best.

No piece holds the space mark after another character, so no edge crosses the place before a space
mark, and the lattice falls apart into chunks there. Distinct chunks are solved once in a task,
as long as it remembers them; the N best of a text are found by the same search over its chunks, of
which only the N - 1 with the cheapest second choices can differ from the best path.

Characters without a piece are spelled as byte pieces, and so is a space mark that a text itself
holds: decoding always gives the text back.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import small_batches, text_or_empty

SPACE = "▁"
_OWN_MARK = "\udc81"  # stands for a space mark that the text itself holds; no text can hold this
N_BEST = 3
UNKNOWN_PENALTY = 10.0  # below the least score of a piece, as the library does it
MOST_CHUNKS = 1 << 18  # solutions that a task remembers
MOST_VALUES = 1 << 22
WIDTHS = (4, 7, 10, 14, 20, 32, 64)  # chunks are solved together up to these lengths

Path = tuple[float, tuple[int, ...]]


class Vocabulary:
    """Pieces with ids and scores, and the ids of the 256 byte pieces."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces = pieces
        self.byte_ids = byte_ids
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        # every beginning of a piece; None where it is not a piece itself
        self.begun: dict[str, tuple[int, float] | None] = {
            p[:k]: None for p in pieces for k in range(1, len(p) + 1)} | pieces
        self.text_of = {i: p.encode().replace(SPACE.encode(), b" ") for p, (i, _) in pieces.items()}
        self.text_of |= {i: bytes([b]) for b, i in enumerate(byte_ids)}

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        """Read a model file: its pieces by the library, everything else is done here.

        A prefix space is added to texts that are not empty. The model must have byte pieces and
        no normalisation of its own.
        """
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        pieces, byte_ids = {}, [-1] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {i} holds a space mark after another character")
                pieces[piece] = (i, model.get_score(i))
        if -1 in byte_ids:
            raise ValueError("the model needs byte pieces, for characters that it doesn't know")
        return cls(pieces, byte_ids)

    def tree(self) -> Tree:
        return Tree(self.pieces)

    def spell(self, character: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in character.replace(_OWN_MARK, SPACE).encode())


def n_best(vocabulary: Vocabulary, chunk: str, n: int) -> list[Path]:
    """The n best segmentations (score, ids) of a chunk, best first; fewer if it has no more.

    Forward: best[i], the best score up to place i, and all edges into every place. Backward: a
    partial path from the end to place i has the full score (its own + best[i]); as that is exact,
    a queue of partial paths by full score gives complete ones in order. An edge that keeps the
    full score would be taken off at once, so it is followed at once; the others are queued, unless
    n queued or finished paths are already better. Equal scores come in an order that depends on
    the chunk alone.
    """
    size = len(chunk)
    begun = vocabulary.begun
    into: list[list[tuple[float, int, int]]] = [[] for _ in range(size + 1)]
    best = [0.0]
    for start in range(size):
        for end in range(start + 1, size + 1):
            part = chunk[start:end]
            if part not in begun:
                break
            piece = begun[part]
            if piece is not None:
                into[end].append((best[start] + piece[1], start, piece[0]))
        if begun.get(chunk[start]) is None:
            into[start + 1].append((best[start] + vocabulary.unknown, start, -1))
        best.append(max(edge[0] for edge in into[start + 1]))
    # loss against the best score, number, edges so far from the end (each with those behind it), place
    queue: list[tuple[float, int, tuple | None, int]] = [(0.0, 0, None, size)]
    known = [0.0]  # the n least losses queued or finished
    paths: list[Path] = []
    number = 0
    while queue and len(paths) < n:
        loss, _, tail, place = heapq.heappop(queue)
        while place:
            edges = into[place]
            follow = next(edge for edge in edges if edge[0] == best[place])
            for edge in edges:
                if edge is not follow:
                    more = loss + best[place] - edge[0]
                    if len(known) < n or more < known[-1]:
                        number += 1
                        bisect.insort(known, more)
                        del known[n:]
                        heapq.heappush(queue, (more, number, (edge[2], edge[1], tail), edge[1]))
            place = follow[1]
            tail = (follow[2], place, tail)
        paths.append((best[size] - loss, _ids(vocabulary, tail, chunk)))
    return paths


def best_and_next(vocabulary: Vocabulary, chunk: str) -> tuple[list[int], float, float]:
    """The best ids and score of a chunk, and what the second best path loses (inf: there is none).

    The forward pass of n_best, with the second score into every place instead of all edges: the
    second best path leaves the best one at one place, at the least loss on it.
    """
    size = len(chunk)
    begun = vocabulary.begun
    least = -math.inf
    best, second = [0.0] + [least] * size, [least] * (size + 1)
    back: list[tuple[int, int]] = [(0, 0)] * (size + 1)
    for start in range(size):
        here = best[start]
        single = True
        for end in range(start + 1, size + 1):
            piece = begun.get(chunk[start:end], 0)
            if piece:
                score = here + piece[1]
                if score > best[end]:
                    second[end] = best[end]
                    best[end] = score
                    back[end] = (start, piece[0])
                elif score > second[end]:
                    second[end] = score
                single = False if end == start + 1 else single
            elif piece == 0:
                break
        if single:
            end, score = start + 1, here + vocabulary.unknown
            if score > best[end]:
                second[end], best[end], back[end] = best[end], score, (start, -1)
            elif score > second[end]:
                second[end] = score
    ids, place, loss = [], size, math.inf
    while place:
        loss = min(loss, best[place] - second[place])
        start, i = back[place]
        if i >= 0:
            ids.append(i)
        else:
            ids += vocabulary.spell(chunk[start])[::-1]
        place = start
    return ids[::-1], best[size], loss


def _ids(vocabulary: Vocabulary, edges: tuple | None, chunk: str) -> tuple[int, ...]:
    """The ids of linked edges (id, start, edges behind); a character without a piece is spelled."""
    ids: list[int] = []
    while edges:
        i, start, edges = edges
        if i >= 0:
            ids.append(i)
        else:
            ids += vocabulary.spell(chunk[start])
    return tuple(ids)


class Tree:
    """The pieces as a tree of characters in arrays, walked for many places at a time.

    step[slot] leads from (node, character) to a node, found by open addressing.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        nodes = {"": 0}
        for piece in pieces:
            for k in range(1, len(piece) + 1):
                nodes.setdefault(piece[:k], len(nodes))
        self.ids = np.full(len(nodes), -1, dtype=np.int64)
        self.scores = np.zeros(len(nodes))
        for piece, (i, score) in pieces.items():
            self.ids[nodes[piece]], self.scores[nodes[piece]] = i, score
        self.bits = max(4, int(2 * len(nodes)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.next = np.full(1 << self.bits, -1, dtype=np.int64)
        inner = [(nodes[p[:-1]], ord(p[-1]), n) for p, n in nodes.items() if p]
        key = np.array([(node << 21) | c for node, c, _ in inner], dtype=np.int64)
        for k, slot, (_, _, to) in zip(key.tolist(), self._slot(key).tolist(), inner, strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (len(self.keys) - 1)
            self.keys[slot], self.next[slot] = k, to

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def walk(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The nodes reached, -1 where there is none."""
        key = (node << 21) | character
        slot = self._slot(key)
        at = self.keys[slot]
        out = np.where(at == key, self.next[slot], -1)
        open_ = np.flatnonzero((at != key) & (at >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at = self.keys[slot[open_]]
            hit = at == key[open_]
            out[open_[hit]] = self.next[slot[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
        return out

    def solve(self, chunks: list[str], unknown: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """best_and_next for many chunks: flat ids, number of ids, scores and losses of chunks.

        A character without a piece has -2 minus its code point in place of an id.
        """
        size = np.array([len(c) for c in chunks])
        width, n = int(size.max()), len(chunks)
        point = np.frombuffer("".join(c.ljust(width, "\0") for c in chunks).encode("utf-32-le", "surrogatepass"),
                              dtype="<u4").astype(np.int64).reshape(n, width)
        best = np.full((width + 1, n), -np.inf)
        second = np.full((width + 1, n), -np.inf)
        back = np.zeros((width + 1, n), dtype=np.int64)
        came = np.zeros((width + 1, n), dtype=np.int64)
        best[0] = 0.0

        def relax(rows: np.ndarray, start: int, end: int, score: np.ndarray, i: np.ndarray) -> None:
            now = best[end, rows]
            more = score > now
            second[end, rows] = np.where(more, now, np.maximum(second[end, rows], score))
            won = rows[more]
            best[end, won], back[end, won], came[end, won] = score[more], start, i[more]

        for start in range(width):
            rows = np.flatnonzero(size > start)
            here = best[start]
            node = np.zeros(len(rows), dtype=np.int64)
            single = np.zeros(n, dtype=bool)
            for end in range(start + 1, width + 1):
                inside = size[rows] >= end
                rows, node = rows[inside], node[inside]
                node = self.walk(node, point[rows, end - 1])
                alive = node >= 0
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                piece = self.ids[node]
                is_piece = piece >= 0
                hit = rows[is_piece]
                relax(hit, start, end, here[hit] + self.scores[node[is_piece]], piece[is_piece])
                if end == start + 1:
                    single[hit] = True
            rows = np.flatnonzero((size > start) & ~single)
            if len(rows):
                relax(rows, start, start + 1, here[rows] + unknown, -2 - point[rows, start])

        everyone = np.arange(n)
        place, rows, loss = size.copy(), everyone, np.full(n, np.inf)
        steps = []
        while len(rows):
            at = place[rows]
            loss[rows] = np.minimum(loss[rows], best[at, rows] - second[at, rows])
            steps.append((rows, came[at, rows]))
            place[rows] = back[at, rows]
            rows = rows[place[rows] > 0]
        many = np.bincount(np.concatenate([r for r, _ in steps]), minlength=n)
        ends = np.cumsum(many)
        flat = np.zeros(int(ends[-1]), dtype=np.int64)
        for k, (rows, ids) in enumerate(steps):
            flat[ends[rows] - 1 - k] = ids
        return flat, many, best[size, everyone], loss


def chunks_of(text: str) -> list[str]:
    """The chunks of a text with its prefix space, each without its first space mark.

    A chunk is a run of space marks and what follows up to the next one; all chunks have a mark,
    for the text gets one in front. An empty text has no chunks.
    """
    if not text:
        return []
    pieces = text.replace(SPACE, _OWN_MARK).split(" ")
    if "" not in pieces:
        return pieces
    chunks, marks = [], -1
    for piece in pieces:
        marks += 1
        if piece:
            chunks.append(SPACE * marks + piece)
            marks = -1
    if marks >= 0:
        chunks.append(SPACE * marks)
    return chunks


class _Codes(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        return code


class Encoder:
    """Encodes texts, many at a time; every distinct chunk is solved once, and remembered.

    What is remembered is dropped after a call that leaves more than MOST_CHUNKS chunks or MOST_VALUES
    ids or characters; a chunk's solution does not depend on the chunks that are solved with it.
    """

    def __init__(self, vocabulary: Vocabulary, n: int = N_BEST):
        self.vocabulary, self.n, self.tree = vocabulary, n, vocabulary.tree()
        self._forget()

    def _forget(self) -> None:
        self.index = _Codes()
        self.solved = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        self.ranked: dict[str, list[Path]] = {}
        self.characters = 0

    def _known(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What _solve gives for all remembered chunks and these, which are new."""
        if chunks:
            self.solved = tuple(map(np.concatenate, zip(self.solved, self._solve(chunks), strict=True)))
            self.characters += sum(map(len, chunks))
        return self.solved

    def _solve(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat best ids, number of ids, best score, loss of the second choice, of all chunks."""
        marked = [SPACE + c for c in chunks]
        size = np.array([len(c) for c in marked])
        flats, rows, counts = [], [], np.zeros(len(marked), dtype=np.int64)
        scores, losses = np.zeros(len(marked)), np.zeros(len(marked))
        low = 0
        for high in (*WIDTHS, 1 << 60):
            at = np.flatnonzero((size > low) & (size <= high))
            low = high
            if not len(at):
                continue
            if high in WIDTHS:
                flat, many, scores[at], losses[at] = self.tree.solve(
                    [marked[i] for i in at], self.vocabulary.unknown)
            else:  # few, and too long for a table
                found = [best_and_next(self.vocabulary, marked[i]) for i in at]
                flat = np.concatenate([np.array(f[0], dtype=np.int64) for f in found])
                many = np.array([len(f[0]) for f in found])
                scores[at], losses[at] = [f[1] for f in found], [f[2] for f in found]
            flat, many = self._spelled(flat, many)
            counts[at] = many
            flats.append(flat)
            rows.append(at)
        start = np.zeros(len(marked), dtype=np.int64)
        order = np.concatenate(rows)
        start[order] = np.cumsum(counts[order]) - counts[order]
        return _gather(np.concatenate(flats), start, counts), counts, scores, losses

    def _spelled(self, flat: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """With byte ids in place of the characters that have no piece."""
        unknown = np.unique(flat[flat < 0])
        if not len(unknown):
            return flat, many
        owner = np.repeat(np.arange(len(many)), many)
        width = np.ones(len(flat), dtype=np.int64)
        spelled = {int(u): self.vocabulary.spell(chr(-2 - int(u))) for u in unknown}
        for u, ids in spelled.items():
            width[flat == u] = len(ids)
        start = np.cumsum(width) - width
        out = np.repeat(flat, width)
        for u, ids in spelled.items():
            for k, i in enumerate(ids):
                out[start[flat == u] + k] = i
        return out, np.bincount(owner, weights=width, minlength=len(many)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[float]], list[list[list[dict]]]]:
        """Of texts: flat ids of the best paths, number of ids, and of the n best paths the scores
        and how they differ from the best: ids to put in place of `gone` ids after the first `at`,
        the last place first.
        """
        if len(self.index) > MOST_CHUNKS or max(self.characters, len(self.solved[0])) > MOST_VALUES:
            self._forget()
        index, before = self.index, len(self.index)
        lists = [chunks_of(t) for t in texts]
        code = np.fromiter(map(index.__getitem__, itertools.chain.from_iterable(lists)), dtype=np.int64)
        if not len(code):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64), [[0.0] for _ in texts], [[[]] for _ in texts]
        flat, many, score, loss = self._known(list(itertools.islice(index, before, None)))
        start = np.cumsum(many) - many
        ids = _gather(flat, start[code], many[code])
        ends = np.cumsum([len(c) for c in lists])
        total = np.concatenate(([0], np.cumsum(many[code])))
        counts = np.diff(total[np.concatenate(([0], ends))])
        scores, changes = [], []
        for chunks, end in zip(lists, ends.tolist(), strict=True):
            first = end - len(chunks)
            own = code[first:end]
            found, changed = self._ranked(chunks, math.fsum(score[own]), loss[own])
            scores.append(found)
            changes.append([
                [{"at": int(total[first + c] - total[first]), "gone": int(many[own[c]]), "ids": changed_ids}
                 for c, changed_ids in sorted(path.items(), reverse=True)]
                for path in changed])
        return ids, counts, scores, changes

    def _ranked(self, chunks: list[str], top: float, losses: np.ndarray) -> tuple[list[float], list[dict]]:
        """Scores and changes of the n best paths, best first.

        Only the n - 1 chunks of least loss can differ from the best; of equal ones the first.
        """
        if len(losses) > self.n:
            losses = np.where(losses <= np.partition(losses, self.n - 1)[self.n - 1], losses, np.inf)
        free = np.flatnonzero(losses < np.inf)
        free = sorted(free[np.argsort(losses[free], kind="stable")[: self.n - 1]].tolist())
        for i in free:
            if chunks[i] not in self.ranked:
                self.ranked[chunks[i]] = n_best(self.vocabulary, SPACE + chunks[i], self.n)
        paths = [self.ranked[chunks[i]] for i in free]
        queue, found, changes = [(0.0, (), 0)], [], []
        while queue and len(found) < self.n:
            loss, chosen, place = heapq.heappop(queue)
            if place == len(free):
                found.append(top - loss)
                changes.append({free[i]: paths[i][k][1] for i, k in enumerate(chosen) if k})
                continue
            first = paths[place][0][0]
            for k, (score, _) in enumerate(paths[place]):
                heapq.heappush(queue, (loss + first - score, (*chosen, k), place + 1))
        return found, changes

    def paths(self, text: str) -> list[Path]:
        """The n best segmentations of a whole text, best first. An empty text has one, without ids."""
        ids, _, scores, changes = self.encode([text])
        found = []
        for score, changed in zip(scores[0], changes[0], strict=True):
            path = ids.tolist()
            for c in changed:
                path[c["at"]:c["at"] + c["gone"]] = c["ids"]
            found.append((score, tuple(path)))
        return found


def _gather(flat: np.ndarray, start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The stretches of flat that start at `start` and hold `many` values, one after another."""
    total = int(many.sum())
    shift = np.repeat(start - (np.cumsum(many) - many), many)
    return flat[np.arange(total) + shift]


def decode_ids(vocabulary: Vocabulary, ids: Iterable[int]) -> str:
    """The text of a segmentation, without the prefix space."""
    return b"".join(map(vocabulary.text_of.__getitem__, ids))[1:].decode()


def _values(model_file: str) -> tuple[dict[str, tuple[int, float]], list[int]]:
    vocabulary = Vocabulary.load(model_file)
    return vocabulary.pieces, vocabulary.byte_ids


CHANGES = "array<array<struct<at: int, gone: int, ids: array<int>>>>"


def _encoded(docs: DataFrame, model_file: str, n: int, with_changes: bool) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(_values(model_file))  # one vocabulary, its size fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value), n)
        change = pa.struct([("at", pa.int32()), ("gone", pa.int32()), ("ids", pa.list_(pa.int32()))])
        for batch in batches:
            ids, counts, scores, changes = encoder.encode(batch.column("text").to_pylist())
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            columns = {
                "doc_id": batch.column("doc_id"),
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                "n_best_scores": pa.array(scores, pa.list_(pa.float64()))}
            if with_changes:
                columns["n_best_changes"] = pa.array(changes, pa.list_(pa.list_(change)))
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, n_best_scores array<double>"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, schema + (f", n_best_changes {CHANGES}" if with_changes else ""))


def encode(docs: DataFrame, model_file: str, n: int = N_BEST) -> DataFrame:
    """doc_id, ids (array<int>) and n_best_scores of every row of docs, best path first.

    Null texts count as empty, and an empty text has no ids and the one score 0. Fewer scores than
    n come where a text has no more segmentations. Other columns of docs are not read.
    """
    return _encoded(docs, model_file, n, False)


def encode_n_best(docs: DataFrame, model_file: str, n: int = N_BEST) -> DataFrame:
    """The columns of encode, and n_best_changes: how each of the n best paths differs from ids.

    The best path changes nothing; nth_best writes a path out. Nulls, empty texts and repeats as in
    encode. The n paths of a text differ in n - 1 chunks at most, so they take little more room than
    the best one.
    """
    return _encoded(docs, model_file, n, True)


def nth_best(rank: int) -> Column:
    """The ids of the segmentation of that rank (1: the best), over rows of encode_n_best; null
    where a text has fewer.
    """
    return F.aggregate(
        F.get("n_best_changes", F.lit(rank - 1)), F.col("ids"),
        lambda ids, c: F.concat(
            F.slice(ids, F.lit(1), c["at"]), c["ids"], F.slice(ids, c["at"] + c["gone"] + 1, F.size(ids))))


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """All columns of encoded, and text: what its ids spell. Null ids give a null text."""
    spark = encoded.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(_values(model_file))
    schema = encoded.drop("text").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Vocabulary(*shared.value).text_of
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False).tolist()  # no Arrow scalar for each id
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
            texts = [
                b"".join(map(pieces.__getitem__, flat[start:end]))[1:] if known else None
                for start, end, known in zip([0, *ends], ends, lists.is_valid().tolist(), strict=False)]
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict(columns | {"text": pa.array(texts, pa.binary()).cast(pa.string())})

    return encoded.drop("text").mapInArrow(run, schema)
