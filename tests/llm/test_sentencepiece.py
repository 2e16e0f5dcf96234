import pytest
from conftest_llm import words
from pyspark.sql import functions as F

from notewright.llm import sentencepiece as sp
from notewright.llm.queries import MODEL_FILE


@pytest.fixture(scope="module")
def small():
    pieces = ["▁", "a", "b", "c", "ab", "bc", "▁a", "▁ab", "▁abc", "abc", "▁▁", "cab", "ca", "."]
    scores = [-6.0, -2.0, -2.5, -3.0, -3.25, -4.0, -2.75, -5.0, -7.0, -4.5, -7.0, -5.5, -4.25, -1.5]
    return sp.Vocabulary(
        {p: (i, s) for i, (p, s) in enumerate(zip(pieces, scores, strict=True))}, [100 + b for b in range(256)])


@pytest.fixture(scope="module")
def real():
    return sp.Vocabulary.load(MODEL_FILE)


def every_path(vocabulary, marked):
    """All segmentations with scores; sp._OWN_MARK stands for a mark of the text itself."""
    if not marked:
        return [(0.0, ())]
    out = []
    for end in range(1, len(marked) + 1):
        piece = vocabulary.pieces.get(marked[:end])
        if piece:
            out += [(piece[1] + s, (piece[0], *ids)) for s, ids in every_path(vocabulary, marked[end:])]
    if marked[0] not in vocabulary.pieces:
        out += [(vocabulary.unknown + s, vocabulary.spell(marked[0]) + ids)
                for s, ids in every_path(vocabulary, marked[1:])]
    return out


def marked(text):
    return "▁" + text.replace("▁", sp._OWN_MARK).replace(" ", "▁") if text else ""


TEXTS = ["abc", "ab cab", "a b  c ", " abcab", "é", "ab▁c a", "abc. abc. abc.", "cabcab abcabc", "   ", "a", "x\ny z"]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_n_best_against_every_path(small, text, n):
    every = sorted(every_path(small, marked(text)), key=lambda p: -p[0])
    found = sp.Encoder(small, n).paths(text)
    assert [round(s, 9) for s, _ in found] == [round(s, 9) for s, _ in every[:n]]
    assert len({ids for _, ids in found}) == len(found) and {ids for _, ids in found} <= {ids for _, ids in every}
    assert all(sp.decode_ids(small, ids) == text for _, ids in found)
    ids, _, scores, _ = sp.Encoder(small, n).encode([text])
    assert tuple(ids) == found[0][1] and scores[0] == [s for s, _ in found]


def test_chunks_solved_together_as_one_by_one(real):
    chunks = sorted({w + e for w in words("sp", 400) for e in ("", ".", ",", "\nÉtre", "漢", "\U0001f600", sp._OWN_MARK)})
    chunks += ["x" * 63, "x" * 64, "ab" * 200, "▁▁", ""]
    encoder = sp.Encoder(real)
    flat, many, scores, losses = encoder._solve(chunks)
    ends = many.cumsum()
    for i, chunk in enumerate(chunks):
        ids, score, loss = sp.best_and_next(real, sp.SPACE + chunk)
        best = sp.n_best(real, sp.SPACE + chunk, 2)
        assert flat[ends[i] - many[i]:ends[i]].tolist() == ids == list(best[0][1])
        assert (scores[i], losses[i]) == (score, loss) and best[0][0] == score
        assert (best[0][0] - best[1][0] if len(best) > 1 else float("inf")) == loss


def test_best_scores_against_the_library(tmp_path, real):
    """The library's own N-best, of the same pieces and scores as a unigram model."""
    import sentencepiece

    data = open(MODEL_FILE, "rb").read()
    assert data.count(b"\x18\x02 \x80\xfa\x01") == 1  # model type 2, followed by the vocabulary's size
    path = tmp_path / "unigram.model"
    path.write_bytes(data.replace(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01"))
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    for seed in range(40):
        text = " ".join(words(seed, 3))
        found = sp.Encoder(real, 3).paths(text)
        theirs = library.nbest_encode(text, nbest_size=3)
        score = lambda ids: sum(library.get_score(int(i)) for i in ids)
        assert [score(ids) for _, ids in found] == [score(ids) for ids in theirs]


def test_round_trip_of_odd_rows(documents, odd_rows):
    docs = documents(odd_rows).withColumn("ids", F.lit("mine")).withColumn("row", F.monotonically_increasing_id())
    encoded = sp.encode(docs, MODEL_FILE)
    assert encoded.columns == ["doc_id", "ids", "n_best_scores"]
    back = sp.decode(encoded.withColumn("text", F.lit("old")), MODEL_FILE).collect()
    assert sorted([(r.doc_id, r.text) for r in back], key=str) == sorted([(i, t or "") for i, t in odd_rows], key=str)
    empty = [r for r in back if r.text == ""]
    assert empty and all(r.ids == [] and r.n_best_scores == [0.0] for r in empty)
    assert sp.encode(documents([]), MODEL_FILE).count() == 0


def test_all_segmentations_come_out(documents, odd_rows, real):
    rows = [r for r in odd_rows if r[0] != 7] + [(100 + i, " ".join(words(i, 30))) for i in range(20)]
    encoded = sp.encode_n_best(documents(rows), MODEL_FILE)
    found = encoded.select("doc_id", "n_best_scores", F.array(*(sp.nth_best(k) for k in (1, 2, 3))).alias("paths"))
    encoder = sp.Encoder(real, 3)
    wanted = []
    for i, text in rows:
        paths = encoder.paths(text or "")
        wanted.append((i, [s for s, _ in paths], [list(ids) for _, ids in paths] + [None] * (3 - len(paths))))
        assert all(sp.decode_ids(real, ids) == (text or "") for _, ids in paths)
        assert len({ids for _, ids in paths}) == len(paths)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    assert encoded.drop("n_best_changes").columns == sp.encode(documents([]), MODEL_FILE).columns
    assert sp.encode_n_best(documents([]), MODEL_FILE).count() == 0


def test_long_chunks_take_time_in_proportion(real):
    import time

    text = "".join(words("one chunk", 60_000))[:160_000]
    assert len(text) == 160_000 and " " not in text
    began = time.process_time()
    paths = sp.n_best(real, sp.SPACE + text, 3)
    took = time.process_time() - began
    assert all(sp.decode_ids(real, ids) == text for _, ids in paths)
    assert paths[0][0] >= paths[1][0] >= paths[2][0] and len({ids for _, ids in paths}) == 3
    assert took < 10, took


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in sp.decode(rows, MODEL_FILE).orderBy("doc_id").collect()] == [None, ""]


def test_chunks_are_solved_once_in_a_task(real, monkeypatch):
    """Chunks met in an earlier batch are not solved again, and forgetting them changes nothing."""
    batches = [["low lower lowest", "new lower"], ["lowest new", "", "a lower low"], ["low", "newer é new"]]
    solved = []
    solve = sp.Encoder._solve
    monkeypatch.setattr(sp.Encoder, "_solve", lambda self, chunks: solved.extend(chunks) or solve(self, chunks))

    def encoded(encoder, texts):
        ids, counts, scores, changes = encoder.encode(texts)
        return ids.tolist(), counts.tolist(), scores, changes

    fresh = [encoded(sp.Encoder(real), texts) for texts in batches]
    solved.clear()
    kept = sp.Encoder(real)
    assert [encoded(kept, texts) for texts in batches] == fresh
    assert sorted(solved) == sorted({c for texts in batches for t in texts for c in sp.chunks_of(t)})
    monkeypatch.setattr(sp, "MOST_CHUNKS", 3)
    forgetful = sp.Encoder(real)
    assert [encoded(forgetful, texts) for texts in batches] == fresh
    assert len(forgetful.index) < len(kept.index)
