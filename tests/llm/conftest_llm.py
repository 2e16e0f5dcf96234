import hashlib
import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    draw = random.Random(seed)
    parts = ["ka", "lo", "mi", "ten", "sur", "vo", "ri", "pel", "da", "nu"]
    return ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n)]


def sentence(seed, n=12):
    return " ".join(words(seed, n)).capitalize() + "."


def passage(seed, lines=4):
    return "\n".join(sentence(f"{seed}/{i}") for i in range(lines))


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) rows, with the other columns filled in."""
    return lambda rows: spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCUMENT)


@pytest.fixture
def odd_rows():
    """Null and repeated ids, null, blank and very long texts, repeated rows, marks and other scripts."""
    return [
        (None, passage("none")), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, passage("x")),
        (4, passage("x")), (4, passage("other")), (5, passage("x")), (6, "x" * 30_000),
        (7, " ".join(words("long", 20_000))), (8, "\n".join(["Same line."] * 300)),
        (9, "ünï 漢字 ▁ \x00 \U0001f600 a\r\nb\x0bc"), (10, "a"), (11, "one two three"),
    ]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
