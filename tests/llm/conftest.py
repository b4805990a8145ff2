from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, rank string"


def documents() -> list[tuple]:
    """Copies, near copies, shared passages, short, empty and null texts, a text of one byte repeated, and null keys."""
    import random

    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = prose(120), prose(300)
    near = base.split()
    near[7] = "changed"
    texts = [base, base, " ".join(near), prose(50) + "\n" + passage + "\n" + prose(30), prose(20) + " " + passage, passage, prose(400), prose(12), prose(13), "", None, "one", "one", "a" * 900, "  \t\n", prose(60) + " é ß ü " + prose(30), prose(5000)]
    sources = ["b", "a", None, "c", "b", "b", "d", "", "a", None, "b", "e", "b", "c", "a", "f", "b"]
    return [(i, t, "en", s, len(t or ""), i % 3, "x") for i, (t, s) in enumerate(zip(texts, sources, strict=True))]


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
