from __future__ import annotations

import re
from itertools import count

import pytest

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return SPACED.findall(text or "")


@pytest.fixture
def documents(spark):
    """A documents table of some texts, or of (doc_id, text, source) rows."""

    def make(*rows):
        ids = count()
        full = [(*r[:2], "en", r[2] if len(r) > 2 else "s", None) if isinstance(r, tuple) else (next(ids), r, "en", "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


def prose(n: int, seed: int, vocabulary: int = 4000) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
