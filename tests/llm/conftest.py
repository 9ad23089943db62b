from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture
def make(spark):
    """Rows of documents with one more column, whose name clashes with the operators' own."""

    def build(rows, score="x"):
        full = [(*r, None, None)[:4] for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, score string, t int, c long"
        data = [(i, t, lang, source, len(t or ""), score, 1, 2) for i, t, lang, source in full]
        return spark.createDataFrame(data, schema)

    return build
