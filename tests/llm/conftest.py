import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Make a table like ``documents`` from texts, numbered from 0, or from ``(id, text)``."""

    def make(texts, lang="en"):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in pairs], DOCS)

    return make


@pytest.fixture
def prose():
    """Random prose of invented words, the same for the same seed."""

    def make(seed, n=60, stock=("ba", "co", "di", "fu", "ge", "ho", "ki", "lu")):
        r = random.Random(seed)
        return " ".join("".join(r.choice(stock) for _ in range(r.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(autouse=True)
def shared(spark, tmp_path_factory):
    """A folder for checkpoints, as a cluster would name one."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
