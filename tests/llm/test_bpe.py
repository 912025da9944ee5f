import random

import pytest
from pyspark.sql import functions as F

from quillgrid.llm import bpe
from quillgrid.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def text():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


def test_all_characters_and_random_texts_as_the_library(library, text):
    ours, back = bpe.Vocabulary(text), bpe.Decoder(text)
    texts = []
    for low in range(0, 0x30000, 1511):
        texts.append("".join(chr(c) + " a"[c % 2] for c in range(low, low + 1511) if not 0xD800 <= c < 0xE000))
    r = random.Random(5)
    parts = ["a", "the", "  ", "\n", "<|endoftext|>", "'s", "é", "zz", "12", "!!", "　", "日本", "x" * 900, " " * 30]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(300)]
    for one, ids in zip(texts, ours.encode(texts)):
        expected = library.encode(one, add_special_tokens=False).ids
        assert ids.tolist() == expected
        assert back.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_one_word_many_words_and_pairs_agree(text):
    ours, r = bpe.Vocabulary(text), random.Random(3)
    words = [bytes(r.choices(b"abcdeht ", k=r.randint(1, 40))) for _ in range(400)]
    assert [w for w in ours.encode_words(words)] == [ours.ids[ours.encode_word(w)].tobytes() for w in words]


def test_full_memories_start_anew(text, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    ours = bpe.Vocabulary(text)
    for _ in range(3):
        for one in ("some words here again", "and others there"):
            assert ours.encode([one])[0].tolist() == library.encode(one, add_special_tokens=False).ids


def test_operator_on_nulls_empty_long_and_extra_columns(docs, library):
    texts = [None, "", "word " * 50_000, "ab" * 40_000, "same", "same"]
    df = docs(texts).withColumn("ids", F.lit("old")).withColumn("tokens", F.lit(None).cast("long"))
    encoded = bpe.encode(df, PATH)
    assert set(encoded.columns) == set(df.columns)
    found = {r.doc_id: r for r in bpe.decode(encoded, PATH).collect()}
    for i, t in enumerate(texts):
        assert found[i].ids == library.encode(t or "", add_special_tokens=False).ids and found[i].decoded == (t or "")
    assert bpe.decode(bpe.encode(docs([]), PATH), PATH).count() == 0


def test_an_unknown_id_stops(spark):
    with pytest.raises(Exception, match="does not have"):
        bpe.decode(spark.createDataFrame([([99_999_999],)], "ids array<int>"), PATH).collect()
