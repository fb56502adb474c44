"""Cases in which results were once wrong."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from parley.llm import source_mixing, tokens


def test_every_letter_before_every_mark():
    encoder = tokens.WordEncoder(tokens.default_tokenizer())
    letters = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]
    odd = encoder.odd[1:-1]
    assert set(odd) <= set(letters) and 40 < len(odd) < 100
    marks = "!#$%&()*+,./:;=?@_|~-"
    # All odd letters with all marks, every other letter with some.
    words = [a + c + m for c in odd for m in marks for a in ("", "x")] + [
        c + marks[i % len(marks)] for i, c in enumerate(letters)
    ]
    for at in range(0, len(words), 20_000):
        part = words[at : at + 20_000]
        ids, offsets = encoder.encode(pa.array(part), 0)
        want = encoder.tokenizer.encode_batch(part, add_special_tokens=False)
        for i, w in enumerate(want):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == [*w.ids, 0], part[i]


def test_random_texts_of_hard_letters():
    encoder = tokens.WordEncoder(tokens.default_tokenizer())
    rnd = random.Random(11)
    alphabet = encoder.odd[1:-1] + "aZéßΣς़́İı'’ .,+-!?\t\n0١<|"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(6000)]
    ids, offsets = encoder.encode(pa.array(texts), 0)
    for i, w in enumerate(encoder.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == [*w.ids, 0], texts[i]


def test_documents_without_id_are_mixed_one_by_one(spark):
    """1,000 different texts of 4 words without an id, budget 6,000 words."""
    docs = spark.range(1000).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.concat_ws(" ", F.lit("a b c"), F.col("id").cast("string")).alias("text"),
        F.lit("s").alias("source"),
    )
    got = source_mixing.mix_sources(docs).agg(F.sum("taken").alias("t"), F.max("target").alias("g")).first()
    assert abs(got["t"] - got["g"]) <= 4


def test_words_of_one_hash_are_kept_apart(monkeypatch):
    """A hash only proposes a word."""
    monkeypatch.setattr(tokens, "word_hashes", lambda words: np.arange(len(words), dtype=np.uint64) % np.uint64(2))
    encoder = tokens.WordEncoder(tokens.default_tokenizer())
    texts = ["alpha beta gamma alpha", "delta, beta <|endoftext|>x epsilon", "", "gamma. zeta"] * 3
    for _ in range(2):
        ids, offsets = encoder.encode(pa.array(texts), 1)
        for i, w in enumerate(encoder.tokenizer.encode_batch(texts, add_special_tokens=False)):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == [*w.ids, 1]
