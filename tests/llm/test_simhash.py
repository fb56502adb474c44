"""SimHash near-duplicates against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from parley.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, fp string, a int, b int, rows int, copies long, component_id string"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Index sets reachable over links of at most 3 bits."""
    group = list(range(len(fps)))
    links = [0] * len(fps)
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                links[i] += 1
                links[j] += 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group, links


def test_whole_result_against_brute_force(spark):
    rng = random.Random(3)
    words = ["Wort", "word", "Mot", "É", "x", "naïve", "東京", "a1", "B", "#"]
    texts = [None, "", " \t\r\n\x0b\x0c", "one", "ONE", "one two", "a b c", "A\tB\nC", "\x85 \xa0 \x1c a b", "wİ İ"]
    for _ in range(30):
        base = [rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.choice([4, 30, 200]))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(3)):  # near copies
            base[rng.randrange(len(base))] = "new"
            texts.append(" ".join(base))
    texts.append("long " * 70_000 + "end")
    rows = [(i, t, "x", 1, 2, 3, 4, "y") for i, t in enumerate(texts)]
    rows += [rows[12], (None, texts[12], None, None, None, None, None, None), (None, "only a null id here", None, None, None, None, None, None)]
    got = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [plain_fingerprint(r[1]) for r in rows]
    group, links = plain_components(fps)
    want = []
    for r, fp, g, n in zip(rows, fps, group, links, strict=True):
        ids = [s[0] for s, h in zip(rows, group, strict=True) if h == g and s[0] is not None]
        same = [s[0] for s, f in zip(rows, fps, strict=True) if f == fp and s[0] is not None]
        want.append((r[0], f"{fp:016x}", min(ids, default=None), min(same, default=None), n))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert len({r["component_id"] for r in got}) < len(texts)


@pytest.mark.parametrize("blocks", [4, 5, 6, 8])
def test_all_close_pairs_and_no_other(spark, blocks):
    rng = random.Random(blocks)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        fp = rng.getrandbits(64)
        fps.add(fp)
        for bits in (1, 2, 3, 4, 5):
            fps.add(fp ^ sum(1 << b for b in rng.sample(range(64), bits)))
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = sorted(map(tuple, simhash.close_pairs(df, blocks=blocks, part_rows=4).collect()))
    close = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3
    assert got == [(a, b) for a in fps for b in fps if a < b and close(a, b)]


def test_hot_fingerprints_and_empty_tables(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text for many").alias("text"))
    got = simhash.simhash_components(docs, hot_copies=150)
    assert {tuple(r) for r in got.select("component_id", "class_id", "n_links").collect()} == {(1, 1, 199), (0, 0, 99)}
    assert simhash.simhash_components(docs.limit(0)).collect() == []


def test_tables_cover_every_choice_of_bits():
    masks = simhash.table_masks()
    assert len(masks) == 20
    for bits in ([0, 1, 2], [0, 31, 63], [10, 11, 53], [21, 42, 63]):
        x = sum(1 << b for b in bits)
        assert any((x & (m % (1 << 64))) == 0 for m in masks)
    with pytest.raises(ValueError):
        simhash.table_masks(distance=6, blocks=6)
