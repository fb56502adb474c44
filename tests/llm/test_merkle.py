"""Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest

from parley.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, row long, digest string, tree int, at int, node int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(items):
    out = [items]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def plain(rows):
    null_first = lambda v: (v is not None, v if v is not None else 0)
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        by_lang[g].sort(key=lambda r: (null_first(r[0]), leaf(r[:5])))
        trees[g] = levels([leaf(r[:5]) for r in by_lang[g]])
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for at, g in enumerate(langs):
        for pos, r in enumerate(by_lang[g]):
            folded = trees[g][0][pos]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                folded = leaf([*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])])
            proof = []
            for tree, place in ((trees[g], pos), (top, at)):
                for nodes in tree[:-1]:
                    run = nodes[place - place % 8 : place - place % 8 + 8]
                    proof += run[: place % 8] + run[place % 8 + 1 :]
                    run[place % 8] = folded
                    folded, place = sha("".join(run)), place // 8
            out.append((r[0], leaf(r[:5]), trees[g][-1][0], top[-1][0], sha("".join(proof)), folded, folded == top[-1][0]))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def compare(spark, rows):
    padded = [(*r, 1, "d", 2, 3, 4) for r in rows]
    got = [tuple(r) for r in merkle.merkle_manifest(spark.createDataFrame(padded, SCHEMA)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    return got


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(merkle, "CHUNK", 8)
    monkeypatch.setattr(merkle, "CHUNK_LEVELS", 1)


@pytest.mark.parametrize("counts", [{"en": 1}, {"en": 600, "de": 9, None: 1, "é": 8, "": 2}, {f"l{i:03d}": 1 + i % 3 for i in range(70)}])
def test_against_plain_recomputation(spark, small_chunks, counts):
    rows, i = [], 0
    for lang, n in counts.items():
        for _ in range(n):
            i += 1
            text = [None, "", "ABC é Ö", "x" * i, "Long " * 3000][i % 5]
            rows.append((i * 7 % 1000, None if i % 4 else f"s{i % 3}", lang, None if i % 6 == 0 else len(text or ""), text))
    if len(rows) > 1:
        rows += [rows[0], rows[0], (rows[0][0], "other", rows[0][2], None, "Tie"), (None, None, None, None, "No Id"), (None,) * 5]
    got = compare(spark, rows)
    if len(rows) > 1:
        assert {r[6] for r in got} == {True, False}


def test_default_chunks_and_deep_trees(spark):
    rows = [(i, "s", "en" if i % 9 else "de", i, f"Text {i}") for i in range(5000)]
    assert {r[6] for r in compare(spark, rows)} == {True, False}


def test_empty_table(spark):
    assert merkle.merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
