"""Periodic runs against the definition, over tiles of several sizes, and on odd rows."""

import hashlib
import random
import re
import zlib

import pytest
from brute import collapsed, periodic_runs as plain

from strataflow.llm import catalog, periodic_runs

SHAPE = "doc_id bigint, text string"


def words_with_runs(rng, n):
    """Words of small or large alphabets with stretches of copied blocks, some of them nested or cut short."""
    out = []
    while len(out) < n:
        if rng.random() < 0.5:
            out += [str(rng.randrange(rng.choice((1, 2, 3, 1000)))) for _ in range(rng.randrange(1, 30))]
        else:
            block = [str(rng.randrange(rng.choice((2, 5, 50)))) for _ in range(rng.choice((1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40, 70)))]
            if rng.random() < 0.3:
                block = block * rng.randrange(2, 5) + ["x"]
            out += (block * 9)[: int(len(block) * rng.uniform(2, 8))]
    return out[:n]


def found_by_tiles(texts):
    parts = []
    for k, text in enumerate(texts):
        ids = periodic_runs.numbered(text)
        given = [(len(ids), *cut, ids[cut[2] : cut[4]]) for cut in periodic_runs.tiles(len(ids))]
        parts.append([x[1:] for x in periodic_runs.solve(given)])
    return parts


@pytest.mark.parametrize("core", [64, 256, 1 << 16])
def test_runs_equal_the_definition(spark, monkeypatch, core):
    monkeypatch.setattr(periodic_runs, "CORE", core)
    rng = random.Random(core)
    texts = [" ".join(words_with_runs(rng, rng.choice((23, 24, 25, 60, 200, 700)))) for _ in range(60)]
    texts += ["a " * 500, "a b " * 300, ("a " * 7 + "b ") * 60, " ".join(map(str, range(300))) + " " + " ".join(map(str, range(300))) + " " + " ".join(map(str, range(300)))]
    rows = [(k, q, a, b) for k, found in enumerate(found_by_tiles(texts)) for q, a, b in found]
    whole = periodic_runs.stitched(spark.createDataFrame(rows, "doc bigint, period bigint, start bigint, stop bigint")).collect()
    got = {k: sorted(((r.start, r.stop - r.start, r.period) for r in whole if r.doc == k), key=lambda r: (r[0], r[2])) for k in range(len(texts))}
    expected = {k: plain(text.split()) for k, text in enumerate(texts)}
    assert got == expected
    assert sum(map(len, expected.values())) > 50


def test_several_tiles_at_once(monkeypatch):
    monkeypatch.setattr(periodic_runs, "STEP", 64)
    rng = random.Random(3)
    texts = [" ".join(words_with_runs(rng, rng.randrange(1, 300))) for _ in range(40)] * 2  # copies side by side
    given = []
    for text in texts:
        ids = periodic_runs.numbered(text)
        given += [(len(ids), *cut, ids[cut[2] : cut[4]]) for cut in periodic_runs.tiles(len(ids))] or [(0, 8, 8, 0, 0, 0, ids)]
    long = [x for x in periodic_runs.solve(given) if x[3] - x[2] >= max(24, 3 * x[1])]
    got = [sorted(((a, b - a, q) for t, q, a, b in long if t == k), key=lambda r: (r[0], r[2])) for k in range(len(texts))]
    assert got == [plain(t.split()) for t in texts]


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PIECE", 50)
    rng = random.Random(9)
    rows = [(n, "\n\t ".join(words_with_runs(rng, 150)) + " ") for n in range(30)]
    rows += [(1, None), (None, None), (None, "a b " * 20), (None, "c"), (40, ""), (41, " \n"), (42, "é\x1c \x85ü " * 24), (43, "z " * 40), (43, "z " * 40)]
    frame = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as runs", "2 as doc", "3 as period", "4 as start")
    for options in ({}, {"long": 0, "small": -1}):
        got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(frame, **options).collect())
        expected = []
        for key, text in rows:
            words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
            expected.append((key is not None, key or 0, len(words), plain(words), collapsed(words, plain(words))))
        assert got == sorted(expected)
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SHAPE)).count() == 0


def test_long_text_in_tiles(spark):
    block = [f"w{n}" for n in range(30_000)]
    words = ["head"] * 5 + block * 3 + ["x"] * 30 + block[:7]
    [row] = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(words))], SHAPE), long=1000).collect()
    assert [tuple(r) for r in row.runs] == [(5, 90_000, 30_000), (90_005, 30, 1)]
    assert row.collapsed == " ".join(words[:30_005] + ["x"] + block[:7])


def planted(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_equals_brute_force(spark, folder):
    rows = {r.doc_id: r for r in catalog.op12_periodic_runs(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        words, row = planted(doc.doc_id, doc.text), rows[doc.doc_id]
        runs = plain(words) if len(words) < 1500 else None
        if runs is None:
            continue
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
