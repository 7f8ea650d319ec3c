"""Ranked search against plain scores, with small blocks and passes, ties, and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strataflow.llm import lexical_index

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def plain(docs, items, k=20):
    found = [(key, Counter(terms(text))) for key, text in docs if terms(text)]
    n_docs, n_terms = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    rows = []
    for item, text in items:
        scores = []
        for key, counts in found:
            m = 75 + 25 * counts.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * counts[t] // (1000 * counts[t] + 12 * m)) for t in terms(text) if counts[t])
            if score > 0:
                scores.append((-score, key is not None, key or 0))
        rows += [(item, n, key if known else None, -s) for n, (s, known, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=repr)


def ranked(spark, docs, items, **options):
    folder = lexical_index.build_index(spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as m", "2 as terms", "3 as n").repartition(3))
    found = lexical_index.search(spark, folder, spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as item", "2 as rank"), **options)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


def corpus(rng, n):
    words = ["the", "The", "über", "Ünter", "a1", "日本", "naïve", "x_y", "q-r"] + [f"w{k}" for k in range(80)]
    docs = []
    for key in range(n):
        size = rng.choice((1, 3, 10, 10, 10, 40, 200))
        docs.append((key, rng.choice((" ", ", ", "\n", "\x00")).join(words[min(int(rng.expovariate(0.08)), len(words) - 1)] for _ in range(size))))
    copy = docs[3][1]
    return docs + [(n + k, copy) for k in range(60)]  # many equal scores


@pytest.mark.parametrize("block, pairs, first, cells", [(4096, 1 << 20, 8, 1 << 21), (5, 12, 1, 20)])
def test_ranks_equal_plain_scores(spark, monkeypatch, block, pairs, first, cells):
    for name, value in (("BLOCK", block), ("PAIRS", pairs), ("FIRST", first), ("CELLS", cells)):
        monkeypatch.setattr(lexical_index, name, value)
    rng = random.Random(block)
    docs = corpus(rng, 250)
    items = [(n, " ".join(rng.choice(docs)[1].split()[:30])) for n in range(12)] + [(50, "the the THE w1"), (51, "nowhere at all"), (52, docs[3][1])]
    got = ranked(spark, docs, items)
    assert got == plain(docs, items)
    assert len(got) > 150


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..., !"), (None, "alpha beta"), (None, "alpha"), (5, "alpha beta beta"), (5, "alpha beta beta"), (6, "gamma " * 50_000 + "alpha"), (7, "delta")]
    items = [(1, "alpha beta"), (1, "alpha beta"), (None, "gamma"), (2, None), (3, ""), (4, "beta beta alpha")]
    assert ranked(spark, docs, items, k=3) == plain(docs, items, 3)
    assert ranked(spark, docs, []) == []
    assert ranked(spark, [], items) == []
    assert ranked(spark, [(1, "one")], [(1, "one")]) == plain([(1, "one")], [(1, "one")])


def test_bounds_hold(spark):
    docs = [(n, f"rare{n % 3} " * 3 + "filler " * (n % 40)) for n in range(200)]
    asked = []
    folder = lexical_index.build_index(spark.createDataFrame(docs, DOCS))
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.select("m").distinct().count() > 10
    # The scorer alone, outside of Spark: a bound is never below a score.
    some = lexical_index.Items(np.array([0]), [b"rare1", b"filler"], np.array([0]), np.array([0, 1]), np.array([1, 2]), np.array([900, 3]))
    scorer = lexical_index._Scorer(some)
    for row in blocks.collect():
        columns = [np.frombuffer(x, "<i4") for x in (row.term_groups, row.tfs, row.term_docs, row.group_docs, row.places)]
        bound = scorer.load(row.m, pa.array([bytes(t) for t in row.terms], pa.binary()), columns[0], columns[1])
        table = scorer.scores(row.m, np.array([0]), row.n_docs, columns[2], columns[1], columns[3], columns[4])
        assert bound[0] >= table.max()
        asked.append(bound[0])
    assert max(asked) > min(asked)
