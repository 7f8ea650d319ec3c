"""Classifier, token attribution and surrogates against plain Python on random rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import regex

from strataflow.llm import byte_tokens, catalog, pair_ranking, quality_rules, surrogates, token_counts

RANKS = f"{catalog.TOKENIZERS}/byte_bpe_50k.tiktoken"
SHAPE = "doc_id bigint, text string"
BLANKS = " \t\n\x0b\x0c\r"


def plain_features(text):
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(BLANKS)]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    symbols, letters = sum(c in quality_rules.SYMBOLS for c in text or ""), sum(map(len, words))
    n = max(len(words), 1)
    return {
        "symbols": math.log(1 + 100 * symbols / n), "some_symbols": min(1, 10 * symbols / n), "repeats": len(repeated) / n,
        "some_repeats": min(1, 4 * len(repeated) / n), "word_length": min(1, abs(letters / n - 5) / 5),
        "repeated_lines": (len(lines) - len(set(lines))) / max(len(lines), 1), "words": math.log(1 + len(words)), "few_words": 1 / (1 + len(words)),
    }


def test_features_equal_plain_counts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(["ab ", "ab ", "cd\n", "#", " ", "xyz ", "é|\t"], k=rng.randint(0, 60))) for _ in range(80)] + [None, ""]
    got = pair_ranking.features(spark.createDataFrame(list(enumerate(texts)), SHAPE)).collect()
    for row in got:
        want = plain_features(texts[row.doc_id])
        assert {k: row[k] for k in want} == pytest.approx(want), texts[row.doc_id]


def test_scores_equal_the_plain_formula(spark, folder, monkeypatch):
    fits = []
    fit = pair_ranking.fit

    def noted(x, good, often):
        fits.append((fit(x, good, often), len(x), often.sum()))
        return fits[-1][0]

    monkeypatch.setattr(pair_ranking, "fit", noted)
    monkeypatch.setattr(pair_ranking, "MAX_LABELLED", 60)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    many = docs.unionByName(docs.where("doc_id = 1")).unionByName(docs.where("doc_id = 1"))
    rows = pair_ranking.pair_ranking(many, labels).collect()
    (ranking, taught, stood), = fits
    assert 30 <= taught <= 60 <= 2 * stood and len(rows) == many.count()
    for row in pair_ranking.features(docs).collect():
        x = np.array([row[name] for name in pair_ranking.FEATURES])
        raw = ranking.gain * (ranking.weights @ ((x - ranking.mean) / ranking.scale) - ranking.threshold) + math.log(0.7 / 0.3)
        (score, predicted), *_ = {(r.score, r.predicted) for r in rows if r.doc_id == row.doc_id}
        assert score == pytest.approx(1 / (1 + math.exp(-raw))) and predicted == (score >= 0.7)


def test_counted_rows_weigh_as_often_as_they_occur():
    rng = np.random.default_rng(1)
    x, often = rng.normal(size=(300, 4)), rng.integers(1, 6, 300)
    good = x[:, 0] + 0.3 * rng.normal(size=300) > 0
    counted, whole = pair_ranking.fit(x, good, often), pair_ranking.fit(np.repeat(x, often, axis=0), np.repeat(good, often))
    assert counted.mean == pytest.approx(whole.mean) and counted.scale == pytest.approx(whole.scale)
    side = lambda r: (x - r.mean) / r.scale @ r.weights > r.threshold
    assert np.average(side(counted) == side(whole), weights=often) > 0.95 and np.average(side(counted) == good, weights=often) > 0.85


def plain_counts(coder, text, spans):
    """Tokens and crossing tokens of each span, None for no span; a token goes where most of its bytes lie."""
    owner = []
    for at, c in enumerate(text):
        inside = [n for n, (start, end) in enumerate(spans) if start <= at < end]
        owner += [inside[0] if inside else None] * len(c.encode())
    found, at = Counter(), 0
    for token in coder.encoding.encode_ordinary(text):
        size = len(coder.encoding.decode_single_token_bytes(token))
        held = Counter(o for o in owner[at : at + size] if o is not None)
        best = min(held, key=lambda o: (-held[o], o)) if held else None
        found[best, "tokens"] += 1
        found[best, "crossing"] += bool(held) and held[best] < size
        at += size
    return found


@pytest.mark.parametrize("by", ["lines", "spans"])
def test_token_counts_equal_plain_attribution(spark, by):
    rng = random.Random(by)
    coder = byte_tokens.ByteTokens(byte_tokens.read_ranks(RANKS))
    texts = ["".join(rng.choices(["hello", " wonder", "ful", "\n", "\n\n", "日本", "é", " ", "12", "!"], k=rng.randint(0, 40))) for _ in range(60)]
    spans = []
    for text in texts:
        if by == "lines":
            cuts = [0, *(n + 1 for n, c in enumerate(text) if c == "\n"), len(text)]
            spans.append(list(zip(cuts, cuts[1:])))
        else:
            cuts = sorted(rng.sample(range(len(text) + 1), min(6, len(text) + 1)) if text else [])
            spans.append([p for p in zip(cuts, cuts[1:]) if rng.random() < 0.7])
    rows = [(n, t, [(str(k), *p) for k, p in enumerate(spans[n])]) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, f"{SHAPE}, spans {token_counts.SECTIONS}")
    got = token_counts.token_counts(frame, RANKS, sections="spans" if by == "spans" else None).collect()
    for n, text in enumerate(texts):
        want = plain_counts(coder, text, spans[n])
        own = {r.section: (r.n_tokens, r.n_crossing) for r in got if r.doc_id == n}
        labels = {str(k): (want[k, "tokens"], want[k, "crossing"]) for k in range(len(spans[n]))}
        assert own == labels | ({None: (want[None, "tokens"], 0)} if want[None, "tokens"] else {}), text


def test_surrogates_are_one_to_one_and_leave_the_rest(spark):
    rng = random.Random(11)
    names = ["Smith", "Παπάς", "Иванов", "Պետրոսյան", "O'Neil", "Lee"]
    make = [
        lambda: f"{rng.choice(['Mr', 'Mrs.', 'Frau'])} {rng.choice(names)}", lambda: f"Ms {rng.choice(names)} {rng.choice(names)}",
        lambda: f"{rng.choice('abc')}.{rng.choice('xyz')}@{rng.choice(['one', 'two'])}.example.org",
        lambda: ".".join(str(rng.randint(1, 9)) for _ in range(4)), lambda: f"+1 ({rng.randint(200, 202)}) 555-{rng.randint(1000, 1009)}",
        lambda: "4316" + "".join(rng.choices("0123456789", k=12)), lambda: "".join(rng.choices("0123456789abcdef", k=40)),
        lambda: "plain words", lambda: "3.5 and 12",
    ]
    texts = [" ; ".join(rng.choice(make)() for _ in range(rng.randint(0, 8))) for _ in range(150)]
    rows = surrogates.replace_entities(spark.createDataFrame(list(enumerate(texts)), SHAPE), "k").collect()
    pattern = regex.compile(surrogates.ANY)
    pairs = {}
    for row in rows:
        old, new = pattern.findall(texts[row.doc_id]), pattern.findall(row.text)
        assert len(old) == len(new) == row.n_entities
        assert pattern.split(texts[row.doc_id]) == pattern.split(row.text)
        for kind, a, b in zip(row.kinds, old, new):
            assert regex.sub(r"[\w']", "", a) == regex.sub(r"[\w']", "", b) or kind == "name"
            if kind == "name":
                assert a.split()[0] == b.split()[0] and len(a.split()) == len(b.split())
                for x, y in zip(a.split()[1:], b.split()[1:]):
                    assert all(bool(regex.search(rf"\p{{{s}}}", x)) == bool(regex.search(rf"\p{{{s}}}", y)) for s in surrogates.ENDS)
            spelt = {"card": r"\D", "phone": r"\D", "name": r"^\S+ "}.get(kind, "$^")
            one, other = (regex.sub(spelt, "", v).lower() for v in (a, b))
            assert pairs.setdefault((kind, one), other) == other and one != other
    assert len({(kind, other) for (kind, _), other in pairs.items()}) == len(pairs)
    assert not {(kind, other) for (kind, _), other in pairs.items()} & set(pairs)
