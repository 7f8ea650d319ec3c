"""Every operator against a plain form, and on NULLs, empty tables, repeated rows and clashing names."""

import os
import random
import time
from collections import Counter

import numpy as np
import xxhash
import pytest
from brute import edit_distance, groups

import corpus_pipeline
from strataflow.llm import (
    byte_tokens, catalog, chat_format, latent_search, line_dedup, pair_ranking, pieces, quality_rules, shared, shingle_join, simhash_dedup, surrogates,
    token_counts, training_order,
)

RANKS, MODEL = f"{catalog.TOKENIZERS}/byte_bpe_50k.tiktoken", f"{catalog.TOKENIZERS}/piece_bpe_32k.model"
LONG = " ".join(f"word{n % 977}" for n in range(20_000))
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (None, "no id here at all today"), (None, None), (5, "twice the same row of text"), (5, "twice the same row of text"),
    (6, "one\ntwo  three\n\none"), (7, LONG), (8, "ünï ☃ 日本語 𝒳 <|im_end|>"),
]
SHAPE = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(ODD, SHAPE)
    # Extra columns named as results and helpers are.
    return frame.selectExpr("*", "1 as words", "2 as score", "'x' as fp", "3 as line_id", "4 as kept", "'y' as row", "5 as n_tokens")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta"), (2, None), (3, ""), (1, "alpha beta gamma delta")], "item_id bigint, text string")


def counted(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    seen = Counter(zip(words, words[1:], words[2:]))
    at = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in quality_rules.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(at)


def test_quality_counts(spark, odd, none):
    more = [(n, t) for n, t in enumerate(["a b c a b c", "a a a a", "x\ny\nx\n \n ", "#*# $%&|<>", "a b c d a b"])]
    for frame, given in ((odd, ODD), (spark.createDataFrame(more, SHAPE), more)):
        rows = quality_rules.quality_rules(frame).collect()
        got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
        assert got == sorted(counted(t) for _, t in given)
    assert quality_rules.quality_rules(none).count() == 0


def test_fingerprints_and_groups(spark, odd, none):
    rng = random.Random(4)
    base = " ".join(rng.choice("abcdefghijklmnop") * 3 + str(rng.randrange(90)) for _ in range(400))
    texts = []
    for n in range(60):
        words = base.split() if n % 2 else [str(rng.random()) for _ in range(50)]
        words[rng.randrange(len(words))] = "changed"
        texts.append((n, " ".join(words)))
    rows = simhash_dedup.simhash_components(spark.createDataFrame(texts, SHAPE)).collect()
    found = {n: simhash_dedup.fingerprint(t) % (1 << 64) for n, t in texts}
    links = [(a, b) for a in found for b in found if a < b and (found[a] ^ found[b]).bit_count() <= 2]
    assert {r.doc_id: r.component_id for r in rows} == groups(found, links)
    rows = simhash_dedup.simhash_components(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.fp == 0} == {1}
    assert simhash_dedup.simhash_components(none).count() == 0
    assert sorted(r.doc_id or 0 for r in simhash_dedup.one_of_each(odd).collect()) == [0, 1, 5, 6, 7, 8]


def test_tiles_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([centres ^ (np.uint64(1) << np.uint64(k)) for k in range(30)]))
    own, other = values[::2], values[1::2]
    every = np.concatenate([own, other])
    a, b = simhash_dedup.tile_links(own, other, 2, block=16)
    links = [(i, j) for i in range(len(own)) for j in range(len(every)) if i != j and int(every[i] ^ every[j]).bit_count() <= 2]
    assert groups(range(len(every)), links) == groups(range(len(every)), zip(a.tolist(), b.tolist()))


def test_components_of_chains(spark):
    links = [(n, n + 1) for n in range(40) if n % 13] + [(100, 3), (3, 3), (None, 4)]
    got = {r.node: r.component for r in shared.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {n for pair in links[:-1] for n in pair}
    assert got == {n: c for n, c in groups(nodes, links[:-1]).items()}


def test_lines(spark, odd, none):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["red", "green", "blue", "tall", "small"]) + str(rng.randrange(40)) for _ in range(30)) for _ in range(4)]
    texts = []
    for n in range(30):
        words = base[n % 4].split()
        if n > 3:
            words[rng.randrange(30)] = "other"
        texts.append((n, " ".join(words) + "\nShort one.\n" + f"only {n}"))
    frame = spark.createDataFrame(texts, SHAPE)
    lines = line_dedup.document_lines(frame, "doc_id", "text")
    text_of = {r.line_id: r.norm for r in lines.collect() if r.norm is not None}
    found = line_dedup.fingerprints(lines.where("norm is not null").select("line_id", "norm").distinct())
    sim_of = {r.line_id: r.sim for r in found.collect()}
    for line_id, norm in text_of.items():
        hashes = [xxhash.xxh64_intdigest(word, seed=42) for word in norm.split()]
        assert sim_of[line_id] == sum(1 << k for k in range(60) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
    links = [
        (a, b) for a in sim_of for b in sim_of
        if a < b and (sim_of[a] ^ sim_of[b]).bit_count() <= 3 and edit_distance(text_of[a], text_of[b]) <= int(0.2 * max(len(text_of[a]), len(text_of[b])) + 1e-9)
    ]
    got = [tuple(r) for r in line_dedup.line_links(lines).collect()]
    assert links and groups(sim_of, links) == groups(sim_of, got)
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert sum("Short one." in t for t in kept.values()) == 1 and "Short one." in kept[0]
    assert all(f"only {n}" in kept[n] for n in kept)
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert by_id[1].text is None and by_id[1].n_lines == 0 and by_id[6].text == "one\ntwo  three\n" and by_id[7].text == LONG
    assert [r.text for r in rows if r.doc_id == 5] == [ODD[5][1]] * 2
    assert line_dedup.dedup_lines(none).count() == 0


def best_score(v, text):
    known = {p: v.scores[i] for i, p in enumerate(v.pieces) if v.byte_of[i] < 0 and not v.control[i] and i != v.unknown}
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - v.longest), end):
            score = known.get(text[start:end], v.unknown_score if end - start == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_pieces(spark, odd, none):
    v = pieces.vocabulary(pieces.read_model(MODEL))
    encoder = pieces.Encoder(v)
    for text in ["the  the   the", "a b", "naïve café\ttab", " x", "日本語 𝒳", "onreat ansting ntator", "a" * 90]:
        ids = encoder.encode([text])[0].tolist()
        marked = "▁" + text.replace(" ", "▁")
        unknown = sum(v.codes[ord(c)] == 0 or c not in v.pieces for c in marked)
        score = sum(v.scores[i] for i in ids if v.byte_of[i] < 0) + unknown * v.unknown_score
        assert score == best_score(v, marked) and pieces.decode(v, ids) == text
    rows = pieces.encode_documents(odd, MODEL).collect()
    assert len(rows) == len(ODD) and all(r.round_trip for r in rows) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert pieces.encode_documents(none, MODEL).count() == 0


def test_leaks(spark, odd, none, items):
    rng = random.Random(5)
    words = [f"w{n}" for n in range(3000)]
    bench = [(n, " ".join(rng.sample(words, 20 + 5 * n))) for n in range(8)]
    docs = []
    for n in range(80):
        body = [rng.choice(words[:300]) for _ in range(120)]
        if n % 10 == 3:
            item = bench[n // 10][1].split()
            for k in range(0, len(item) - 9, 7):
                item[k] = "changed"
            body[50:50] = item
        docs.append((n, " ".join(body)))
    found = latent_search.leaks(spark.createDataFrame(docs, SHAPE), spark.createDataFrame(bench, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(n, n // 10) for n in range(80) if n % 10 == 3}
    assert latent_search.leaks(odd, items).count() == 0
    assert latent_search.leaks(none, items).count() == 0
    assert latent_search.leaks(odd, items.limit(0)).count() == 0


def test_chat(spark):
    log = [
        (1, 1, 0, "open", "user", None), (1, 2, 0, "delta", None, "Hel"), (1, 3, 0, "delta", None, "lo"),
        (1, 4, 1, "open", "assistant", None), (1, 5, 1, "delta", None, "bad"), (1, 6, 1, "regenerate", None, None), (1, 7, 1, "delta", None, "good <|im_end|>"),
        (1, 7, 1, "delta", None, "good <|im_end|>"), (1, 8, 2, "open", "user", None), (1, 9, 2, "delta", None, "lost"), (1, 10, 1, "edit", None, "new"),
        (2, 1, 0, "open", None, None), (2, 2, 0, "what", None, "x"), (None, 1, None, "open", "user", "t"),
    ]
    events = spark.createDataFrame(log, "conv_id bigint, seq bigint, turn bigint, kind string, role string, text string")
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_format.folded(events).collect()}
    assert got == {(1, 0): ("user", "Hello"), (1, 1): ("assistant", "new"), (2, 0): (None, ""), (None, None): ("user", "")}
    texts = ["<|", "<\\|", "<\\\\|x", "a<|im_start|>", "", None, "|<"]
    talk = [(9, n, "assistant" if n % 2 else "us\ner&<|", t) for n, t in enumerate(texts)]
    frame = chat_format.rendered(spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string")).first()
    assert chat_format.parse(frame.formatted) == [(r, t or "") for _, _, r, t in talk]
    assert "".join(chat_format.unescape(frame.formatted[s.start : s.end]) for s in frame["mask"]) == "".join(t or "" for _, _, r, t in talk if r == "assistant")


def test_ranking(spark, folder, odd, none):
    docs, labels = shared.table(spark, folder, "documents"), shared.table(spark, folder, "labels")
    rows = pair_ranking.pair_ranking(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert rows and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    rows = pair_ranking.pair_ranking(odd, labels.limit(0)).collect()
    assert len(rows) == len(ODD) and all(abs(r.score - pair_ranking.CUT) < 1e-9 for r in rows)
    assert pair_ranking.pair_ranking(none, labels).count() == 0


def test_slots_are_a_permutation():
    for total in (1, 2, 3, 100, 4097):
        assert sorted(training_order.slots(np.arange(total), total, 11).tolist()) == list(range(total))


def test_training_order(spark, odd, none):
    folder = training_order.training_order(odd, RANKS, length=16, per_shard=32)
    rows = training_order.read_from(spark, folder, per_shard=32, length=16).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    coder = byte_tokens.ByteTokens(byte_tokens.read_ranks(RANKS))
    mine = [i for r in sorted((r for r in rows if r.doc_id == 7), key=lambda r: r.part) for i in np.frombuffer(r.payload, "<u2")[: r.n_tokens].tolist()]
    assert mine == [*coder.encoding.encode_ordinary(LONG), 50256]
    later = training_order.read_from(spark, folder, 50, per_shard=32, length=16)
    assert sorted(r.slot for r in later.collect()) == list(range(50, len(rows)))
    assert training_order.read_from(spark, training_order.training_order(none, RANKS)).count() == 0


def test_byte_tokens():
    coder = byte_tokens.ByteTokens(byte_tokens.read_ranks(RANKS))
    for text in ["a b", "a  b", " a", "a ", "a\nb c", "a \n b", "it's we'll", "日本 語", "\n\n", "", "x\t y"]:
        assert coder.encode(text).tolist() == coder.encoding.encode_ordinary(text)


def test_token_counts(spark, odd, none):
    coder = byte_tokens.ByteTokens(byte_tokens.read_ranks(RANKS))
    rows = token_counts.token_counts(odd, RANKS).collect()
    for key, text in ODD:
        if key and text is not None and key != 5:
            own = [r for r in rows if r.doc_id == key]
            assert sum(r.n_tokens for r in own) == len(coder.encoding.encode_ordinary(text))
            assert [r.n_chars for r in own] == [len(x) for x in text.splitlines(True) if True] or key in (2, 3, 6)
    spans = spark.createDataFrame([(1, "hello wonderful world", [("a", 0, 8), ("b", 8, 15), (None, None, 3)])], "doc_id int, text string, spans " + token_counts.SECTIONS)
    got = {r.section: (r.n_tokens, r.n_crossing) for r in token_counts.token_counts(spans, RANKS, sections="spans").collect()}
    assert got == {"a": (1, 0), "b": (1, 1), None: (1, 0)}
    assert token_counts.token_counts(none, RANKS).count() == 0


def test_surrogates(spark, odd, none):
    texts = [
        (1, "Write to Ann.Lee@mail.example.com, or call +1 (293) 555-9179; Mr. John Smith and Mrs Smith know."),
        (2, "ann.lee@mail.example.com again, 4316522678525456 and 4316-5226-7852-5456 at 8.196.19.208"), (3, "plain text, 12 words and 3.5 numbers"),
    ]
    rows = {r.doc_id: r for r in surrogates.replace_entities(spark.createDataFrame(texts, SHAPE), "k").collect()}
    assert rows[3].text == texts[2][1] and rows[1].kinds == ["email", "phone", "name", "name"] and rows[2].kinds == ["email", "card", "card", "ip"]
    assert not any(x in rows[1].text + rows[2].text for x in ("Lee@", "555-9179", "Smith", "4316522678525456", "8.196.19.208"))
    assert rows[1].text.split()[2].rstrip(",").lower() == rows[2].text.split()[0].rstrip(",")
    card, dashed = rows[2].text.split()[2], rows[2].text.split()[4]
    assert dashed.replace("-", "") == card and card[0] == "4"
    # One-digit octets leave 6561 values for 2500 addresses, so many collide at first.
    many = [(n, f"{n // 729 % 9 + 1}.{n // 81 % 9 + 1}.{n // 9 % 9 + 1}.{n % 9 + 1}") for n in range(800)]
    got = [r.text for r in surrogates.replace_entities(spark.createDataFrame(many, SHAPE), "k").collect()]
    assert len(set(got)) == len(many) and not set(got) & {t for _, t in many}
    rows = surrogates.replace_entities(odd, "k").collect()
    assert len(rows) == len(ODD) and {r.text for r in rows} == {t for _, t in ODD}
    assert surrogates.replace_entities(none, "k").count() == 0


def test_pipeline_stages(spark, folder, odd):
    docs = shared.table(spark, folder, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = shared.saved(stage(spark, docs, folder), name)
        assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        docs = after
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert {r.doc_id for r in docs.collect()} <= set(texts)
    done = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert done.where("round_trip").count() == docs.count()
    assert corpus_pipeline.lines(spark, odd, folder).columns == odd.columns
    assert corpus_pipeline.near_duplicates(spark, odd, folder).columns == odd.columns
    assert corpus_pipeline.quality(spark, odd, folder).count() <= len(ODD)


def test_leaks_are_dropped_by_row(spark, tmp_path):
    item = " ".join(f"item{n}" for n in range(30))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = [" ".join(f"plain{n}x{k}" for k in range(60)) for n in range(3)]
    docs = [(None, f"{plain[0]} {item}"), (None, plain[1]), (None, plain[1]), (7, f"{item} {plain[0]}"), (7, plain[2]), (8, plain[2]), (9, None), (None, None)]
    frame = spark.createDataFrame(docs, SHAPE).selectExpr("*", "1 as version", "2 as row")
    left = corpus_pipeline.decontamination(spark, frame, str(tmp_path))
    assert left.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(d for d in docs if item not in (d[1] or ""))


def test_near_duplicates_by_jaccard(spark, odd, none):
    rng = random.Random(6)
    base = [[f"w{rng.randrange(500)}" for _ in range(90)] for _ in range(6)]
    common = [f"c{n}" for n in range(25)]
    texts = [(None if n == 7 else n, " ".join(common + [rng.choice("xyz") if rng.random() < n % 4 * 0.012 else w for w in base[n % 6]])) for n in range(90)]
    texts += [(200 + n, " ".join(common + [f"s{rng.randrange(10**6)}" for _ in range(n)])) for n in range(40)]
    shingles = []
    for _, text in texts:
        words = text.split()
        shingles.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    pairs = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])]
    group = groups(range(len(texts)), pairs)
    assert any(shingles[i] != shingles[j] for i, j in pairs) and len(set(group.values())) < len(texts)
    want = {min((texts[i][0] is None, texts[i][0] or 0, i) for i in group if group[i] == g)[2] for g in set(group.values())}
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(texts, SHAPE), None).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(texts[i] for i in want)
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.near_duplicates(spark, odd, None).collect()) == [0, 1, 5, 6, 7, 8]
    assert corpus_pipeline.near_duplicates(spark, none, None).count() == 0


def test_near_duplicates_meet_by_simhash(spark, monkeypatch):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(5000)}" for _ in range(900)] for _ in range(5)]
    texts = []
    for n in range(40):
        words = list(base[n % 5])
        words[rng.randrange(900)] = f"other{n}"
        texts.append((n, " ".join(words)))
    found = {n: simhash_dedup.simhash(np.unique(simhash_dedup.shingle_hashes(t, 5))) for n, t in texts}
    linked, links = [], simhash_dedup.fingerprint_links
    rows = [(n, 800 + n, found[n]) for n in found]
    nodes = spark.createDataFrame(rows, "node bigint, size int, fp bigint")
    got = [tuple(r) for r in shingle_join.simhash_pairs(nodes, links, 0.8).collect()]
    want = [(a, b) for a in found for b in found if a < b and ((found[a] ^ found[b]) % (1 << 64)).bit_count() <= simhash_dedup.RADIUS]
    assert want and groups(found, got) == groups(found, want)
    # Sizes that rule the similarity out make no pair.
    apart = nodes.withColumn("size", simhash_dedup.F.expr("cast(pow(2, node) as bigint)"))
    assert not shingle_join.simhash_pairs(apart, links, 0.8).collect()
    monkeypatch.setattr(simhash_dedup, "fingerprint_links", lambda distinct: linked.append({r.fp for r in distinct.collect()}) or links(distinct))
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(texts, SHAPE), None).collect()
    assert linked[-1] == set(found.values()) and {r.doc_id for r in kept} == set(range(5))


def test_surrogates_never_run_out(spark, monkeypatch):
    # One value for each number of syllables: as when all values of four syllables are taken.
    monkeypatch.setattr(surrogates, "LATIN", ("ba",) * 16)
    monkeypatch.setattr(surrogates, "OWN_FORMAT", 2)
    texts = [(n, f"Mr {name} came") for n, name in enumerate(["Smith", "Jones", "Brown"])]
    # An address that is its own only form, so no redraw in its format can replace it.
    texts += [(9, "to _@-.com now")]
    rows = {r.doc_id: r.text for r in surrogates.replace_entities(spark.createDataFrame(texts, SHAPE), "k").collect()}
    assert len(set(rows.values())) == 4 and not set(rows.items()) & set(texts)
    assert sorted(len(rows[n]) for n in range(3)) == [len("Mr  came") + 2 * k for k in (4, 5, 6)]
    own = surrogates.surrogate(surrogates.F.col("v"), surrogates.F.col("a"), "k")
    given = spark.createDataFrame([("1.2.3.4", a) for a in range(surrogates.OWN_FORMAT + 3)], "v string, a int")
    drawn = [r[0] for r in given.orderBy("a").select(own).collect()]
    assert all(len(x) == 7 for x in drawn[: surrogates.OWN_FORMAT]) and any(len(x) > 7 for x in drawn[surrogates.OWN_FORMAT :])


def test_similar_lines_become_candidates(spark):
    rng = random.Random(8)
    texts = []
    for n in range(120):
        words = [rng.choice("bcdfg") + str(rng.randrange(300)) for _ in range(6 + n % 20)]
        texts.append(" ".join(words))
        for k in rng.sample(range(len(words)), 1 + len(words) // 10):
            words[k] = "z" + str(rng.randrange(300))
        texts.append(" ".join(words))
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], SHAPE)
    lines = line_dedup.document_lines(frame, "doc_id", "text")
    text_of = {r.line_id: r.norm for r in lines.collect()}
    ids = {t: i for i, t in text_of.items()}
    want = [(ids[a], ids[b]) for a, b in zip(texts[::2], texts[1::2]) if edit_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9)]
    group = groups(ids.values(), [tuple(r) for r in line_dedup.line_links(lines, line_dedup.WIDE).collect()])
    assert len(want) > 60 and sum(group[a] == group[b] for a, b in want) >= 0.9 * len(want)


def test_spaced_items_are_found(spark):
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in "bcdfghklmn" for b in range(60)]
    items = {i: [rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 30, 40, 60]))] for i in range(30)}
    docs, want = [], set()
    for n in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 300))]
        if n < 60:
            item = items[n % 30]
            # Verbatim, with one other word between each two, or with two.
            gap = n % 3
            spread = [w for t in item for w in [t, *(rng.choice(["other", "filler", "between"]) for _ in range(gap))]]
            at = rng.randrange(len(words))
            words[at:at] = spread
            want.add((n, n % 30))
        docs.append((n, " ".join(words)))
    frame = spark.createDataFrame(docs, SHAPE)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in latent_search.leaks(frame, bench).collect()}
    long = {(d, i) for d, i in want if len(items[i]) >= 30}
    print("found", len(got & want), "of", len(want), "long", len(got & long), "of", len(long), "others", len(got - want))
    assert len(got & want) >= 0.9 * len(want) and not {d for d, _ in got} & set(range(60, 150))


def test_passed_over_windows_hold_no_leak():
    rng = random.Random(5)
    items = latent_search.read_items([(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(4, 30))), None) for i in range(12)])
    weight = latent_search.np.array([rng.random() for _ in items.vocabulary] + [0.0])
    sizes, least = latent_search.least_weights(items, weight)
    skipped = 0
    for _ in range(900):
        ids = latent_search.np.array([rng.choice([-1, -1, -1, -1, rng.randrange(len(items.vocabulary))]) for _ in range(rng.randrange(1, 200))])
        count = len(latent_search.windows(ids))
        kept = set(latent_search.may_leak(ids, weight, sizes, least, 0, count).tolist())
        for w in set(range(count)) - kept:
            skipped += 1
            for terms in items.terms:
                region = ids[max(0, w * latent_search.STEP - len(terms)) : w * latent_search.STEP + latent_search.WINDOW + len(terms)].tolist()
                assert latent_search.common_subsequence(terms, region) < latent_search.PARAPHRASE * len(terms)
    assert skipped > 50


def test_words_of_regions_are_counted_in_arrays(monkeypatch):
    monkeypatch.setattr(latent_search, "PAIRS", 7)
    rng = random.Random(5)
    items = [[rng.randrange(40) for _ in range(rng.randrange(1, 30))] for _ in range(12)]
    ends, terms = np.cumsum([0, *map(len, items)]), np.concatenate(items)
    for _ in range(200):
        ids = np.array([rng.choice([-1, rng.randrange(40)]) for _ in range(rng.randrange(1, 200))], np.int32)
        item = np.array([rng.randrange(12) for _ in range(rng.randrange(1, 30))])
        low = np.array([rng.randrange(len(ids)) for _ in item])
        high = np.minimum(low + rng.randrange(80), len(ids))
        want = [sum(t in ids[a:b].tolist() for t in items[i]) for a, b, i in zip(low, high, item)]
        assert latent_search.held_words(ids, low, high, terms, ends, item).tolist() == want


def test_saved_leaves_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    count = lambda: sum("shuffle_" in files.getAllFiles().apply(i).getName() for i in range(files.getAllFiles().size()))
    before = count()
    made = shared.saved(spark.range(20000).selectExpr("id % 997 AS k", "id").repartition(7, "k"), "many")
    for _ in range(50):
        if count() <= before:
            break
        time.sleep(0.1)
    assert count() <= before and made.count() == 20000


def test_maps_rule_out_no_near_pair(spark):
    np, rng = shingle_join.np, random.Random(6)
    sets = []
    for size in (1, 5, 40, 300, 3000):
        own = [rng.getrandbits(64) for _ in range(size)]
        for changed in (0, size // 20, size // 9, size // 8 + 1, size):
            sets.append(np.unique(np.array([rng.getrandbits(64) if i < changed else h for i, h in enumerate(own)], np.uint64)).view(np.int64))
    pairs = [(x, y) for x in sets for y in sets]
    maps = [np.array([shingle_join.bit_map(p[k]) for p in pairs]) for k in (0, 1)]
    sizes = [np.array([len(p[k]) for p in pairs]) for k in (0, 1)]
    kept = shingle_join.may_be_near(*maps, *sizes, 0.8).tolist()
    near = [len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) for x, y in pairs]
    assert any(near) and all(k for k, n in zip(kept, near) if n) and sum(kept) < 1.5 * sum(near)


def test_sets_are_sent_for_possible_pairs_only(spark, monkeypatch):
    rng = random.Random(12)
    common = " ".join(f"c{i}" for i in range(12))
    texts = [" ".join([common, *(f"w{rng.randrange(10**6)}" for _ in range(60))]) for _ in range(40)]
    texts.append(texts[0].replace("c3 ", "x "))
    written, saved = {}, shingle_join.saved

    def counted(frame, label, *rest):
        found = saved(frame, label, *rest)
        written.setdefault(label, []).append(found.count())
        return found

    monkeypatch.setattr(shingle_join, "saved", counted)
    frame = spark.createDataFrame(list(enumerate(texts)), SHAPE)
    rows = simhash_dedup.one_of_each(frame, shingle=5, similarity=0.8).collect()
    assert {r.doc_id for r in rows} == set(range(40))
    assert written["pairs"][0] <= 1 and "sets" not in written


def test_dense_stretches_are_searched_whole(monkeypatch):
    rng, asked, may_leak = random.Random(14), [], latent_search.may_leak
    items = latent_search.read_items([(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(15, 50))), None) for i in range(12)])
    weight = np.array([rng.random() for _ in items.vocabulary] + [0.0])
    sizes, least = latent_search.least_weights(items, weight)
    monkeypatch.setattr(latent_search, "may_leak", lambda ids, *rest: asked.append(len(ids)) or may_leak(ids, *rest))
    for known in (0.0, 0.1, 0.2, 0.5, 1.0):
        ids = np.array([rng.randrange(len(items.vocabulary)) if rng.random() < known else -1 for _ in range(2000)])
        count = len(latent_search.windows(ids))
        asked.clear()
        found = set(latent_search.to_search(ids, weight, sizes, least, 0, count).tolist())
        assert found >= set(may_leak(ids, weight, sizes, least, 0, count).tolist())
        assert (len(found) == count and not asked) if known >= 0.5 else asked == [len(ids)]


def test_basis_is_fitted_on_every_document(spark):
    np = latent_search.np
    rng = random.Random(16)
    items = latent_search.read_items([(i, " ".join(f"w{rng.randrange(90)}" for _ in range(30)), None) for i in range(3)])
    weight = np.array([0.5 + rng.random() for _ in items.vocabulary] + [0.0])
    texts = [[rng.choice([-1, rng.randrange(len(items.vocabulary))]) for _ in range(rng.choice([3, 25, 45]))] for _ in range(8010)]
    texts.append([rng.randrange(len(items.vocabulary)) for _ in range(25000)])
    known = spark.createDataFrame([(n, bytearray(np.array(t, np.int32).tobytes())) for n, t in enumerate(texts)], "doc_id bigint, ids binary")
    got = latent_search.latent_basis(known, items, weight)
    rows = np.concatenate([latent_search.windows(np.array(t)) for t in texts])
    own = np.concatenate([latent_search.windows(np.array(t)) for t in items.terms])
    columns = len(items.vocabulary)
    basis = np.linalg.qr(np.random.default_rng(3).standard_normal((columns, min(latent_search.RANK, columns))))[0].astype(np.float32)
    gram = np.zeros((columns, columns), np.float64)
    for part, times in ((rows, latent_search.FIT_DOCUMENTS / len(texts)), (own, 50)):
        dense = latent_search._dense(part, weight, columns).astype(np.float64)
        dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
        gram += times * dense.T @ dense
    # The full width spans everything, so what a direction weighs is compared: each column's own value.
    assert got.shape[1] == basis.shape[1]
    want = np.linalg.eigvalsh(gram)[-got.shape[1] :]
    assert np.allclose(np.einsum("ij,ij->j", got, gram @ got), want, rtol=1e-3, atol=1e-3 * want.max())


def test_words_are_those_of_the_pattern():
    rng = random.Random(17)
    for _ in range(3000):
        text = "".join(rng.choice("ab_ß3Σ .,-'\"\n\t\x1c\x85 ​́–…é中%") for _ in range(12))
        assert latent_search.words(text) == latent_search._WORD.findall(text.lower())


def test_all_pairs_of_a_line_make_keys(spark):
    rng = random.Random(18)
    texts = []
    for n in range(150):
        words = [rng.choice("bcdfg") + str(rng.randrange(300)) for _ in range(40)]
        texts.append(" ".join(words))
        for k in range(n % 4, 40, 4):
            words[k] = "z" + words[k][1:]
        texts.append(" ".join(words))
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], SHAPE)
    lines = line_dedup.document_lines(frame, "doc_id", "text")
    text_of = {r.line_id: r.norm for r in lines.collect()}
    ids = {t: i for i, t in text_of.items()}
    sim = {r.line_id: r.sim for r in line_dedup.fingerprints(lines.select("line_id", "norm")).collect()}
    want = [(ids[a], ids[b]) for a, b in zip(texts[::2], texts[1::2]) if (sim[ids[a]] ^ sim[ids[b]]).bit_count() <= line_dedup.WIDE]
    group = groups(ids.values(), [tuple(r) for r in line_dedup.line_links(lines, line_dedup.WIDE).collect()])
    assert len(want) > 40 and all(group[a] == group[b] for a, b in want)


def test_keys_of_all_rounds_are_all_keys(spark, monkeypatch):
    rows = [(n, [n + 10 * k for k in range(n)]) for n in range(1, 6)]
    pairs = spark.createDataFrame(rows, "line_id bigint, pairs array<bigint>")
    whole = sorted(tuple(r) for r in line_dedup.line_keys(pairs).collect())
    parts = sorted(tuple(r) for n in range(1, 5) for r in line_dedup.line_keys(pairs, n, 4).collect())
    assert parts == whole and [sum(i == n for i, _ in whole) for n in range(1, 6)] == [1, 1, 3, 5, 7]
    texts = [(n, f"one two three four five six {w}\nother {w}") for n, w in enumerate(["seven", "seven", "sevens", "even"])]
    frame = spark.createDataFrame(texts, SHAPE)
    once = sorted(map(tuple, line_dedup.dedup_lines(frame).collect()))
    monkeypatch.setattr(line_dedup, "ROUND_KEYS", 7)
    monkeypatch.setattr(line_dedup, "ROUNDS", 3)
    assert sorted(map(tuple, line_dedup.dedup_lines(frame).collect())) == once and sum(r[3] for r in once) == 4


def test_scratch_of_lines_goes_when_it_is_read(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    frame = spark.createDataFrame([(n, f"a b c d e f g{n % 2}") for n in range(6)], SHAPE)
    found = line_dedup.dedup_lines(frame)
    assert sum(r.n_removed for r in found.collect()) == 5
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(base)) - before} == {"gone"}
