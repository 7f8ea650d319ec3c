"""Long runs: encoded without the pattern's look-ahead, to the same ids; and through both operators."""

import numpy as np
import pytest

from strataflow.llm import byte_tokens, catalog, token_counts, training_order

RANKS = f"{catalog.TOKENIZERS}/byte_bpe_50k.tiktoken"
SHAPE = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def coder():
    return byte_tokens.ByteTokens(byte_tokens.read_ranks(RANKS))


@pytest.mark.parametrize("run", [" ", "\n", "\t", "\r\n", " \n", "　", "\xa0 ", "\x1c", "a", "é", "!", "7"])
def test_cut_runs_give_the_same_ids(coder, monkeypatch, run):
    texts = [f"{a}{run * n}{b}" for n in (1, 2, 3, 7, 50) for a in ("", "it's", " x ", "5") for b in ("", "x", "'s", " 7", "!\n", "日本", " " * 9 + "y")]
    whole = [coder.encoding.encode_ordinary(t) for t in texts]
    for least in (2, 3, 40):
        monkeypatch.setattr(byte_tokens, "_LONG", byte_tokens.re.compile(byte_tokens._LONG.pattern.split("{")[0] + "{%d,}" % least))
        assert [coder.encode(t).tolist() for t in texts] == whole


@pytest.mark.parametrize("text", [" " * 1_000_000 + "x", "\n" * 1_000_000, "a" * 1_000_000, "x" + "\t" * 1_000_000 + "y"])
def test_a_million_of_one(coder, text):
    ids = coder.encode(text)
    assert coder.encoding.decode(ids.tolist()) == text
    assert ids.dtype == np.uint32


def test_operators_on_long_runs(spark):
    rows = [(1, " " * 1_000_000 + "x"), (2, "\n" * 20_000), (3, "plain")]
    docs = spark.createDataFrame(rows, SHAPE)
    counts = {(r.doc_id, r.section): r.n_tokens for r in token_counts.token_counts(docs, RANKS).collect()}
    assert counts[3, "0"] == 1 and sum(1 for d, _ in counts if d == 2) == 20_001
    read = training_order.read_from(spark, training_order.training_order(docs, RANKS))
    assert {r.doc_id for r in read.collect()} == {1, 2, 3}


def test_wide_ids_are_read_as_written(spark, tmp_path):
    """A vocabulary beyond 65,535 ids takes four bytes an id; readers learn it from the folder."""
    import base64

    single = [(bytes([b]), b) for b in range(256)]
    path = tmp_path / "wide.tiktoken"
    wide = single + [(bytes([97 + n % 26, 97 + n // 26 % 26, 97 + n // 676 % 26, 48 + n // 17576]), 256 + n) for n in range(66_000)]
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in wide))
    docs = spark.createDataFrame([(1, "some text"), (2, "")], SHAPE)
    folder = training_order.training_order(docs, str(path), length=16, per_shard=3, seed=5)
    coder = byte_tokens.ByteTokens(byte_tokens.read_ranks(str(path)))
    ids = {}
    for r in training_order.read_from(spark, folder).collect():
        ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.payload, "<u4")[: r.n_tokens].tolist())
    assert {k: v[:-1] for k, v in ids.items()} == {1: coder.encode("some text").tolist(), 2: []}
    assert tuple(spark.read.parquet(f"{folder}/about").first()) == (16, 4, 3, 2, 5)
    with pytest.raises(ValueError, match="width=4"):
        training_order.read_from(spark, folder, width=2)
