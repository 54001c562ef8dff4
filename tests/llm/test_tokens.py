import os
import random

import pytest

from shotlake.llm import tokens

PATH = f"{tokens.TOKENIZERS}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")


def plain(texts):
    return [e.ids for e in tokens._tokenizer(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("size", [4, 16, 256, 1 << 20])
def test_any_cut_gives_the_whole_texts_ids(size, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CHUNK", size)
    rnd = random.Random(size)
    letters = "ab1'. \n\t 　\x1c\x85 ẩđ\U0001f600木,"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(90))) for _ in range(3000)] + ["", None, "a" * 5000, " " * 3000, "bản tin " * 2000, "<|endoftext|>"]
    enc = tokens.Encoder(PATH)
    for _ in range(2):
        assert enc.encode(pa.array(texts)).to_pylist() == plain(texts)
    assert (enc.repaired > 0) == (size < 1000) and enc.met >= 2 * enc.coded


def test_passages_are_cut_alike_and_encoded_once():
    import pyarrow as pa

    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcđeêghiklmnoôơpqrstuưvxy") for _ in range(rnd.randrange(1, 8)))
    passage = " ".join(word() for _ in range(2000))
    texts = [word() * 5 + passage + word() * k for k in range(20)]
    enc = tokens.Encoder(PATH)
    assert enc.encode(pa.array(texts)).to_pylist() == plain(texts)
    # But for the first and last chunk of each text all are those of the passage.
    assert enc.coded <= enc.met / 20 + 3 * 20 and enc.repaired > enc.met / 2


def test_cache_starts_anew_when_full(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHE_BYTES", 100)
    enc = tokens.Encoder(PATH)
    for t in (["một hai"], ["ba bốn"], ["một hai"]):
        assert enc.encode(pa.array(t)).to_pylist() == plain(t)


def test_query(spark):
    rows = [(1, "bản tin 24 giờ"), (2, ""), (3, None), (4, "x"), (4, "x")]
    df = spark.createDataFrame(rows, "ids long, text string")
    got = sorted((r[0], list(r[1])) for r in tokens.token_ids(df, "ids", "text", out="out").collect())
    assert got == sorted((k, e) for (k, _), e in zip(rows, plain([t for _, t in rows])))
    assert tokens.token_ids(df.limit(0), "ids", "text", out="out").count() == 0
