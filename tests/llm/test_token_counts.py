import random

import pytest

from tidemark.llm.token_counts import PieceCounter, token_counts

public = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


def texts():
    rng = random.Random(6)
    make = lambda n: "".join(rng.choice("ab é▁ \t\n  ☃xyz<s>") for _ in range(n))
    return [None, "", " ", "<s> </s> <unk>", "a" * 3000, " " * 3000, "▁ " * 900, "é" * 2500 + " x"] + [make(rng.randint(1, 2500)) for _ in range(80)]


@pytest.mark.parametrize("chunk,overlap", [(48, 6), (300, 40), (32_768, 512)])
def test_equals_the_library(chunk, overlap):
    path = public.path("piece_bpe_32k.model")
    whole = sentencepiece.SentencePieceProcessor(model_file=path)
    counter = PieceCounter(path, chunk, overlap)
    assert counter.splits
    own = [(t or "").encode() for t in texts()]
    assert counter.count(own) == [len(whole.encode(b.decode())) for b in own]


def test_columns(spark):
    rows = [(k, t, "keep") for k, t in enumerate(texts())] + [(None, "x y", "keep")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = token_counts(docs, public.path("piece_bpe_32k.model"), limit=900).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 900)
    assert token_counts(docs.limit(0), public.path("piece_bpe_32k.model")).count() == 0
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in token_counts(docs.where("doc_id < 20"), public.path("byte_bpe_50k.json")).collect()}
    assert got == {k: len(t.encode(x or "", add_special_tokens=False).ids) for k, x, _ in rows[:20]}
