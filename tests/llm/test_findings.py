"""Tests of the review's findings on the corpus operators, one section for each."""

import random

import numpy as np

from tidegate.llm import queries, token_blocks
from tidegate.llm.queries import tokenizer_path

ODD = [
    *"  \n\n\t\r'''aAzé.,!12s",
    *"\x00\x0b\x1c\x1f\x7f\x85\xa0 　́×÷ɏɐª²Àÿ日\U0001f600Ⅷ",
    *("re", "ll", "ve", "<|endoftext|>"),
]


def test_texts_are_cut_only_where_the_tokenizer_cuts():
    encoder, draw = token_blocks.Encoder(tokenizer_path()), random.Random(5)
    for _ in range(20):
        texts = ["".join(draw.choice(ODD) for _ in range(draw.choice([0, 1, 2, 3, 5, 8, 30]))) for _ in range(200)]
        assert [list(x) for x in encoder.encode(texts)] == encoder.whole(texts)


def test_a_word_is_encoded_once_whatever_stands_behind_it():
    """Every word here has an ending of its own; the whole tokenizer need not see each pair of the two."""
    encoder, seen = token_blocks.Encoder(tokenizer_path()), []
    plain = encoder.whole
    encoder.whole = lambda texts: seen.extend(texts) or plain(texts)
    words = [f"{w}{i}." for i in range(300) for w in ("thonble", "éternel", "Anding")]
    texts = [" ".join(words), "x\n" + "\n".join(words)]
    assert [list(x) for x in encoder.encode(texts)] == plain(texts)
    assert sum(map(len, seen)) < 5000 < sum(map(len, texts)) / 2
    assert not any("thonble" in t for t in seen)


def test_tasks_of_a_worker_share_an_encoder():
    assert token_blocks.encoder_of(tokenizer_path()) is token_blocks.encoder_of(tokenizer_path())


def test_blocks_of_many_exceptions_round_trip():
    draw = np.random.default_rng(3)
    for top in (1 << 17, 1 << 32):
        ids = np.where(draw.random(3000) < 0.93, draw.integers(0, 4, 3000), draw.integers(0, top, 3000))
        starts, payload = token_blocks.pack(ids)
        assert (token_blocks.unpack(starts, payload, 3000) == ids).all()
        assert (token_blocks.unpack(starts, payload, 3000, 2, 5) == ids[256:640]).all()


def test_op1_goes_by_bytes_not_by_words(spark, tmp_path):
    """A passage of 60 words in 399 bytes stays, one of 400 bytes goes, through the query."""
    words = " ".join(f"w{i:04d}" for i in range(70))
    short, long = words[:399], words[:400]
    assert len(short.split()) > 50
    rows = [(i, f"{start}{passage}{end}") for i, (start, passage, end) in enumerate(
        [("<a ", short, "-1>"), ("<b", short, "+2>"), ("<c ", long.upper(), "-3>"), ("<d", long.upper(), "+4>")]
    )]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op1_suffix_merge(spark, str(tmp_path)).select("doc_id", "n_removed", "n_spans").collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0), (1, 0, 0), (2, 400, 1), (3, 400, 1)]
