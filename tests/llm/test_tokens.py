"""Encoding: whole texts against pieces, round trips, defined results for odd inputs."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandloom.llm import tokens

FOLDER = tokens.default_folder()


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("ab1 '\n\t.é中‮s-🧬")), max_size=300))
def test_pieces_encode_like_the_whole(text):
    enc = tokens.encoder(FOLDER)
    whole = enc.encode_ordinary(text)
    assert tokens.encode(enc, text, 16).tolist() == whole
    assert tokens.decode(enc, whole) == text


def test_special_looking_text_is_ordinary():
    enc = tokens.encoder(FOLDER)
    ids = tokens.encode(enc, "a<|endoftext|>b").tolist()
    assert 50256 not in ids and tokens.decode(enc, ids) == "a<|endoftext|>b"


def test_bytes_that_are_no_text():
    enc = tokens.encoder(FOLDER)
    ids = enc.encode_ordinary("🧬")
    assert tokens.decode(enc, ids[:1]) == "�"


def test_column(spark):
    long = "word 12, " * 40000
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " ", None), (4, "hi", "y"), (4, "hi", "y"), (5, long, "z"), (None, "hi", "y")], "doc_id long, text string, ids string")
    got = tokens.encode_column(df, ["doc_id"]).collect()
    by = {r["doc_id"]: r["ids"] for r in got}
    assert len(got) == 7 and by[1] == [] and by[2] == [] and len(by[3]) == 1 and by[4] == by[None]
    assert by[5] == tokens.encoder(FOLDER).encode_ordinary(long)
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.count_column(df, ["doc_id"]).collect()}
    assert counts[5] == len(by[5]) and counts[1] == 0
    assert tokens.encode_column(df.limit(0), ["doc_id"]).count() == 0
