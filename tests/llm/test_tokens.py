"""Corpus encoding: the same ids as the tokenizer itself, and back."""

import os

import pytest
from pyspark.sql import functions as F

from veilwright.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.DEFAULT_RANKS), reason="no vocabulary file")
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TEXTS = ["", None, " ", "Hello  world\n\n 's 'll x", "<|endoftext|> <|im_start|>", "患者は安定している。", "😀👍 ok", "a​﻿b", "tab\t\tend  ", "\x1c\x1d x y\xa0 z", "été 𝒳𝒴 ½ µg ±", "it's we'lling 'S", "a" * 5000, "word " * 3000, "𐍈퟿", "مرحبا Здоровье"]


def reference(text):
    import tiktoken

    enc = tiktoken.Encoding("ref", pat_str=PLAIN, mergeable_ranks=tokens.load_ranks(), special_tokens={})
    return enc.encode_ordinary(text or "")


def test_same_ids_and_round_trip(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, word string").repartition(3)
    enc = tokens.encode_corpus(docs)
    got = {r["doc_id"]: list(r["ids"]) for r in enc.collect()}
    assert got == {i: reference(t) for i, t in enumerate(TEXTS)}
    back = {r["doc_id"]: r["text"] for r in tokens.decode_corpus(enc).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_repeats_nulls_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "the the the cat"), (1, "the the the cat"), (None, "the")], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, list(r["ids"])) for r in tokens.encode_corpus(docs).collect())
    assert got == [(0, reference("the")), *[(1, reference("the the the cat"))] * 2]
    assert tokens.encode_corpus(docs.limit(0)).count() == 0


def test_words_meet_across_batches(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("the "), F.col("id").cast("string"), F.lit(" cats")).alias("text"))
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.encode_corpus(docs, batch_tokens=7).collect()}
    assert got == {i: reference(f"the {i} cats") for i in range(200)}
    assert tokens.pretokens(docs.coalesce(1), batch_tokens=7).where("words is not null").count() == 67
