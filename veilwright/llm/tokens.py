"""Encoding of a whole corpus with a public byte-level BPE.

Texts are split into pre-tokens. Documents are taken in batches; a batch has its own
list of distinct words and each document becomes the numbers of its words in order, so a
position is an index and no word is moved more than once a batch. The words of all
batches meet in one shuffle, where each distinct word is encoded once; its ids are joined
back to the batches and documents are reassembled by position. Decoding joins the table
of token bytes.
"""

from __future__ import annotations

import base64
import secrets
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, spread

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-token pattern. White space is the Unicode property, as in
#: the tokenizer's own engine.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Pre-tokens after which a batch ends; a document is never divided.
BATCH_TOKENS = 1 << 20
_LONG = 1 << 22  # letters from which on the pre-tokens of a text aren't held all at once


def load_ranks(path: str = DEFAULT_RANKS) -> dict[bytes, int]:
    """Token bytes to ids; the file is small and of fixed size."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}


class _Numbers(dict):
    """Words to numbers in order of their first occurrence."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def pretokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """``(batch, doc_id, codes, words)``: a row for every document with the numbers of its pre-tokens
    in the word list of its batch, and one for every batch with that list, whose codes are null."""
    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def split(batches):
        import regex

        pat = regex.compile(PATTERN)
        ids, codes, ends, numbers = [], array("i"), [0], _Numbers()

        def flush():
            batch = secrets.randbits(62)
            n = len(ids)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(codes, np.int32)))
            yield _rows(batch, pa.array(ids, pa.int64()), lists, pa.nulls(n, pa.list_(pa.string())))
            if numbers:
                yield _rows(batch, pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.array([list(numbers)], pa.list_(pa.string())))
            ids.clear(), numbers.clear()
            del codes[:]
            ends[:] = [0]

        def _rows(batch, *cols):
            return pa.record_batch([pa.array(np.full(len(cols[0]), batch)), *cols], names=["batch", "doc_id", "codes", "words"])

        for b in batches:
            for doc, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids.append(doc)
                if t:
                    words = pat.findall(t) if len(t) < _LONG else (m[0] for m in pat.finditer(t))
                    codes.extend(map(numbers.__getitem__, words))
                ends.append(len(codes))
                if len(codes) >= batch_tokens:
                    yield from flush()
        if ids:
            yield from flush()

    return d.mapInArrow(split, "batch bigint, doc_id bigint, codes array<int>, words array<string>")


def encode_words(words: DataFrame, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """``(word, ids)`` of ``words`` (column ``word``), each row encoded once."""
    ranks = words.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def encode(batches):
        import tiktoken

        enc = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks.value, special_tokens={})
        for b in batches:
            ids = [enc.encode_ordinary(w) for w in b.column("word").to_pylist()]
            yield pa.record_batch([b.column("word"), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    return words.select("word").mapInArrow(encode, "word string, ids array<int>")


def _reassemble(docs: pa.Table, words: pa.Table) -> pa.Table:
    """``(doc_id, ids)`` of a batch: the ids of the words its documents have, position by position."""
    codes = docs.column("codes").combine_chunks()
    size = np.diff(codes.offsets.to_numpy())
    if words.num_rows:
        order = np.argsort(words.column("code").to_numpy())
        ids = words.column("ids").combine_chunks().take(pa.array(order)).take(codes.flatten())
        at = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
        flat = ids.flatten()
    else:
        at, flat = np.zeros(1, np.int64), pa.array([], pa.int32())
    ends = at[np.concatenate([[0], np.cumsum(size)])]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    return pa.table({"doc_id": docs.column("doc_id"), "ids": lists})


def encode_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks_path: str = DEFAULT_RANKS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """``(doc_id, ids)``, one row for every row of ``docs``; null and empty texts give an empty list.

    Text that looks like a special token is plain text; null ids stay null. A word occurs
    at most once a batch, so however frequent it is, it is no hot spot of the shuffle, and
    what is grouped is a batch, whose size is bounded but for a single longer document.
    """
    toks = materialize(pretokens(spread(docs.select(doc_id, text)), doc_id, text, batch_tokens), "p8-words")
    words = toks.where("words is not null").select(F.col("batch").alias("of"), F.posexplode("words").alias("code", "word")).repartition("word")
    vocab = encode_words(words.select("word").distinct(), ranks_path)
    back = words.join(vocab, "word").select("of", "code", "ids")
    rows = toks.where("codes is not null").select("batch", "doc_id", "codes")
    return rows.groupBy("batch").cogroup(back.groupBy("of")).applyInArrow(_reassemble, "doc_id bigint, ids array<int>")


def token_table(spark: SparkSession, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """``(token, bytes)`` of the vocabulary."""
    ranks = load_ranks(ranks_path)
    t = pa.table({"token": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())})
    return spark.createDataFrame(t)


def decode_corpus(encoded: DataFrame, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """``(doc_id, text)``; an empty list gives the empty text. The token table is of fixed size, hence broadcast."""
    spark = encoded.sparkSession
    table = F.broadcast(token_table(spark, ranks_path))
    flat = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "token"))
    flat = flat.join(table, "token", "left").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("bytes").alias("h")))).alias("p"))
    return flat.select("doc_id", F.decode(F.unhex(F.array_join(F.col("p.h"), "")), "UTF-8").alias("text"))
