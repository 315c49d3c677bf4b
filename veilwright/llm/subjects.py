"""Subject areas of documents.

Documents are weighted by term (TF-IDF over hashed terms) and embedded by a truncated
SVD that is computed by a randomised range finder over the whole corpus (more rounds make
it subspace iteration). Labelled documents give seed centroids per area and language,
which are refined on their sentences; then every sentence of every document is compared
with the centroids by cosine, and an area counts for a document when enough of its
sentences are about it.

Words and sentences are cut for a whole block of texts at once, by array operations over
code points, so a pass over the corpus costs little more than reading it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import gather, materialize, release, spread

_BLOCK = 1 << 20  # letters of texts taken together; a longer text is a block of its own
_DOCS = 64  # documents per product of matrices
_PAIRS = 4096  # terms gathered at once
_TILE = 256  # terms per row of a shuffled sum

_TAG = re.compile(r"</?[a-z]+>")
_LETTER, _SPACE, _DIGIT, _STOP = 1, 2, 4, 8
_MULT = 0x9E3779B1
#: Titles whose dot doesn't end a sentence.
_TITLES = ("dr", "mr", "mrs", "prof")


@dataclass
class Settings:
    """Parameters of the fit; defaults are the production values."""

    dims: int = 256
    power_rounds: int = 1  # one round is a randomised range finder
    refine_rounds: int = 3
    labelled_docs: int = 20_000  # bound of the sample of labelled documents on which centroids are fitted
    min_cos: float = 0.10
    min_margin: float = 0.10  # over the best other area
    min_sentences: int = 2
    long_words: int = 8  # runs of more words are tested for missing sentence ends
    min_seed_docs: int = 2  # labelled documents that make a centroid of an area and language
    languages: int = 50  # languages with centroids of their own, the most frequent ones of the labelled documents
    terms: int = 1 << 17  # hashed terms; words share a slot beyond that many
    slots: int = 1 << 20  # hashed word pairs of the sentence statistics
    seed: int = 7


@dataclass
class Model:
    """What the tasks need; its size is bounded by terms x dims + 3 x slots, not by the corpus."""

    idf: np.ndarray
    inside: np.ndarray
    ends: np.ndarray
    starts: np.ndarray
    row_of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))


class Centroids(NamedTuple):
    """Unit vectors in order of their areas; a few per area."""

    areas: list[str]
    area: np.ndarray
    vectors: np.ndarray


# --- words and sentences --------------------------------------------------------------
class Words(NamedTuple):
    """Words of a block of texts in order: hash, number of the text, number of the sentence."""

    hash: np.ndarray
    doc: np.ndarray
    part: np.ndarray


_class = np.full(0x110000, 255, np.uint8)
_power: list[np.ndarray] = [np.ones(1, np.uint32), np.ones(1, np.uint32)]


def _classes(codes: np.ndarray) -> np.ndarray:
    """Class of each code point, looked up once per process."""
    out = _class[codes]
    fresh = np.unique(codes[out == 255])
    if len(fresh):
        for x in fresh.tolist():
            ch = chr(x)
            _class[x] = (_DIGIT if ch.isdecimal() else _LETTER) if ch.isalnum() else _DIGIT if ch == "_" else _SPACE if ch.isspace() else _STOP if ch in ".!?" else 0
        out = _class[codes]
    return out


def _powers(n: int) -> list[np.ndarray]:
    if len(_power[0]) < n:
        for k, base in enumerate((_MULT, pow(_MULT, -1, 1 << 32))):
            p = np.full(max(n, _BLOCK), base, np.uint32)
            p[0] = 1
            _power[k] = np.cumprod(p, dtype=np.uint32)
    return _power


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _runs_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint32)
    np.cumsum(codes * up[: len(codes)], dtype=np.uint32, out=sums[1:])
    return _mix(((sums[end] - sums[start]) * down[start]).astype(np.uint64))


def word_hash(word: str) -> int:
    codes = np.frombuffer(word.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return int(_runs_hash(codes, np.array([0]), np.array([len(codes)]))[0])


_TITLE_HASHES = np.array([word_hash(w) for w in _TITLES])


def cut_words(texts: list[str]) -> Words:
    """Words (letters only, two or more) of texts.

    A sentence ends at a line break, at a tag, and at closing punctuation that white space
    or a letter follows, but for white space after a single letter or a title.
    """
    low = [t.lower() for t in texts]
    first = np.cumsum([0, *(len(t) + 1 for t in low)])[:-1].astype(np.int64)
    block = "\0".join(low) + "\0"
    codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    kind = _classes(codes)
    letter = kind == _LETTER
    begins = np.zeros(n, bool)
    begins[first] = True
    cut = begins | (codes == 10)
    if "<" in block and (spans := [m.span() for m in _TAG.finditer(block)]):
        a = np.array(spans)
        step = np.zeros(n + 1, np.int8)
        step[a[:, 0]] += 1
        step[a[:, 1]] -= 1
        letter &= np.cumsum(step[:n], dtype=np.int8) == 0
        cut[a[:, 0]] = True
    edge = np.diff(letter.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = _runs_hash(codes, start, end)
    p = np.flatnonzero(kind == _STOP) + 1
    cut[p[letter[p]]] = True
    q = p[kind[p] == _SPACE]
    if len(q) and len(start):
        back = lambda d: np.maximum(q - d, 0)
        alone = (q >= 2) & letter[back(2)] & (begins[back(2)] | (kind[back(3)] == _SPACE) | (codes[back(3)] == 40))
        at = np.minimum(np.searchsorted(end, q - 1), len(end) - 1)
        ahead = np.maximum(start[at] - 1, 0)
        title = (end[at] == q - 1) & np.isin(hashes[at], _TITLE_HASHES) & (begins[start[at]] | ((kind[ahead] & (_LETTER | _DIGIT)) == 0))
        cut[q[~((codes[back(1)] == 46) & (alone | title))]] = True
    long = end - start >= 2
    start, hashes = start[long], hashes[long]
    return Words(hashes, np.searchsorted(first, start, side="right") - 1, np.cumsum(cut, dtype=np.int32)[start].astype(np.int64))


def _blocks(batch: pa.RecordBatch, *cols: str) -> Iterator[list[list]]:
    """Rows of a batch in blocks of about _BLOCK letters, as lists by column, the text first."""
    lists = [batch.column(c).to_pylist() for c in cols]
    at, used = 0, 0
    for k, t in enumerate(lists[0]):
        if used and used + len(t) > _BLOCK:
            yield [x[at:k] for x in lists]
            at, used = k, 0
        used += len(t) + 1
    if at < batch.num_rows:
        yield [x[at:] for x in lists]


def _slot(a: np.ndarray, b: np.ndarray, slots: int) -> np.ndarray:
    """Slots of word pairs; hashes have 32 bits, so the products have 64."""
    x = (a.astype(np.uint64) * np.uint64(0x9E3779B1)) ^ (b.astype(np.uint64) * np.uint64(0x85EBCA77))
    return (x % np.uint64(slots)).astype(np.int64)


def _spans(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each sentence."""
    first = np.flatnonzero(np.diff(part, prepend=-1))
    return first, np.diff(first, append=len(part))


def sentences(w: Words, m: Model, long_words: int) -> Words:
    """Words of sentences of two words or more, sentences numbered from 0.

    Long runs are cut between words that hardly ever follow each other within a sentence,
    though the one often ends and the other begins one.
    """
    first, size = _spans(w.part)
    new = np.zeros(len(w.hash), bool)
    new[first] = True
    slots = len(m.inside)
    k = np.flatnonzero(np.repeat(size > long_words, size) & ~new)
    a, b = w.hash[k - 1], w.hash[k]
    new[k[m.inside[_slot(a, b, slots)].astype(np.int64) * 50 < np.minimum(m.ends[a % slots], m.starts[b % slots])]] = True
    part = np.cumsum(new)
    first, size = _spans(part)
    ok = np.repeat(size >= 2, size)
    new &= ok
    return Words(w.hash[ok], w.doc[ok], np.cumsum(new[ok]) - 1)


# --- vectors ----------------------------------------------------------------------------
def _weights(group: np.ndarray, hashes: np.ndarray, n: int, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the known terms, unit-length weights and group of each distinct term of each of ``n`` groups, by group."""
    terms = len(m.idf)
    pair, count = np.unique(group * terms + hashes % terms, return_counts=True)
    term, row = pair % terms, pair // terms
    val = (1 + np.log(count)) * m.idf[term]
    norm = np.sqrt(np.bincount(row, val * val, minlength=n))
    val = (val / np.where(norm > 0, norm, 1)[row]).astype(np.float32)
    k = m.row_of[term]
    known = k >= 0
    return k[known], val[known], row[known]


def _embed(group: np.ndarray, hashes: np.ndarray, n: int, m: Model) -> np.ndarray:
    """Embeddings of ``n`` groups of words, one row each (zero without known terms)."""
    k, val, row = _weights(group, hashes, n, m)
    out = np.zeros((n, m.vectors.shape[1]), np.float32)
    first, size = _spans(row)
    for s in np.unique(size).tolist():  # groups of equal size are one product
        of = first[size == s]
        step = max(1, _PAIRS // s)
        for i in range(0, len(of), step):
            at = of[i : i + step, None] + np.arange(s)
            out[row[at[:, 0]]] = np.matmul(val[at][:, None, :], m.vectors[k[at]])[:, 0, :]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(n > 0, n, 1)


def _counts(texts: DataFrame, s: Settings) -> tuple[int, dict[str, np.ndarray]]:
    """Document frequencies of terms and sentence statistics, over all documents, in one pass.

    Texts of a single sentence tell nothing about where sentences end.
    """

    def count(batches):
        df, inside, ends, starts = np.zeros(s.terms, np.int64), *(np.zeros(s.slots, np.int64) for _ in range(3))
        n = 0
        for b in batches:
            for (t,) in _blocks(b, "text"):
                n += len(t)
                w = cut_words(t)
                pair = np.sort(w.doc * s.terms + w.hash % s.terms)
                df += np.bincount(pair[np.diff(pair, prepend=-1) > 0] % s.terms, minlength=s.terms)
                first, size = _spans(w.part)
                several = np.bincount(w.doc[first], minlength=len(t)) >= 2
                use = (size >= 2) & several[w.doc[first]]
                np.add.at(starts, w.hash[first[use]] % s.slots, 1)
                np.add.at(ends, w.hash[(first + size - 1)[use]] % s.slots, 1)
                inner = np.repeat(use, size)
                inner[first] = False
                k = np.flatnonzero(inner)
                np.add.at(inside, _slot(w.hash[k - 1], w.hash[k], s.slots), 1)
        for kind, x in enumerate((df, inside, ends, starts, np.array([n]))):
            at = np.flatnonzero(x)
            yield pa.record_batch([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(x[at])], names=["kind", "slot", "n"])

    # At most terms + 3 slots rows come back.
    got = texts.mapInArrow(count, "kind int, slot int, n bigint").groupBy("kind", "slot").agg(F.sum("n").alias("n")).toArrow()
    kind, slot, n = (got.column(c).to_numpy() for c in ("kind", "slot", "n"))
    out = {}
    for k, (name, size) in enumerate((("df", s.terms), ("inside", s.slots), ("ends", s.slots), ("starts", s.slots))):
        x = np.zeros(size, np.int64)
        x[slot[kind == k]] = n[kind == k]
        out[name] = x
    return int(n[kind == 4].sum()), out


_SUMS = "k int, v binary"


def _tiles(total: np.ndarray) -> pa.RecordBatch:
    """A task's sums as rows of _TILE vectors in single precision; tiles without any are left out."""
    k = [i for i in range(0, len(total), _TILE) if total[i : i + _TILE].any()]
    v = [total[i : i + _TILE].astype(np.float32).tobytes() for i in k]
    return pa.record_batch([pa.array(k, pa.int32()), pa.array(v, pa.binary())], names=["k", "v"])


def _sum_tiles(rows: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of what all tasks returned; its size is that of the result, whatever the number of tasks."""

    def add(key, table):
        total = sum(np.frombuffer(v.as_buffer(), np.float32).astype(np.float64) for v in table.column("v"))
        return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(shape)
    for r in rows.groupBy("k").applyInArrow(add, _SUMS).toArrow().to_pylist():
        x = np.frombuffer(r["v"]).reshape(-1, shape[1])
        out[r["k"] : r["k"] + len(x)] = x
    return out


def _truncated_svd(texts: DataFrame, m: Model, s: Settings) -> None:
    """Right singular vectors of the document-term matrix A: repeatedly Q := orth(A'AQ).

    A task adds up A'(AQ) of its documents before anything leaves it: at most one vector
    per term.
    """
    used = np.flatnonzero(m.idf > 0)
    m.row_of = np.full(len(m.idf), -1, np.int32)
    m.row_of[used] = np.arange(len(used))
    dims = min(s.dims, max(1, len(used)))
    q = np.linalg.qr(np.random.default_rng(s.seed).standard_normal((len(used), dims)))[0]
    sc = texts.sparkSession.sparkContext
    for _ in range(s.power_rounds):
        sent = sc.broadcast(Model(m.idf, *[m.inside[:0]] * 3, m.row_of, q.astype(np.float32)))

        def multiply(batches, sent=sent, n=len(used), dims=dims):
            m, total = sent.value, np.zeros((n, dims), np.float32)
            for b in batches:
                for (t,) in _blocks(b, "text"):
                    w = cut_words(t)
                    k, val, row = _weights(w.doc, w.hash, len(t), m)
                    border = np.searchsorted(row, np.arange(0, len(t) + _DOCS, _DOCS))
                    for i, (x, y) in enumerate(zip(border[:-1].tolist(), border[1:].tolist(), strict=True)):
                        terms, col = np.unique(k[x:y], return_inverse=True)
                        a = np.zeros((_DOCS, len(terms)), np.float32)
                        a[row[x:y] - i * _DOCS, col] = val[x:y]
                        total[terms] += a.T @ (a @ m.vectors[terms])
            yield _tiles(total)

        y = _sum_tiles(texts.mapInArrow(multiply, _SUMS), (len(used), dims))
        sent.unpersist()
        q = np.linalg.qr(y)[0]
    m.vectors = q.astype(np.float32)


def _scores(e: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best area, its cosine, and the margin over the best other area."""
    size = np.sqrt(np.einsum("ij,ij->i", e, e))[:, None]
    sim = (e @ c.vectors.T) / np.where(size > 0, size, 1)
    first = np.flatnonzero(np.diff(c.area, prepend=-1))  # centroids are in order of their areas
    by = np.full((len(e), len(c.areas)), -1.0, np.float32)
    by[:, c.area[first]] = np.maximum.reduceat(sim, first, axis=1)
    rows = np.arange(len(e))
    best = by.argmax(axis=1)
    top = by[rows, best]
    by[rows, best] = -1.0
    return best, top, top - by.max(axis=1)


def _fit_centroids(labelled: DataFrame, areas: list[str], langs: list[str], sent: Broadcast, s: Settings) -> Centroids:
    """Seed centroids per area and language from labelled documents, refined on their sentences.

    A centroid is the mean of its members less the mean of its language, so what all
    areas share counts for none. In refinement a sentence belongs to the best area if
    that is one of its document's labels. Documents of other languages than ``langs``
    count only for the centroid over all languages that an area gets if it has too few
    documents in each. ``labelled`` is bounded by ``labelled_docs``.
    """
    dims = sent.value.vectors.shape[1]
    n_area, n_lang = len(areas), len(langs) + 1
    lang_of, area_of = {x: k for k, x in enumerate(langs)}, {x: k for k, x in enumerate(areas)}

    def sums(seeds: Centroids | None):
        def body(batches):
            m = sent.value
            total = np.zeros(((n_area + 1) * n_lang, dims + 1))
            for b in batches:
                for texts, marks, lang in _blocks(b, "text", "areas", "lang"):
                    g = np.array([lang_of.get(x, n_lang - 1) for x in lang])
                    w = cut_words(texts)
                    if seeds is None:
                        e, own = _embed(w.doc, w.hash, len(texts), m), np.arange(len(texts))
                    else:
                        w = sentences(w, m, s.long_words)
                        own = w.doc[_spans(w.part)[0]]
                        e = _unit(_embed(w.part, w.hash, len(own), m))
                    e = np.concatenate([e, np.ones((len(e), 1))], axis=1)
                    np.add.at(total, n_area * n_lang + g[own], e)
                    allowed = np.zeros((len(texts), n_area), bool)
                    for k, x in enumerate(marks):
                        allowed[k, [area_of[a] for a in x]] = True
                    if seeds is None:
                        k, a = np.nonzero(allowed)
                        np.add.at(total, a * n_lang + g[k], e[k])
                    elif len(e):
                        best, top, margin = _scores(e[:, :-1].astype(np.float32), seeds)
                        q = (top > s.min_cos) & (margin > s.min_margin) & allowed[own, best]
                        np.add.at(total, best[q] * n_lang + g[own[q]], e[q])
            yield _tiles(total)

        out = _sum_tiles(labelled.mapInArrow(body, _SUMS), ((n_area + 1) * n_lang, dims + 1))
        return out.reshape(n_area + 1, n_lang, -1)

    got = None
    for _ in range(s.refine_rounds + 1):
        t = sums(got)
        n = t[:, :, -1:]
        mean = t[:, :, :-1] / np.where(n > 0, n, 1)
        keep, cents = [], []
        for a in range(n_area):
            for g in range(n_lang - 1):
                if n[a, g, 0] >= s.min_seed_docs:
                    keep.append((a, g))
                    cents.append(mean[a, g] - mean[n_area, g])
            if not any(k[0] == a for k in keep) and n[a].sum() > 0:  # too few in each language
                keep.append((a, -1))
                cents.append(t[a, :, :-1].sum(0) / n[a].sum() - t[n_area, :, :-1].sum(0) / n[n_area].sum())
        if got is not None and len(keep) < len(got.area):
            break  # refinement lost a centroid: the seeds stay
        got = Centroids(areas, np.array([k[0] for k in keep], np.int64), _unit(np.array(cents)).astype(np.float32))
    return got


def assign_subjects(
    docs: DataFrame, labels: DataFrame, area_table: DataFrame, settings: Settings | None = None,
    doc_id: str = "doc_id", text: str = "text", lang: str = "lang", area: str = "area",
) -> DataFrame:
    """``(doc_id, area)`` of every area that at least ``min_sentences`` sentences of a text are about.

    Null and blank texts have none, rows without id are left out. Labels may repeat and
    be spelt in any case; those of unknown areas or documents don't count. An area is known
    by what sets it apart, so the result is empty without usable labels, and with labels of
    one area only if it has no documents beside it. Counts, statistics and vectors come from
    all documents; centroids from at most ``labelled_docs`` labelled documents, chosen by a
    hash of their id.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    clean = lambda c: F.lower(F.trim(c))
    raw = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull() & (F.length(F.trim(text)) > 0))
    raw = raw.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.substring(clean(F.col(lang)), 1, 2), F.lit("")).alias("lang"))
    rows = spread(raw)
    known = area_table.select(clean(F.col(area)).alias("area")).where("area <> ''").distinct()
    marks = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), clean(F.col(area)).alias("area")).join(known, "area", "left_semi")
    marks = marks.where("doc_id is not null").groupBy("doc_id").agg(F.collect_set("area").alias("areas"))
    some = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.labelled_docs)  # a bounded table, so it may be broadcast
    kept = labelled = materialize(raw.join(F.broadcast(some), "doc_id").select("text", "areas", "lang"), "p10-labelled")
    areas = sorted(r[0] for r in labelled.select(F.explode("areas")).distinct().collect())
    empty = spark.createDataFrame([], "doc_id bigint, area string")
    if not areas:
        return empty
    langs = [r["lang"] for r in labelled.where("lang <> ''").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.languages).collect()]
    labelled = spread(labelled)
    texts = gather(rows, 1).select("text")
    n, c = _counts(texts, s)
    idf = np.where(c["df"] > 0, np.log((n + 1) / (c["df"] + 0.5)), 0.0)
    m = Model(np.maximum(idf, 0), *(c[k].astype(np.int32) for k in ("inside", "ends", "starts")))
    if not (m.idf > 0).any():
        return empty
    _truncated_svd(texts, m, s)
    sent = spark.sparkContext.broadcast(m)
    cents = _fit_centroids(labelled, areas, langs, sent, s)
    release(kept)

    def assign(batches):
        m = sent.value
        for b in batches:
            for t, doc in _blocks(b, "text", "doc_id"):
                w = sentences(cut_words(t), m, s.long_words)
                own = w.doc[_spans(w.part)[0]]
                best, top, margin = _scores(_embed(w.part, w.hash, len(own), m), cents)
                q = (top > s.min_cos) & (margin > s.min_margin)
                hits = np.bincount(own[q] * len(areas) + best[q], minlength=len(t) * len(areas))
                at = np.flatnonzero(hits >= s.min_sentences)
                ids = pa.array(doc, pa.int64()).take(pa.array(at // len(areas)))
                yield pa.record_batch([ids, pa.array([areas[a] for a in (at % len(areas)).tolist()], pa.string())], names=["doc_id", "area"])

    return rows.select("doc_id", "text").mapInArrow(assign, "doc_id bigint, area string").distinct()
