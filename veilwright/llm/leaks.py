"""Evaluation texts leaking into training text.

Size-partitioned MinHash containment search: every 12-word passage of an item belongs to
a size class by its length, and a class has its own window length. The MinHash of a window
is the least hash of the shingles in it. A document that contains a passage has, at the
word where the passage begins, a window whose MinHash is the passage's, so no leak is
lost, whatever the share of the item that leaked. Windows whose MinHash no item has are
dropped beside the document by a bitmap of fixed size; the others meet the passages in a
join, with an excerpt of the document in which containment is verified exactly.

Texts are compared as streams of folded letters and digits, so case, accents,
punctuation, layout, invisible characters and markup don't matter, even within a word.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

PASSAGE_WORDS = 12
#: Least length, in letters and digits, of the passages of each size class, 12 to a million.
SIZE_CLASSES = [12, *[b for k in range(4, 20) for b in (1 << k, 3 << (k - 1))]]
#: Bits of the bitmap of each size class, as a power of two.
SLOT_BITS = 24
_TEXTS = 1 << 20  # letters of texts taken together; a longer text is taken alone
_SLICE = 1 << 18  # letters hashed at once

_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_MULT = 0x9E3779B97F4A7C15 | 1
_POW = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of each."""
    if not _POW or len(_POW[0]) < n:
        for k, base in enumerate((_MULT, pow(_MULT, -1, 1 << 64))):
            p = np.full(max(n, 2 * _SLICE), base, np.uint64)
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=np.uint64)
    return _POW[0], _POW[1]


def folded(text: str) -> str:
    """Text without markup, entities, accents and case."""
    if "<" in text:
        text = _TAG.sub("\u0001", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.casefold())
        text = "".join([c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c)])
    return text.casefold()


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits of the folded text; empty for null."""
    return _WORD.findall(folded(text)) if text else []


def passages(words: list[str], size: int = PASSAGE_WORDS) -> list[str]:
    """Every run of ``size`` words as one stream; none for shorter texts."""
    return ["".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def size_class(length: int) -> int:
    """The class of a passage: the greatest that isn't longer; the last for all beyond it."""
    return max((s for s in SIZE_CLASSES if s <= length), default=0)


def _codes(stream: str) -> np.ndarray:
    return np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), np.uint32)


def minhashes(codes: np.ndarray, size: int) -> np.ndarray:
    """The MinHash of every window of ``size`` letters; shingles have half that length."""
    n, g = len(codes), size // 2
    if n < size:
        return np.empty(0, np.uint32)
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * up[:n], dtype=np.uint64, out=sums[1:])
    h = (sums[g:] - sums[:-g]) * down[: n - g + 1]
    h ^= h >> np.uint64(29)
    least = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)
    width, have = size - g + 1, 1
    while have * 2 <= width:  # the least of twice as many shingles at a time
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def slots(minhash: np.ndarray) -> np.ndarray:
    """Bits of MinHashes in the bitmap; least values are small, so they are scattered first."""
    return (minhash * np.uint32(2654435761)) >> np.uint32(32 - SLOT_BITS)


def item_keys(item_id: int, text: str | None) -> Iterator[tuple[int, int, int, int, str]]:
    """``(class, MinHash, slot, item_id, passage)`` of each passage of an item."""
    for p in dict.fromkeys(passages(words_of(text))):
        if c := size_class(len(p)):
            h = minhashes(_codes(p[:c]), c)
            yield c, int(h[0]), int(slots(h)[0]), item_id, p


_alnum = np.full(0x110000, 2, np.uint8)


def _is_alnum(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters or digits, looked up once per process."""
    out = _alnum[codes]
    fresh = np.unique(codes[out == 2])
    if len(fresh):
        _alnum[fresh] = [chr(x).isalnum() for x in fresh.tolist()]
        out = _alnum[codes]
    return out.view(bool)


def streams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and digits of folded texts end to end, which of them begin a word, and the border of each text."""
    plain = [folded(t) for t in texts]
    codes = _codes("\0".join(plain))
    use = _is_alnum(codes)
    first = use.copy()
    first[1:] &= ~use[:-1]
    at = np.cumsum([0, *(len(t) + 1 for t in plain)])
    at[-1] -= 1
    count = np.concatenate([[0], np.cumsum(use)])
    return codes[use], first[use], count[at]


def windows(texts: list[str], maps: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int, str, str]]:
    """``(text, class, MinHash, excerpt, borders)`` of each window that begins with a word and whose MinHash is in the class's bitmap.

    The excerpt holds as many letters as a passage of the class may have; a 1 in ``borders``
    tells that a word or the text ends after the letter at its place.
    """
    letters, first, border = streams(texts)
    longest = max(maps)
    for a in range(0, len(letters), _SLICE):
        part = letters[a : a + _SLICE + longest - 1]
        start = np.flatnonzero(first[a : a + _SLICE])
        doc = np.searchsorted(border, start + a, side="right") - 1
        left = border[doc + 1] - a - start
        for c, bits in maps.items():
            ok = left >= c
            s, d = start[ok], doc[ok]
            h = minhashes(part, c)[s]
            k = slots(h)
            hit = np.flatnonzero((bits[k >> np.uint32(3)] >> (k & np.uint32(7)).astype(np.uint8)) & 1)
            more = next((x - 1 for x in SIZE_CLASSES if x > c), None)
            for i in hit.tolist():
                b = a + int(s[i])
                e = int(border[d[i] + 1])
                e = e if more is None else min(e, b + more)
                last = int(e == border[d[i] + 1] or first[e])
                ends = (first[b + 1 : e] + np.uint8(48)).tobytes().decode() + "01"[last]
                yield int(d[i]), c, int(h[i]), letters[b:e].tobytes().decode("utf-32-le", "surrogatepass"), ends


def bitmaps(keys: DataFrame) -> dict[int, np.ndarray]:
    """A bitmap of slots for each size class; at most 2 MB for each class that occurs, however many keys there are."""
    bit = F.col("slot").cast("bigint") + 1  # Spark numbers bits, and the bitmaps that hold 32768 of them, from 1
    rows = keys.groupBy("class", F.bitmap_bucket_number(bit).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out: dict[int, np.ndarray] = {}
    size = 4096  # bytes of one of Spark's bitmaps
    for r in rows.toArrow().to_pylist():
        m = out.setdefault(r["class"], np.zeros(1 << SLOT_BITS - 3, np.uint8))
        part = np.frombuffer(r["bits"], np.uint8)
        m[(r["b"] - 1) * size : (r["b"] - 1) * size + len(part)] |= part
    return out


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(doc_id, item_id)`` of every document that holds at least 12 consecutive words of an item, once.

    Null, empty and shorter texts hold nothing; items under 12 words, or whose 12 words have
    fewer than 12 letters, can't leak; rows without id are left out; items with one id count
    together. Documents are read once, whole, and no text is shuffled but excerpts.
    """
    d = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    q = items.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"))

    def keys_of_items(batches):
        for b in batches:
            for i, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                got = list(zip(*item_keys(i, t), strict=True)) or [[]] * 5
                yield pa.record_batch([pa.array(x, k) for x, k in zip(got, (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True)], names=["class", "minhash", "slot", "item_id", "passage"])

    keys = q.mapInArrow(keys_of_items, "class int, minhash bigint, slot int, item_id bigint, passage string").distinct()
    sent = d.sparkSession.sparkContext.broadcast(bitmaps(keys))
    schema = "doc_id bigint, class int, minhash bigint, excerpt string, borders string"

    def search(batches):
        maps = sent.value
        for b in batches if maps else ():
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            at = 0
            while at < len(texts):
                to, used = at, 0
                while to < len(texts) and (to == at or used + len(texts[to]) <= _TEXTS):
                    used += len(texts[to])
                    to += 1
                got = list(zip(*windows(texts[at:to], maps), strict=True)) or [[]] * 5
                own = ids.take(pa.array([at + k for k in got[0]], pa.int32()))
                yield pa.record_batch([own, *(pa.array(x, k) for x, k in zip(got[1:], (pa.int32(), pa.int64(), pa.string(), pa.string()), strict=True))], names=["doc_id", "class", "minhash", "excerpt", "borders"])
                at = to

    near = spread(d).mapInArrow(search, schema)
    both = near.join(keys.select("class", "minhash", "item_id", "passage"), ["class", "minhash"])
    held = F.startswith("excerpt", "passage") & (F.substr("borders", F.length("passage"), F.lit(1)) == "1")
    return both.where(held).select("doc_id", "item_id").distinct()
