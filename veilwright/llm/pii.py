"""Personal information inside free text: finding it and replacing it.

Pieces are found by patterns, with names and towns known from the master table of
personal data. They are replaced by typed placeholders whose content is a
pseudonym: validated numbers and dates are permuted by a keyed Feistel network within
their format, the rest gets a keyed tag of 128 bits, so equal values stay linked across
documents and no table of pseudonyms has to be kept. Dates are masked only on request.

A pattern runs over a text only if the text holds what every match of it has (a sign, a
run of digits, a kind of word), which is looked for first.
"""

from __future__ import annotations

import bisect
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterable
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

TYPES = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")
#: Words of the lexicon up to which it travels to every task; beyond, each text gets its own words by a join.
BROADCAST_WORDS = 200_000

# --- patterns -----------------------------------------------------------------------
_SEP = r"[-. \u00a0\u2010-\u2015]"
_EMAIL = re.compile(r"[^\W_][\w.+-]*@(?:[^\W_][\w-]*\.)+[^\W\d_]{2,}")
_AT_SIGN = re.compile(r"[(\[{]\s?at\s?[)\]}]", re.I)
_DISGUISED = re.compile(
    r"[^\W_][\w.+-]*\s?[(\[{]\s?at\s?[)\]}]\s?[^\W_][\w-]*(?:(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)[^\W_][\w-]*?)*(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)[^\W\d_]{2,}",
    re.I,
)
_FOUR = re.compile(r"\d{4}")  # in every phone number without a plus sign and in every id
_EXT = r"(?:,?\s?(?:ext\.?|extension|x)\s?\d{1,6})?"
_PHONE = re.compile(
    r"(?<![\w@/#+-])(?<!\d[.,:])(?:"
    rf"\+\d{{1,3}}{_SEP}?(?:\(?\d{{2,5}}\)?{_SEP}?)\d{{2,5}}(?:{_SEP}?\d{{2,5}}){{0,2}}"
    rf"|00\d{{1,3}}{_SEP}\d{{3}}{_SEP}\d{{3}}{_SEP}\d{{4}}"
    r"|\(\d{3}\)\s?\d{3}[-. ]\d{4}"
    rf"|(?:1{_SEP})?\d{{3}}([-.  ])\d{{3}}\1\d{{4}}"
    r"|0\d{2}[  ]\d{4}[  ]\d{4}|0\d{4}[  ]\d{6}"
    r"|\d{10}(?!\d)|\d{3}-\d{4}"
    rf"){_EXT}(?![A-Za-z\d_@]|[-/.:]\d)"
)
_SOCIAL = re.compile(r"(?<![\w.+-])\d{3}(?:([- ‐-―])\d{2}\1\d{4}|\d{6})(?![\w]|[-.]\d)")
_SOCIAL_WORD = re.compile(r"\b(?:ssn|soc(?:ial)?\b)", re.I)
#: Codes of one to three capitals and seven to ten digits in one or two groups, as charts, policies, licences and passports have.
_CODE = re.compile(r"(?<![\w-])(?!(?:MRN|SSN)\b)[A-Z]{1,3}(?:[- ]?\d{3,5}[- ]\d{4,5}|[- ]?\d{7,10})(?![\w-])")
_LABELLED = re.compile(
    r"\b(?:mrn|medical record|chart|hospital|patient id|policy|insur(?:ed|ance)|member|licen[cs]e|lic|passport|travel document)\b"
    r"[^\S\r\n]*(?:no\b\.?|number|num\b\.?|id\b|#)?[^\S\r\n]*[:#]?[^\S\r\n]*([A-Z]{0,3}-?\d[\dA-Z-]{4,14}\d)(?![\w-])",
    re.I,
)
_LATIN = r"[A-Za-zÀ-ÖØ-öø-ɏ]"
_STREET = r"street|st|avenue|ave|boulevard|blvd|road|rd|lane|ln|row|way|court|ct|close|drive|dr|place|pl|square|sq|terrace"
_WORDC = r"[^\W\d_][\w'’-]*"
_LINE = re.compile(
    rf"(?<![\w-])(?:(?:flat|unit|apt\.?|suite)\s\d+[a-z]?,\s)?\d{{1,5}}\s(?:[NSEW]\.\s)?(?:{_WORDC}\s){{1,2}}?(?:(?:st|blvd|ave|rd|ln|dr|ct|pl|sq)\.|(?:{_STREET})\b)(?:\s(?:apt\.?|unit|suite|#)\s?\w+)?",
    re.I,
)
_ONE_WORD = re.compile(rf"(?<![\w-]){_WORDC}(?:weg|stra(?:ß|ss)e|gasse|platz|allee)\s\d{{1,4}}[a-z]?", re.I)
_ONE_WORD_END = re.compile(r"(?:weg|(?:ß|ss)e|platz|allee)\s\d", re.I)
_BOX = re.compile(r"(?<![\w-])p\.?\s?o\.?\sbox\s\d+", re.I)
_HOUSE = re.compile(r"\d\s[^\W\d_]")
_AFTER_LINE = re.compile(r"(?:,[ \t ]*|[ \t]*(?:\r?\n)[ \t]*)(?:(\d{5})[  ])?")
_STATE = re.compile(r",\s[A-Z]{2}\s\d{5}(?:-\d{4})?(?!\w)")
_TOWN_WORD = re.compile(_WORDC)
_TOWN = re.compile(rf"{_WORDC}(?:[  ]{_WORDC})?")
_TOKEN = re.compile(rf"{_LATIN}(?:{_LATIN}|[\u0300-\u036f]|['’-](?={_LATIN}))*")

#: Words that are first names as well as everyday English.
EVERYDAY = {"may", "will", "rose", "mark", "grace", "hope", "faith", "joy", "art", "bill", "pat", "dawn", "june", "april", "august", "summer", "ivy", "iris", "daisy", "lily", "violet", "ruby", "pearl", "frank", "rich", "guy", "jack", "rob", "sue", "drew", "miles", "chase", "grant", "heath", "dale", "glen", "cliff", "lance", "max", "gene", "ray"}
#: What may stand before a name, lower case.
TITLES = {"dr", "prof", "mr", "mrs", "ms", "miss", "sr", "sra", "herr", "frau", "doctor", "nurse", "sister", "father"}
KIN = {"brother", "sister", "son", "daughter", "mother", "father", "wife", "husband", "partner", "aunt", "uncle", "cousin", "nephew", "niece", "called", "named", "friend", "neighbour", "carer", "guardian"}
PARTICLES = {"de", "del", "della", "di", "van", "von", "der", "den", "la", "le", "el", "al", "bin", "ibn", "da", "dos"}
#: A finding or a place that bears a surname: "Varrick's sign", "Halgard clinic" (but not "... Hospital no 5").
_ABOUT = re.compile(r"['’]s\s(?:sign|test|disease|syndrome|method|score|manoeuvre)\b|[ \u00a0](?:clinic|hospital|practice)\b(?!\.?\s(?:no|#))", re.I)
_NOT_A_PERSON = {"sign", "test", "disease", "syndrome", "clinic", "hospital", "practice", "ward", "day", "manoeuvre", "method", "score"}
#: First names that are months, which "from", "to" and the like don't make persons.
MONTHS = {"april", "may", "june", "august"}
#: What introduces a person: a field of a form, or a word that asks for somebody.
_LABEL = re.compile(r"(?:^|[^\w])(?:(?:next of kin|name|patient|tutor|author|addressee|record|card|reads|signed|witness|reviewed|seen|copy|cc|re)(?:\s(?:is|to|by|with|together with))?|(?P<asks>from|with|by|to)|w/)\s*:?\s*$", re.I)


def fold(word: str) -> str:
    """A word without case and accents."""
    w = word.casefold().replace("’", "'")
    return w if w.isascii() else "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))


class Lexicon:
    """Known first names, surnames and towns, as folded words."""

    def __init__(self, firsts: Iterable[str], lasts: Iterable[str], towns: Iterable[str]):
        self.firsts = {fold(w) for x in firsts for w in x.split()} - {""}
        self.lasts = {fold(w) for x in lasts for w in x.split()} - PARTICLES - {""}
        self.towns = {" ".join(fold(t).split()) for t in towns} - {""}
        self._kinds: dict[str, str] = {}

    def kind(self, word: str) -> str:
        """L for a surname, F for a first name, p for a particle, i for a capital letter, else empty; remembered by spelling."""
        k = self._kinds.get(word)
        if k is None:
            if len(self._kinds) > 1_000_000:
                self._kinds.clear()
            w = fold(word)
            k = self._kinds[word] = "L" if w in self.lasts else "F" if w in self.firsts else "p" if w in PARTICLES else "i" if len(word) == 1 and word.isupper() else ""
        return k


def _spans(pattern: re.Pattern, t: str) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(t)]


def _emails(t: str) -> list[tuple[int, int]]:
    return (_spans(_EMAIL, t) if "@" in t else []) + (_spans(_DISGUISED, t) if _AT_SIGN.search(t) else [])


def _ids(t: str) -> list[tuple[int, int]]:
    out = _spans(_CODE, t)
    out += [(m.start(1), m.end(1)) for m in _LABELLED.finditer(t)]
    for m in _SOCIAL.finditer(t):
        if m[1] or _SOCIAL_WORD.search(t[max(0, m.start() - 30) : m.start()]) or _SOCIAL_WORD.search(t[m.end() : m.end() + 20]):
            out.append((m.start(), m.end()))
    return out


def _addresses(t: str, lex: Lexicon) -> list[tuple[int, int]]:
    out = []
    found = list(_LINE.finditer(t)) if _HOUSE.search(t) else []
    found += _ONE_WORD.finditer(t) if _ONE_WORD_END.search(t) else ()
    found += _BOX.finditer(t) if "ox" in t or "OX" in t else ()
    for m in found:
        end = m.end()
        if m[0][:1].isdecimal() and not re.search(r"\d\s[A-ZÀ-Þ]", m[0]):
            continue  # "27 weeks court"
        if a := _AFTER_LINE.match(t, end):
            if w := _TOWN.match(t, a.end()):
                two, one = w[0], re.split(r"[  ]", w[0])[0]
                town = next((x for x in (two, one) if " ".join(fold(x).split()) in lex.towns), None)
                if town is None and (a[1] or a[0].startswith(",")) and one[:1].isupper():
                    town = two if two[len(one) + 1 : len(one) + 2].isupper() and re.match(r"\s*(?:[.,;<\r\n]|$)", t[w.end() : w.end() + 3]) else one
                if town:
                    end = a.end() + len(town)
                    if z := _STATE.match(t, end):
                        end = z.end()
        out.append((m.start(), end))
    return out


def _introduced(t: str, start: int, word: str) -> bool:
    m = _LABEL.search(t, max(0, start - 25), start)
    return m is not None and not (m["asks"] and word in MONTHS)


def _names(t: str, lex: Lexicon) -> list[tuple[int, int]]:
    """Runs of name words: first names, initials and surnames in any usual order."""
    titled = [m.span(1) for m in _TITLED.finditer(t)]
    kinds = list(map(lex.kind, _TOKEN.findall(t)))
    if "L" not in kinds and "F" not in kinds:  # initials and particles are part of a name, but none alone
        return titled
    toks = list(_TOKEN.finditer(t))
    hot = [k for k, x in enumerate(kinds) if x]
    for k in hot:
        if kinds[k] == "i" and t[toks[k].end() : toks[k].end() + 1] != ".":
            kinds[k] = ""
    out, done, n = [], 0, len(toks)
    word_at = lambda j: fold(toks[j][0])
    gap = lambda a, b: t[toks[a].end() : toks[b].start()]
    plain = lambda g: 0 < len(g) <= 3 and not g.strip("  \t")
    dotted = lambda g: len(g) <= 3 and g[:1] == "." and not g[1:].strip("  ")
    for i in hot:
        if i < done or not kinds[i]:
            continue
        j, seen = i, kinds[i]
        while j + 1 < n and kinds[j + 1]:
            g, nxt = gap(j, j + 1), kinds[j + 1]
            if kinds[j] == "i" and dotted(g) or kinds[j] != "i" and plain(g):
                pass
            elif kinds[j] == "L" and nxt == "F" and g.replace(" ", " ").strip(" ") == "," and len(g) <= 3:
                pass
            else:
                break
            step = seen[-1] + nxt
            if step not in ("FL", "Fi", "iL", "ii", "LF", "pL", "Fp", "ip", "FF", "LL", "pp"):
                break
            if step == "FF" and word_at(j + 1) in EVERYDAY:
                break
            if step == "LF" and seen not in ("L", "pL") or step == "FL" and "L" in seen:
                break
            if step == "LL" or (step == "FF" and "L" in seen):
                break
            j, seen = j + 1, seen + nxt
        while seen and seen[-1] in "pi":  # a trailing initial or particle is no part of it
            j, seen = j - 1, seen[:-1]
        if not seen:
            continue
        start, end = toks[i].start(), toks[j].end()
        word, before = word_at(i), word_at(i - 1) if i else ""
        after = word_at(j + 1) if j + 1 < n else ""
        ok = False
        if "L" in seen:
            ok = not _ABOUT.match(t[end : end + 24])
        elif "F" in seen:
            known = before in KIN or before in TITLES or _introduced(t, start, word)
            capital = t[start].isupper()
            ok = known and capital if word in EVERYDAY else known or (capital and after not in _NOT_A_PERSON)
        if ok:
            out.append((start, end))
            done = j + 1
    return out + titled


_CAP = rf"[A-ZÀ-ÖØ-Þ](?:{_LATIN}|[\u0300-\u036f])*(?:['’-]{_LATIN}+)*"
_TITLED = re.compile(rf"\b(?:Dr|Prof|Mrs?|Ms|Miss|Herr|Frau)\b\.?[  ]((?:[A-Z]\.[  ]?)*{_CAP})(?!\.?\w)")


def find_pieces(text: str | None, lex: Lexicon, dates: bool = False) -> list[tuple[int, int, str]]:
    """``(start, end, type)`` of the personal data in a text, in order and without overlaps.

    Where pieces overlap, e-mail comes before address, id, phone, name and date, then the
    longer one; so a name inside another piece doesn't count. Real dates count on request.
    """
    if not text or len(text) < 2:
        return []
    four = _FOUR.search(text)
    phones = _spans(_PHONE, text) if four or "+" in text else []
    ranked = [("EMAIL", _emails(text)), ("ADDRESS", _addresses(text, lex)), ("ID_NUMBER", _ids(text) if four else []), ("PHONE", phones), ("NAME", _names(text, lex))]
    if dates and four:
        ranked.append(("DATE", [m.span() for m in _DATES.finditer(text) if _read_date(m)]))
    kept: list[tuple[int, int, str]] = []
    for kind, spans in ranked:
        for s, e in sorted(set(spans), key=lambda x: (x[0] - x[1], x)):
            k = bisect.bisect(kept, (s, e))
            if (not k or kept[k - 1][1] <= s) and (k == len(kept) or kept[k][0] >= e):
                kept.insert(k, (s, e, kind))
    return kept


# --- pseudonyms ---------------------------------------------------------------------
def _round(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.digest(key, "\x1f".join(map(str, parts)).encode(), "sha256")[:16], "big")


def permute_digits(digits: str, key: bytes, tweak: str = "") -> str:
    """Keyed permutation of the digit strings of one length (alternating Feistel network, ten rounds)."""
    n = len(digits)
    if n < 2:
        return str((int(digits) + _round(key, tweak, "one")) % 10) if digits else ""
    u = n // 2
    a, b = digits[:u], digits[u:]
    for r in range(10):
        m = u if r % 2 == 0 else n - u
        c = (int(a) + _round(key, tweak, n, r, b)) % 10**m
        a, b = b, str(c).zfill(m)
    return a + b


def restore_digits(digits: str, key: bytes, tweak: str = "") -> str:
    """Inverse of :func:`permute_digits`."""
    n = len(digits)
    if n < 2:
        return str((int(digits) - _round(key, tweak, "one")) % 10) if digits else ""
    u = n // 2
    a, b = digits[:u], digits[u:]
    for r in reversed(range(10)):
        m = u if r % 2 == 0 else n - u
        a, b = str((int(b) - _round(key, tweak, n, r, a)) % 10**m).zfill(m), a
    return a + b


#: Days within which dates are permuted: 1900-01-01 to 2099-12-31.
_DAY0, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def permute_date(d: date, key: bytes, inverse: bool = False) -> date:
    """Keyed permutation of the dates of 1900 to 2099 (cycle walking); other dates stay."""
    k = (d - _DAY0).days
    if not 0 <= k < _DAYS:
        return d
    f = restore_digits if inverse else permute_digits
    s = f(str(k).zfill(5), key, "date")
    while int(s) >= _DAYS:
        s = f(s, key, "date")
    return _DAY0 + timedelta(days=int(s))


_EXTENSION = re.compile(r"(?:ext\.?|extension|x)\s?(\d+)$", re.I)
_COUNTRY = re.compile(r"(?:\+|00)(1|\d{1,3}(?=[^\d])|\d\d)")


def valid_social(d: str) -> bool:
    """Whether nine digits can be a social security number: area, group and serial that are given out."""
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def valid_phone(d: str) -> bool:
    """Whether ten digits can be a number of the ten-digit plan; area and exchange begin with 2 to 9."""
    return d[0] > "1" and d[3] > "1"


def _segments(kind: str, value: str, n: int) -> list[tuple[int, int, str, Callable[[str], bool] | None]]:
    """Parts of a number's ``n`` digits that are permuted on their own: from, to, tweak and test of validity.

    A country code stays; an extension is a part of its own.
    """
    if kind != "PHONE":
        return [(0, n, kind, valid_social if n == 9 and not any(c.isalpha() for c in value) else None)]
    ext = len(m[1]) if (m := _EXTENSION.search(value)) else 0
    at = sum(c.isdecimal() for c in m[0]) if (m := _COUNTRY.match(value)) else 1 if n - ext == 11 and value.startswith("1") else 0
    return [(at, n - ext, kind, valid_phone if n - ext - at == 10 else None), (n - ext, n, "extension", None)]


def permute_number(kind: str, value: str, key: bytes, inverse: bool = False) -> str:
    """A number of the same format: separators, letters and country code stay, digits are permuted.

    Numbers that are valid in their plan are permuted among the valid ones, others among
    the others (cycle walking). Values that differ only in separators give the same digits.
    """
    f = restore_digits if inverse else permute_digits
    digits = "".join(c for c in value if c.isdecimal() and c.isascii())

    def put(new: str) -> str:
        it = iter(new)
        return "".join(next(it) if c.isdecimal() and c.isascii() else c for c in value)

    parts = _segments(kind, value, len(digits))
    for k, (a, b, tweak, ok) in enumerate(parts):
        old = got = digits[a:b]
        while True:  # until it is of the same class and the number still falls into the same parts
            got = f(got, key, tweak)
            new = digits[:a] + got + digits[b:]
            if (ok is None or ok(got) == ok(old)) and (k or [x[:2] for x in _segments(kind, put(new), len(digits))] == [x[:2] for x in parts]):
                break
        digits = new
    return put(digits)


_DATES = re.compile(r"(?<![\w/.-])(?:(?P<y>\d{4})-(?P<m>\d{2})-(?P<d>\d{2})|(?P<a>\d{1,2})(?P<s>[/.])(?P<b>\d{1,2})(?P=s)(?P<z>\d{4}))(?![\w/]|[.-]\d)")


def _read_date(m: re.Match) -> tuple[date, str] | None:
    """The date of a match and its order; 03/04/2024 is month first unless that is no date, 03.04.2024 day first."""
    tries = [("ymd", "y", "m", "d")] if m["y"] else [("mdy", "z", "a", "b"), ("dmy", "z", "b", "a")] if m["s"] == "/" else [("dmy", "z", "b", "a")]
    for order, y, mo, d in tries:
        try:
            return date(int(m[y]), int(m[mo]), int(m[d])), order
        except ValueError:
            pass
    return None


def permute_date_text(text: str, key: bytes, inverse: bool = False) -> str:
    """A date text of the same notation with its date permuted; what is no real date stays."""
    m = _DATES.fullmatch(text)
    got = _read_date(m) if m else None
    if got is None:
        return text
    new, order = permute_date(got[0], key, inverse), got[1]
    if order == "ymd":
        return new.isoformat()
    two = "02" if len(text) == 10 else ""
    parts = [format(x, two) for x in ((new.month, new.day) if order == "mdy" else (new.day, new.month))]
    return m["s"].join([*parts, f"{new.year:04d}"])


def pseudonym(kind: str, value: str, key: bytes) -> str:
    """What stands in for a value: numbers and dates of the same format, for names, addresses and e-mails,
    which have none, a keyed tag of their folded text."""
    if kind in ("PHONE", "ID_NUMBER"):
        return permute_number(kind, value, key)
    if kind == "DATE":
        return permute_date_text(value, key)
    text = " ".join(fold(value).split())
    if kind == "EMAIL":
        text = re.sub(r"\s?[(\[{]\s?dot\s?[)\]}]\s?", ".", re.sub(r"\s?[(\[{]\s?at\s?[)\]}]\s?", "@", text))
    return f"{_round(key, kind, text):032x}"


def mask(text: str | None, lex: Lexicon, key: bytes, dates: bool = False) -> str | None:
    """The text with ``[TYPE:pseudonym]`` for each piece and all else unchanged; null for null."""
    if text is None:
        return None
    out, at = [], 0
    for s, e, kind in find_pieces(text, lex, dates):
        out += [text[at:s], f"[{kind}:{pseudonym(kind, text[s:e], key)}]"]
        at = e
    return "".join([*out, text[at:]])


# --- DataFrame operators ------------------------------------------------------------
def lexicon_words(master: DataFrame, first: str = "ufname", last: str = "ulname", address: str = "upaddress") -> DataFrame:
    """``(kind, word)``, distinct: first names, surnames and towns of the master table.

    Combined before the shuffle. A town is what follows the last comma or line break of
    an address, without postal code; a part with a two-letter state and code isn't one.
    """
    clean = lambda c: F.lower(F.regexp_replace(F.trim(c), r"(?U)\s+", " "))
    tail = F.regexp_replace(F.regexp_replace(address, r",\s*[A-Za-z]{2}\s+\d{5}(-\d{4})?\s*$", ""), r"^\s+|\s+$", "")
    town = F.regexp_extract(tail, r"(?U)(?:,|\n)\s*(?:\d{5}\s+)?([\p{L}][\p{L}' -]*)$", 1)
    rows = master.select(F.explode(F.array(F.struct(F.lit("F").alias("kind"), clean(F.col(first)).alias("word")), F.struct(F.lit("L").alias("kind"), clean(F.col(last)).alias("word")), F.struct(F.lit("T").alias("kind"), clean(town).alias("word")))).alias("x"))
    return rows.select("x.kind", "x.word").where("word is not null and word <> ''").distinct()


def _keyed_words(batches):
    """``(key, entry)`` of lexicon rows: the folded word that must occur in a text, and what its lexicon gets."""
    for b in batches:
        rows = set()
        for kind, word in zip(b.column("kind").to_pylist(), b.column("word").to_pylist(), strict=True):
            if kind == "T":
                town = " ".join(fold(word).split())
                rows |= {("T:" + town.split()[0], "T:" + town)} if town else set()
            else:
                rows |= {("N:" + w, f"{kind}:{w}") for w in map(fold, word.split()) if w and not (kind == "L" and w in PARTICLES)}
        yield pa.record_batch([pa.array(c, pa.string()) for c in (list(zip(*rows, strict=True)) or [[], []])], names=["key", "entry"])


def _text_keys(batches):
    """``(digest, key)``, the keys under which a text asks for entries, cut and folded as :func:`_names` and :func:`_addresses` read words."""
    for b in batches:
        rows = []
        for h, t in zip(b.column("digest").to_pylist(), b.column("text").to_pylist(), strict=True):
            keys = {"N:" + fold(m[0]) for m in _TOKEN.finditer(t)}
            keys |= {"T:" + w for m in _TOWN_WORD.finditer(t) for w in fold(m[0]).split()[:1]}
            rows += [(h, k) for k in keys]
        yield pa.record_batch([pa.array(c, pa.string()) for c in (list(zip(*rows, strict=True)) or [[], []])], names=["digest", "key"])


def _own_words(docs: DataFrame, words: DataFrame) -> DataFrame:
    """Documents with the lexicon entries whose (first) word occurs in their text, for lexicons too large to send out.

    What a text needs follows from the text alone, so it is joined back by the text's
    digest, and ids may be null or repeat.
    """
    docs = docs.withColumn("digest", F.sha2("text", 256))
    entries = words.where("kind is not null and word is not null").mapInArrow(_keyed_words, "key string, entry string").distinct()
    keys = docs.where("text is not null").select("digest", "text").mapInArrow(_text_keys, "digest string, key string")
    own = keys.join(entries, "key").groupBy("digest").agg(F.collect_set("entry").alias("lex"))
    return docs.join(own, "digest", "left").drop("digest")


def _run(docs: DataFrame, words: DataFrame, make: Callable, schema: str, limit: int) -> DataFrame:
    docs = spread(docs)
    some = words.limit(limit + 1).collect()
    if len(some) <= limit:
        sent = docs.sparkSession.sparkContext.broadcast([(r["kind"], r["word"]) for r in some])

        def body(batches):
            lex = Lexicon(*([w for k, w in sent.value if k == kind] for kind in "FLT"))
            for b in batches:
                yield make(b, [lex] * b.num_rows)

        return docs.mapInArrow(body, schema)

    def own_body(batches):
        for b in batches:
            lists = b.column("lex").to_pylist()
            yield make(b, [Lexicon(*([w[2:] for w in x or [] if w[0] == kind] for kind in "FLT")) for x in lists])

    return _own_words(docs, words).mapInArrow(own_body, schema)


def find_personal_data(docs: DataFrame, words: DataFrame, limit: int = BROADCAST_WORDS) -> DataFrame:
    """``(source_table, row_id, pii_type, pii_text)``, distinct, of ``docs(source_table, row_id, text)``.

    Null and blank texts hold nothing; texts are read whole. ``limit`` is the size of
    the lexicon that is sent to the tasks.
    """

    def make(b, lexs):
        rows = [(s, r, k, t[x:y]) for s, r, t, lex in zip(*(b.column(c).to_pylist() for c in ("source_table", "row_id", "text")), lexs, strict=True) for x, y, k in find_pieces(t, lex)]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.record_batch([pa.array(c, p) for c, p in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["source_table", "row_id", "pii_type", "pii_text"])

    return _run(docs, words, make, "source_table string, row_id bigint, pii_type string, pii_text string", limit).distinct()


def mask_personal_data(docs: DataFrame, words: DataFrame, key: bytes, limit: int = BROADCAST_WORDS, dates: bool = False) -> DataFrame:
    """``(source_table, row_id, masked)``; null texts stay null. ``key`` decides the pseudonyms; ``dates`` masks dates too."""

    def make(b, lexs):
        out = [mask(t, lex, key, dates) for t, lex in zip(b.column("text").to_pylist(), lexs, strict=True)]
        return pa.record_batch([b.column("source_table"), b.column("row_id"), pa.array(out, pa.string())], names=["source_table", "row_id", "masked"])

    return _run(docs, words, make, "source_table string, row_id bigint, masked string", limit)
