"""Clinical documents: blobs, markup masking, XML to JSON, sections to (category, value) rows.

The parsers are plain functions on one document, run on Arrow batches; everything
around them (filters, joins, explode) is built-in.
"""

from __future__ import annotations

import hashlib
import json
import re
import xml.etree.ElementTree as ET
import zlib
from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of binary documents by number.
EXTENSIONS = {1000: "xml", 1004: "xml", 1005: "xml", 1016: "xml", 1001: "pdf", 1003: "txt", 1007: "tif"}
#: Element names whose text is replaced, by placeholder.
TAG_MASKS = {
    "((PATIENT_NAME))": ["patient", "Patient", "patientName", "PatientName", "hl7PtName", "patientname", "ptName"],
    "((GUARANTORNAME))": ["GuarantorName"],
    "((PROVIDER_NAME))": ["ProviderName", "providerName", "AttendingName", "ReferringName"],
    "((FACILITYNAME))": ["facName"],
    "((NPI))": ["NPI"],
    "((SSN))": ["SSN"],
    "((ADDRESS))": ["address", "Address"],
    "((PHONE_NUMBER))": ["phone", "Phone", "phoneNumber"],
    "((PAYORID))": ["PayorID"],
    "((INSURANCEID))": ["InsuranceId"],
    "((INSURANCE_NAME))": ["InsuranceName"],
}
BIRTH_TAGS, ZIP_TAGS = {"dob", "dateofbirth", "ptdob"}, {"zip", "zipcode", "postalcode"}
_MASK_OF = {tag: token for token, tags in TAG_MASKS.items() for tag in tags}
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def extension(kind: Column) -> Column:
    """File extension of a document kind, null if unknown."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv]), kind.cast("int"))


def kinds_of(name: str) -> list[int]:
    """Kind numbers of a type name: xml, pdf, tiff, txt or all."""
    ext = {"tiff": "tif"}.get(name.lower(), name.lower())
    found = sorted(k for k, e in EXTENSIONS.items() if ext in ("all", e))
    if not found:
        raise ValueError(f"unknown document type {name!r}")
    return found


def scan_documents(bins: DataFrame, docs: DataFrame, kinds: list[int], patients: DataFrame | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Blobs with their document rows, by kind, patient and date."""
    out = bins.where(F.col("bintypeid").isin(kinds)).join(docs, "documentid")
    if patients is not None:
        out = out.join(patients.select("patientid").distinct(), "patientid", "left_semi")
    if start:
        out = out.where(F.col("document_date") >= start)
    return out.where(F.col("document_date") <= end) if end else out


# --- blobs --------------------------------------------------------------------------------
def inflate(data: bytes | None) -> bytes | None:
    """Zlib data decompressed; anything else as it is."""
    if data and data[:2] in (b"\x78\x9c", b"\x78\x01", b"\x78\xda"):
        try:
            return zlib.decompress(data)
        except zlib.error:
            return data
    return data


@F.pandas_udf(T.BinaryType())
def inflate_udf(data: pd.Series) -> pd.Series:
    return data.map(inflate)


def clean_xml(data: bytes | str | None) -> str | None:
    """Well-formed XML of raw bytes without control characters, mended where possible, else null."""
    if not data:
        return None
    text = _CONTROL.sub("", data.decode("utf-8", "ignore") if isinstance(data, bytes) else data)
    root = read_xml(text)
    return None if root is None else ET.tostring(root, encoding="unicode")


@F.pandas_udf(T.StringType())
def clean_xml_udf(data: pd.Series) -> pd.Series:
    return data.map(clean_xml)


def decrypt_note(data: bytes | None, when: str, secret: bytes, decrypt: Callable[[bytes, bytes], bytes]) -> str | None:
    """A note: plain XML as it is, else decrypted with a key made of the secret and the date, and inflated.

    The cipher is passed in, as it is no part of this library; what can't be read gives null.
    """
    if not data:
        return None
    if data.lstrip()[:5] == b"<?xml":
        return data.decode("utf-8", "replace")
    try:
        key = hashlib.sha256(secret + when.encode()).digest()[:16]
        return inflate(decrypt(data, key)).decode("utf-8", "replace")
    except Exception:
        return None


def decrypt_notes(df: DataFrame, content: str, when: str, secret: bytes, decrypt: Callable[[bytes, bytes], bytes]) -> DataFrame:
    """``df`` with its notes decrypted by the date in ``when``; what can't be read gives null."""

    @F.pandas_udf(T.StringType())
    def read(data: pd.Series, day: pd.Series) -> pd.Series:
        return pd.Series([decrypt_note(b, d or "", secret, decrypt) for b, d in zip(data, day, strict=True)], dtype="object")

    return df.withColumn(content, read(F.col(content).cast("binary"), F.col(when).cast("string")))


# --- reading XML ---------------------------------------------------------------------------
_MENDS: list[Callable[[str], str]] = [
    lambda s: s,
    lambda s: _CONTROL.sub("", s),
    lambda s: re.sub(r"<\?.*?\?>", "", s, flags=re.S),
    lambda s: re.sub(r"&(?!#?\w+;)", "&amp;", s),
    lambda s: re.sub(r"(?i)<br\s*>", "<br />", s),
]


def read_xml(text: str) -> ET.Element | None:
    """Root of a document or fragment; mends are applied one after another until it parses."""
    s = re.sub(r"^\s*<\?xml(?:-stylesheet)?[^>]*\?>", "", text.strip())
    s = re.sub(r"^\s*<\?xml-stylesheet[^>]*\?>", "", s).strip()
    if not s:
        return None
    m = re.match(r"<([\w:.-]+)[\s>/]", s)
    whole = m and (s.endswith(f"</{m[1]}>") and s.find(f"</{m[1]}>") + len(m[1]) + 3 == len(s) or re.fullmatch(r"<[^<>]*/>", s))
    if not whole:
        s = f"<root>{s}</root>"
    for mend in _MENDS:
        s = mend(s)
        try:
            return ET.fromstring(s)
        except ET.ParseError:
            continue
    return None


def mask_xml(text: str | None, year_now: int | None = None) -> str | None:
    """XML with births cut to years, postal codes to three digits, and named elements masked.

    Only text that begins with a tag and can be parsed is changed; comments vanish.
    """
    if not isinstance(text, str) or text.lstrip()[:1] != "<":
        return text
    root = read_xml(text)
    if root is None:
        return text
    now = year_now or datetime.now().year
    for el in root.iter():
        if not isinstance(el.tag, str):
            continue
        name, value = el.tag.rsplit("}", 1)[-1], (el.text or "").strip()
        if name.lower() in BIRTH_TAGS:
            el.text = _birth_year(value, now) or value
        elif name.lower() in ZIP_TAGS:
            el.text = re.sub(r"\b(\d{3})\d{2}(?:-\d{4})?\b", r"\1", value)
        elif name in _MASK_OF:
            el.text = _MASK_OF[name]
    return ET.tostring(root, encoding="utf-8", xml_declaration=True).decode("utf-8")


def _birth_year(value: str, now: int) -> str | None:
    for f in ("%Y-%m-%d", "%m/%d/%Y", "%m-%d-%Y", "%m/%d/%y", "%m-%d-%y", "%Y%m%d", "%d %b %Y", "%b %d, %Y", "%B %d, %Y", "%Y-%m-%dT%H:%M:%S", "%Y"):
        try:
            y = datetime.strptime(value, f).year
        except ValueError:
            continue
        return str(y - 100 if y > now else y)
    return None


@F.pandas_udf(T.StringType())
def mask_xml_udf(text: pd.Series) -> pd.Series:
    return text.map(mask_xml)


# --- XML to JSON ----------------------------------------------------------------------------
def _node(el: ET.Element):
    """An element as value: text, or a dict of ``@attributes``, children (lists if repeated) and ``#text``."""
    out: dict = {f"@{k.rsplit('}', 1)[-1]}": v for k, v in el.attrib.items()}
    for child in el:
        if not isinstance(child.tag, str):
            continue
        name, value = child.tag.rsplit("}", 1)[-1], _node(child)
        if name in out:
            out[name] = [*out[name], value] if isinstance(out[name], list) else [out[name], value]
        else:
            out[name] = value
    text = " ".join(re.sub(r"<[^>]+>", "", "".join([el.text or "", *[c.tail or "" for c in el]])).split())
    if not out:
        return text or None
    if text:
        out["#text"] = text
    return out


def xml_to_json(text: str | None) -> str | None:
    """JSON of an XML text without tags in its values, or null where it can't be read."""
    if not text:
        return None
    root = read_xml(_CONTROL.sub("", text))
    return None if root is None else json.dumps({root.tag.rsplit("}", 1)[-1]: _node(root)}, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def xml_to_json_udf(text: pd.Series) -> pd.Series:
    return text.map(xml_to_json)


# --- sections -----------------------------------------------------------------------------
def _each(x) -> list:
    return [] if x is None else x if isinstance(x, list) else [x]


def _text(x) -> str:
    return str(x.get("#text") or "") if isinstance(x, dict) else "" if x is None else str(x)


def _items(x) -> list[dict]:
    """Item dicts of a list node, whether wrapped or not."""
    out = []
    for n in _each(x):
        if isinstance(n, dict):
            out += [i for i in _each(n["item"]) if isinstance(i, dict)] if "item" in n else [n]
    return out


def _code(x) -> str | None:
    v = x.get("coded_entry") if isinstance(x, dict) else None
    v = v.get("coded_entry.value") if isinstance(v, dict) else None
    return v.get("@V") if isinstance(v, dict) else None


def list_section(sec: dict):
    return [i["content"] for i in _items(sec["list"]) if "content" in i]


_CELL_NAMES = ("Status", "Start/Stop", "Quantity", "Notes")


def table_section(sec: dict) -> dict:
    """First cell names the row, the next four have set names; cells of ``--`` are left out."""
    out = {}
    table = sec["table"] if isinstance(sec["table"], dict) else {}
    for row in _each(table.get("tr")):
        if not isinstance(row, dict) or row.get("th") or "td" not in row:
            continue
        cells = [_text(c) for c in _each(row["td"])]
        if len(cells) < 2:
            out[cells[0] if cells else ""] = {"Status": "N/A"}
        else:
            out[cells[0]] = {n: c for n, c in zip(_CELL_NAMES, cells[1:], strict=False) if c and c.strip() != "--"} or None
    return out


def tree(x) -> dict:
    """Captioned lists within lists as nested maps."""
    out = {}
    for i in _items(x):
        inner = i.get("content", "")
        if isinstance(inner, dict) and "list" in inner:
            if sub := tree(inner["list"]):
                out[_text(i.get("caption"))] = sub
        else:
            out[_text(i.get("caption"))] = inner
    return out


def _subsections(sec: dict, read: Callable[[dict], object]) -> dict:
    out = {}
    for s in _each(sec.get("section")):
        if isinstance(s, dict) and (name := _text(s.get("caption"))) and "list" in s and (value := read(s)):
            out[name] = value
    return out


def systems_section(sec: dict) -> dict:
    """Per system what the patient denies or admits, as lists."""
    return _subsections(sec, lambda s: {c: _each(i.get("content")) for i in _items(s["list"]) if (c := _text(i.get("caption"))) in ("Denies", "Admits") and isinstance(i.get("content"), (str, list))})


def examination_section(sec: dict) -> dict:
    return _subsections(sec, lambda s: tree(s["list"]))


def plan_section(sec: dict) -> dict:
    def read(s: dict) -> list[str]:
        out = []
        for i in _items(s["list"]):
            if "content" not in i:
                continue
            c = i["content"]
            if isinstance(c, dict) and "#text" not in c and _code(c):
                out.append(f" (Code: {_code(c)})")
            else:
                out.append(_text(c) if isinstance(c, dict) and "#text" in c else str(c))
        return out

    return _subsections(sec, read)


def assessment_section(sec: dict) -> list[dict]:
    out = []
    for i in _items(sec["list"]):
        for c in _each(i.get("content")):
            if isinstance(c, dict) and "#text" in c and _code(c):
                out.append({"description": c["#text"], "code": _code(c)})
            elif isinstance(c, dict) and "dxdesc" in c and "dxcode" in c:
                out.append({"description": c["dxdesc"], "code": c["dxcode"]})
    return out


def markup_text(x) -> str | None:
    """Text of a markup node: sketch data, division text, own text, or mixed text without style rules."""
    if isinstance(x, str):
        return x
    if not isinstance(x, dict):
        return None
    h = x.get("datahtml")
    if isinstance(h, str):
        h = re.sub(r"\.\w+\s*\{[^}]*\}", "", h)
        return " ".join(h.replace("&nbsp;", " ").replace('\\"', '"').replace("\\n", " ").replace("\\t", " ").split())
    if isinstance(h, dict):
        pad = h.get("sketchpads")
        for step in ("sketchpad", "text"):
            pad = pad.get(step) if isinstance(pad, dict) else None
        if isinstance(pad, dict) and "@data" in pad:
            return pad["@data"]
        div = h.get("div")
        return div.get("#text") if isinstance(div, dict) else h.get("#text")
    return x.get("content")


#: Order of the readings of a vitals line after date and time.
_VITALS = ("BP", "Position", "TEMP( F)", "L\\R", "Cuff", "WT")


def vitals(text: str | None) -> dict:
    """Date, time and readings of a vitals line; a line without them is kept raw."""
    if not text:
        return {}
    text = text.strip()
    at = re.search(r"(\d{1,2}/\d{1,2}/\d{4})\s+(\d{1,2}:\d{2}\s+[AP]M)", text)
    if not at:
        return {"Raw_Vitals": text}
    parts = re.findall(r"(?:[^\s'\"]|'[^'\"]*['\"]|\"[^'\"]*['\"])+", text[at.end() :])
    out = {"Date": at[1], "Time": at[2]}
    if len(parts) >= len(_VITALS):
        out |= dict(zip(_VITALS, parts, strict=False))
        rest = parts[len(_VITALS) :]
        numbers = [p for p in rest if re.fullmatch(r"[+-]?\d+(?:\.\d*)?", p)]
        heights = [p for p in rest if "'" in p or '"' in p]
        out |= {"HT": heights[-1] if heights else None, "BMI": numbers[0] if numbers else None, "BSA": numbers[1] if len(numbers) > 1 else None}
    return out


def _paragraph_text(x) -> str | None:
    lines = [x] if isinstance(x, str) else [t for p in _each(x) if (t := p if isinstance(p, str) else _text(p)).strip()]
    return "\n".join(lines) if lines else None


def letter_section(sec: dict) -> dict | None:
    """Paragraphs of a section without caption: by title, else by the label before the first colon, else numbered."""
    out = {}
    many = isinstance(sec["paragraph"], list)
    for i, p in enumerate(_each(sec["paragraph"])):
        if not isinstance(p, dict):
            continue
        title, text = (p.get("@title") or "").strip(), _paragraph_text(p.get("content"))
        if title:
            out[title] = text or ""
        elif text:
            label = text.split(":")[0].strip() if ":" in text and not isinstance(p.get("content"), str) else ""
            out[label if 0 < len(label) < 50 else f"Content_{i}" if many else "Content"] = text
    return out or None


def parse_section(sec) -> object:
    """Value of one section, by its caption and the kind of its content."""
    if not isinstance(sec, dict):
        return None
    name = _text(sec.get("caption"))
    if not name:
        return letter_section(sec) if "paragraph" in sec else None
    if "list" in sec:
        return assessment_section(sec) if name == "Assessment" else list_section(sec)
    if "local_markup" in sec:
        text = markup_text(sec["local_markup"])
        return vitals(text) if name == "Vitals" else text
    if "table" in sec:
        return table_section(sec)
    if "section" in sec:
        reader = {"Review of Systems": systems_section, "Plan": plan_section, "Physical Examination": examination_section}.get(name)
        return reader(sec) if reader else tree(sec["section"])
    if "content" in sec:
        return sec["content"] if isinstance(sec["content"], str) else [c for c in _each(sec["content"]) if isinstance(c, str)]
    if "paragraph" in sec:
        return _paragraph_text([p.get("content") for p in _each(sec["paragraph"]) if isinstance(p, dict)])
    return None


def body_of(doc: str | dict | None) -> dict | None:
    d = json.loads(doc) if isinstance(doc, str) else doc
    d = d.get("levelone") if isinstance(d, dict) else None
    b = d.get("body") if isinstance(d, dict) else None
    return b if isinstance(b, dict) else None


def document_sections(doc: str | None) -> dict | None:
    """Caption to value of a document in JSON; sections without caption merge in. Null where there is no body."""
    try:
        body = body_of(doc)
    except (ValueError, TypeError):
        return None
    if not body:
        return None
    if "section" not in body:
        text = markup_text(body.get("local_markup"))
        return {"Content": text} if text else None
    out = {}
    for s in _each(body["section"]):
        value = parse_section(s)
        if value is None:
            continue
        name = _text(s.get("caption"))
        out.update({name: value} if name else value if isinstance(value, dict) else {"Content": value})
    return out


def lines_of(value, depth: int = 0) -> list[str]:
    """A value as indented lines."""
    pad = "    " * depth
    if isinstance(value, dict):
        out = []
        for k, v in value.items():
            out += [f"{pad}{k}:", *lines_of(v, depth + 1)] if isinstance(v, (dict, list)) else [f"{pad}{k}: {v}"]
        return out
    if isinstance(value, list):
        return [x for v in value for x in (lines_of(v, depth) if isinstance(v, dict) else [f"{pad}- {v}"])]
    return [f"{pad}{value}"]


def document_text(doc: str | None) -> str:
    """A document as text lines."""
    return "\n".join(lines_of(document_sections(doc) or {}))


@F.pandas_udf(T.StructType([T.StructField("sections", T.StringType()), T.StructField("text", T.StringType())]))
def document_udf(doc: pd.Series) -> pd.DataFrame:
    parsed = [document_sections(d) for d in doc]
    return pd.DataFrame({"sections": [None if p is None else json.dumps(p, ensure_ascii=False) for p in parsed], "text": ["\n".join(lines_of(p or {})) for p in parsed]})


def explode_pairs(df: DataFrame, col: str) -> DataFrame:
    """One row per key of a JSON object: ``{col}_category`` and the value as text; others keep one row of nulls."""
    pairs = F.map_entries(F.from_json(F.when(F.ltrim(F.col(col)).startswith("{"), F.col(col)), "map<string,string>"))
    out = df.select(*[c for c in df.columns if c != col], F.explode_outer(pairs).alias("_e"))
    return out.select(*[c for c in df.columns if c != col], F.col("_e.key").alias(f"{col}_category"), F.col("_e.value").alias(col))


def body_json(doc: Column) -> Column:
    return F.get_json_object(doc, "$.levelone.body")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")
