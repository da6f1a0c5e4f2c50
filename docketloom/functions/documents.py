"""What a document's bytes say: readability of PDFs, text by text layer, Word or OCR, dossiers of orders."""

from __future__ import annotations

import io
import re
import shutil
import subprocess
import tempfile
import zipfile
import zlib
from html import unescape
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..udf import arrow_udf
from .dates import find_dates
from .text import blank, col, let, spans, squash

PROBE = "struct<has_font:boolean,has_image:boolean,has_text_operators:boolean,text_chars:int,pages:int,is_image_only:boolean,error:string>"
LEAST_GLYPHS = 40
_SHOWS = re.compile(rb"(?:\)|\]|\d)\s*(?:Tj|TJ|'|\")(?![A-Za-z0-9])")


def inflated(data: bytes) -> list[bytes]:
    """A PDF's streams, decompressed where they can be (a truncated one as far as it goes)."""
    out = []
    for m in re.finditer(rb"stream\r?\n?(.*?)endstream", data, re.S):
        try:
            out.append(zlib.decompressobj().decompress(m[1]))
        except zlib.error:
            out.append(m[1])
    return out


def glyphs(stream: bytes) -> int:
    """About how many characters a content stream draws."""
    blocks = re.findall(rb"BT\b(.*?)\bET\b", stream, re.S) or [stream]
    literal = sum(len(re.sub(rb"\\.", b"x", s)) for b in blocks for s in re.findall(rb"\(((?:\\.|[^\\()])*)\)", b, re.S))
    return literal + sum(len(re.sub(rb"\s", b"", s)) // 2 for b in blocks for s in re.findall(rb"<([0-9A-Fa-f\s]+)>", b))


def probe_bytes(data: bytes | None) -> dict:
    """Fonts, images, drawn text and pages of a PDF; ``is_image_only`` is null where nothing can be said."""
    out = {"has_font": False, "has_image": False, "has_text_operators": False, "text_chars": 0, "pages": 0, "is_image_only": None, "error": ""}
    if not data:
        return out | {"error": "empty document"}
    if b"%PDF-" not in data[:1024]:
        return out | {"error": "missing %PDF- header"}
    shown = [s for s in inflated(data) if _SHOWS.search(s)]
    chars = sum(map(glyphs, shown))
    pages = len(re.findall(rb"/Type\s*/Page\b(?!s)", data)) or max(map(int, re.findall(rb"/Count\s+(\d+)", data)), default=0)
    font, image = bool(re.search(rb"/Font\b", data)), bool(re.search(rb"/Subtype\s*/Image\b", data))
    return out | {"has_font": font, "has_image": image, "has_text_operators": bool(shown), "text_chars": chars, "pages": pages, "is_image_only": image and not font and not (shown and chars >= LEAST_GLYPHS)}


@arrow_udf(PROBE)
def probe_pdf(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([probe_bytes(c) for c in content])


def word_text(data: bytes) -> str:
    """Paragraphs of a .docx; nothing if it can't be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            xml = z.read("word/document.xml").decode("utf-8", "replace")
    except (zipfile.BadZipFile, KeyError, OSError, zlib.error):
        return ""
    for mark, char in ((r"</w:p>|<w:br/>", "\n"), (r"<w:tab/>", "\t"), (r"<[^>]+>", "")):
        xml = re.sub(mark, char, xml)
    return unescape(xml)


def _run(command: list[str], seconds: int) -> bytes | None:
    try:
        return subprocess.run(command, check=True, capture_output=True, timeout=seconds).stdout
    except (OSError, subprocess.SubprocessError):
        return None


def layer_text(data: bytes, layout: bool = False, pages: int | None = None) -> str:
    """The text layer by pdftotext, in reading order or as laid out; nothing if that fails or isn't installed."""
    if not data or not shutil.which("pdftotext"):
        return ""
    with tempfile.TemporaryDirectory() as folder:  # lives for this call alone
        (source := Path(folder, "in.pdf")).write_bytes(data)
        got = _run(["pdftotext", *(["-layout"] if layout else []), *(["-f", "1", "-l", str(pages)] if pages else []), str(source), "-"], 120)
    return (got or b"").decode("utf-8", "replace")


def ocr_text(data: bytes, first: int = 1, last: int | None = None, dpi: int = 200) -> str | None:
    """Text of page images by pdftoppm and tesseract; None where a tool is missing, which differs from finding nothing."""
    if not data:
        return ""
    if not (shutil.which("pdftoppm") and shutil.which("tesseract")):
        return None
    with tempfile.TemporaryDirectory() as folder:
        (source := Path(folder, "in.pdf")).write_bytes(data)
        if _run(["pdftoppm", "-r", str(dpi), "-png", "-f", str(first), *(["-l", str(last)] if last else []), str(source), f"{folder}/page"], 300) is None:
            return ""
        return "\f".join((_run(["tesseract", str(p), "stdout"], 180) or b"").decode("utf-8", "replace") for p in sorted(Path(folder).glob("page-*.png")))


def starved(text: str | None) -> bool:
    """Has a text layer lost its word spaces? At least 30 words, more than 3 % of them of 18 letters or more."""
    words = re.findall("[A-Za-z]{2,}", text or "")
    return len(words) >= 30 and sum(len(w) >= 18 for w in words) > 0.03 * len(words)


def is_starved(text: Column | str) -> Column:
    """The same as a native expression."""
    words = F.regexp_extract_all(blank(col(text)), F.lit("[A-Za-z]{2,}"), F.lit(0))
    return (F.size(words) >= 30) & (F.size(F.filter(words, lambda w: F.length(w) >= 18)) > F.size(words) * 0.03)


def read_document(data: bytes | None, layer=layer_text, ocr=ocr_text, last_page: int | None = 8) -> tuple[str, str]:
    """(text, how it was got): docx, text_layer, ocr, ocr_unavailable or unreadable."""
    if data and data[:2] == b"PK":
        text = word_text(data)
        return text, "docx" if text.strip() else "unreadable"
    if not data or b"%PDF-" not in data[:1024]:
        return "", "unreadable"
    text = layer(data)
    if len(re.sub(r"\s", "", text)) >= 200 and not starved(text):
        return text, "text_layer"
    scanned = ocr(data, last=last_page)
    if text.strip() and (not scanned or starved(scanned)):
        return text, "text_layer"
    if scanned is None:
        return text, "ocr_unavailable"
    return (scanned, "ocr") if scanned.strip() else (text, "unreadable")


@arrow_udf("struct<text:string,method:string>")
def document_text(content: pd.Series) -> pd.DataFrame:
    """struct(text, method) of each document's bytes."""
    return pd.DataFrame([read_document(c) for c in content], columns=["text", "method"])


def rejected_page(content: Column | str) -> Column:
    """A small page that says the request was rejected, though it came with a good status."""
    c = col(content)
    return (F.octet_length(c) < 4096) & F.contains(F.lower(F.decode(F.substring(c, 1, 2048), "ISO-8859-1")), F.lit("request rejected"))


# --- dossiers ----------------------------------------------------------------------------------------------------------

#: What revokes a certification; the first that occurs is reported. Fixed values.
REVOKED = (
    r"REVOKING\s+CERTIFICATION", r"REVOCATION\s+OF\b[^.]{0,80}?\bCERTIFICATION", r"is\s+hereby\s+REVOKED", r"certification[^.\n]{0,120}?\bis\s+revoked\b",
    r"petition\s+to\s+disclaim\s+interest\s+is\s+GRANTED", r"disclaimer\s+of\s+interest", r"decertif",
)
_HEADING = r"(?m)^[^a-z\n]*\b(?:ORDER|CERTIFICATION)\b[^a-z\n]*$"
_NOT_CERTIFYING = r"(?i)REVOK|AMEND|DISCLAIM|DECERTIF|DISMISS"
_SERVED = r"(?is)filed\s+and\s+a\s+copy\s+served\s+on\s+each\s+party\s+on\s+(.{0,60})"


def revocation(text: Column) -> Column:
    """The words that revoke a certification, or nothing."""
    hits = [F.nullif(F.substring(squash(F.regexp_extract(text, "(?i)" + p, 0)), 1, 120), F.lit("")) for p in REVOKED]
    return blank(F.coalesce(*hits))


def order_sections(text: Column | str) -> Column:
    """A dossier's orders, oldest first: array(struct(title, body)), cut at capital headings."""
    t = blank(col(text))
    title = lambda raw: F.substring(F.regexp_replace(squash(raw), r"^[ .:_-]+|[ .:_-]+$", ""), 1, 120)
    heads = F.filter(F.transform(spans(t, _HEADING), lambda s: F.struct(s["start"].alias("start"), title(s["raw"]).alias("title"))), lambda h: F.length(h["title"]) >= 5)
    return let(heads, lambda all_: F.transform(all_, lambda h, i: F.struct(h["title"].alias("title"), F.substring(t, h["start"] + 1, F.coalesce(F.get(all_, i + 1)["start"], F.length(t)) - h["start"]).alias("body"))))


def dossier_status(text: Column | str, as_of, whole: Column | bool = True) -> Column:
    """struct of a dossier's facts: the last order decides the status (then the whole text), the earliest certifying order gives the
    date. A read that may have missed pages can say revoked, never in_effect."""
    t = blank(col(text))
    told = F.lit(whole) if isinstance(whole, bool) else whole

    def dated(s: Column) -> Column:
        served = F.get(find_dates(F.regexp_extract(s["body"], _SERVED, 1), as_of), F.lit(0))["iso"]
        return let(served, lambda at: F.struct(F.coalesce(at, F.get(find_dates(s["body"], as_of), F.lit(0))["iso"]).alias("iso"), F.when(at.isNotNull(), "filed_and_served").otherwise("first_date_in_order").alias("source")))

    def facts(sections: Column) -> Column:
        last = F.try_element_at(sections, F.lit(-1))
        certifying = F.filter(sections, lambda s: F.contains(F.upper(s["title"]), F.lit("CERTIFICATION")) & ~s["title"].rlike(_NOT_CERTIFYING))
        return F.struct(
            F.coalesce(F.nullif(revocation(last["body"]), F.lit("")), revocation(t)).alias("signal"), blank(last["title"]).alias("title"), blank(F.get(find_dates(blank(last["body"]), as_of), F.lit(0))["iso"]).alias("latest"),
            F.array_min(F.filter(F.transform(certifying, dated), lambda d: d["iso"].isNotNull())).alias("first"), F.size(certifying).alias("n"),
        )

    def columns(f: Column) -> Column:
        status = F.when(F.trim(t) == "", "unknown").when(f["signal"] != "", "revoked").when(told, "in_effect").otherwise("unknown")
        known = f["first"].isNotNull()
        return F.struct(
            status.alias("certification_status"), f["title"].alias("latest_order_title"), f["latest"].alias("latest_order_date"), f["signal"].alias("revocation_signal"), blank(f["first"]["iso"]).alias("certification_order_date"), blank(f["first"]["source"]).alias("certification_order_date_source"),
            F.when(known, "ok").when(f["n"] > 0, "date_not_matched").otherwise("no_certification_section").alias("pdf_fetch_status"),
        )

    return let(let(order_sections(t), facts), columns)


#: Dossiers of up to FULL pages are read whole by OCR; longer ones at HEAD and TAIL pages.
FULL, HEAD, TAIL = 12, 3, 4


def read_dossier(data: bytes | None, layer=layer_text, ocr=ocr_text) -> tuple[str, str, bool, str, dict]:
    """(text, method, read whole?, why nothing was read, probe) of one dossier."""
    probe = probe_bytes(data)
    if probe["is_image_only"] is None:
        return "", "", False, "unreadable_bytes", probe
    text = "" if probe["is_image_only"] else layer(data) or ""
    if len(re.sub(r"\s", "", text)) >= 200 and not probe["is_image_only"]:
        return text, "text_layer", True, "", probe
    pages = probe["pages"]
    if pages and pages <= FULL:
        scanned, whole = ocr(data, first=1, last=pages), True
    elif not pages:
        scanned, whole = ocr(data, first=1, last=FULL), False
    else:
        parts = [ocr(data, first=1, last=HEAD), ocr(data, first=pages - TAIL + 1, last=pages)]
        scanned, whole = None if parts[0] is None else "\f".join(p for p in parts if p), False
    if scanned is None:
        return ("", "", False, "image_only_ocr_unavailable", probe) if probe["is_image_only"] else (text, "text_layer", False, "image_only_ocr_unavailable", probe)
    if scanned.strip():
        return scanned, "ocr", whole, "", probe
    return ("", "", False, "image_only_unread", probe) if probe["is_image_only"] else (text, "text_layer", whole, "", probe)


@arrow_udf("struct<text:string,method:string,whole:boolean,problem:string,is_image_only:boolean,text_chars:int>")
def dossier_text(content: pd.Series) -> pd.DataFrame:
    rows = [read_dossier(c) for c in content]
    return pd.DataFrame({"text": [r[0] for r in rows], "method": [r[1] for r in rows], "whole": [r[2] for r in rows], "problem": [r[3] for r in rows], "is_image_only": [r[4]["is_image_only"] for r in rows], "text_chars": [len(r[0].strip()) or r[4]["text_chars"] for r in rows]})


@arrow_udf("array<string>")
def zip_members(content: pd.Series) -> pd.Series:
    """Names of the PDF files in each archive, in directory order; nothing for what is no archive."""

    def names(data: bytes | None) -> list[str]:
        try:
            with zipfile.ZipFile(io.BytesIO(data or b"")) as z:
                return [n for n in z.namelist() if n.lower().endswith(".pdf")]
        except zipfile.BadZipFile:
            return []

    return pd.Series([names(c) for c in content], dtype="object")
