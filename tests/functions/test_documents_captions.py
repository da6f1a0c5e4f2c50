"""Bytes, dossiers, captions and certification sections on made inputs."""

import io
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from docketloom.functions import captions, documents

AS_OF = "2026-09-30"


def pdf(text="", font=True, image=False, pages=1, compress=True):
    stream = f"BT /F1 12 Tf ({text}) Tj ET".encode()
    body = zlib.compress(stream) if compress else stream
    parts = [b"%PDF-1.4\n", b"/Type /Page " * pages, b"/Font " if font else b"", b"/Subtype /Image " if image else b""]
    return b"".join(parts) + (b"<< >>\nstream\n" + body + b"endstream" if text else b"")


def test_probe(spark):
    word = io.BytesIO()
    with zipfile.ZipFile(word, "w") as z:
        z.writestr("word/document.xml", "<w:p>One &amp; two</w:p><w:p>x<w:tab/>y</w:p>")
        z.writestr("a/b.PDF", "x")
    docs = [pdf("hello world " * 5), pdf("hello world " * 5, compress=False), pdf(font=False, image=True, pages=3), b"not a pdf", None, b"", word.getvalue()]
    rows = [r.p for r in spark.createDataFrame([(k, d) for k, d in enumerate(docs)], "k int, c binary").withColumn("p", documents.probe_pdf("c")).orderBy("k").collect()]
    assert [r.is_image_only for r in rows] == [False, False, True, None, None, None, None]
    assert rows[0].text_chars == 60 and rows[2].pages == 3 and rows[4].error == "empty document"
    assert documents.word_text(docs[6]) == "One & two\nx\ty\n" and documents.word_text(b"PK broken") == ""
    got = spark.createDataFrame([(d,) for d in (docs[6], b"x")], "c binary").select(documents.zip_members("c").alias("n")).collect()
    assert [r.n for r in got] == [["a/b.PDF"], []]


def test_text_acquisition():
    good, none = "word " * 60, lambda d, **k: None
    assert documents.read_document(pdf("x"), layer=lambda d: good, ocr=none) == (good, "text_layer")
    assert documents.read_document(pdf("x"), layer=lambda d: "", ocr=none) == ("", "ocr_unavailable")
    assert documents.read_document(pdf("x"), layer=lambda d: "", ocr=lambda d, **k: "scan") == ("scan", "ocr")
    assert documents.read_document(pdf("x"), layer=lambda d: "stub", ocr=lambda d, **k: "") == ("stub", "text_layer")
    assert documents.read_document(pdf("x"), layer=lambda d: "", ocr=lambda d, **k: " ") == ("", "unreadable")
    assert documents.read_document(b"junk") == documents.read_document(None) == ("", "unreadable")


def test_starved(spark):
    bad, good = "TheAmericanFederationofState words " * 20, "plain words " * 40
    rows = spark.createDataFrame([(bad,), (good,), (None,)], "t string").select(documents.is_starved("t").alias("s")).collect()
    assert [r.s for r in rows] == [documents.starved(t) for t in (bad, good, None)] == [True, False, False]


DOSSIER = """STATE OF X
VERIFICATION OF ELECTION RESULTS AND CERTIFICATION OF EXCLUSIVE COLLECTIVE BARGAINING REPRESENTATIVE
The election was held on May 1, 2010. I HEREBY CERTIFY that this document was filed and a copy served on each party on June 14, 2011.
ORDER AMENDING CERTIFICATION
Issued July 2, 2012.
"""


@pytest.mark.parametrize(
    ("text", "whole", "want"),
    [
        (DOSSIER, True, ("in_effect", "ORDER AMENDING CERTIFICATION", "2012-07-02", "", "2011-06-14", "filed_and_served", "ok")),
        (DOSSIER, False, ("unknown", "ORDER AMENDING CERTIFICATION", "2012-07-02", "", "2011-06-14", "filed_and_served", "ok")),
        (DOSSIER + "ORDER REVOKING CERTIFICATION\nOn March 1, 2015 it was so.", False, ("revoked", "ORDER REVOKING CERTIFICATION", "2015-03-01", "REVOKING CERTIFICATION", "2011-06-14", "filed_and_served", "ok")),
        ("a petition to disclaim interest is granted", True, ("revoked", "", "", "petition to disclaim interest is granted", "", "", "no_certification_section")),
        ("FINAL ORDER AND CERTIFICATION\nno date", True, ("in_effect", "FINAL ORDER AND CERTIFICATION", "", "", "", "", "date_not_matched")),
        ("", True, ("unknown", "", "", "", "", "", "no_certification_section")),
    ],
)
def test_dossiers(spark, text, whole, want):
    got = spark.createDataFrame([(text, whole)], "t string, w boolean").select(documents.dossier_status("t", AS_OF, F.col("w")).alias("s")).first().s
    assert tuple(got) == want


CAPTION = """BEFORE THE BOARD
In the Matter of:
DEPARTMENT OF SERVICES FOR CHILDREN, YOUTH,    )
AND THEIR FAMILIES,                            )
Charging Party,                                )
V.                                             ) Case
STATE AND FEDERAL EMPLOYEES LOCAL 1029,        |
LABORERS INTERNATIONAL UNION, Respondent.
and
Unlabelled Body
and
Office of Labor, Agency
CERTIFICATION OF REPRESENTATIVE
Later Name, Intervenor
"""


def test_labelled_caption(spark):
    made = captions.labelled_caption("t", r"in\s+the\s+matter\s+of\s*:?", r"^\s*certification\s+of", (r"Case\b.*",))
    got = spark.createDataFrame([(CAPTION,), (None,)], "t string").select(made.alias("c")).collect()
    assert got[0].c.petitioner == ["DEPARTMENT OF SERVICES FOR CHILDREN, YOUTH, AND THEIR FAMILIES"]
    assert got[0].c.respondent == ["STATE AND FEDERAL EMPLOYEES LOCAL 1029, LABORERS INTERNATIONAL UNION"]
    assert got[0].c.agency == ["Office of Labor"] and got[0].c.intervenor == [] and got[0].c.labels == ["charging party", "respondent", "agency"]
    assert got[1].c.labels == []


@pytest.mark.parametrize(
    ("text", "name", "result"),
    [
        ("IT IS HEREBY CERTIFIED that the AFGE Local 1 has been designated by the employees", "AFGE Local 1", "representative_certified"),
        ("IT IS HEREBY CERTIFIED that a majority of the valid ballots have been cast for the Fraternal Order of Police, and that it is", "Fraternal Order of Police", "representative_certified"),
        ("IT IS HEREBY CERTIFIED that no labor organization has been selected", "", "no_representative"),
        ("The petitioner is AFGE.", "", "section_not_found"),
        (" ", "", "document_unreadable"),
    ],
)
def test_certified_representative(spark, text, name, result):
    got = spark.createDataFrame([(text,)], "t string").select(captions.certified_representative("t").alias("r")).first().r
    assert (got.name, got.result) == (name, result)


def test_certification_sentence(spark):
    text = "NOW, THEREFORE, the Board certifies that the  International\nBrotherhood has been duly designated and authorized to represent the craft of Engineers"
    got = spark.createDataFrame([(text,), ("none",)], "t string").select(captions.certification_sentence("t").alias("r")).collect()
    assert got[0].r.name == "International Brotherhood" and "Engineers" in got[0].r.snippet and got[1].r.name == ""
