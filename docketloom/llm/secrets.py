"""Secret scan with multipart credential linking.

Strong findings stand alone: an assignment to a secret-like name, an access key id, a long hexadecimal run. Weak
candidates say nothing alone: a user or client name (identifier), a token-like run of mixed characters or what stands behind
a name such as ``pwd``, ``key`` or ``secret_access_key`` (opaque), a host, URL or socket address (endpoint). An interval join inside each document links identifiers, secrets and endpoints whose gap
is at most ``reach`` characters and which stand in the same scope (a block of text without a blank line); a weak candidate
is reported only when its complementary part co-occurs:

* identifier and opaque: each needs the other, or a strong part of the other's role;
* endpoint: needs an identifier and a secret in reach that are linked with each other.

A URL with a login is three candidates: the user is an identifier, the password a secret of the kind opaque (whatever its
characters), and what stands behind the ``@`` the endpoint; a token alone before the ``@`` is a secret.

Defined cases: null and empty texts have no findings; overlapping findings of different kinds are all kept, also those inside
an endpoint. Wholly inside a strong finding an identifier or opaque run is that finding and not a second one, the parts of a
login only where the strong finding is of their role; an opaque run in an identifier, as in a mail address, is part of it. Rows are handled one
by one, so repeated rows, ties and null ids need no rule. Positions are code points, ends exclusive. Other columns pass
through; a column that is already named ``spans`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back

#: Kinds in the order in which equal starts are listed; the first three are the strong ones.
KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
STRONG = KINDS[:3]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "opaque": "secret", "endpoint": "endpoint"}

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IDENTIFIER = re.compile(r"""(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{2,}|(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+""", re.I | re.A)
#: A run of mixed characters: an equals sign in front of it separates, and belongs to it only as padding at its end.
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?", re.A)
#: What stands behind a name of a secret that alone says little: a password has a character that is no letter, a key a digit.
_LABELLED = re.compile(r"""(?<![A-Za-z0-9])(?:(?:pwd|pass(?:phrase|code|wd)?)["']?\x20*[:=]\x20*["']?(?=[A-Za-z]*[^A-Za-z\s"'<>,;&])|(?:secret_?access_?key|access_?secret|private_?key|auth|key)["']?\x20*[:=]\x20*["']?(?=[^\s"'<>,;&0-9]*[0-9]))[^\s"'<>,;&]{6,}""", re.I | re.A)
_ENDPOINT = re.compile(r"(?:(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,30}://[^\s\"'<>]+)|(?:\b\d{1,3}(?:\.\d{1,3}){3}\b(?::\d{1,5})?)|(?:(?<![A-Za-z0-9])(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+(?::\d{1,5})?)", re.I | re.A)
#: The login in front of a URL's host, and what a text with a password in one must hold. A user has no brackets, so a redacted login is none.
_LOGIN = re.compile(r"[a-z][a-z0-9+.-]{0,30}://(?P<user>[^\s/?#\"'<>:@\[\]]*)(?::(?P<word>[^\s/?#\"'<>]*))?@", re.I | re.A)
_PASSWORD = re.compile(r"://[^\s/?#\"'<>:@\[\]]*:[^\s/?#\"'<>]+@")
_SCOPE = re.compile(r"\n[ \t\r]*\n")

SPANS = "array<struct<kind:string,start:int,end:int,role:string,link:int>>"


def _strong(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _sorted(parts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, running largest ends) of intervals."""
    parts = sorted(parts)
    return np.array([s for s, _ in parts], np.int64), np.maximum.accumulate(np.array([e for _, e in parts], np.int64))


def _overlapped(held: tuple[np.ndarray, np.ndarray], start: int, end: int) -> bool:
    """Does one of the intervals share a place with [start, end)?"""
    k = int(np.searchsorted(held[0], end)) - 1
    return k >= 0 and held[1][k] > start


def _inside(held: tuple[np.ndarray, np.ndarray], start: int, end: int) -> bool:
    """Does [start, end) lie wholly inside one of the intervals?"""
    k = int(np.searchsorted(held[0], start, "right")) - 1
    return k >= 0 and held[1][k] >= end


def _weak(text: str, strong: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    stronger = _sorted([(s, e) for _, s, e in strong])
    of_role = {r: _sorted([(s, e) for k, s, e in strong if ROLE[k] == r]) for r in ROLE.values()}
    found, logins = [], []
    for m in _ENDPOINT.finditer(text):
        start, end = m.span()
        if login := _LOGIN.match(text, start, end):
            user, start = login.span("user"), login.end()
            kind = "opaque" if login["word"] is None and _OPAQUE.fullmatch(login["user"]) else "identifier"
            own = [(kind, *user), ("opaque", *login.span("word"))]
            found += [x for x in own if x[1] < x[2] and not _inside(of_role[ROLE[x[0]]], *x[1:])]
            logins.append((m.start(), start))
        if start < end and not _inside(of_role["endpoint"], start, end):
            found.append(("endpoint", start, end))
    split = _sorted(logins)
    own = [m.span() for m in _IDENTIFIER.finditer(text)]
    own = [x for x in own if not _inside(stronger, *x) and not _overlapped(split, *x)]
    found += [("identifier", *x) for x in own]
    names = _sorted(own)
    own = [x for x in (m.span() for m in _LABELLED.finditer(text)) if not (_inside(stronger, *x) or _overlapped(split, *x) or _overlapped(names, *x))]
    found += [("opaque", *x) for x in own]
    taken = _sorted(own)
    own = [m.span() for m in _OPAQUE.finditer(text)]
    return found + [("opaque", *x) for x in own if not (_inside(stronger, *x) or any(_overlapped(h, *x) for h in (split, names, taken)))]


def join_near(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
    """Interval join: for each interval of ``a`` (scope, start, end) the row of the nearest of ``b`` in its scope with a gap
    of at most ``reach``, or -1. Both are sorted by (scope, start)."""
    out = np.full(len(a), -1, np.int64)
    if not len(a) or not len(b):
        return out
    span = int(max(a[:, 2].max(), b[:, 2].max())) + reach + 1
    at, to = a[:, 0] * span + a[:, 1], b[:, 0] * span + b[:, 1]
    until = b[:, 0] * span + b[:, 2]
    last = np.maximum.accumulate(until)  # intervals may overlap, so what reaches farthest need not start last
    farthest = np.maximum.accumulate(np.where(until == last, np.arange(len(b)), 0))
    right = np.searchsorted(to, at)
    gap = np.full(len(a), reach + 1, np.int64)
    for k in (farthest[np.maximum(right - 1, 0)], np.minimum(right, len(b) - 1)):
        d = np.maximum(0, np.maximum(b[k, 1] - a[:, 2], a[:, 1] - b[k, 2]))
        better = (b[k, 0] == a[:, 0]) & (d < gap)
        gap[better], out[better] = d[better], k[better]
    return out


def find(text: str | None, reach: int = 200) -> list[tuple[str, int, int, str, int]]:
    """All findings of one text: (kind, start, end, role, number of its link or -1), by start and then kind."""
    text = text or ""
    strong = _strong(text)
    weak = _weak(text, strong) if strong or any(p.search(text) for p in (_OPAQUE, _LABELLED, _PASSWORD)) else []
    parts = sorted(strong + weak, key=lambda x: (x[1], KINDS.index(x[0])))
    if not parts:
        return []
    breaks = np.array([m.start() for m in _SCOPE.finditer(text)], np.int64)
    rows = np.array([(int(np.searchsorted(breaks, s)), s, e) for _, s, e in parts], np.int64)
    role = np.array([ROLE[k] for k, _, _ in parts])
    sets = {r: np.flatnonzero(role == r) for r in ("identifier", "secret", "endpoint")}
    link = np.full(len(parts), -1, np.int64)

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = join_near(rows[a], rows[b], reach)
        return np.where(k >= 0, b[np.maximum(k, 0)], -1) if len(b) else np.full(len(a), -1, np.int64)

    identifiers, secrets = sets["identifier"], sets["secret"]
    to_secret, to_identifier = near(identifiers, secrets), near(secrets, identifiers)
    link[identifiers] = to_secret  # a link is numbered by its secret
    linked = secrets[(to_identifier >= 0) | np.isin(secrets, to_secret)]
    link[linked] = linked
    link[sets["endpoint"]] = near(sets["endpoint"], linked)
    keep = np.array([k in STRONG for k, _, _ in parts]) | (link >= 0)
    number = {int(x): n for n, x in enumerate(dict.fromkeys(link[keep & (link >= 0)].tolist()))}
    return [(k, s, e, ROLE[k], number.get(int(n), -1)) for (k, s, e), n, kept in zip(parts, link, keep, strict=True) if kept]


def scan_secrets(df: DataFrame, text: str = "text", reach: int = 200) -> DataFrame:
    """``df`` with a column ``spans``: the findings in the column ``text``; no shuffle, whole texts."""

    @F.pandas_udf(SPANS)
    def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for each in texts:
            yield pd.Series([[dict(zip(("kind", "start", "end", "role", "link"), x, strict=True)) for x in find(t, reach)] for t in each])
            give_back()

    return df.withColumn("spans", spans(F.col(text)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(df: DataFrame, reach: int = 200) -> DataFrame:
    """doc_id, counts of the strong kinds, the digest of the strong spans, and all spans."""
    found = scan_secrets(df.select("doc_id", "text"), "text", reach)
    base = F.filter("spans", lambda x: x["kind"].isin(*STRONG))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, STRONG), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda x: x["link"] >= 0)).cast("long").alias("n_linked"))


def redact(df: DataFrame, text: str = "text", reach: int = 200, mark: str = "[secret]") -> DataFrame:
    """``df`` with every finding in ``text`` replaced by ``mark``; overlapping findings become one mark. Rows and columns stay."""

    @F.pandas_udf("string")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for each in texts:
            out = []
            for t in each:
                pieces, at = [], 0
                for _, start, end, _, _ in find(t, reach):
                    if start >= at:
                        pieces += [t[at:start], mark]
                    at = max(at, end)
                out.append(t if t is None or not pieces else "".join([*pieces, t[at:]]))
            yield pd.Series(out, dtype="object")
            give_back()

    return df.withColumn(text, clean(F.col(text)))
