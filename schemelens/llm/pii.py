"""Personal data by anchor expansion (operator 9).

One Aho-Corasick pass over the whole text finds anchors: at-signs, URL
schemes, plus signs, digits and cue words of identifiers.  From each anchor a
deterministic local parser expands to the left and right and validates what it
found.  Email, address (ip), card and phone spans are the leftmost
non-overlapping matches of their patterns, since an anchor that lies inside an
earlier match of its kind is passed over; url, account, iban and secret spans
come on top, from cue words and schemes.

Results on odd input: a null or empty text has no spans and is redacted to
itself; texts of any length are read whole; repeated rows give repeated rows;
an empty table gives an empty table; null ids pass through; columns other than
id and text are read only by ``redact``, which keeps them unchanged.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import map_batches

KINDS = ("email", "ip", "card", "phone", "url", "account", "iban", "secret")
ACCOUNT_CUES = ("account", "acct", "konto")
SECRET_CUES = ("token", "secret", "password", "api_key", "apikey")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_DIGITS = re.compile(r"[0-9]+").match
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)").match
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+").match
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").match
_USERINFO = re.compile(r"://[^\s/@:]+:[^\s/@]*@[^\s]+").match
_ACCOUNT = re.compile(r"(?:\s?(?:number|no\.?|nr\.?))?[\s:#=]{1,3}([0-9][0-9-]{6,30}[0-9])").match
_IBAN = re.compile(r"[\s:#=]{1,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])").match
_SECRET = re.compile(r"\s*[=:]\s*[\"']?([A-Za-z0-9_\-]{16,})").match


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


@lru_cache(maxsize=1)
def anchors():
    import ahocorasick
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (("account", ACCOUNT_CUES), ("iban", ("iban",)), ("secret", SECRET_CUES)):
        for cue in cues:
            for form in (cue, cue.capitalize(), cue.upper()):
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind in the order of KINDS, then start."""
    got: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    email_end = run_end = ip_end = number_end = phone_end = url_end = 0
    for last, (anchor, size) in anchors().iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at < run_end:
                continue
            run_end = _DIGITS(text, at).end()
            if at >= ip_end and (m := _IP(text, at)):
                ip_end = m.end()
                if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m.groups()):
                    got["ip"].append(("ip", at, ip_end))
            if at >= number_end and (m := _NUMBER(text, at)):
                number_end = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    got["card"].append(("card", at, number_end))
        elif anchor == "at":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN(text, at + 1)):
                email_end = m.end()
                got["email"].append(("email", start, email_end))
        elif anchor == "plus":
            if at >= phone_end and (m := _PHONE(text, at)):
                phone_end = m.end()
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    got["phone"].append(("phone", at, phone_end))
        elif anchor == "scheme":
            if at >= url_end and (m := _USERINFO(text, at)):
                start = at
                while start > url_end and text[start - 1].isalnum():
                    start -= 1
                url_end = m.end()
                got["url"].append(("url", start, url_end))
        elif at == 0 or not text[at - 1].isalnum():
            parse = {"account": _ACCOUNT, "iban": _IBAN, "secret": _SECRET}[anchor]
            if (m := parse(text, last + 1)) and (anchor != "iban" or _iban_ok(m[1])):
                row = (anchor, m.start(1), m.end(1))
                if not got[anchor] or got[anchor][-1][2] <= row[1]:
                    got[anchor].append(row)
    return [s for k in KINDS for s in got[k]]


def replace(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each stretch of overlapping spans becomes the mark of the span that opens it, such as <EMAIL>."""
    out, done = [], 0
    stretch = None
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if stretch and start < stretch[2]:
            stretch[2] = max(stretch[2], end)
            continue
        if stretch:
            out += [text[done:stretch[1]], f"<{stretch[0].upper()}>"]
            done = stretch[2]
        stretch = [kind, start, end]
    if stretch:
        out += [text[done:stretch[1]], f"<{stretch[0].upper()}>"]
        done = stretch[2]
    return "".join(out) + text[done:]


SPANS = "array<struct<kind:string,start:int,end:int>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _span_array(rows: list[list[tuple[str, int, int]]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in r] for r in rows], _ARROW_SPANS)


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of each row; spans as ``find`` lists them."""
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batch):
        spans = [find(t) if t else [] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), _span_array(spans)], names=[id_col, "spans"])

    return map_batches(rows, run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, spans {SPANS}")


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, personal data in ``text_col`` replaced by marks."""
    at = df.columns.index(text_col)

    def run(batch):
        texts = [replace(t, find(t)) if t else t for t in batch.column(at).to_pylist()]
        cols = list(batch.columns)
        cols[at] = pa.array(texts, batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return map_batches(df, run, df.schema)
