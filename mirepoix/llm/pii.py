"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, URL schemes, plus signs
before digits, neighbouring digits, and identifier cues. A local parser grows each
anchor to the span it belongs to and validates it. The four base kinds (email, ip,
card, phone) are exactly the leftmost non-overlapping matches of their patterns;
url, secret, account and address are found besides.

Defined cases: a null or empty text has no spans. Spans of different kinds may
overlap; spans of one kind do not. Offsets are code points, ends exclusive. Each
input row gives one row, so repeated rows stay; further columns are kept by
``mask`` and not read by ``find``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url", "secret", "account", "address")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,30}\Z")
_URL_REST = re.compile(r"[^\s<>\"'{}|\\^`]+")
_KEY_ID = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
_SECRET_REST = re.compile(r"\s{0,3}[=:]\s{0,3}[\"']?([^\s\"',;]{6,})")
_ACCOUNT_REST = re.compile(r"(?:\s{1,2}(?i:no\.?|number|nr\.?))?\s{0,2}[:#=]?\s{0,2}([A-Z]{0,4}[0-9](?:[ -]?[0-9A-Z]){3,33})")
_BEFORE_STREET = re.compile(r"(?<![0-9])[0-9]{1,5}[A-Za-z]?(?:\s[A-Z][a-z]{1,20}){1,3}\s\Z")
# Words that announce an identifier or end a street name.
SECRET_CUES = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "api-key")
ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport", "konto", "compte", "cuenta")
STREET_CUES = ("Street", "St.", "Avenue", "Ave.", "Road", "Rd.", "Boulevard", "Lane", "Drive")


@cache
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for d in _DIGITS:
        found.add_word("+" + d, ("phone", 2))
        for e in _DIGITS:
            found.add_word(f"{d}.{e}", ("ip", 3))
            for sep in ("", " ", "-"):
                found.add_word(d + sep + e, ("card", 2 + len(sep)))
    found.add_word("@", ("email", 1))
    found.add_word("://", ("url", 3))
    found.add_word("AKIA", ("key", 4))
    for kind, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES)):
        for cue in {c for w in cues for c in (w, w.title(), w.upper())}:
            found.add_word(cue, (kind, len(cue)))
    for cue in STREET_CUES:
        found.add_word(cue, ("address", len(cue)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(doubled) + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of one text, by kind as in ``KINDS``, then start."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, width) in _anchors().iter(text):
        at = last - width + 1
        if kind == "email":
            start = at
            while start > done[kind] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                out[kind].append((start, m.end()))
                done[kind] = m.end()
        elif kind == "ip":
            if at < done[kind]:
                continue
            while at > done[kind] and text[at - 1] in _DIGITS:
                at -= 1
            if m := _IP.match(text, at):
                done[kind] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                    out[kind].append(m.span())
        elif kind == "card":
            if at < done[kind]:
                continue
            m = _CARD.match(text, at)
            done[kind] = m.end()
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out[kind].append(m.span())
        elif kind == "phone":
            if at >= done[kind] and (m := _PHONE.match(text, at)):
                done[kind] = m.end()
                if 9 <= sum(c in _DIGITS for c in m.group()) <= 15:
                    out[kind].append(m.span())
        elif kind == "url":
            head = _SCHEME.search(text, max(done[kind], at - 31), at)
            if head and (m := _URL_REST.match(text, at + 3)):
                end = at + 3 + len(m.group().rstrip(".,;:!?)]"))
                if end > at + 3:
                    out[kind].append((head.start(), end))
                    done[kind] = end
        elif kind == "key":
            if at >= done["secret"] and (at == 0 or not text[at - 1].isalnum()) and (m := _KEY_ID.match(text, at)):
                out["secret"].append(m.span())
                done["secret"] = m.end()
        elif kind == "address":
            begin = max(done[kind], at - 80)
            if m := _BEFORE_STREET.search(text, begin, at):
                out[kind].append((m.start(), last + 1))
                done[kind] = last + 1
        else:
            rest = _SECRET_REST if kind == "secret" else _ACCOUNT_REST
            if at >= done[kind] and (m := rest.match(text, last + 1)):
                if kind == "account" and sum(c in _DIGITS for c in m.group(1)) < 6:
                    continue
                out[kind].append(m.span(1))
                done[kind] = m.end(1)
    return [(kind, a, b) for kind in KINDS for a, b in out[kind]]


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    parts, at = [], 0
    for kind, start, end in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:] if parts else text


def find(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end)."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind string, start bigint, end bigint>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans as text."""
    def text_of(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """The rows with personal data in ``text`` masked; a null text stays null. ``n_chars``, if there, is counted anew."""
    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(masked, na_action="ignore")

    out = docs.withColumn("text", run(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
