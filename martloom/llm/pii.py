"""Personal data by anchor expansion: an Aho-Corasick pass finds anchors, small parsers find the boundaries."""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "secret")
_AT, _PLUS, _DIGIT, _SCHEME, _IBAN, _SECRET = range(6)
# Schemes and words that announce an account number or a secret.
SCHEMES = ("http://", "https://", "ftp://")
IBAN_CUES = ("IBAN", "iban", "Iban")
SECRET_CUES = ("password", "passwd", "token", "api_key", "apikey", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_SPACED = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_REST = re.compile(r"[A-Za-z0-9\[][^\x00-\x20\"'<>\\^`{|}]*")
_IBAN_REST = re.compile(r"[\x20:#]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SECRET_REST = re.compile(r"[\"']?[\x20\t]*[:=][\x20\t]*[\"']?([A-Za-z0-9+/_=.-]{8,})")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    cues = {"@": _AT, "+": _PLUS, **dict.fromkeys("0123456789", _DIGIT), **dict.fromkeys(SCHEMES, _SCHEME)}
    cues |= dict.fromkeys(IBAN_CUES, _IBAN)
    cues |= {form(cue): _SECRET for cue in SECRET_CUES for form in (str, str.upper, str.capitalize)}
    for cue, kind in cues.items():
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _iban_holds(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def spans_of(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, by kind and start; kinds may overlap each other, not themselves.

    Every base match holds an anchor, and its ends follow from the characters around it: no other start
    could match there. Parsers keep how far they came, so that each character is parsed once per kind.
    """
    found: list[tuple[int, int, int]] = []
    done = [0] * len(KINDS)
    email, ip, card, phone, url, iban, secret = range(len(KINDS))
    for last, (anchor, width) in anchors.iter(text):
        at = last - width + 1
        if anchor == _DIGIT:
            if at >= done[ip]:
                chain = _DOTTED.match(text, at)
                done[ip] = chain.end()
                if "." in chain[0]:
                    parts, start = chain[0].split("."), at
                    for i in range(0, len(parts) - 3, 4):
                        end = start + sum(map(len, parts[i : i + 4])) + 3
                        if all(map(_octet, parts[i : i + 4])):
                            found.append((ip, start, end))
                        start = end + 1
            if at >= done[card]:
                chain = _SPACED.match(text, at)
                done[card] = chain.end()
                if chain.end() - at >= 13:
                    digits = chain[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found.append((card, at, chain.end()))
        elif anchor == _AT:
            rest = _DOMAIN.match(text, at + 1)
            if rest:
                start = at
                while start > done[email] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    found.append((email, start, rest.end()))
                    done[email] = rest.end()
        elif anchor == _PLUS:
            whole = _PHONE.match(text, at)
            if whole and 9 <= sum(map(str.isdigit, whole[0])) <= 15:
                found.append((phone, at, whole.end()))
        elif anchor == _SCHEME:
            rest = _URL_REST.match(text, last + 1)
            if rest and at >= done[url]:
                end = rest.end() - (len(rest[0]) - len(rest[0].rstrip(".,;:!?)]*")))
                found.append((url, at, end))
                done[url] = end
        elif anchor == _IBAN:
            rest = _IBAN_REST.match(text, last + 1)
            if rest and rest.start(1) >= done[iban] and _iban_holds(rest[1]):
                found.append((iban, rest.start(1), rest.end(1)))
                done[iban] = rest.end(1)
        else:
            rest = _SECRET_REST.match(text, last + 1)
            if rest and rest.start(1) >= done[secret]:
                found.append((secret, rest.start(1), rest.end(1)))
                done[secret] = rest.end(1)
    found.sort()
    return found


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)``: per input row an array of ``kind, start, end``, ordered by kind as in ``KINDS``.

    ``BASE_KINDS`` are found by their fixed grammar: leftmost, not overlapping, failing candidates dropped.
    ``url``, ``iban`` and ``secret`` come from schemes and cue words. Null and empty texts have no spans, a
    null id is carried along, repeated rows give repeated results, an empty table gives no rows. A text of any
    length is searched whole; places count its code points.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches):
        anchors = automaton()
        names = pa.array(KINDS)
        for batch in batches:
            found = [spans_of(t, anchors) if t else [] for t in batch.column("text").to_pylist()]
            flat = np.array([s for spans in found for s in spans], np.int32).reshape(-1, 3)
            span = pa.StructArray.from_arrays(
                [names.take(pa.array(flat[:, 0])), pa.array(flat[:, 1]), pa.array(flat[:, 2])], ["kind", "start", "end"]
            )
            ends = np.cumsum([0] + [len(spans) for spans in found], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), span)], ["doc_id", "spans"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int>>")
