"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and identifier cues.
At each anchor a deterministic local parser expands to the match's bounds and validates it. The kinds email,
ip, card and phone equal leftmost non-overlapping matches of their expressions; url and account are the
method's own, with schemes and cues in any ASCII case. What follows a cue is an account if it has a digit and stands
by itself; what has the form of an IBAN (in groups too) must pass its check digits, what follows "routing" must be
nine digits that pass theirs, and what follows "ssn" must be a number that can be given out. Each parser moves on
from where its last match (kept or dropped) ended, so the work is linear.

Defined results: a null text counts as empty and has no spans; an empty table gives no rows; repeated rows are
scanned each; extra columns are ignored (or kept, by ``redact``).
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded_batches, map_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("account", "acct", "iban", "passport", "ssn", "user id", "customer id", "member id", "routing")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\x00-\x20\x7f<>\"'`{}|\\^]+")
_ACCOUNT = re.compile(r"(?i:\x20?(?:no\.?|number|num|id|#))?[\x20:=#.]{1,3}([A-Z0-9][A-Z0-9-]{4,32}[A-Z0-9])(?![A-Za-z0-9])")

_IBAN_LEAD = re.compile(r"(?i:\x20?(?:no\.?|number|num|id|#))?[\x20:=#.]{1,3}([A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30})")
_IBAN_FORM = re.compile(r"[A-Za-z]{2}[0-9]{2}[A-Za-z0-9]{11,30}")
_SSN = re.compile(r"(?i:\x20?(?:no\.?|number|num|id|#))?[\x20:=#.]{1,3}(([0-9]{3})([\x20-]?)([0-9]{2})\3([0-9]{4}))(?![A-Za-z0-9])")
_CAPITALS = re.compile("[A-Z]+")

_anchors: ahocorasick.Automaton | None = None


def _automaton() -> ahocorasick.Automaton:
    global _anchors
    if _anchors is None:
        found = ahocorasick.Automaton()
        for c in "0123456789":
            found.add_word(c, ("digit", 1))
        found.add_word("@", ("at", 1))
        found.add_word("+", ("plus", 1))
        for word in SCHEMES:
            found.add_word(word, ("scheme", len(word)))
        for word in CUES:
            found.add_word(word, (word, len(word)))
        found.make_automaton()
        _anchors = found
    return _anchors


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if n % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _lowered(text: str) -> str:
    """``text`` with the ASCII capitals made small; every other code point stays, so places are the same."""
    return text.lower() if text.isascii() else _CAPITALS.sub(lambda m: m[0].lower(), text)


def iban(plain: str) -> bool:
    """Check digits of an IBAN without blanks."""
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def routing(digits: str) -> bool:
    """Check digit of a nine-digit routing number."""
    return len(digits) == 9 and digits.isdecimal() and sum(w * int(d) for w, d in zip((3, 7, 1) * 3, digits, strict=True)) % 10 == 0


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """The longest valid IBAN after a cue that ends at ``at``: 15 to 34 letters and digits, single spaces between groups."""
    m = _IBAN_LEAD.match(text, at)
    end = m.end(1) if m else 0
    while m and end - m.start(1) >= 15:
        if not (text[end - 1] == " " or text[end : end + 1].isalnum()):
            plain = text[m.start(1) : end].replace(" ", "")
            if len(plain) >= 15 and iban(plain):
                return m.start(1), end
        end -= 1
    return None


def _account(text: str, cue: str, at: int) -> tuple[int, int, int] | None:
    """Start and end of a valid account after a cue that ends at ``at``, and where to go on."""
    if place := _iban(text, at):
        return *place, place[1]
    if cue == "ssn":
        m = _SSN.match(text, at)
        possible = m and m[2] not in ("000", "666") and m[2] < "900" and m[4] != "00" and m[5] != "0000"
        return (m.start(1), m.end(1), m.end()) if possible else None
    m = _ACCOUNT.match(text, at)
    if not m or not any("0" <= c <= "9" for c in m[1]):
        return None
    if cue == "routing" and not routing(m[1]) or _IBAN_FORM.fullmatch(m[1]):
        return None  # what has the form of an IBAN and is valid was found above
    return m.start(1), m.end(1), m.end()


def find_pii(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in code points, end exclusive, by start, then kind as in ``KINDS``."""
    spans: list[tuple[int, int, str]] = []
    done = dict.fromkeys(KINDS, 0)
    left = 0  # no local part reaches back over the last at-sign
    for last, (anchor, length) in _automaton().iter(_lowered(text)):
        at = last - length + 1
        if anchor == "digit":
            if at >= done["ip"] and not (at and "0" <= text[at - 1] <= "9") and (m := _IP.match(text, at)):
                done["ip"] = m.end()
                if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m[0].split(".")):
                    spans.append((at, m.end(), "ip"))
            if at >= done["card"] and (m := _CARD.match(text, at)):
                done["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append((at, m.end(), "card"))
        elif anchor == "at":
            if m := _DOMAIN.match(text, at):
                start, floor = at, max(done["email"], left)
                while start > floor and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    done["email"] = m.end()
                    spans.append((start, m.end(), "email"))
            left = at + 1
        elif anchor == "plus":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    spans.append((at, m.end(), "phone"))
        elif anchor == "scheme":
            if at >= done["url"] and (m := _URL.match(text, at + length)):
                end = m.end()
                while end > at + length and text[end - 1] in ".,;:!?)]":
                    end -= 1
                if end > at + length:
                    done["url"] = end
                    spans.append((at, end, "url"))
        elif at >= done["account"] and not (at and text[at - 1].isalnum()) and (place := _account(text, anchor, at + length)):
            start, end, done["account"] = place
            spans.append((start, end, "account"))
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _row(text: str) -> tuple:
    spans = find_pii(text)
    base = [s for s in spans if s[2] in BASE_KINDS]
    counts = [sum(s[2] == k for s in base) for k in BASE_KINDS]
    return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))


def pii_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row."""
    return map_text(docs, id_col, text_col, _row, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one, under the first's kind."""
    out, at = [], 0
    spans = find_pii(text)
    i = 0
    while i < len(spans):
        a, b, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < b:
            b = max(b, spans[i][1])
            i += 1
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with redacted texts (null stays null); a column ``n_chars`` follows the new length."""
    bounded_batches(docs.sparkSession)
    change = F.pandas_udf(lambda texts: texts.map(lambda t: None if t is None else redacted(t)), "string")
    out = docs.withColumn(text_col, change(F.col(text_col).cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType))
    return out
