"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, URL schemes, plus-digit and
digit-dot pairs, digits, and identifier cues (words such as ``iban`` or
``password``).  At each anchor a small deterministic parser walks to both ends
of the span and validates it.

Base kinds, leftmost and non-overlapping within a kind, failing matches
dropped without a retry:

* email: local part, ``@``, two or more labels;
* ip: four numbers joined by dots, each at most 255;
* card: 14 to 19 digits, single blanks or hyphens between, passing Luhn;
* phone: ``+`` and 10 to 15 digits with blanks, brackets, dots, hyphens.

Added kinds: url (a scheme and a host with a dot, to the next blank or quote)
and secret (a cue, ``:`` or ``=``, an optional quote and 8 or more characters
of ``[A-Za-z0-9_/+=.-]``, a digit among them).  After the cues ``iban``, ``ssn``
and ``account`` words such as ``number`` or ``no.`` may follow, the separator
may be missing and the value may be grouped:

* iban, account: an IBAN of its country's length that passes mod 97;
* ssn: 3, 2 and 4 digits, as issued (no 000, 666 or 9xx, no 00, no 0000);
* account: digits, single blanks or hyphens between: 6 or more after such a
  word, 8 or more otherwise, without a separator in groups of 3 or more.

What these do not accept is still a secret by the rule of all cues.  Offsets
are code points, ends exclusive.

Defined cases: a null text is empty and has no spans; repeated rows are
answered alike, each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import string
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import carried
from cumulus.llm.shingles import SMALL_TEXT, slices

# fixed values: span kinds in their order, anchors and character classes
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("token", "password", "passwd", "secret", "api_key", "apikey", "access_key", "iban", "ssn", "account")
NUMBER_CUES = frozenset(("iban", "ssn", "account"))
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
UPPER = frozenset(string.ascii_uppercase)
DIGITS = frozenset("0123456789")
ALNUM = frozenset(string.ascii_letters + string.digits)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
PHONE = frozenset(" ().0123456789-")
URL_RUN = re.compile(r"""[^ \t\n\r\x0b\x0c"'<>|`]*+""")
HOST_END, DOT, NO_DOT = re.compile("[/?#:]"), re.compile(r"\."), re.compile(r"[^.]")
VALUE = re.compile(r"[A-Za-z0-9_/+=.-]*+")
DIGIT = re.compile("[0-9]")
ASSIGN = re.compile(r"[ \t\"':=]*+")
NAMES = re.compile(r"((?:[ \t_-]*+(?:(?:numbers?|nummer|num|nr|no|code|id|is)(?![A-Za-z])\.?|#))*+)([ \t\"'():=-]*+)", re.I | re.A)
SSN = re.compile(r"(?!000|666|9)[0-9]{3}([ -]?)(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9])")
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 "
    "YE30").split()}


@lru_cache(maxsize=1)
def automaton():
    """Anchors with their kind, for a text whose A-Z are lower-cased: cues and schemes ignore case."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
        a.add_word("+" + d, ("plus", 2))
        a.add_word(d + ".", ("dot", 2))
    a.add_word("@", ("at", 1))
    for words, kind in ((SCHEMES, "scheme"), (CUES, "cue")):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, its local part not before ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    end, n, labels = at + 1, len(text), 0
    while True:
        label = end
        while label < n and text[label] in LABEL:
            label += 1
        if label == end:
            break
        labels, end = labels + 1, label
        if end < n and text[end] == ".":
            end += 1
        else:
            return (start, end) if labels > 1 else None
    # a trailing dot is not part of the address
    return (start, end - 1) if labels > 1 else None


def number_chain(text: str, at: int) -> list[tuple[int, int]]:
    """The numbers joined by single dots around position ``at`` of a digit: (start, end) of each."""
    n, start = len(text), at
    while start and text[start - 1] in DIGITS:
        start -= 1
    parts = []
    while True:
        end = start
        while end < n and text[end] in DIGITS:
            end += 1
        parts.append((start, end))
        if end + 1 < n and text[end] == "." and text[end + 1] in DIGITS:
            start = end + 1
        else:
            return parts


def small_number(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def card_from(text: str, start: int) -> int:
    """End of the run of digits, single blanks or hyphens between, that starts at ``start``."""
    n, end = len(text), start + 1
    while end < n:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def phone_from(text: str, plus: int) -> int | None:
    """End of the number whose ``+`` is at ``plus``: the last digit of the run, two characters or more after the first digit."""
    n, end = len(text), plus + 2
    while end < n and text[end] in PHONE:
        end += 1
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end > plus + 3 else None


class Runs:
    """Ends of the unbroken runs that parsers scan: a run is walked once, however many anchors lie inside it."""

    def __init__(self, text: str):
        self.text, self.known = text, {}

    def ends(self, name: str, pattern: re.Pattern, trimmed: str, start: int) -> tuple[int, int]:
        """End of the run of ``pattern`` from ``start`` on, as it is and without ``trimmed`` at its end."""
        first, last, end = self.known.get(name, (1, 0, 0))
        if not first <= start < last:
            last = pattern.match(self.text, start).end()
            end = last
            while end > start and self.text[end - 1] in trimmed:
                end -= 1
            self.known[name] = start, last, end
        return last, max(start, end)

    def next(self, name: str, pattern: re.Pattern, start: int) -> int:
        """Start of the first match of ``pattern`` at or after ``start``; the text's length if there is none."""
        first, at = self.known.get(name, (1, 0))
        if not first <= start <= at:
            found = pattern.search(self.text, start)
            at = found.start() if found else len(self.text)
            self.known[name] = start, at
        return at


def url_from(runs: Runs, host: int) -> int | None:
    """End of the URL whose host starts at ``host``; the host's dot is not at its ends."""
    end = runs.ends("url", URL_RUN, ".,;:!?)]}", host)[1]
    name = min(end, runs.next("host", HOST_END, host))
    first = runs.next("no dot", NO_DOT, host)
    dot = runs.next("dot", DOT, first)
    # a dot between two other characters of the host
    return end if dot < name and runs.next("no dot", NO_DOT, dot) < name else None


def iban_from(text: str, start: int) -> int | None:
    """End of the IBAN that starts at ``start``, single blanks or hyphens between its characters."""
    size = IBAN_LENGTHS.get(text[start:start + 2].upper()) if text[start:start + 2].isascii() else None
    n, end, chars = len(text), start, ""
    while size and end < n and len(chars) < size:
        if text[end] in " \xa0-" and chars:
            end += 1
        if end == n or text[end] not in ALNUM:
            return None
        chars += text[end]
        end += 1
    if not size or len(chars) < size or (end < n and text[end] in ALNUM) or not DIGITS.issuperset(chars[2:4]):
        return None
    return end if int("".join(str(int(c, 36)) for c in chars[4:] + chars[:4])) % 97 == 1 else None


def account_from(text: str, start: int, named: bool, parted: bool) -> int | None:
    """End of the account number that starts at ``start``; ``named``: a word such as number is before it,
    ``parted``: a colon or equals sign."""
    if start == len(text) or text[start] not in DIGITS:
        return None
    end = card_from(text, start)
    groups = re.split("[ -]", text[start:end])
    if sum(map(len, groups)) < (6 if named else 8):
        return None
    return end if named or parted or min(map(len, groups)) > 2 else None


def number_after(runs: Runs, cue: int, word: str) -> tuple[int, int] | None:
    """The IBAN, social security or account number after the cue ``word`` that ends at ``cue``."""
    text = runs.text
    lead = NAMES.match(text, cue)
    i, parted = lead.end(), any(c in lead[2] for c in ":=")
    if i == cue:
        return None
    if word == "ssn":
        found = SSN.match(text, i)
        end = found and found.end()
    else:
        end = iban_from(text, i)
        if word == "account" and not end:
            end = account_from(text, i, bool(lead[1]), parted)
    return (i, end) if end else value_at(runs, i, parted)


def secret_after(runs: Runs, cue: int) -> tuple[int, int] | None:
    """The value assigned after a cue that ends at ``cue``."""
    lead = ASSIGN.match(runs.text, cue)
    return value_at(runs, lead.end(), any(c in lead[0] for c in ":="))


def value_at(runs: Runs, i: int, assigned: bool) -> tuple[int, int] | None:
    """The unbroken value that starts at ``i``."""
    if not assigned:
        return None
    end = runs.ends("value", VALUE, ".-=", i)[1]
    return (i, end) if end - i >= 8 and runs.next("digit", DIGIT, i) < end else None


def find_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every span, by start, then kind as listed."""
    spans, runs = [], Runs(text)
    done = dict.fromkeys(KINDS, 0)  # where a kind's scan goes on
    # offsets stay: only A-Z change
    for last, (anchor, size) in automaton().iter(text.lower() if text.isascii() else text.translate(LOWER)):
        first = last - size + 1
        if anchor == "digit":
            if first >= done["card"]:
                end = done["card"] = card_from(text, first)
                digits = "".join(c for c in text[first:end] if c in DIGITS)
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append((first, "card", end))
        elif anchor == "at":
            if found := email_at(text, first, done["email"]):
                spans.append((found[0], "email", found[1]))
                done["email"] = found[1]
        elif anchor == "dot":
            if first >= done["ip"]:
                parts = number_chain(text, first)
                done["ip"] = parts[-1][1]
                for i in range(0, len(parts) - 3, 4):
                    if all(small_number(text[a:b]) for a, b in parts[i:i + 4]):
                        spans.append((parts[i][0], "ip", parts[i + 3][1]))
        elif anchor == "plus":
            if first >= done["phone"] and (end := phone_from(text, first)):
                done["phone"] = end
                if 10 <= sum(c in DIGITS for c in text[first:end]) <= 15:
                    spans.append((first, "phone", end))
        elif anchor == "scheme":
            if first >= done["url"] and (end := url_from(runs, last + 1)):
                spans.append((first, "url", end))
                done["url"] = end
        elif last >= done["secret"] and (
                first == 0 or not text[first - 1].isalnum() or (text[first] in UPPER and text[first - 1] not in UPPER)):
            word = text[first:last + 1].lower()
            if found := number_after(runs, last + 1, word) if word in NUMBER_CUES else secret_after(runs, last + 1):
                spans.append((found[0], "secret", found[1]))
                done["secret"] = found[1]
    spans.sort(key=lambda s: (s[0], ORDER[s[1]], s[2]))
    return spans


def as_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans) -> str:
    """Each stretch of overlapping spans replaced by its first kind in angle brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(out) + text[at:]


def _scan(batches):
    for whole in batches:
        for b in slices(whole, "text", SMALL_TEXT):
            texts = [t or "" for t in b.column("text").to_pylist()]
            found = [find_spans(t) for t in texts]
            counts = [pa.array([sum(s[1] == k for s in f) for f in found], pa.int64()) for k in BASE_KINDS]
            base = [hashlib.sha256(as_text(s for s in f if s[1] in BASE_KINDS).encode()).hexdigest() for f in found]
            clean = [redact(t, f) if f else t for t, f in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), *counts, pa.array(base), pa.array([as_text(f) for f in found], pa.string()),
                 pa.array(clean, pa.string())],
                ["doc", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "redacted"])


OWN = [*[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "redacted"]


def find_personal_data(docs: DataFrame, text_col="text") -> DataFrame:
    """Columns of ``docs`` but the text, and n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted.

    Input columns with one of these names are replaced.
    """
    keep = carried(docs, [text_col, *OWN])
    rows = docs.select(F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("_")]).alias("doc"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    found = rows.mapInArrow(_scan, f"doc {kind}, {counts}, base_sha256 string, spans string, redacted string")
    return found.select(*[F.col("doc")[c].alias(c) for c in keep], *OWN)
