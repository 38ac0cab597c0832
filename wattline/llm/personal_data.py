"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the few characters and words that every kind of
personal data must contain: at-signs, plus signs, digits, scheme marks and
identifier cues. From each anchor a small parser walks outwards, fixes the exact
boundaries and validates what it found. Text without anchors costs one pass.

Kinds ``email ip card phone`` follow fixed grammars; the method adds ``login``
(user and password inside an address with a scheme) and ``account`` (a validated
identifier after a cue). Spans are code points, end exclusive.

Defined cases: a null or empty text has no span; repeated rows are reported one
by one.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone", "login", "account")

# Words that announce an identifier.
CUES = ("iban", "ssn", "social security", "account", "acct", "passport")

DIGITS = frozenset(string.digits)
ALNUM = frozenset(string.ascii_letters + string.digits)
LABEL = ALNUM | {"-"}
LOCAL = ALNUM | frozenset("._%+-")
DIAL = DIGITS | frozenset(" ().-")

_AUTOMATON = []


def _automaton():
    if not _AUTOMATON:
        import ahocorasick

        built = ahocorasick.Automaton()
        for mark in ("@", "+", "://", *string.digits):
            built.add_word(mark, (mark, 1 if mark in DIGITS else 0))
        for cue in CUES:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                built.add_word(form, ("cue", 0))
        built.make_automaton()
        _AUTOMATON.append(built)
    return _AUTOMATON[0]


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that begins at ``at``."""
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign, beginning no earlier than ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == ".":
        label = _run(text, end + 1, LABEL)
        if label == end + 1:
            break
        end, dots = label, dots + 1
    return (start, end) if dots else None


def _dotted(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """The digit runs joined by single dots from ``at``, and where the chain ends."""
    runs, end = [], at
    while True:
        stop = _run(text, end, DIGITS)
        if stop == end:
            return runs, runs[-1][1]
        runs.append((end, stop))
        if stop >= len(text) or text[stop] != ".":
            return runs, stop
        end = stop + 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _spaced(text: str, at: int) -> int:
    """End of the digits that single blanks or hyphens may separate."""
    end, size = at, len(text)
    while end < size:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _phone(text: str, at: int) -> tuple[int, int] | None:
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = _run(text, at + 2, DIAL)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (at, end) if end > at + 3 else None


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


# What may follow a cue, after an optional word, colon or hash sign.
_AFTER_CUE = re.compile(r"(?: ?(?:number|no\.?|nr\.?))?[ :#=]{0,3}([A-Za-z0-9][A-Za-z0-9 -]{6,40}[A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PLAIN = re.compile(r"[0-9](?:-?[0-9]){7,16}(?![0-9-])")
_PASSPORT = re.compile(r"[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])")
_LOGIN = re.compile(r"[^\s/@:?#]+:[^\s/@?#]+@[A-Za-z0-9.-]*[A-Za-z0-9]")


def iban(text: str) -> bool:
    """Check digits by remainder 97."""
    flat = text.replace(" ", "")
    if not 15 <= len(flat) <= 34:
        return False
    rest = 0
    for c in flat[4:] + flat[:4]:
        n = int(c, 36)
        rest = (rest * (100 if n > 9 else 10) + n) % 97
    return rest == 1


def _account(text: str, at: int) -> tuple[int, int] | None:
    """A validated identifier that begins shortly after the cue ending at ``at``."""
    found = _AFTER_CUE.match(text, at)
    if not found:
        return None
    start = found.start(1)
    own = _IBAN.match(text, start)
    while own:  # a following word may look like one more group
        if iban(own[0]):
            return own.span()
        shorter = own[0].rstrip().rpartition(" ")[0]
        own = _IBAN.match(text, start, start + len(shorter)) if shorter else None
    for form in (_SSN, _PLAIN, _PASSPORT):
        if own := form.match(text, start):
            return own.span()
    return None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` by start, then kind."""
    out: list[tuple[str, int, int]] = []
    mail_end = ip_end = card_end = dial_end = 0
    for last, (mark, digit) in _automaton().iter(text):
        if digit:
            if last >= ip_end:
                runs, ip_end = _dotted(text, last)
                for k in range(0, len(runs) - 3, 4):
                    if all(_octet(text[a:b]) for a, b in runs[k : k + 4]):
                        out.append(("ip", runs[k][0], runs[k + 3][1]))
            if last >= card_end:
                card_end = _spaced(text, last)
                digits = _only_digits(text[last:card_end]) if card_end - last >= 14 else ""
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", last, card_end))
        elif mark == "@":
            if own := _email(text, last, mail_end):
                mail_end = own[1]
                out.append(("email", *own))
        elif mark == "+":
            if last >= dial_end and (own := _phone(text, last)):
                dial_end = own[1]
                if 10 <= len(_only_digits(text[own[0] : own[1]])) <= 15:
                    out.append(("phone", *own))
        elif mark == "://":
            if own := _LOGIN.match(text, last + 1):
                out.append(("login", *own.span()))
        elif own := _account(text, last + 1):
            out.append(("account", *own))
    order = {kind: k for k, kind in enumerate(KINDS)}
    return sorted(set(out), key=lambda s: (s[1], order[s[0]], s[2]))


def _listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SCHEMA = pa.schema(
    [
        ("n_email", pa.int64()),
        ("n_ip", pa.int64()),
        ("n_card", pa.int64()),
        ("n_phone", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)


def find_personal_data(documents: DataFrame) -> DataFrame:
    """Per row of ``documents (doc_id, text)``: counts of the base kinds, their digest, all spans."""
    rows = documents.select("doc_id", "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _SCHEMA.names}
            for text in batch.column("text").to_pylist():
                spans = find_spans(text) if text else []
                base = [s for s in spans if s[0] in KINDS[:4]]
                for kind in KINDS[:4]:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest())
                out["spans"].append(_listed(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array(out[f.name], f.type) for f in _SCHEMA],
                names=["doc_id", *_SCHEMA.names],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan,
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long,"
        " base_sha256 string, spans string",
    )


def redact(text: str, by: str = "[{kind}]") -> str:
    """``text`` with every span replaced; of overlapping spans the earlier one counts."""
    out, end = [], 0
    for kind, start, stop in find_spans(text):
        if start >= end:
            out += [text[end:start], by.format(kind=kind)]
            end = stop
    return "".join([*out, text[end:]])
