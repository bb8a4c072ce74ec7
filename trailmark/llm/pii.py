"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, URL schemes, identifier cues, a plus before a digit, digits beside a dot, and
neighbouring digits.  A local parser then expands each anchor to the whole run of characters its kind can consist of,
and matches and validates inside that run.  Since no match reaches beyond its run, and runs are read from
their left end, this equals matching the whole text from left to right.

Base kinds: email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits).
The method adds: account (an identifier cue with its value), iban (checked modulo 97 after the cue), url_user (a user name in a URL).

Defined cases: a null text counts as empty; failing matches are dropped and not retried; repeated rows each get
the same spans; an empty table gives no rows.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from trailmark.llm.common import spans_text

# Kinds in their order, and the expressions of the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
METHOD_KINDS = ("account", "iban", "url_user")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ACCOUNT = re.compile(r"(?:account|acct|konto|cuenta|compte)(?: (?:no|number|nr))?[.:#]? ?([0-9][0-9 -]{6,28}[0-9])", re.IGNORECASE | re.ASCII)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?")
URL_USER = re.compile(r"://([A-Za-z0-9._-]+)@")

# Characters a match of the kind can hold; a run of them bounds the local parser.
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
RUN_OF = {
    "email": frozenset(LETTERS + DIGITS + "._%+-@"),
    "ip": frozenset(DIGITS + "."),
    "card": frozenset(DIGITS + " -"),
    "phone": frozenset(DIGITS + " ().+-"),
}
_LOWER = str.maketrans(LETTERS[26:], LETTERS[:26])  # anchors are found in any case, at the same offsets
CUES = ("account", "acct", "konto", "cuenta", "compte")


def anchors() -> dict[str, tuple[str, ...]]:
    """Anchor text to the kinds it may belong to."""
    found: dict[str, tuple[str, ...]] = {"@": ("email",), "://": ("url_user",)}
    for a in DIGITS:
        found["+" + a] = ("phone",)
        for b in DIGITS:
            found[a + "." + b] = ("ip",)
            for between in ("", " ", "-"):
                found[a + between + b] = ("card",)
    for cue in CUES:
        found[cue] = ("account",)
    found["iban"] = ("iban",)
    return found


def machine():
    import ahocorasick

    built = ahocorasick.Automaton()
    for text, kinds in anchors().items():
        built.add_word(text, (len(text), kinds))
    built.make_automaton()
    return built


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _iban_ok(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    digits = re.sub(r"[^0-9]", "", found)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


PARSER = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")


def _emails(text: str, begin: int, stop: int) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL inside a run: each at-sign has a name on its left and a domain on its right, or no match."""
    after, at = begin, text.find("@", begin, stop)
    while at >= 0:
        name = at - after - len(text[after:at].rstrip(LETTERS + DIGITS + "._%+-"))
        domain = DOMAIN.match(text, at + 1, stop) if name else None
        if domain:
            yield at - name, domain.end()
        after = domain.end() if domain else at + 1
        at = text.find("@", after, stop)


def _addresses(text: str, begin: int, stop: int) -> Iterator[tuple[int, int]]:
    """The matches of IP inside a run of digits and dots: four numbers in a row, then the next four."""
    numbers: list[int] = []
    at = begin
    for number in text[begin:stop].split("."):
        numbers = [*numbers, at] if number else []
        at += len(number) + 1
        if len(numbers) == 4:
            yield numbers[0], at - 1
            numbers = []


def _matches(kind: str, text: str, begin: int, stop: int) -> Iterator[tuple[int, int]]:
    """Matches of a base kind inside a run, in one reading."""
    if kind == "email":
        yield from _emails(text, begin, stop)
    elif kind == "ip":
        yield from _addresses(text, begin, stop)
    else:
        for m in PARSER[kind].finditer(text, begin, stop):
            yield m.start(), m.end()


def _run(text: str, kind: str, at: int, end: int, after: int) -> tuple[int, int]:
    """The run of the kind's characters around [at, end), not before ``after``."""
    allowed = RUN_OF[kind]
    while at > after and text[at - 1] in allowed:
        at -= 1
    n = len(text)
    while end < n and text[end] in allowed:
        end += 1
    return at, end


def find_spans(automaton, text: str) -> list[tuple[str, int, int]]:
    """All valid spans of all kinds, unordered."""
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(BASE_KINDS + METHOD_KINDS, 0)
    for last, (size, kinds) in automaton.iter(text.translate(_LOWER)):
        start, end = last + 1 - size, last + 1
        for kind in kinds:
            if start < done[kind]:
                continue
            if kind in PARSER:
                begin, stop = _run(text, kind, start, end, done[kind])
                done[kind] = stop
                out += [(kind, a, b) for a, b in _matches(kind, text, begin, stop) if _valid(kind, text[a:b])]
            elif kind == "account" and (m := ACCOUNT.match(text, start)):
                out.append((kind, m.start(1), m.end(1)))
                done[kind] = m.end()
            elif kind == "iban" and (m := IBAN.search(text, end, min(len(text), end + 48))) and _iban_ok(m.group()):
                out.append((kind, m.start(), m.end()))
                done[kind] = m.end()
            elif kind == "url_user" and (m := URL_USER.match(text, start)):
                out.append((kind, m.start(1), m.end(1)))
                done[kind] = m.end()
    return out


def _scan(batches: Iterator[pa.RecordBatch], id_name: str, text: str) -> Iterator[pa.RecordBatch]:
    automaton = machine()
    order = {kind: i for i, kind in enumerate(BASE_KINDS + METHOD_KINDS)}
    empty = hashlib.sha256(b"").hexdigest()
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            sha, spans = [], []
            for value in batch.column(text):
                found = find_spans(automaton, value.as_py() or "")
                for i, kind in enumerate(BASE_KINDS):
                    counts[i].append(sum(s[0] == kind for s in found))
                found.sort(key=lambda s: (order[s[0]], s[1]))
                base = spans_text([s for s in found if s[0] in BASE_KINDS])
                sha.append(hashlib.sha256(base.encode()).hexdigest() if base else empty)
                spans.append(spans_text(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_name), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                names=[id_name, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )


def scan_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans as text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return docs.select(doc_id, text).mapInArrow(lambda it: _scan(it, doc_id, text), schema)


def op5_query(docs: DataFrame) -> DataFrame:
    return scan_pii(docs)
