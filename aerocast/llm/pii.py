"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, digits, plus signs,
schemes and identifier cues); at each one a deterministic parser looks at
the characters around it, expands to the boundaries and validates.  Every
parser consumes what it has matched, so that spans of a kind never overlap
and the leftmost wins.

Base kinds: email, ip, card, phone.  Added kinds: url (a scheme with a
user and password before the host), iban (checked by its remainder), and
account (a cue such as "account number" or "SSN", then an identifier).
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from aerocast.llm import common as c

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account")
DIGITS = frozenset("0123456789")
_ALNUM = DIGITS | frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | {"-"}
_PHONE = DIGITS | frozenset(" ().-")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")
CUES = ("account number", "account no", "acct no", "iban", "ssn", "social security number", "passport no",
        "passport number", "customer id", "tax id", "kontonummer", "numéro de compte", "número de cuenta")
_IDENTIFIER = re.compile(r"[ \t]*(?:is\b|[:#.=])?[ \t]*([A-Z]{0,3}[0-9](?:[ -]?[0-9A-Z]){4,33})(?![0-9A-Za-z])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![0-9A-Za-z])")

_automata: list = []


def automaton():
    """Anchors → what to do there; built once per Python worker."""
    if not _automata:
        a = ahocorasick.Automaton()
        a.add_word("@", ("@", 1))
        a.add_word("+", ("+", 1))
        for d in "0123456789":
            a.add_word(d, ("digit", 1))
        for s in SCHEMES:
            a.add_word(s, ("scheme", len(s)))
        for w in CUES:
            for form in {w, w.upper(), w.title(), w.capitalize()}:
                a.add_word(form, ("cue", len(form)))
        a.make_automaton()
        _automata.append(a)
    return _automata[0]


def _run(text: str, i: int, chars: frozenset) -> int:
    n = len(text)
    while i < n and text[i] in chars:
        i += 1
    return i


def email_at(text: str, at: int, low: int) -> tuple[int, int] | None:
    """Address around the at-sign, its local part not before ``low``."""
    s = at
    while s > low and text[s - 1] in _LOCAL:
        s -= 1
    e = _run(text, at + 1, _LABEL)
    if s == at or e == at + 1:
        return None
    end = None
    while e < len(text) and text[e] == "." and (nxt := _run(text, e + 1, _LABEL)) > e + 1:
        e = end = nxt
    return None if end is None else (s, end)


def dotted(text: str, i: int) -> tuple[list[tuple[int, int]], int]:
    """Numbers of four parts in the chain of digits and dots that begins at
    i, and where the chain ends."""
    ends, e = [], _run(text, i, DIGITS)
    starts = [i]
    while True:
        ends.append(e)
        if e + 1 < len(text) and text[e] == "." and text[e + 1] in DIGITS:
            starts.append(e + 1)
            e = _run(text, e + 1, DIGITS)
        else:
            break
    return [(starts[k], ends[k + 3]) for k in range(0, len(starts) - 3, 4)], e


def octet(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def digit_run(text: str, i: int) -> int:
    """End of the digits from i on, single spaces and dashes between them."""
    e, n = i + 1, len(text)
    while e < n:
        if text[e] in DIGITS:
            e += 1
        elif text[e] in " -" and e + 1 < n and text[e + 1] in DIGITS:
            e += 2
        else:
            break
    return e


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        v = int(ch) << (k & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def phone_at(text: str, i: int) -> int | None:
    """End of the number that begins with the plus sign at i."""
    if i + 1 >= len(text) or text[i + 1] not in DIGITS:
        return None
    e = _run(text, i + 2, _PHONE)
    while e > i + 3 and text[e - 1] not in DIGITS:
        e -= 1
    return e if e > i + 3 else None


def run_end(text: str, at: int) -> int:
    """Where the run of URL characters around ``at`` ends."""
    e = at
    while e < len(text) and text[e] > " " and text[e] not in "\"<>'|":
        e += 1
    return e


def credentials(text: str, host: int, end: int) -> bool:
    """Whether the authority from ``host`` on, up to a slash, holds
    user:password@ and a server."""
    slash = text.find("/", host, end)
    user, at, server = text[host:end if slash < 0 else slash].rpartition("@")
    return bool(at and ":" in user and server)


def iban_ok(code: str) -> bool:
    code = code.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    return int("".join(str(int(ch, 36)) for ch in code[4:] + code[:4])) % 97 == 1


def spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind in code points, end exclusive, ordered by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)
    chain = number = url_end = 0
    for last, (what, size) in automaton().iter(text):
        i = last - size + 1
        if what == "digit":
            if i >= chain:
                ips, chain = dotted(text, i)
                found["ip"] += [(s, e) for s, e in ips if all(octet(x) for x in text[s:e].split("."))]
            if i >= number:
                number = digit_run(text, i)
                digits = text[i:number].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((i, number))
            if i >= 2 and i >= done["iban"] and "A" <= text[i - 1] <= "Z" and "A" <= text[i - 2] <= "Z":
                m = _IBAN.match(text, i - 2)
                if m and (i == 2 or text[i - 3] not in _ALNUM) and iban_ok(m.group()):
                    found["iban"].append(m.span())
                    done["iban"] = m.end()
        elif what == "@":
            got = email_at(text, i, done["email"])
            if got:
                found["email"].append(got)
                done["email"] = got[1]
        elif what == "+":
            end = phone_at(text, i) if i >= done["phone"] else None
            if end:
                done["phone"] = end
                if 8 <= sum(ch in DIGITS for ch in text[i:end]) <= 15:
                    found["phone"].append((i, end))
        elif what == "scheme":
            if last + 1 > url_end:                      # each run is followed once, however many schemes it holds
                url_end = run_end(text, last + 1)
            if i >= done["url"] and credentials(text, last + 1, url_end):
                found["url"].append((i, url_end))
                done["url"] = url_end
        elif i >= done["account"] and (i == 0 or text[i - 1] not in _ALNUM):
            m = _IDENTIFIER.match(text, last + 1)
            if m:
                found["account"].append(m.span(1))
                done["account"] = m.end(1)
    return found


def listed(found: dict, kinds) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in found[k])


def redact(text: str, found: dict) -> str:
    """The text with every span replaced by its kind in angle brackets; of
    overlapping spans the leftmost, then the longest, names the hole."""
    every = sorted(((s, -e, k) for k in KINDS for s, e in found[k]))
    out, at = [], 0
    for s, e, k in every:
        if -e <= at:
            continue
        if s >= at:
            out.append(text[at:s] + f"<{k}>")
        at = -e
    return "".join(out) + text[at:]



def find(docs: DataFrame, redacted: bool = False) -> DataFrame:
    """All columns of ``docs`` and: pii_email, pii_ip, pii_card, pii_phone
    (counts), pii_base_sha256, pii_spans; with ``redacted`` the text has its
    spans replaced by their kinds instead of these columns.

    A null text counts as empty (and stays null when redacted).  One pass
    over whole texts, no shuffle; repeated rows give repeated results; an
    empty table gives an empty result; columns of the added names are
    replaced.
    """
    c.prepare(docs.sparkSession)
    added = ["pii_email", "pii_ip", "pii_card", "pii_phone", "pii_base_sha256", "pii_spans"]
    src = docs if redacted else docs.drop(*added)

    @c.lean
    def run(batches):
        for b in c.slices(batches):
            texts = c.column(b, "text").to_pylist()
            got = [spans(x or "") for x in texts]
            if redacted:
                new = pa.array([x if x is None else redact(x, g) for x, g in zip(texts, got)], pa.string())
                yield b.set_column(b.schema.get_field_index("text"), "text", new)
                continue
            base = [listed(g, BASE) for g in got]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array([len(g[k]) for g in got], pa.int64()) for k in BASE],
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base]),
                 pa.array([listed(g, KINDS) for g in got])], [*b.schema.names, *added])
    fields = list(src.schema.fields)
    if not redacted:
        fields += [T.StructField(x, T.LongType() if x in added[:4] else T.StringType()) for x in added]
    return src.mapInArrow(run, T.StructType(fields))
