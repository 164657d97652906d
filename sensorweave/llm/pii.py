"""Personal data by anchor expansion.

One Aho-Corasick pass over a whole text finds anchors: at-signs, digits, plus
signs, schemes and identifier cues (``CUES``). At each anchor a small parser
expands the span to both sides and validates it. Spans of one kind don't
overlap and are taken from the left, so the parsers for e-mail, ip, card and
phone find what the patterns in ``BASE_KINDS`` find, and no more. The other
kinds are added by cue: ``account`` (an identifier after an account word;
IBANs and social security numbers must validate; after mere blanks or "is" only
long numbers count), ``contact`` (the address after a contact scheme),
``secret`` (a value assigned to a name with a credential word in it, what follows
``Bearer``, tokens of well-known form, and private key blocks) and ``url`` (only
where it carries credentials). A cue begins a word, follows ``_`` or ``-``
(``access_token``), or is a capitalised part of a name (``accessToken``); case
does not matter otherwise. Values run to their delimiter, however long
they are; what a parser has run over is not run over again, so the time stays in
proportion to the text. Positions count code points, ends
are exclusive.

Defined cases: null and empty texts have no spans (a null text stays null when
redacted); failing candidates are dropped without another try; overlapping spans
are redacted as one under the first one's kind; repeated rows and null ids are
handled row by row; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "contact", "secret", "url")
KINDS = BASE_KINDS + ADDED_KINDS

#: Words that announce an identifier, by the kind of what follows; compared without regard to case.
CUES = {
    "account": ("iban", "account", "acct", "ssn", "passport", "konto", "cuenta", "compte"),
    "contact": ("mailto:", "tel:", "sip:"),
    "secret": ("token", "secret", "password", "passwd", "passphrase", "pwd", "api_key", "apikey", "api-key", "access_key", "accesskey", "private_key", "privatekey"),
    "bearer": ("bearer",),
    "block": ("-----begin ",),
}

#: How well-known kinds of tokens begin, and what follows.
TOKENS = {
    "ghp_": r"[A-Za-z0-9]{30,}+", "gho_": r"[A-Za-z0-9]{30,}+", "ghu_": r"[A-Za-z0-9]{30,}+", "ghs_": r"[A-Za-z0-9]{30,}+", "ghr_": r"[A-Za-z0-9]{30,}+",
    "github_pat_": r"[A-Za-z0-9_]{30,}+", "glpat-": r"[A-Za-z0-9_-]{20,}+", "AKIA": r"[A-Z0-9]{16}(?![A-Za-z0-9])", "ASIA": r"[A-Z0-9]{16}(?![A-Za-z0-9])",
    "AIza": r"[A-Za-z0-9_-]{35}", "xoxb-": r"[A-Za-z0-9-]{20,}+", "xoxp-": r"[A-Za-z0-9-]{20,}+", "sk_live_": r"[A-Za-z0-9]{16,}+",
    "eyJ": r"[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{6,}+(?:\.[A-Za-z0-9_-]++)?",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = _LOCAL - frozenset("._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACCOUNT = re.compile(r"(?i:\x20{0,2}(?:number|no|nr|id)?\.?)\x20{0,2}[:=#]\x20{0,2}([A-Za-z0-9](?:[\x20-]?[A-Za-z0-9]){3,}+)")
#: After an account word, with nothing but blanks or "is": digits, or what may be an IBAN.
_STATED = re.compile(r"(?i:\x20{0,2}(number|no|nr|id)?\.?)\x20{1,2}(?:((?i:is))\x20{1,2})?([0-9](?:[\x20-]?[0-9])*+|[A-Za-z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]){11,64})")
#: The rest of a name after its cue (a part begins with a separator or, after a small letter, a capital), and the sign that assigns.
_TAIL = {True: re.compile(r"[0-9]*+(?:[_-][A-Za-z0-9]++|[A-Z][a-z0-9]*+)*+"), False: re.compile(r"[0-9]*+(?:[_-][A-Za-z0-9]++)*+")}
_ASSIGNED = re.compile(r"[\"'\]]{0,2}\x20{0,2}(?:=>|:=|[:=])\x20{0,2}")
_SECRET = re.compile(r"\"([^\"\s]{8,}+)\"|'([^'\s]{8,}+)'|([^\s\"']{8,}+)")
_BEARER = re.compile(r"\x20{1,2}([A-Za-z0-9._~+/=-]{16,}+)")
_KEY_BLOCK = re.compile(r"(?:[A-Z0-9]++\x20){0,4}?PRIVATE\x20KEY(?:\x20BLOCK)?-----")
_CONTACT = re.compile(r"[^\s<>\"'()\[\]{},;?]{3,}+")
_CREDENTIALS = re.compile(r"://[^\s/@:<>\"']++:[^\s/@<>\"']++@[A-Za-z0-9.-]++[^\s<>\"']*+")
#: Characters of the longest IBAN, with a separator after each.
_IBAN_SIZE = 68

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    """Whether letters and digits form an IBAN with right check digits."""
    v = value.replace(" ", "").replace("-", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", v):
        return False
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


@functools.lru_cache(maxsize=1)
def anchors():
    """The automaton; built once per worker."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for sign, kind in (("@", "email"), ("+", "phone"), ("://", "url"), *((d, "digit") for d in "0123456789")):
        machine.add_word(sign, (kind, len(sign)))
    for kind, words in CUES.items():
        for word in words:
            machine.add_word(word, (kind, len(word)))
    for prefix in TOKENS:
        machine.add_word(prefix.lower(), ("prefix", len(prefix)))
    machine.make_automaton()
    return machine


_PREFIXED = {prefix: re.compile(rest) for prefix, rest in TOKENS.items()}


def _lowered(text: str) -> str:
    """``text`` in lower case, at the same places."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c if len(low := c.lower()) != 1 else low for c in text)


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _account(text: str, cue: str, end: int) -> tuple[int, int] | None:
    found = _ACCOUNT.match(text, end)
    if not found:
        return _stated_account(text, cue, end)
    start, stop = found.span(1)
    value = found[1]
    if cue == "iban":
        for stop in range(min(stop, start + _IBAN_SIZE), start + 14, -1):  # the longest part that checks out
            if text[stop - 1].isalnum() and iban(text[start:stop]):
                return start, stop
        return None
    word = re.match(r"[A-Za-z0-9-]+(?:\x20[0-9]+)*", value)[0]  # words after the number don't belong to it
    good = _ssn(word) if cue == "ssn" else sum(c.isdigit() for c in word) >= 4
    return (start, start + len(word)) if good else None


def _ssn(value: str) -> bool:
    number = re.fullmatch(r"([0-9]{3})[\x20-]?([0-9]{2})[\x20-]?([0-9]{4})", value)
    return bool(number) and number[1] not in ("000", "666") and number[1] < "900" and number[2] != "00" and number[3] != "0000"


def _stated_account(text: str, cue: str, end: int) -> tuple[int, int] | None:
    """A number after blanks or "is": one that validates, or long enough."""
    found = _STATED.match(text, end)
    if not found:
        return None
    start, stop = found.span(3)
    if cue == "iban" or not found[3][0].isdigit():
        return next(((start, e) for e in range(stop, start + 14, -1) if text[e - 1].isalnum() and iban(text[start:e])), None)
    if cue == "ssn":
        return (start, stop) if _ssn(found[3]) else None
    digits = found[3].replace(" ", "").replace("-", "")
    named = found[1] or found[2]
    return (start, stop) if len(digits) >= 6 and named or len(digits) >= 8 and digits == found[3] else None


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed in ``KINDS``, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return []
    floor = dict.fromkeys((*KINDS, "block"), 0)  # where each kind's search has come to

    def take(kind: str, start: int, end: int) -> None:
        if start >= floor[kind]:
            found[kind].append((start, end))
            floor[kind] = end

    name = 0  # where the last name with a cue ends
    for last, (kind, length) in anchors().iter(_lowered(text)):
        at = last - length + 1
        if kind == "digit":
            if at >= floor["ip"]:
                if m := _IP.match(text, at):
                    floor["ip"] = m.end()
                    if all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in m.groups()):
                        found["ip"].append(m.span())
                else:
                    floor["ip"] = _DIGITS.match(text, at).end()
            if at >= floor["card"]:
                m = _CARD.match(text, at)
                floor["card"] = m.end() if m else at + 1
                if m and 16 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                    found["card"].append(m.span())
        elif kind == "email":
            if span := _email(text, at, floor["email"]):
                take("email", *span)
        elif kind == "phone":
            if at >= floor["phone"] and (m := _PHONE.match(text, at)):
                floor["phone"] = m.end()
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found["phone"].append(m.span())
        elif kind == "url":
            if at > floor["url"] and (m := _CREDENTIALS.match(text, at)):
                start = at
                while start > floor["url"] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    take("url", start, m.start() + len(m[0].rstrip(".,;:!?)")))
        elif kind == "block":
            if at >= floor["secret"] and at >= floor["block"] and (m := _KEY_BLOCK.match(text, last + 1)):
                stop = text.find("-----END ", m.end())
                floor["block"] = len(text) if stop < 0 else 0  # no later block has an end either
                line = text.find("-----", stop + 9) if stop >= 0 else -1
                if line >= 0:
                    take("secret", at, line + 5)
        elif at and text[at - 1] in _WORD and not (kind == "secret" and text[at].isupper() and text[at - 1].islower()):
            continue  # a cue begins a word or a part of a name
        elif kind == "prefix":
            rest = _PREFIXED.get(text[at : last + 1])
            if rest and at >= floor["secret"] and (m := rest.match(text, last + 1)):
                take("secret", at, m.end())
        elif kind == "bearer":
            if at >= floor["secret"] and (m := _BEARER.match(text, last + 1)):
                floor["secret"] = m.start(1)
                if any(c.isdigit() for c in m[1]):
                    take("secret", *m.span(1))
        elif kind == "account":
            if span := _account(text, text[at : last + 1].lower(), last + 1):
                take("account", *span)
        elif kind == "secret":
            # cues inside a name share its end, so that no name is walked twice
            name = name if last < name else _TAIL[text[last].islower()].match(text, last + 1).end()
            if (m := _ASSIGNED.match(text, name)) and m.end() >= floor["secret"] - 1 and (m := _SECRET.match(text, m.end())):
                start, stop = m.span(m.lastindex)
                if m.lastindex == 3:  # marks that close what the value stands in
                    stop = start + len(m[3].rstrip(".,;:!?)]}>"))
                if stop - start >= 8:
                    take("secret", start, stop)
        elif kind == "contact" and last + 1 >= floor["contact"] and (m := _CONTACT.match(text, last + 1)):
            value = m[0].rstrip(".:!")
            if "@" in value[1:-1] or sum(c.isdigit() for c in value) >= 7:
                take("contact", m.start(), m.start() + len(value))
            else:  # nor is a later part of it an address
                floor["contact"] = m.end()
    return [(kind, start, end) for kind in KINDS for start, end in found[kind]]


def redact_text(text: str | None, spans: list[Span]) -> str | None:
    """``text`` with every span replaced by its kind in brackets."""
    out, done = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e in spans):
        end = -end
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:] if spans else text


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def pii_spans(text: Column) -> Column:
    """Array of ``(kind, start, end)`` found in a text column."""

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t.as_py())] for t in texts], _SPANS)

    return spans(text)


def redacted(text: Column) -> Column:
    """A text column with its personal data replaced."""

    @F.arrow_udf("string")
    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([redact_text(s, find_spans(s)) for s in (t.as_py() for t in texts)], pa.string())

    return redact(text)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)`` for every row of ``docs``."""
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).select(id_col, pii_spans(F.col("text")).alias("spans"))


def digest(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the texts replaced; all rows stay."""
    return docs.select(*[(redacted(docs[c].cast("string")).alias(c) if c == text_col else docs[c]) for c in docs.columns])
