"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, digits, plus signs and
identifier cues; a local parser at each anchor expands and validates the span around it."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import text_slices, worker_state

#: Kinds in the order of their listing: those of the base first.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "address")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: After a cue for an account: an optional sign, then the number; an IBAN stands without a cue too.
ACCOUNT = re.compile(r"[\x20]?(?:no\.?|number|nr\.?|#)?[\x20]?[:=#]?[\x20]?([0-9](?:[\x20-]?[0-9]){5,17})(?![0-9A-Za-z])", re.I)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: After a scheme: the address of a person, as in ``mailto:`` without a full domain or ``user:key@host``.
SIP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]*[A-Za-z0-9]")
LOGIN = re.compile(r"[A-Za-z0-9._~%+-]+:[^\s@/:]+@[A-Za-z0-9.-]*[A-Za-z0-9]")

ACCOUNT_CUES = ("account", "acct", "kontonummer", "cuenta", "compte")
SCHEMES = {"sip:": SIP, "sips:": SIP, "xmpp:": SIP, "mailto:": SIP, "://": LOGIN}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def iban(text: str) -> bool:
    code = text.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    anchors = {"@": "at", "+": "plus"} | {str(d): "digit" for d in range(10)}
    anchors |= {cue: "account" for cue in ACCOUNT_CUES} | {cue.capitalize(): "account" for cue in ACCOUNT_CUES}
    anchors |= {cue.upper(): "account" for cue in ACCOUNT_CUES} | {scheme: "scheme" for scheme in SCHEMES}
    for word, kind in anchors.items():
        found.add_word(word, (kind, word))
    found.make_automaton()
    return found


def spans(text: str, anchors=None) -> list[tuple[str, int, int]]:
    """Kind, start and end (exclusive, in code points), by kind as in ``KINDS`` and then by start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    email_end = quad_next = card_next = phone_next = account_next = 0
    for last, (kind, word) in (anchors or automaton()).iter(text):
        if kind == "digit":
            if last >= quad_next:
                # A run of digits that begins no quad begins none further on either.
                match = QUAD.match(text, last)
                quad_next = match.end() if match else DIGITS.match(text, last).end()
                if match and all(int(x[-4:]) <= 255 and (len(x) < 4 or not x[:-3].strip("0")) for x in match[0].split(".")):
                    found["ip"].append(match.span())
            if last >= card_next:
                match = CARD.match(text, last)
                card_next = match.end() if match else last + 1
                if match:
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(match.span())
            begin = last - 2
            if begin >= account_next and text[begin:last].isupper() and (begin == 0 or not text[begin - 1].isalnum()):
                match = IBAN.match(text, begin)
                if match and iban(match[0]):
                    found["account"].append(match.span())
                    account_next = match.end()
        elif kind == "at":
            start = last
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            match = DOMAIN.match(text, last + 1) if start < last else None
            if match:
                found["email"].append((start, match.end()))
                email_end = match.end()
        elif kind == "plus":
            match = PHONE.match(text, last) if last >= phone_next else None
            if match:
                phone_next = match.end()
                if 8 <= sum(c.isdigit() for c in match[0]) <= 15:
                    found["phone"].append(match.span())
        elif kind == "account":
            first = last - len(word) + 1
            if first and text[first - 1].isalnum():
                continue
            match = ACCOUNT.match(text, last + 1)
            if match and match.start(1) >= account_next:
                found["account"].append(match.span(1))
                account_next = match.end(1)
        else:
            match = SCHEMES[word].match(text, last + 1)
            if match and not (found["address"] and found["address"][-1][1] > match.start()):
                found["address"].append(match.span())
    taken = {span for kind in BASE for span in found[kind]}
    return [(kind, *span) for kind in KINDS for span in found[kind] if kind in BASE or span not in taken]


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string,"
    " found array<struct<kind: string, start: int, end: int>>"
)


def personal_data(documents: DataFrame, text: str = "text") -> DataFrame:
    """``SCHEMA`` for every row: counts and digest of the base kinds, and all spans with those the cues
    add. Every whole text is read once. A null text is an empty one; rows of one ``doc_id`` are each
    returned. Digits count as spelt: a quad's parts are at most 255 whatever zeros stand before."""

    def find(batches):
        state = worker_state("personal data")
        anchors = state["anchors"] if "anchors" in state else state.setdefault("anchors", automaton())
        for part in text_slices(batches):
            rows = []
            for doc_id, value in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                found = spans(value, anchors) if value else []
                base = [x for x in found if x[0] in BASE]
                counts = [sum(x[0] == kind for x in base) for kind in BASE]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((doc_id, *counts, digest, listed(found), [dict(zip(("kind", "start", "end"), x)) for x in found]))
            longs, places = pa.int64(), [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
            types = [longs] * 5 + [pa.string(), pa.string(), pa.list_(pa.struct(places))]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", *(f"n_{kind}" for kind in BASE), "base_sha256", "spans", "found"]
            )

    return documents.select("doc_id", F.col(text).alias("text")).mapInArrow(find, SCHEMA)
