"""Personal data: an Aho-Corasick automaton finds anchors, local parsers expand and validate them.

Anchors are at-signs, ``://``, plus signs, digits and the cue words of secrets and accounts. Each
parser reads only around its anchor, to the left and right as far as its characters go, never
before the end of its kind's last match. Offsets count code points, ends are excluded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The kinds in the order of the result; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "secret")
BASE = KINDS[:4]
# The characters of the base patterns.
DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
LABEL = LETTERS | DIGITS | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
SCHEME = LETTERS | DIGITS | frozenset("+.-")
VALUE = LETTERS | DIGITS | frozenset("_-./+=~")
URL_END = frozenset(" \t\n\r\x0b\x0c<>\"'`{}|\\^")
CUES = ("token", "api_key", "apikey", "api-key", "secret", "password", "passwd", "access_key", "auth_key", "private_key")
#: Least characters of a secret's value.
SECRET_LENGTH = 8


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """Check digits of an international account number, without spaces."""
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for text, kind in [("@", "@"), ("://", ":"), ("+", "+"), *((d, "d") for d in "0123456789")]:
        machine.add_word(text, (kind, len(text)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            machine.add_word(form, ("cue", len(form)))
    machine.make_automaton()
    return machine


def run_right(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def run_left(text: str, at: int, allowed: frozenset, least: int) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def email_around(text: str, at: int, least: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``: local part and at least two labels."""
    begin = run_left(text, at, LOCAL, least)
    if begin == at:
        return None
    end = run_right(text, at + 1, LABEL)
    if end == at + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == ".":
        after = run_right(text, end + 1, LABEL)
        if after == end + 1:
            break
        end, dots = after, dots + 1
    return (begin, end) if dots else None


def ip_from(text: str, at: int) -> tuple[int, int | None]:
    """Where the search goes on after the digits at ``at``, and the end of four dotted numbers there."""
    first = end = run_right(text, at, DIGITS)
    for _ in range(3):
        if end >= len(text) or text[end] != ".":
            return first, None
        after = run_right(text, end + 1, DIGITS)
        if after == end + 1:
            return first, None
        end = after
    return end, end


def card_from(text: str, at: int) -> int:
    """End of the digits from ``at`` with single spaces or hyphens between."""
    n, at = len(text), run_right(text, at, DIGITS)
    while at + 1 < n and text[at] in " -" and text[at + 1] in DIGITS:
        at = run_right(text, at + 1, DIGITS)
    return at


def phone_from(text: str, at: int) -> int | None:
    """End of the number whose plus sign is at ``at``: a digit, at least one more character, a last digit."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = run_right(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end > at + 3 and text[end - 1] in DIGITS else None


def url_around(text: str, at: int, least: int) -> tuple[int, int] | None:
    """The address around ``://`` at ``at``: a scheme that begins with a letter, a host, the rest without closing punctuation."""
    begin = run_left(text, at, SCHEME, least)
    while begin < at and text[begin] not in LETTERS:
        begin += 1
    if begin == at or at + 3 >= len(text) or not (text[at + 3] in LABEL or text[at + 3] == "["):
        return None
    end = at + 3
    while end < len(text) and text[end] not in URL_END:
        end += 1
    while end > at + 3 and text[end - 1] in ".,;:!?)]*":
        end -= 1
    return (begin, end) if end > at + 3 else None


def iban_around(text: str, at: int, least: int) -> tuple[int, int] | None:
    """The account number whose two check digits begin at ``at``, in one piece or in groups of four."""
    if at - 2 < least or not ("A" <= text[at - 2] <= "Z" and "A" <= text[at - 1] <= "Z") or text[at + 1 : at + 2] not in DIGITS or at + 1 >= len(text):
        return None
    if at - 3 >= 0 and (text[at - 3] in LETTERS or text[at - 3] in DIGITS):
        return None
    plain, end, best = text[at - 2 : at + 2], at + 2, None
    while len(plain) <= 34:
        if end < len(text) and (text[end] in DIGITS or "A" <= text[end] <= "Z"):
            plain, end = plain + text[end], end + 1
            continue
        if iban_valid(plain):
            best = end
        if len(plain) % 4 == 0 and end + 1 < len(text) and text[end] == " " and (text[end + 1] in DIGITS or "A" <= text[end + 1] <= "Z"):
            end += 1
            continue
        break
    return (at - 2, best) if best else None


def secret_after(text: str, at: int, least: int) -> tuple[int, int, bool] | None:
    """Begin and end of the value that follows a cue word which ends at ``at``, and whether it is a secret.

    ``=`` or ``:``, then the value, quoted or bare. None where no value begins from ``least`` on.
    """
    n = len(text)
    if at < n and text[at] in "\"'":
        at += 1
    at = run_right(text, at, frozenset(" \t"))
    if at >= n or text[at] not in "=:":
        return None
    at = run_right(text, at + 1, frozenset(" \t"))
    if at < n and text[at] in "\"'":
        at += 1
    if at < least:
        return None
    end = run_right(text, at, VALUE)
    while end > at and text[end - 1] == ".":
        end -= 1
    return at, end, end - at >= SECRET_LENGTH and any(c in DIGITS for c in text[at:end])


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a whole text as ``kind, start, end``, by start and then by kind."""
    found: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)

    def put(kind: str, begin: int, end: int) -> None:
        found.append((begin, KINDS.index(kind), end))
        done[kind] = end

    digits_seen = 0
    for last, (anchor, length) in anchors().iter(text):
        at = last - length + 1
        if anchor == "d":
            if at >= digits_seen:  # the first of a run of digits, for what begins with digits
                digits_seen = run_right(text, at, DIGITS)
                if (match := iban_around(text, at, done["iban"])) is not None:
                    put("iban", *match)
            if at >= done["ip"]:
                after, end = ip_from(text, at)
                if end is not None and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[at:end].split(".")):
                    put("ip", at, end)
                done["ip"] = after
            if at >= done["card"]:
                end = card_from(text, at)
                digits = [c for c in text[at:end] if c in DIGITS]
                if 12 <= len(digits) <= 19 and luhn("".join(digits)):
                    put("card", at, end)
                done["card"] = end
        elif anchor == "@":
            if at >= done["email"] and (match := email_around(text, at, done["email"])) is not None:
                put("email", *match)
        elif anchor == "+":
            if at >= done["phone"] and (end := phone_from(text, at)) is not None:
                if 9 <= sum(c in DIGITS for c in text[at:end]) <= 15:
                    put("phone", at, end)
                done["phone"] = end
        elif anchor == ":":
            if at >= done["url"] and (match := url_around(text, at, done["url"])) is not None:
                put("url", *match)
        elif (match := secret_after(text, last + 1, done["secret"])) is not None:
            # What ends a value that is none also ends the shorter ones inside it.
            begin, done["secret"], secret = match
            if secret:
                put("secret", begin, done["secret"])
    return [(KINDS[kind], begin, end) for begin, kind, end in sorted(found)]


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in found)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        counts = {kind: [] for kind in BASE}
        shas, alls = [], []
        for value in batch.column(1):
            found = spans(value.as_py() or "")
            base = [f for f in found if f[0] in BASE]
            for kind in BASE:
                counts[kind].append(sum(f[0] == kind for f in base))
            shas.append(hashlib.sha256(joined(base).encode()).hexdigest() if base else empty)
            alls.append(joined(found))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(shas, pa.string()), pa.array(alls, pa.string())],
            ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
        )


def pii_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for each row of ``docs``.

    Null and empty texts have no spans. Ids may be null or repeated; rows are kept as they are.
    Spans of different kinds may overlap. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_digests, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def found_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, kind, start, end`` of every span, one row each."""
    part = F.split(F.explode(F.split("spans", ",")), ":")
    rows = pii_digests(docs).filter("spans != ''").select("doc_id", part.alias("p"))
    return rows.select("doc_id", F.col("p")[0].alias("kind"), F.col("p")[1].cast("long").alias("start"), F.col("p")[2].cast("long").alias("end"))


def mask(text: str) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named by the first."""
    out, at, until = [], 0, -1
    for kind, begin, end in spans(text):
        if begin < until:
            until = max(until, end)
            at = until
            continue
        out += [text[at:begin], f"[{kind.upper()}]"]
        at = until = end
    return "".join(out) + text[at:]


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked and ``n_chars`` made to fit, if there is one; null texts stay null."""
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if v is None else mask(v) for v in batch.column(where).to_pylist()]
            columns = [pa.array(texts, batch.schema.field(i).type) if i == where else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*docs.columns)
