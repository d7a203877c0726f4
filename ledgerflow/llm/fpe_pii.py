"""Personal data replaced by format-preserving Feistel pseudonyms.

Validated numbers and dates (and addresses and keys made of letters and
digits) are permuted under a key within their own format: a card number that passes its
check stays one, a date stays a date, separators stay where they are. The same
value gives the same pseudonym in every document, and only the key undoes it.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from hashlib import blake2b
from math import isqrt, prod

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KEY = b"ledgerflow-example-key"  # callers give their own
KINDS = ("email", "key", "iban", "ssn", "date", "ip", "card", "phone")
_KIND = {k: re.compile(p, re.X) for k, p in {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "key": r"(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|sk-[0-9A-Za-z]{20,}|[0-9a-f]{16,64})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w/-]|\.\d)",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "card": r"(?<![\w+.-])\d(?:[ -]?\d){12,18}(?![\w]|-\d)",
    "phone": r"(?<![\w+.-])(?:\+?1[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w]|-\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\w)",
}.items()}
_PATTERN = re.compile("|".join(f"(?P<{k}>{p.pattern})" for k, p in _KIND.items()), re.X)
_GROUP = re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z]|[(+]")  # where a value may begin
_LONGEST = 64  # characters of a span that a check can refuse
_SHORTER = re.compile(r"[^0-9A-Za-z]+[0-9A-Za-z]*[^0-9A-Za-z]*\Z")
_RUN = re.compile(r"[0-9]+(?:[ -][0-9]+){0,18}")
_PRINTED = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
_ANY = re.compile(r"[0-9@]")
_DIGITS = "0123456789"
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _DIGITS)


class Feistel:
    """A keyed permutation of 0 .. size - 1 for any size.

    Halves are numbers below the root of the size; a result outside is permuted
    again until it is inside, which keeps it a permutation.
    """

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = key[:64], rounds

    def _round(self, kind: str, size: int, k: int, half: int) -> int:
        return int.from_bytes(blake2b(f"{kind}|{size}|{k}|{half}".encode(), key=self.key, digest_size=32).digest(), "big")

    def permute(self, value: int, size: int, kind: str = "") -> int:
        a = isqrt(size - 1) + 1 if size > 1 else 1
        while True:
            left, right = divmod(value, a)
            for k in range(self.rounds):
                left, right = right, (left + self._round(kind, size, k, right)) % a
            value = left * a + right
            if value < size:
                return value

    def restore(self, value: int, size: int, kind: str = "") -> int:
        a = isqrt(size - 1) + 1 if size > 1 else 1
        while True:
            left, right = divmod(value, a)
            for k in reversed(range(self.rounds)):
                left, right = (right - self._round(kind, size, k, left)) % a, left
            value = left * a + right
            if value < size:
                return value


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` plus it valid."""
    total = sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if k % 2 == 0 else int(c) for k, c in enumerate(reversed(digits)))
    return -total % 10


def _letters(text: str, alphabets: list[str], move, kind: str) -> str:
    """Permutes the characters of ``text``, the i-th within alphabets[i] (empty: it stays)."""
    places = [(k, a) for k, a in enumerate(alphabets) if a]
    if not places:
        return text
    value = 0
    for k, a in places:
        value = value * len(a) + a.index(text[k])
    shape = "".join(a[0] if a else "-" for a in alphabets)
    value = move(value, prod(len(a) for _, a in places), f"{kind}|{shape}")
    out = list(text)
    for k, a in reversed(places):
        value, at = divmod(value, len(a))
        out[k] = a[at]
    return "".join(out)


def _by_class(text: str) -> list[str]:
    return [next((a for a in _CLASSES if c in a), "") for c in text]


def _put_back(shape: str, chars: str) -> str:
    """The characters in the places of the letters and digits of ``shape``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _email(v: str, move) -> str:
    local, at, host = v.partition("@")
    new = _letters(local.lower(), _by_class(local.lower()), move, "email|" + host.lower())
    return "".join(n.upper() if c.isupper() else n for c, n in zip(local, new, strict=True)) + at + host


def _key(v: str, move) -> str | None:
    if v.startswith("AKIA"):
        return "AKIA" + _letters(v[4:], [_DIGITS + _CLASSES[1]] * (len(v) - 4), move, "key")
    for head in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-"):
        if v.startswith(head):
            return head + _letters(v[len(head):], [_DIGITS + _CLASSES[0] + _CLASSES[1]] * (len(v) - len(head)), move, "key")
    if v.isdigit():
        return _card(v, move) if len(v) <= 19 else None
    return _letters(v, [_DIGITS + "abcdef"] * len(v), move, "hex") if any(c.isdigit() for c in v) else None


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _iban(v: str, move) -> str | None:
    flat = v.replace(" ", "")
    country, check, rest = flat[:2], flat[2:4], flat[4:]
    if len(flat) > 34 or _iban_check(country, rest) != check:
        return None
    rest = _letters(rest, _by_class(rest), move, "iban|" + country)
    return _put_back(v, country + _iban_check(country, rest) + rest)


def _ssn(v: str, move) -> str | None:
    area, group, serial = map(int, v.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(move(value, 898 * 99 * 9999, "ssn"), 9999)
    area, group = divmod(value, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(v: str, move) -> str | None:
    """ISO, day.month.year and month/day/year; a date stays within 1900 to 2099, or in its own century.

    With a first number of 13 to 31, day/month/year: it stays a date that can be read in no other way."""
    sep = next(c for c in v if not c.isdigit())
    a, b, c = v.split(sep)
    late = sep == "/" and int(a) > 12
    y, m, d = (a, b, c) if sep == "-" else (c, b, a) if sep == "." or late else (c, a, b)
    try:
        at = datetime.date(int(y), int(m), int(d)).toordinal()
    except ValueError:
        return None
    year = int(y)
    lo, hi = (1900, 2100) if 1900 <= year < 2100 else (max(1, year // 100 * 100), year // 100 * 100 + 100)
    first = datetime.date(lo, 1, 1).toordinal()
    n = (datetime.date(hi, 1, 1).toordinal() if hi < 10000 else datetime.date.max.toordinal() + 1) - first
    wide = "02d" if a[0] == "0" or b[0] == "0" or len(a) == len(b) == 2 else "d"
    n_at = at - first
    while True:
        n_at = move(n_at, n, "date")
        new = datetime.date.fromordinal(first + n_at)
        if not late or new.day > 12 and (wide == "02d" or new.month < 10):
            break
    if sep == "-":
        return f"{new.year:04d}-{new.month:02d}-{new.day:02d}"
    x, z = (new.day, new.month) if sep == "." or late else (new.month, new.day)
    return f"{x:{wide}}{sep}{z:{wide}}{sep}{new.year:04d}"


def _ip(v: str, move) -> str | None:
    parts = [int(x) for x in v.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in v.split(".")):
        return None
    value = move(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _card(v: str, move) -> str | None:
    flat = re.sub(r"\D", "", v)
    if luhn(flat[:-1]) != int(flat[-1]) or len(set(flat)) == 1:
        return None
    new = _letters(flat[:-1], ["", *[_DIGITS] * (len(flat) - 2)], move, "card|" + flat[0])
    return _put_back(v, new + str(luhn(new)))


def _phone(v: str, move) -> str | None:
    flat = re.sub(r"\D", "", v)
    if not 8 <= len(flat) <= 15:
        return None
    if not v.startswith("+") or flat[0] == "1" and len(flat) == 11:  # North American: area and exchange keep their first digits' kind
        head = flat[:-10]
        rest = flat[-10:]
        kinds = [("23456789" if c > "1" else "01") if k in (0, 3) else _DIGITS for k, c in enumerate(rest)]
        return _put_back(v, head + _letters(rest, kinds, move, "phone|1"))
    head = re.match(r"\+(\d{1,3})", v)[1]
    head = head if len(head) < len(flat) - 5 and not v[1 + len(head):2 + len(head)].isdigit() else flat[:2]
    return _put_back(v, head + _letters(flat[len(head):], [_DIGITS] * (len(flat) - len(head)), move, "phone|" + head))


_REPLACE = {"email": _email, "key": _key, "iban": _iban, "ssn": _ssn, "date": _date, "ip": _ip, "card": _card, "phone": _phone}


def _valid(kind: str, value: str) -> bool:
    return _REPLACE[kind](value, lambda v, size, kind="": v) is not None


def _cards(text: str, at: int) -> list[int]:
    """Ends of what may be a card from the start of a digit group: groups of four digits or more, only the last
    may be shorter. One group and the usual printed groups come first, then the longest."""
    run, sizes, ends = _RUN.match(text, at), [], []
    for g in re.finditer("[0-9]+", run[0]) if run else ():
        sizes.append(len(g[0]))
        end = at + g.end()
        if 13 <= sum(sizes) <= 19 and not re.match(r"\w", text[end:end + 1]):
            ends.append((len(sizes) > 1 and tuple(sizes) not in _PRINTED, -sum(sizes), end))
        if sizes[-1] < 4 or sum(sizes) > 19:
            break
    return [e for _, _, e in sorted(ends)]


def _value(text: str, at: int, m: re.Match | None, fresh: bool) -> tuple[int, str, bool] | None:
    """(end, kind, whether nothing was refused before it) of a valid value that begins at a place.

    ``m``: what the patterns find there; ``fresh``: the place is in no span that was refused."""
    sure = fresh
    if fresh or text[at - 1] in " -":
        for end in _cards(text, at):
            if _valid("card", text[at:end]):
                return end, "card", sure
            sure = False
    if m is None:
        return None
    fine = _valid(m.lastgroup, m[0])
    if m.lastgroup == "card":  # digits in groups unlike a card's: only if no other value begins in them
        sure = False
        inside = [at, *(g.start() for g in _GROUP.finditer(text, at + 1, m.end()))]
        fine = fine and fresh and not any(_valid("card", text[k:e]) for k in inside[1:] for e in _cards(text, k))
        fine = fine and not any((x := _KIND[kind].match(text, k)) and _valid(kind, x[0]) for k in inside for kind in ("ssn", "date", "phone"))
    if fine:
        return m.end(), m.lastgroup, sure
    for kind, pattern in _KIND.items():
        found = pattern.match(text, at) if kind != "card" else None
        while found:
            if _valid(kind, found[0]):
                return found.end(), kind, False
            less = _SHORTER.search(found[0])
            found = pattern.match(text, at, at + less.start()) if less else None
    return None


def _cluster(text: str, lo: int, fresh: bool = True, tried: int = 0, until: int | None = None) -> tuple[list[tuple[int, int, str]], list[int], bool, int]:
    """The valid values from a place on to the end of all spans refused there, the places looked at, whether
    nothing was refused, and the end.

    Where a span is no valid value, its shorter parts are tried, then the search goes on one group further."""
    hits, seen, sure, pos = [], [], True, lo
    while until is None or pos <= until:
        here = _PATTERN.match(text, pos)
        hit = _value(text, pos, here, fresh)
        seen.append(pos)
        if not (hit and hit[2]):
            end = here.end() if here else pos
            tried = max([tried, end, *(e for k in (pos, *(g.start() for g in _GROUP.finditer(text, pos + 1, end))) for e in _cards(text, k))])
            sure = False
        fresh = False
        if hit:
            hits.append((pos, *hit[:2]))
        pos = hit[0] if hit else pos + 1
        group = _GROUP.search(text, pos, tried) if pos < tried else None
        if not group:
            return hits, seen, sure, max(tried, pos)
        pos = group.start()
    return hits, seen, sure, tried


def _in_turn(text: str, lo: int, hits: list[tuple[int, int, str]], seen: list[int], hi: int, move) -> str:
    """``text`` with the values of a cluster replaced one after another (undone backwards), each moved on until
    the text around it is read as before: else a refused span could become valid and hide it from undoing."""
    order = range(len(hits))
    for i in reversed(order) if getattr(move, "__func__", None) is Feistel.restore else order:
        a, z, kind = hits[i]
        near = max((k for k in seen if k <= a - _LONGEST), default=lo)
        while (new := _REPLACE[kind](text[a:z], move)) is not None:
            by = len(new) - (z - a)
            text, z = text[:a] + new + text[z:], a + len(new)
            hits = [*hits[:i], (a, z, kind), *((x + by, y + by, k) for x, y, k in hits[i + 1:])]
            seen, hi = [k + by if k > a else k for k in seen], hi + by
            if _cluster(text, near, near == lo, 0 if near == lo else hi, a)[0] == [h for h in hits[:i + 1] if h[0] >= near]:
                break
    return text


def pseudonymise(text: str, move, found: dict[str, int] | None = None) -> str:
    """``text`` with all that is recognised and valid replaced; ``move``: permute or restore of a Feistel.

    A value found only after a longer or earlier span was refused may be moved on (see _in_turn), its
    pseudonym then differs from that of the same value elsewhere."""
    if not _ANY.search(text):
        return text
    out, last = [], 0
    while m := _PATTERN.search(text, last):
        hits, seen, sure, hi = _cluster(text, m.start())
        out.append(text[last:m.start()])
        if sure:
            (a, z, kind), = hits
            out.append(_REPLACE[kind](text[a:z], move) or text[a:z])
        else:
            lo = max(m.start() - 1, 0)
            part, after = text[lo:hi], text[hi:hi + _LONGEST]
            part = _in_turn(part + after, m.start() - lo, [(a - lo, z - lo, kind) for a, z, kind in hits], [k - lo for k in seen], hi - lo, move)
            out.append(part[m.start() - lo:len(part) - len(after)])
        last = hi
        if found is not None:
            for _, _, kind in hits:
                found[kind] = found.get(kind, 0) + 1
    return "".join([*out, text[last:]])


def pii_pseudonyms(docs: DataFrame, key: bytes = KEY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_values, kinds, text``: the number of values replaced, their kinds, and the new text.

    A null text stays null with no values; an empty or clean one is unchanged.
    A number that fails its check is no such value and stays, but the values within it or overlapping it are
    found. Repeated rows
    and a null id are treated like any other. Other columns are not read; an empty table gives an empty
    result.
    """
    move = Feistel(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, kinds, out = [], [], []
            for t in b.column(1).to_pylist():
                found: dict[str, int] = {}
                out.append(None if t is None else pseudonymise(t, move.permute, found))
                n.append(sum(found.values()))
                kinds.append(",".join(k for k in KINDS if k in found))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(kinds, pa.string()), pa.array(out, pa.string())], names=["id", "n_values", "kinds", "text"])

    out = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, n_values long, kinds string, text string")
    return out.withColumnRenamed("id", id)


def pseudonym_column(key: bytes = KEY):
    """A function of a text column to its pseudonymised text."""
    move = Feistel(key)

    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: pseudonymise(t, move.permute), na_action="ignore")

    return run
