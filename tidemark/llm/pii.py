"""Format-preserving Feistel pseudonyms for personal data.

Validated values (calendar dates, card numbers with a right check digit, IBANs, dotted quads, social
security and phone numbers), e-mail addresses and secrets (keys, passwords, long hexadecimal tokens) are
found in the text and replaced by a keyed permutation of the values of the same format.  A value is written
as digits in mixed radices (a decimal digit, a letter of the same case, a day number, an octet of the same
length, ...), split in two halves, and mixed by a Feistel network whose round function is keyed BLAKE2;
values outside the format's valid set are walked past (cycle walking), and check digits are recomputed.
So a pseudonym is valid, has the length of its original, equal values get equal pseudonyms in
every document, and the key's holder can invert them (``reveal``).

Everything happens inside a row.

Defined cases: null texts stay null and empty texts empty, with no spans; what doesn't validate is left alone
(a 16-digit number with a wrong check digit, 30 February, an octet over 255); equal texts get
equal results and every row stays; input columns named like an output column are replaced, others are
passed through; texts of any length are searched whole.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, quoted, read_table, slices, without

ROUNDS = 10
SLICE_CHARS = 1 << 21
#: For the registered query and the pipeline; a deployment passes its own.
DEMO_KEY = b"demonstration key, not a secret"

_DAY0 = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _DAY0


def _product(radices: list[int]) -> int:
    out = 1
    for r in radices:
        out *= r
    return out


def feistel(digits: list[int], radices: list[int], key: bytes, tweak: str, inverse: bool = False) -> list[int]:
    """Permute the mixed-radix number ``digits`` among all numbers of these radices."""
    if len(digits) == 1:  # one digit: split its value instead
        return [_walk_single(digits[0], radices[0], key, tweak, inverse)]
    half = (len(digits) + 1) // 2
    sizes = (_product(radices[:half]), _product(radices[half:]))
    parts = [0, 0]
    for i, (d, r) in enumerate(zip(digits, radices, strict=True)):
        side = int(i >= half)
        parts[side] = parts[side] * r + d
    for step in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        side = step & 1
        shift = _round(parts[1 - side], sizes, step, key, tweak)
        parts[side] = (parts[side] + (-shift if inverse else shift)) % sizes[side]
    out = []
    for side, own in ((1, radices[half:]), (0, radices[:half])):
        value = parts[side]
        for r in reversed(own):
            out.append(value % r)
            value //= r
    return out[::-1]


def _round(value: int, sizes: tuple[int, int], step: int, key: bytes, tweak: str) -> int:
    size = (max(sizes).bit_length() + 7) // 8 + 8
    message = f"{tweak}|{sizes[0]}|{sizes[1]}|{step}|{value}".encode()
    out, block = b"", 0
    while len(out) < size:
        out += blake2b(message + block.to_bytes(4, "big"), key=key[:64]).digest()
        block += 1
    return int.from_bytes(out[:size], "big")


def _walk_single(value: int, radix: int, key: bytes, tweak: str, inverse: bool) -> int:
    """Permute 0..radix-1 through a square that holds it, walking back in."""
    side = 1
    while side * side < radix:
        side += 1
    if side == 1:
        return value
    while True:
        a, b = feistel([value // side, value % side], [side, side], key, tweak, inverse)
        value = a * side + b
        if value < radix:
            return value


def _classes(text: str, hexa: bool = False) -> tuple[list[int], list[int], list[int]]:
    """(places, digits, radices) of the characters that a format lets vary."""
    places, digits, radices = [], [], []
    for i, c in enumerate(text):
        o = ord(c)
        if hexa and c in "0123456789abcdef":
            d, r = int(c, 16), 16
        elif hexa and c in "0123456789ABCDEF":
            d, r = int(c, 16), 16
        elif 48 <= o < 58:
            d, r = o - 48, 10
        elif 97 <= o < 123:
            d, r = o - 97, 26
        elif 65 <= o < 91:
            d, r = o - 65, 26
        else:
            continue
        places.append(i)
        digits.append(d)
        radices.append(r)
    return places, digits, radices


def _write(text: str, places: list[int], digits: list[int], hexa: bool = False) -> str:
    out = list(text)
    upper = hexa and any(c in "ABCDEF" for c in text)
    for p, d in zip(places, digits, strict=True):
        c = text[p]
        if hexa:
            out[p] = "0123456789ABCDEF"[d] if upper else "0123456789abcdef"[d]
        elif c.isdigit():
            out[p] = chr(48 + d)
        else:
            out[p] = chr((97 if c.islower() else 65) + d)
    return "".join(out)


def permute_text(text: str, key: bytes, tweak: str, inverse: bool = False, hexa: bool = False, valid: Callable[[str], bool] | None = None) -> str:
    """Permute the digits and letters of a text, each within its class, to a text that ``valid`` accepts."""
    places, digits, radices = _classes(text, hexa)
    if not places:
        return text
    while True:
        digits = feistel(digits, radices, key, tweak, inverse)
        made = _write(text, places, digits, hexa)
        if valid is None or valid(made):
            return made


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def luhn_ok(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def iban_rest(iban: str) -> int:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def _card(m: str, key: bytes, inverse: bool) -> str | None:
    digits = re.sub(r"\D", "", m)
    if not 13 <= len(digits) <= 19 or not luhn_ok(digits):
        return None
    payload = permute_text(digits[:-1], key, "card", inverse)
    new = iter(payload + luhn_digit(payload))
    return "".join(next(new) if c.isdigit() else c for c in m)


def _iban(m: str, key: bytes, inverse: bool) -> str | None:
    if iban_rest(m) != 1:
        return None
    body = permute_text(m[4:], key, "iban" + m[:2], inverse)
    return m[:2] + f"{98 - iban_rest(m[:2] + '00' + body):02d}" + body


def _ssn_ok(m: str) -> bool:
    area, group, serial = m.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def _ssn(m: str, key: bytes, inverse: bool) -> str | None:
    return permute_text(m, key, "ssn", inverse, valid=_ssn_ok) if _ssn_ok(m) else None


def _quad(m: str, key: bytes, inverse: bool) -> str | None:
    low = {1: 0, 2: 10, 3: 100}
    size = {1: 10, 2: 90, 3: 156}
    octets = m.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    digits = feistel([int(o) - low[len(o)] for o in octets], [size[len(o)] for o in octets], key, "quad", inverse)
    return ".".join(str(d + low[len(o)]) for d, o in zip(digits, octets, strict=True))


def _phone(m: str, key: bytes, inverse: bool) -> str | None:
    digits = re.sub(r"\D", "", m)
    if not 7 <= len(digits) <= 15:
        return None
    head = re.match(r"\+\d{1,3}(?=[\s.(-])", m)
    at = head.end() if head else 0
    return m[:at] + permute_text(m[at:], key, "phone", inverse)


def _date(order: str):
    def run(m: str, key: bytes, inverse: bool) -> str | None:
        sep = next(c for c in m if not c.isdigit())
        values = dict(zip(order, map(int, m.split(sep)), strict=True))
        try:
            day = datetime.date(values["y"], values["m"], values["d"]).toordinal() - _DAY0
        except ValueError:
            return None
        if not 0 <= day < _DAYS:
            return None
        new = datetime.date.fromordinal(_DAY0 + feistel([day], [_DAYS], key, "date", inverse)[0])
        return sep.join(f"{ {'y': new.year, 'm': new.month, 'd': new.day}[c]:0{4 if c == 'y' else 2}d}" for c in order)

    return run


def _slashed(m: str, key: bytes, inverse: bool) -> str | None:
    """Day first where that is a date, else month first; days and months that could be either keep their order."""
    a, b = int(m[:2]), int(m[3:5])
    order = "mdy" if b > 12 >= a else "dmy"
    # the new date must be read in the same order
    made = m
    while True:
        made = _date(order)(made, key, inverse)
        if made is None:
            return None
        if ("mdy" if int(made[3:5]) > 12 >= int(made[:2]) else "dmy") == order:
            return made


def _email(m: str, key: bytes, inverse: bool) -> str | None:
    at = m.rindex(".")
    return permute_text(m[:at], key, "email", inverse) + m[at:]


def _after(prefix: str):
    cut = re.compile(prefix)

    def run(m: str, key: bytes, inverse: bool) -> str | None:
        at = cut.match(m).end()
        return m[:at] + permute_text(m[at:], key, "secret", inverse)

    return run


def _hexa(m: str, key: bytes, inverse: bool) -> str | None:
    if m.isdigit() or not re.search(r"\d", m) or (re.search("[a-f]", m) and re.search("[A-F]", m)):
        return None

    def valid(x: str) -> bool:
        return bool(re.search("[a-fA-F]", x)) and bool(re.search(r"\d", x))

    return permute_text(m, key, "hex", inverse, hexa=True, valid=valid)


#: (kind, pattern, permutation); earlier kinds win where two start at one place.
KINDS: list[tuple[str, str, Callable[[str, bytes, bool], str | None]]] = [
    ("email", r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    ("secret", r"(?i:(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api_?key)[ \t]?[=:][ \t]?['\"]?(?-i:[A-Za-z0-9]{6,}))", _after(r"(?i)\w+[ \t]?[=:][ \t]?['\"]?")),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", _after(r"AKIA|ASIA")),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", _iban),
    ("hex", r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])", _hexa),
    ("ip", r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)", _quad),
    ("date", r"(?<![\w./-])\d{4}-\d{2}-\d{2}(?![\w-]|/\d)", _date("ymd")),
    ("date", r"(?<![\w./-])\d{4}/\d{2}/\d{2}(?![\w/-])", _date("ymd")),
    ("date", r"(?<![\w./-])\d{2}/\d{2}/\d{4}(?![\w/-])", _slashed),
    ("date", r"(?<![\w./-])\d{2}\.\d{2}\.\d{4}(?![\w-]|\.\d)", _date("dmy")),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|-\d)", _card),
    ("phone", r"(?<![\w.+])\+\d{1,3} \(\d{3}\) \d{3}-\d{4}(?![\w-])", _phone),
    ("phone", r"(?<![\w.+])\+\d{1,3}[\s.-]?(?:\(\d{1,4}\)[\s.-]?)?\d{2,4}(?:[\s.-]?\d{2,4}){1,4}(?![\w])", _phone),
    ("phone", r"(?<![\w.+])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?![\w])", _phone),
    ("phone", r"(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])", _phone),
]
_FIND = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p, _) in enumerate(KINDS)))
_MAYBE = re.compile(r"[0-9@]|(?i:passw|pwd|secret|token|api_?key)[^\n]{0,3}[=:]")


def rewrite(text: str, key: bytes, inverse: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """(text with pseudonyms, spans as (kind, start, end)); pseudonyms have the length of their originals."""
    if not _MAYBE.search(text):
        return text, []
    out, spans, at, start = [], [], 0, 0
    while m := _FIND.search(text, start):
        i, first = int(m.lastgroup[1:]), m.start()
        kind, _, permute = KINDS[i]
        new = permute(m.group(), key, inverse)
        if new is None:
            # not valid as this kind: another kind may match here
            new, m, kind = _others(text, m, i, key, inverse)
            if new is None:
                start = first + 1
                continue
        out += [text[at : m.start()], new]
        spans.append((kind, m.start(), m.end()))
        at = start = m.end()
    return "".join([*out, text[at:]]), spans


def _others(text: str, m: re.Match, tried: int, key: bytes, inverse: bool):
    for kind, pattern, permute in KINDS[tried + 1 :]:
        other = re.compile(pattern).match(text, m.start())
        if other and (new := permute(other.group(), key, inverse)) is not None:
            return new, other, kind
    return None, m, ""  # nothing valid starts here


def _apply(df: DataFrame, key: bytes, text: str, spans_col: str | None, inverse: bool) -> DataFrame:
    order = [c for c in df.columns if not spans_col or c.lower() != spans_col.lower()]
    keep = [c for c in order if c != text]
    fields = [T.StructField(text, T.StringType())]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
    if spans_col:
        fields.append(T.StructField(spans_col, T.ArrayType(span)))

    def run(batches):
        for (array,) in batches:
            sizes = pa.compute.binary_length(array.fill_null("") if array.null_count else array).to_pylist()
            for rows in slices(sizes, SLICE_CHARS):
                made = [(None, []) if t is None else rewrite(t, key, inverse) for t in array[rows.start : rows.stop].to_pylist()]
                out = [pa.array([t for t, _ in made], pa.string())]
                if spans_col:
                    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
                    out.append(pa.array([[{"kind": k, "start": a, "stop": b} for k, a, b in s] for _, s in made], pa.list_(kind)))
                yield rows, out

    made = arrow_map(df, [quoted(text)], keep, fields, run)
    return made.select(*[quoted(c) for c in order], *([quoted(spans_col)] if spans_col else []))


def pseudonymize(df: DataFrame, key: bytes, text: str = "text", spans_col: str | None = "pii_spans") -> DataFrame:
    """``df`` with pseudonyms in ``text`` and, unless ``spans_col`` is None, where they stand."""
    return _apply(df, key, text, spans_col, inverse=False)


def reveal(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``df`` with the originals of the pseudonyms that ``key`` made."""
    return _apply(df, key, text, None, inverse=True)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = pseudonymize(docs, DEMO_KEY)
    return made.select("doc_id", "text", F.size("pii_spans").cast("long").alias("n_values"), F.array_join(F.array_sort(F.array_distinct(F.transform("pii_spans", lambda s: s["kind"]))), ",").alias("kinds"))
