"""Personal data: keyed surrogates of the same type, script, format and gender.

A value's surrogate is an encryption of the value within its own format: a keyed permutation of all values of that
type and format. So surrogates are distinct where values are, equal where values are, in every document and without
looking anything up; none is its own value. Values that mean the same (case, separators, layouts) are first made
canonical, and the surrogate takes the value's own case and separators. ``checked`` verifies what was written.

Whoever has the key can undo the permutation: it is the caller's or the session's (``session_key``), never this file's.
"""

from __future__ import annotations

import ipaddress
import re
import secrets
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache, lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow, save

KEY_SETTING = "spark.pelagos.pii.key"


def session_key(spark: SparkSession) -> bytes:
    """The session's key for surrogates; without one, a new random key, so that separate runs don't agree."""
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else secrets.token_bytes(32)


#: Given names by (gender, script). A name is replaced by another one of its list.
NAMES = {
    ("female", "latin"): "Alice Amelia Anna Beatrice Camille Carmen Charlotte Chloé Clara Elena Emma Eva Frieda Greta Hannah Inés Isabel Julia Karin Laura Lena Lucía Maria Marie Monika Nadia Olivia Pilar Sabine Sarah Sofia Ursula".split(),
    ("male", "latin"): "Adam Albert Andrés Antoine Bernard Carlos Daniel David Diego Emil Felix Fritz Georg Gustav Henri Hugo Jakob James Javier John Jürgen Karl Louis Lukas Marco Martin Miguel Otto Pablo Peter Robert Thomas".split(),
    ("female", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Светлана Татьяна Юлия".split(),
    ("male", "cyrillic"): "Алексей Андрей Борис Виктор Дмитрий Иван Максим Михаил Николай Олег Павел Сергей".split(),
    ("female", "greek"): "Άννα Δήμητρα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("male", "greek"): "Αλέξανδρος Βασίλης Γιώργος Δημήτρης Κώστας Νίκος Παύλος Σταύρος".split(),
}
#: Family names; a name is replaced by another one of its list. Those that are not listed get letters of the same kinds.
FAMILIES = "Smith Johnson Brown Miller Wilson Taylor Walker Schmidt Müller Fischer Weber Meyer Wagner Becker Hoffmann Schulz Koch Bauer Richter Dupont Dubois Moreau Laurent Lefebvre Leroy García López Martínez Sánchez Pérez Rossi Ferrari Bianchi Romano Nowak Kowalski Novák Jansen Visser Larsen".split()
#: Endings that tell the gender of a family name, and stay. None ends in another one.
_ENDINGS = ("ова", "ева", "ёва", "ина", "ына", "ская", "цкая", "ов", "ев", "ёв", "ин", "ын", "ский", "цкий")
_TITLES = ("Mr Mrs Ms Miss Dr Prof Herr Frau Señor Señora Sr Sra Monsieur Madame Mme Mlle Господин Госпожа Κύριος Κυρία").split()
_LISTS = NAMES | {("family", "latin"): FAMILIES}
_KNOWN = {name.lower(): group for group, names in _LISTS.items() for name in names}

#: Letters that stand for each other, by kind: a letter's surrogate is of its own kind. ``_alike`` has the others.
_KINDS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâäãåèéêëìíîïòóôöõùúûü", "çñß", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ"]
_KIND = {c: k for k in _KINDS for c in k}
_HEX = "0123456789abcdef"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_WORD = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_UPPER = "[" + "".join(c for c in map(chr, range(0x2000)) if c.isupper()) + "]"
#: A word of a name; a possessive s is no part of it.
_CAP = rf"(?={_UPPER})[^\W\d_]+(?:[-'’](?!s\b)[^\W\d_]+)*"
_PARTICLES = "von vom van der den ter zu zur de del della di da do dos das du la las le los y e i bin ibn al el".split()
_SMALL = rf"(?:(?:{'|'.join(_PARTICLES)}) )*"
_MORE = rf" {_SMALL}(?:{_UPPER}\.(?= )|{_CAP})"
_SECRET = re.compile(r"""\b(?:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|passwd|password)\b["']?\s*[=:]\s*["']?(?P<v>[^\s"',;]{6,})""", re.I)
_TOKEN_PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk-|glpat-")
_TOKEN = re.compile(r"(?<![\w-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|glpat-[\w-]{20,})(?!\w)", re.A)
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?P<v>[A-Za-z0-9+/=\s]+)-----END")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_AMERICAN = re.compile(r"\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4}")
_MAIL = re.compile(r"(?<![\w.+-])\w(?:[\w.+-]*\w)?@\w[\w-]*(?:\.\w[\w-]*)+")
_IP = re.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\w)")
_CARD = re.compile(r"(?<![\w.-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{13,19})(?![\w-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}|(?<!\d[ /])0\d{2,4}[ /]\d{3,4}[ -]?\d{2,4}|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?!\w)")
_NATIONAL = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_TITLE, _LISTED = "|".join(_TITLES), "|".join(n for ns in NAMES.values() for n in ns)
_PERSON = re.compile(rf"\b(?:{_TITLE})\b\.?(?: (?:{_TITLE})\b\.?)* (?P<a>{_SMALL}(?:{_UPPER}\.(?= )|{_CAP})(?:{_MORE})*)|\b(?P<b>(?:{_LISTED})(?:-{_CAP})?(?:{_MORE})+)")
_HINT = re.compile(r"token|key|secret|passw", re.I)
_TITLE_HINT = re.compile(f"{_TITLE}|{_LISTED}")


def _is_ipv6(value: str) -> bool:
    """An address, and not some words joined by colons."""
    if sum(map(bool, value.split(":"))) < 3 and not value.lower().startswith(("fe80:", "2001:")):
        return False
    try:
        return bool(ipaddress.IPv6Address(value))
    except ValueError:
        return False


def _remainder(iban: str) -> int:
    """Modulo 97 of the number that an IBAN's letters and digits make, its first four signs last."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def find(text: str) -> list[tuple[str, int, int]]:
    """(type, start, end) of the entities of a whole text, in order, none overlapping; earlier types come first."""
    found: list[tuple[str, int, int]] = []
    if "PRIVATE KEY" in text:
        found += [("private_key", m.start("v"), m.end("v")) for m in _PEM.finditer(text)]
    if _HINT.search(text):
        found += [("secret", m.start("v"), m.end("v")) for m in _SECRET.finditer(text)]
    if _TOKEN_PREFIX.search(text):
        found += [("secret", *m.span()) for m in _TOKEN.finditer(text)]
    if "@" in text:
        found += [("email", *m.span()) for m in _MAIL.finditer(text) if any(map(str.isalnum, m[0].rpartition(".")[0]))]
    if text.count(":") > 1:
        found += [("ipv6", *m.span()) for m in _IPV6.finditer(text) if _is_ipv6(m[0])]
    if re.search(r"\d{2}|\d\.\d", text):
        found += [("ip", *m.span()) for m in _IP.finditer(text)]
        found += [("iban", *m.span()) for m in _IBAN.finditer(text) if 15 <= len(v := m[0].replace(" ", "")) <= 34 and _remainder(v) == 1]
        found += [("card", *m.span()) for m in _CARD.finditer(text) if _luhn((v := _numbers(m[0]))[:-1]) == int(v[-1])]
        for kind, pattern in (("phone", _PHONE), ("national_id", _NATIONAL)):
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    if _TITLE_HINT.search(text):
        found += [("person", *m.span("a" if m["a"] else "b")) for m in _PERSON.finditer(text)]
    out: list[tuple[str, int, int]] = []
    taken: list[tuple[int, int]] = []

    def take(kind: str, a: int, b: int) -> None:
        at = bisect_left(taken, (b, 0))
        if not at or taken[at - 1][1] <= a:
            insort(taken, (a, b))
            out.append((kind, a, b))

    for one in found:
        take(*one)
    # Words of the names found stand for the same persons elsewhere in the text.
    if words := {w for k, a, b in out if k == "person" for w in re.split("[ -]", text[a:b]) if len(w) > 2 and w[0].isupper()}:
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(words, key=len, reverse=True)))})(?!\w)", text):
            take("person", *m.span())
    return sorted(out, key=lambda e: e[1])


def _round(key: bytes, tweak: bytes, step: int, half: int, bits: int) -> int:
    h = blake2b(half.to_bytes((half.bit_length() + 7) // 8 + 1, "big") + bytes([step]) + tweak, key=key[:64], digest_size=64).digest()
    while len(h) * 8 < bits:
        h += blake2b(h, key=key[:64], digest_size=64).digest()
    return int.from_bytes(h, "big") & ((1 << bits) - 1)


def _feistel(x: int, size: int, key: bytes, tweak: bytes, back: bool) -> int:
    """A keyed permutation of 0 .. size-1: a Feistel network on the next even number of bits, repeated while outside."""
    low = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << low) - 1
    while True:
        a, b = x >> low, x & mask
        for step in (range(7, -1, -1) if back else range(8)):
            if back:
                a, b = b ^ _round(key, tweak, step, a, low), a
            else:
                a, b = b, a ^ _round(key, tweak, step, b, low)
        x = a << low | b
        if x < size:
            return x


def permute(x: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size-1 that moves every number, if there is more than one."""
    if size < 2:
        return x
    t = tweak.encode()
    shift = 1 + int.from_bytes(blake2b(t, key=key[:64], digest_size=16).digest(), "big") % (size - 1)
    return _feistel((_feistel(x, size, key, t, False) + shift) % size, size, key, t, True)


#: Characters of a value at most that are permuted as one number; longer ones go by parts.
_PART = 256
_SIGNS = "!#$%&()*+-./:<=>?@[\\]^_`{|}~"
_PLAIN = {c: k for k in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in k}


def _sort(c: str) -> tuple[str, bool, bool]:
    """A character's category, whether it is in lower case already, and whether it comes back from upper case."""
    return unicodedata.category(c), _lower(c) == c, len(c.upper()) == 1 and _lower(c.upper()) == c


@cache
def _alike(c: str, plain: bool) -> str:
    """What may stand for a character that is in no table: its own sort among the 256 code points around it, or else what
    is left of that sort in all of Unicode. Each member of such a set has the same set."""
    tables, sort = (_PLAIN if plain else _KIND), _sort(c)

    def around(x: int) -> list[str]:
        return [y for y in map(chr, range(x & ~255, (x | 255) + 1)) if y not in tables and _sort(y) == sort]

    if len(own := around(ord(c))) > 1:
        return "".join(own)
    lone = [y[0] for x in range(0, 0x110000, 256) if not 0xD800 <= x < 0xE000 and len(y := around(x)) == 1]
    return "".join(lone) if c in lone else c


def _kinds(value: str, plain: bool) -> list[str | None]:
    """For each character those that may stand for it; none for signs, unless a plain value is nothing else."""
    tables = _PLAIN if plain else _KIND
    found = [tables.get(c) or (_alike(c, plain) if c.isalnum() else None) for c in value]
    if plain and all(k is None or len(k) < 2 for k in found):
        found = [_SIGNS if c in _SIGNS else None if c.isspace() or c in "\"',;" else _alike(c, plain) for c in value]
    return found


def _letters(canonical: str, key: bytes, tweak: str, plain: bool = False, kinds: list[str | None] | None = None) -> str:
    """Another string of the same kinds of characters, place by place."""
    kinds = kinds or _kinds(canonical, plain)
    if len(canonical) > _PART:
        return "".join(_letters(canonical[i : i + _PART], key, f"{tweak}/{i}", plain, kinds[i : i + _PART]) for i in range(0, len(canonical), _PART))
    x, size = 0, 1
    for c, k in zip(canonical, kinds):
        if k:
            x, size = x * len(k) + k.index(c), size * len(k)
    pattern = "".join(k[0] if k else c for c, k in zip(canonical, kinds))
    x, out = permute(x, size, key, f"{tweak}\n{pattern}"), []
    for c, k in zip(reversed(canonical), reversed(kinds)):
        if k:
            x, i = divmod(x, len(k))
            out.append(k[i])
        else:
            out.append(c)
    return "".join(reversed(out))


def _cased(like: str, letters: str) -> str:
    return "".join(n.upper() if o != o.lower() and len(n.upper()) == 1 and n.upper().lower() == n else n for o, n in zip(like, letters))


def _lower(value: str) -> str:
    """In lower case, letter by letter: one that would become several or not come back stays."""
    return "".join(c.lower() if len(c.lower()) == 1 and c.lower().upper() == c else c for c in value)


def _luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 else (2 * d - 9 if d > 4 else 2 * d)
    return -total % 10


def _relaid(value: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in value)


def _numbers(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


#: Private networks as (bits that stay, first address); others are dealt among themselves.
_NETS = [(8, 10 << 24), (12, 172 << 24 | 16 << 16), (16, 192 << 24 | 168 << 16), (8, 127 << 24)]


def _net(x: int) -> int:
    return next((i for i, (bits, base) in enumerate(_NETS) if x >> (32 - bits) == base >> (32 - bits)), -1)


def _walked(x: int, size: int, key: bytes, tweak: str, same) -> int:
    """A permutation of the numbers below size that are alike: permuted until the image is like x."""
    kind = same(x)
    x = permute(x, size, key, tweak)
    while same(x) != kind:
        x = permute(x, size, key, tweak)
    return x


def _address(value: str, key: bytes) -> str:
    """Private networks stay, public addresses stay public, reserved ones reserved."""
    x = 0
    for part in value.split("."):
        x = x << 8 | int(part)
    net = _net(x)
    if net >= 0:
        free = 32 - _NETS[net][0]
        x = (x >> free << free) | permute(x & ((1 << free) - 1), 1 << free, key, f"ip{net}")
    else:
        x = _walked(x, 1 << 32, key, "ip", lambda y: (_net(y) >= 0, ipaddress.IPv4Address(y).is_global and y >> 28 < 14))
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def _address6(value: str, key: bytes) -> str:
    """Link-local addresses keep their network, unique local ones their first byte, those for documents theirs, public ones stay public; in the same notation."""
    x = int(ipaddress.IPv6Address(value))
    if x >> 118 == 0x3FA:
        x = x >> 64 << 64 | permute(x & (1 << 64) - 1, 1 << 64, key, "ip6 link")
    elif x >> 96 == 0x20010DB8:
        x = x >> 96 << 96 | permute(x & (1 << 96) - 1, 1 << 96, key, "ip6 shown")
    elif x >> 121 == 0x7E:
        x = x >> 120 << 120 | permute(x & (1 << 120) - 1, 1 << 120, key, "ip6 local")
    else:
        x = _walked(x, 1 << 128, key, "ip6", lambda y: (y >> 118 == 0x3FA or y >> 121 == 0x7E or y >> 96 == 0x20010DB8, ipaddress.IPv6Address(y).is_global and y >> 125 == 1))
    made = ipaddress.IPv6Address(x)
    groups = value.split(":")
    out = made.exploded if "" not in groups and all(len(g) == 4 for g in groups) else ":".join(f"{int(g, 16):x}" for g in made.exploded.split(":")) if "" not in groups else str(made)
    return out.upper() if value.upper() == value != value.lower() else out


def _iban(value: str, key: bytes) -> str:
    """Of the same country and layout, with right check digits."""
    plain = value.replace(" ", "")
    body = _letters(plain[4:], key, f"iban{plain[:2]}", True)
    it = iter(f"{plain[:2]}{98 - _remainder(plain[:2] + '00' + body):02d}{body}")
    return "".join(c if c == " " else next(it) for c in value)


@lru_cache(maxsize=50_000)
def _word(name: str, key: bytes) -> str:
    """A listed name becomes another of its list, others get letters of the same kinds; endings that tell a gender stay."""
    low = _lower(name)

    def one(x: str) -> str:
        if group := _KNOWN.get(x):
            names = _LISTS[group]
            at = [n.lower() for n in names].index(x)
            return names[permute(at, len(names), key, "given" + "".join(group))].lower()
        end = next((e for e in _ENDINGS if x.endswith(e) and len(x) > len(e) + 1), "")
        return _letters(x[: len(x) - len(end)], key, f"name{end}") + end

    def kind(x: str) -> tuple:
        return _KNOWN.get(x), next((e for e in _ENDINGS if x.endswith(e) and len(x) > len(e) + 1), "")

    out = one(low)
    while kind(out) != kind(low):  # it is some other name's surrogate
        out = one(out)
    if len(out) == len(name):
        return _cased(name, out)
    return out.upper() if name.isupper() else out.title() if name[0].isupper() else out


#: Country codes of two digits; 1 and 7 have one, all others three.
_TWO = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _code(digits: str) -> int:
    return 1 if digits[0] in "017" else 2 if digits[:2] in _TWO else 3


def canonical(kind: str, value: str) -> str:
    """What is equal for all layouts of a value. American phone numbers have code 1; other ones without a code begin with 0."""
    if kind in ("card", "phone", "national_id"):
        return ("1" if kind == "phone" and _AMERICAN.fullmatch(value) else "") + _numbers(value)
    if kind == "ipv6":
        return ipaddress.IPv6Address(value).exploded
    return value.replace(" ", "") if kind == "iban" else _lower(value) if kind in ("person", "email") else value


@lru_cache(maxsize=50_000)
def surrogate(kind: str, value: str, key: bytes) -> str:
    """The value's replacement: of the same type and format, another one, and the same wherever the value occurs.

    Persons: listed given names become others of the same gender and script, listed family names others of the list, the
    rest names with letters of the same kinds, word by word, so that parts of a name agree with it; particles stay.
    Emails keep what follows the last dot. Phone numbers keep the country code, cards their first digit and a right check
    digit, addresses their network's kind, bank accounts their country, tokens their prefix. Letters of any
    script become letters of that script; a value of nothing but signs gets other signs.
    """
    if kind == "ip":
        return _address(value, key)
    if kind == "ipv6":
        return _address6(value, key)
    if kind == "iban":
        return _iban(value, key)
    if kind == "card":
        d = _numbers(value)
        off = (int(d[-1]) - _luhn(d[:-1])) % 10
        body = d[0] + f"{permute(int(d[1:-1]), 10 ** (len(d) - 2), key, f'card{d[0]}{len(d)}{off}'):0{len(d) - 2}d}"
        return _relaid(value, body + str((_luhn(body) + off) % 10))
    if kind in ("phone", "national_id"):
        d = canonical(kind, value)
        keep = _code(d) if kind == "phone" else 0
        new = d[:keep] + f"{permute(int(d[keep:]), 10 ** (len(d) - keep), key, f'{kind}{d[:keep]}/{len(d)}'):0{len(d) - keep}d}"
        return _relaid(value, new[len(d) - len(_numbers(value)) :])
    if kind == "email":
        low = _lower(value)
        name, _, host = low.rpartition("@")
        rest, dot, last = host.rpartition(".")
        return _cased(value, f"{_letters(name, key, 'mail')}@{_letters(rest, key, 'host')}{dot}{last}")
    if kind == "person":
        return "".join(w if w in _PARTICLES else _word(w, key) for w in re.split("([ -])", value))
    if kind == "secret" and (known := _TOKEN_PREFIX.match(value)) and known.end() < len(value):
        return known[0] + _letters(value[known.end() :], key, f"secret{known[0]}", True)
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        hexed = _hexed(value.lower(), key)
        if value == value.lower():
            return hexed
        while hexed.isdigit():  # digits alone are a lower-case value's
            hexed = _hexed(hexed, key)
        return hexed.upper()
    out = _letters(value, key, kind, True)
    while kind == "secret" and (re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", out) or ((known := _TOKEN_PREFIX.match(out)) and known.end() < len(out))):
        out = _letters(out, key, kind, True)  # what it came to is some other kind's
    return out


def _hexed(value: str, key: bytes) -> str:
    return _letters(value, key, "hex", True, [_HEX] * len(value))


def replaced(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int, int, int]]]:
    """(new text, entities): entities are (type, start, length, new start, new length), in characters."""
    out, spans, done, size = [], [], 0, 0
    for kind, a, b in find(text):
        new = surrogate(kind, text[a:b], key)
        out += [text[done:a], new]
        size += a - done
        spans.append((kind, a, b - a, size, len(new)))
        size += len(new)
        done = b
    return ("".join([*out, text[done:]]) if spans else text), spans


_ENTITY = "entities array<struct<type:string,start:int,length:int,new_start:int,new_length:int>>"
_FIELDS = pa.list_(pa.struct([("type", pa.string()), *((n, pa.int32()) for n in ("start", "length", "new_start", "new_length"))]))

_PAIRS = pa.list_(pa.struct([("type", pa.string()), ("value", pa.binary()), ("surrogate", pa.string())]))


def surrogates(docs: DataFrame, key: bytes, text_col: str = "text", pairs: str | None = None) -> DataFrame:
    """docs with text_col rewritten and a column ``entities`` (one of that name is replaced); every row and column stays.

    Null texts stay null and have no entities. Whole texts are read. Nothing is shuffled: a value's surrogate depends on
    the key and the value alone, so copies and repeated mentions agree wherever they are. ``pairs`` names a column to add:
    (type, digest of the canonical value, canonical surrogate) of what was replaced.
    """
    arrow(docs.sparkSession)
    docs = docs.drop("entities")
    at, schema = docs.columns.index(text_col), ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + f", {_ENTITY}" + (f", `{pairs}` array<struct<type:string,value:binary,surrogate:string>>" if pairs else "")

    def pair(old: str, new: str, kind: str, a: int, n: int, b: int, m: int) -> dict:
        value = canonical(kind, old[a : a + n]).encode("utf-8", "replace")
        return {"type": kind, "value": blake2b(value, key=key[:64], digest_size=16).digest(), "surrogate": canonical(kind, new[b : b + m])}

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            made = [(None, []) if t is None else replaced(t, key) for t in batch.column(at).to_pylist()]
            columns, old, names = list(batch.columns), batch.column(at).to_pylist(), [*batch.schema.names, "entities"]
            columns[at] = pa.array([m[0] for m in made], pa.string())
            spans = pa.array([[dict(zip(("type", "start", "length", "new_start", "new_length"), s)) for s in m[1]] for m in made], _FIELDS)
            columns.append(spans)
            if pairs:
                columns.append(pa.array([[pair(t, m[0], *s) for s in m[1]] for t, m in zip(old, made)], _PAIRS))
                names.append(pairs)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def collisions(made: DataFrame, pairs: str = "_pairs") -> DataFrame:
    """(type, surrogate) of surrogates that stand for several canonical values in a result of ``surrogates`` with ``pairs``.

    Rows are not joined: each brings its own pairs, so null and repeated ids don't matter. Only (type, surrogate) and the
    least and greatest digest of its values are shuffled, combined before. No entities or no rows: none.
    """
    found = made.select(F.explode(pairs).alias("p")).groupBy("p.type", "p.surrogate").agg(F.min("p.value").alias("a"), F.max("p.value").alias("z"))
    return found.where("a != z").select("type", "surrogate")


def checked(docs: DataFrame, key: bytes | None = None, text_col: str = "text") -> DataFrame:
    """``surrogates`` under the key (or the session's), written; fails if one surrogate stands for several values anywhere in it."""
    made = save(surrogates(docs, key or session_key(docs.sparkSession), text_col, "_pairs"))
    if hits := collisions(made).groupBy("type").count().collect():
        raise ValueError("surrogates of several values: " + ", ".join(f"{h['count']} of type {h['type']}" for h in hits))
    return made.drop("_pairs")
