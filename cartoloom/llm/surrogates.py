"""Surrogates for personal data and secrets.

Each detected entity is replaced by one of its own type and format. A surrogate is the image of the entity under a keyed
bijection of all strings of its format, so equal entities get equal surrogates in every document and task (coreference),
distinct ones stay distinct, and none maps to itself; no table of entities has to be gathered. The bijection is a keyed
permutation followed by a step to the next element and the way back, over the number that the string stands for.

Types and what they keep: ``card`` (length, grouping, first digit, whether the check digit is right), ``phone`` (layout,
first digit after ``+``), ``ip`` (digits per octet, valid octets), ``email`` (layout, case, top domain), ``secret`` (alphabet,
length), ``number`` (national ids and accounts: layout, country), ``person`` (a title and up to three names of Latin, Cyrillic
or Greek letters, with inner capitals, apostrophes, initials and particles such as "van", which stay, or in capitals: gender by
title, given names within the list of their gender and script, others letter for letter by script, case, and vowel or
consonant). Later mentions of a person's names in the same text are replaced alike; initials only after the title.

Collision checks: a name outside the lists never becomes one in them, a secret in capitals never one that has no capital
letter; where the image is such a string, the next image is taken, which keeps the map one to one.

Cases: a null text stays null, an empty one empty; texts without entities are returned as they are; repeated rows and ids
are treated alike; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

TYPES = ("card", "phone", "ip", "email", "secret", "number", "person")
DEFAULT_KEY = b"surrogates-1"
ROUNDS = 6

# Given names by gender and script, titles by gender, and letters by class.
GIVEN = {
    ("f", "latin"): "Anna Maria Laura Sofia Emma Clara Elena Julia Alice Marta Paula Sarah Lisa Nina Eva Irene Claire Sophie Camille Ingrid Helga Carmen Lucia Ines".split(),
    ("m", "latin"): "John Peter Paul Thomas David Martin Daniel Robert Michael James Lucas Hugo Pierre Jean Louis Karl Hans Jorge Carlos Pablo Diego Mario Marco Erik".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана Юлия Екатерина Вера Нина".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил Виктор Павел Борис Олег".split(),
}
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Señorita Sra Srta Госпожа".split(),
    "m": "Mr Herr Monsieur Señor Sr Господин".split(),
    "": "Dr Prof".split(),
}
CLASSES = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäãåéèêëíìîïóòôöõúùûü", "ñçßøœæ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "αεηιουωάέήίόύώ", "βγδζθκλμνξπρσςτφχψ"]
# Letters beyond those, in classes of their own, so that names of the letters above keep to them.
CLASSES += [
    "āăąēĕėęěĩīĭįıōŏőũūŭůűųǎǐǒǔơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹýÿŷ",
    "ćĉċčďđĝğġģĥħĵķĺļľŀłńņňŋŕŗřśŝşšţťŧŵźżžșțþðƙɓɗ",
    "іїєѐѝўӑӓәӗөӯӱү",
    "ґђѓјљњћќџғқңҷһҳ",
    "ΐΰϊϋὰὲὴὶὸὺὼἀἁἐἑἠἡἰἱὀὁὐὑὠὡᾶῆῖῦῶ",
]

_CLASS_OF = {c: (k, i) for k, members in enumerate(CLASSES) for i, c in enumerate(members)}
_POOL_OF = {name.lower(): (pool, i) for pool, names in GIVEN.items() for i, name in enumerate(names)}

_EMAIL = re.compile(r"[A-Za-z0-9._%+'-]*[A-Za-z0-9]@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)")
_CARD = re.compile(r"(?<![\d-])\d(?:[ -]?\d){11,18}(?![\d]|-\d)")
_PHONE = re.compile(r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])")
_SECRET = re.compile(
    r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|sk-[0-9A-Za-z]{20,}|xox[abp]-[0-9A-Za-z-]{10,})(?![0-9A-Za-z])"
    r"|(?:(?<=token = \")|(?<=token=\")|(?<=secret = \")|(?<=secret=\")|(?<=api_key = \")|(?<=api_key=\")|(?<=password = \")|(?<=password=\"))[^\"\s]{6,}(?=\")"
)
_NUMBER = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,4})?(?![0-9A-Za-z])")
_CAPITAL = "[" + "".join(c for c in map(chr, range(0x2000)) if c.isupper() or c.istitle()) + "]"
_SMALL = "[" + "".join(c for c in map(chr, range(0x2000)) if c.isalpha() and not c.isupper() and not c.istitle()) + "\u0300-\u036f]"
#: Capital words that follow a name in capitals without being one.
_NO_NAME = r"(?!(?:AND|OR|THE|OF|IN|IS|WAS|TO|AT|FOR|BY|ON|UND|DER|DIE|ET|LE|LA|Y|EL|И|В|НА)\b)"
_WORD = rf"(?:{_CAPITAL}{_SMALL}*['’](?={_CAPITAL}{_SMALL}|{_CAPITAL}{{2}}))?{_CAPITAL}(?:{_SMALL}+(?:{_CAPITAL}{_SMALL}+)*|{_CAPITAL}+{_SMALL}*)"
_NAME = rf"{_NO_NAME}{_WORD}(?:-{_WORD})*"
_INITIAL = rf"{_CAPITAL}(?:\. ?| )(?:-?{_CAPITAL}\. ?)*"
_PARTICLE = r"(?:(?:van|von|der|den|dem|de|del|della|di|da|dal|dos|das|do|du|des|la|le|los|las|zu|zum|zur|ten|ter|te|af|av|al|el|bin|ibn|bint|ben|'t|фон|де|ван|дер) |(?:al|el|[dl])[-'’](?=" + _CAPITAL + "))"
_PART = rf"(?:{_INITIAL}){{0,3}}{_PARTICLE}{{0,3}}{_NAME}"
_PERSON = re.compile(r"\b(" + "|".join(t for ts in TITLES.values() for t in ts) + rf")(\.? )({_PART}(?: {_PART}){{0,2}})(?!\w)")
_NAME_PARTS = re.compile(rf"(?<![^\W_])(?:(?P<name>{_WORD}(?:-{_WORD})*)|(?P<initial>{_CAPITAL}))(?![^\W_])")
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
#: A text without any of these holds no entity.
_HINT = re.compile(r"[0-9@=]|\b(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.? ")


class Cipher:
    """Keyed bijections of the integers below a size, without fixed points."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, value: int, bits: int) -> int:
        size = (bits + 7) // 8
        data, out = tweak + bytes([i]) + value.to_bytes(size, "big"), b""
        while len(out) < size:
            out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=self.key, digest_size=min(64, size)).digest()
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def _permute(self, value: int, size: int, tweak: bytes, back: bool) -> int:
        bits = (max(size - 1, 1).bit_length() + 1) // 2
        mask = (1 << bits) - 1
        while True:
            left, right = value >> bits, value & mask
            if back:
                for i in reversed(range(ROUNDS)):
                    left, right = right ^ self._round(tweak, i, left, bits), left
            else:
                for i in range(ROUNDS):
                    left, right = right, left ^ self._round(tweak, i, right, bits)
            value = left << bits | right
            if value < size:
                return value

    def image(self, value: int, size: int, tweak: bytes) -> int:
        """One cycle through all values: the way to a hidden order, the next in it, and back."""
        return self._permute((self._permute(value, size, tweak, False) + 1) % size, size, tweak, True)

    def string(self, text: str, tweak: str, alphabets: list[str | None], refused=None) -> str:
        """The image of a string whose i-th character varies within ``alphabets[i]`` (None: stays)."""
        size = 1
        value = 0
        for c, a in zip(text, alphabets):
            if a is not None:
                value = value * len(a) + a.index(c)
                size *= len(a)
        if size < 2:
            return text
        while True:
            value = self.image(value, size, f"{tweak}:{size}".encode())
            out, rest = [], value
            for c, a in zip(reversed(text), reversed(alphabets)):
                if a is None:
                    out.append(c)
                else:
                    rest, k = divmod(rest, len(a))
                    out.append(a[k])
            made = "".join(reversed(out))
            if refused is None or not refused(made):
                return made


def luhn(digits: str) -> int:
    """The check digit that belongs behind ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _refill(layout: str, digits: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in layout)


def card(cipher: Cipher, text: str) -> str:
    digits = "".join(c for c in text if c.isdigit())
    off = (int(digits[-1]) - luhn(digits[:-1])) % 10  # 0: the check digit is right
    body = digits[1:-1] + (str(off - 1) if off else "")
    made = cipher.string(body, f"card{len(digits)}{bool(off)}{digits[0]}", ["0123456789"] * (len(digits) - 2) + (["012345678"] if off else []))
    front = digits[0] + made[: len(digits) - 2]
    return _refill(text, front + str((luhn(front) + (int(made[-1]) + 1 if off else 0)) % 10))


def phone(cipher: Cipher, text: str) -> str:
    digits = "".join(c for c in text if c.isdigit())
    keep = 1 if text[0] == "+" else 0
    made = cipher.string(digits[keep:], f"phone{digits[:keep]}/{len(digits)}", ["0123456789"] * (len(digits) - keep))
    return _refill(text, digits[:keep] + made)


_OCTETS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}


def ip(cipher: Cipher, text: str) -> str:
    parts = text.split(".")
    value, size = 0, 1
    for p in parts:
        low, count = _OCTETS[len(p)]
        value, size = value * count + int(p) - low, size * count
    value = cipher.image(value, size, ("ip" + ".".join(str(len(p)) for p in parts)).encode())
    out = []
    for p in reversed(parts):
        low, count = _OCTETS[len(p)]
        value, k = divmod(value, count)
        out.append(str(low + k))
    return ".".join(reversed(out))


def _case(like: str, made: str) -> str:
    return "".join(m.upper() if c != c.lower() and len(m.upper()) == 1 else m for c, m in zip(like, made))


def _classes(text: str) -> list[str | None]:
    return [CLASSES[_CLASS_OF[c][0]] if c in _CLASS_OF else None for c in text]


def email(cipher: Cipher, text: str) -> str:
    low = text.lower()
    end = low.rindex(".")
    return _case(text, cipher.string(low[:end], "email" + low[end:], _classes(low[:end])) + low[end:])


def secret(cipher: Cipher, text: str) -> str:
    if re.fullmatch("[0-9a-f]+", text):
        return cipher.string(text, "hex", ["0123456789abcdef"] * len(text))
    if re.fullmatch("[0-9A-F]+", text):
        return cipher.string(text, "HEX", ["0123456789ABCDEF"] * len(text), refused=str.isdigit)
    start = re.match("AKIA|gh[pousr]_|sk-|xox[abp]-|", text).end()
    kinds = ["0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if "a" <= c <= "z" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else None for c in text[start:]]
    return text[:start] + cipher.string(text[start:], "secret" + text[:start] + "".join("x" if k is None else k[0] for k in kinds), kinds)


def number(cipher: Cipher, text: str) -> str:
    start = 4 if text[:2].isalpha() else 0
    bare = text[start:].replace(" ", "")
    kinds = ["0123456789" if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isalpha() else None for c in bare]
    made = iter(cipher.string(bare, "number" + text[:2] * (start > 0) + "".join("x" if k is None else k[0] for k in kinds), kinds))
    return text[:start] + "".join(c if c == " " else next(made) for c in text[start:])


def _lower(text: str) -> str:
    """Lower case letter by letter, as long as the text."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def name(cipher: Cipher, text: str, gender: str) -> str:
    """One name: within its list if it is there, else letter for letter."""
    low = _lower(text)
    pool = _POOL_OF.get(low)
    if pool is not None:
        names = GIVEN[pool[0]]
        made = names[cipher.image(pool[1], len(names), f"given{pool[0]}".encode())]
        return made.upper() if text.isupper() else made
    kinds = _classes(low)
    tweak = "name" + "".join("x" if k is None else k[0] for k in kinds)
    # a letter whose capital is that of another one (ς, ı) or none (ß) doesn't stand for a capital
    keeps = _lower(_case(text, low)) == low

    def refused(made: str) -> bool:
        return made in _POOL_OF or (keeps and (_lower(_case(text, made)) != made or any(c != d and m.upper() == m.lower() for c, d, m in zip(text, low, made)) or any(c != d and len(m.upper()) > 1 for c, d, m in zip(text, low, made))))

    return _case(text, cipher.string(low, tweak, kinds, refused=refused))


_MAKERS = {"card": card, "phone": phone, "ip": ip, "email": email, "secret": secret, "number": number}
_FINDERS = (("email", _EMAIL), ("secret", _SECRET), ("ip", _IP), ("phone", _PHONE), ("number", _NUMBER), ("card", _CARD))


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities but persons, the first finder first, without overlaps."""
    found: list[tuple[int, int, str]] = []
    for kind, pattern in _FINDERS:
        spans = [m.span() for m in pattern.finditer(text)]
        found += [(a, b, kind) for a, b in spans]
        for a, b in spans:  # later finders don't reach into what is taken
            text = f"{text[:a]}{chr(0) * (b - a)}{text[b:]}"
    return sorted(found)


def replace(text: str, cipher: Cipher) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and the number of entities by type."""
    counts: dict[str, int] = {}
    if not _HINT.search(text):
        return text, counts
    spans = [(a, b, kind, _MAKERS[kind](cipher, text[a:b])) for a, b, kind in find(text)]
    names: dict[str, str] = {}
    initials: list[tuple[int, int, str]] = []
    for m in _PERSON.finditer(text):
        for part in _NAME_PARTS.finditer(text, m.start(3), m.end(3)):
            if part["name"]:
                names.setdefault(part[0], "-".join(name(cipher, p, _GENDER[m[1]]) for p in part[0].split("-")))
            else:  # only beside its name
                initials.append((*part.span(), name(cipher, part[0], _GENDER[m[1]])))
    if names:
        mention = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
        taken = [(a, b) for a, b, _, _ in spans]
        for m in mention.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                spans.append((m.start(), m.end(), "person", names[m[0]]))
        taken = [(a, b) for a, b, _, _ in spans]
        spans += [(a, b, "person", made) for a, b, made in initials if not any(c < b and a < d for c, d in taken)]
    out, at = [], 0
    for a, b, kind, made in sorted(spans):
        out += [text[at:a], made]
        counts[kind] = counts.get(kind, 0) + 1
        at = b
    return "".join([*out, text[at:]]), counts


def surrogates(docs: DataFrame, key: bytes = DEFAULT_KEY, text: str = "text") -> DataFrame:
    """Documents with surrogates in ``text`` and added counts ``n_entities`` and ``n_<type>``, which replace columns of those names."""
    common.prepare(docs.sparkSession)
    made = ["n_entities", *(f"n_{t}" for t in TYPES)]
    docs = docs.drop(*made)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in made)])

    def run(batches):
        import pyarrow as pa

        cipher = Cipher(key)
        for batch in batches:
            texts, counts = [], []
            for value in batch.column(text).to_pylist():
                new, found = (None, {}) if value is None else replace(value, cipher)
                texts.append(new)
                counts.append(found)
            columns = [pa.array(texts, batch.schema.field(n).type) if n == text else batch.column(n) for n in batch.schema.names]
            columns += [pa.array([sum(c.values()) for c in counts], pa.int64())] + [pa.array([c.get(t, 0) for c in counts], pa.int64()) for t in TYPES]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *made])

    return docs.mapInArrow(run, schema)


def query(spark, sf_dir):
    return surrogates(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
