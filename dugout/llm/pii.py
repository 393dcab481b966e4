"""Personal data replaced by keyed surrogates of the same type and form.

Detection and replacement are per document. A surrogate follows from a secret key and the
entity alone, so an entity has the same surrogate in every document without any lookup.
Digits and addresses go through a keyed permutation of their own format. Where a surrogate
would meet another entity's surrogate or a real value of the corpus, the entity moves on to
its next permutation; only these moves are a table, joined by the hash of the text.
"""

from __future__ import annotations

import bisect
import hashlib
import ipaddress
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from .common import settle

#: Rounds in which contested surrogates are drawn anew.
ATTEMPTS = 60
#: Types of entities, in the order in which they are looked for.
TYPES = ("email", "iban", "card", "ip", "ssn", "phone", "person")

#: Account numbers: a country, two check digits and 11 to 30 letters or digits, in groups of four or not.
_IBAN = re.compile(r"(?<![\w])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![\w])")
#: Social security numbers of the United States; some areas, and groups and numbers of zeros, are never given out.
_SSN = re.compile(r"(?<![\w-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])")
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Runs of digits with single separators, which can hold a card among other numbers.
_RUN = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}(?![0-9])")
_GROUP = re.compile("[0-9]+")
#: First digits and lengths of the large issuers' cards.
_ISSUED = re.compile(
    "4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11}"
    "|(?:6[0245]|35)[0-9]{14}|6[2-9][0-9]{14,17}|5[06-8][0-9]{11,17}"
)
_IP = re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9])")
#: Candidates of IPv6 addresses; the library decides.
_IP6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{2,39}(?:(?<=:)[0-9]{1,3}(?:\.[0-9]{1,3}){3})?(?![\w:]|\.[0-9])")
_PHONE = re.compile(
    # International: + or 00 and a country, an area in brackets, groups.
    r"(?<![\w+])(?:(?:\+|00)[1-9][0-9]{0,2}[ ./-]?(?:\([0-9]{1,5}\)[ ./-]?)?[0-9]{1,12}(?:[ ./-][0-9]{1,8}){0,7}"
    # North American; a leading 1 may precede it.
    r"|(?:1[ .-])?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\([0-9]{3}\)[ .-]?[0-9]{7}"
    # National with a leading 0: pairs; an area and a number behind a separator.
    r"|0[1-9]([ .-])[0-9]{2}(?:\1[0-9]{2}){3}"
    r"|(?:\(0[1-9][0-9]{1,4}\) ?|0[1-9][0-9]{1,4}(?: ?[/-] ?| ))[0-9]{2,9}(?:[ -][0-9]{2,8}){0,3})(?![0-9])"
)
#: Any number behind a word that announces a phone.
_PLAIN = re.compile(r"(?<![\w+.,])\(?[0-9](?:[ ./()-]{0,2}[0-9]){6,14}(?![0-9])")
_PHONE_WORD = re.compile(
    r"(?i)(?<!\w)(?:(?:tele)?phone|tel|call(?:ed|ing)?|mobile|cell|fax|whatsapp|sms|dial|ring|telefon(?:nummer)?|handy(?:nummer)?"
    r"|mobil|rufnummer|ruf|anrufen|t[ée]l[ée]phone|t[ée]l|portable|appele[rz]|tel[ée]fono|m[óo]vil|celular|llam(?:ar|e|a))(?!\w)[^0-9\n]{0,20}$"
)
#: Characters before a number in which such a word is looked for.
_NEAR = 40
_LOCAL = re.compile(r"[\w.%+-]{1,64}\Z")
_DOMAIN = re.compile(r"@(?:[\w-]{1,63}\.){1,8}[^\W\d_]{2,24}")
#: Titles that announce a person, with the person's gender.
_TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Signor": "m", "г-н": "m", "господин": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f",
    "Signora": "f", "г-жа": "f", "госпожа": "f", "Dr": "n", "Prof": "n",
}
_TITLE = rf"(?:{'|'.join(sorted(_TITLES, key=len, reverse=True))})(?!\w)"
#: Parts of a degree that may stand between titles and a name.
_DEGREE = r"(?:med|phil|jur|iur|rer|nat|pol|oec|ing|Ing|habil|dent|vet|theol|h\.[ ]?c|dr|Dr|Prof)(?!\w)"
_NAME = r"[^\W\d_]+(?:-[^\W\d_]+|['’](?![sS]\b)[^\W\d_]+)*"
_PARTICLE = r"(?:(?:von|van|zu|de|del|della|der|den|du|di|da|la|le|ter)\s+)*"
_ANNOUNCED = re.compile(rf"(?<!\w)({_TITLE}(?:(?:\.\s*|\s+|\.?-)(?:{_TITLE}|{_DEGREE}))*)(?:\.\s*|\s+){_PARTICLE}(?={_NAME})")
_PART = re.compile(_NAME)
#: An initial has its full stop, other parts only white space before the next part.
_BETWEEN = re.compile(rf"(\.?\s*|\s+)({_PARTICLE})(?!{_TITLE})(?={_NAME})")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Names behind a title, besides initials.
MOST_NAMES = 3
#: Given names by script and gender; other scripts use the Latin ones.
_GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Erik Felix Georg Hugo Ivan Jonas Kevin Luis Marco Nils Oscar Paul".split(),
    ("latin", "f"): "Anna Berta Clara Diana Emma Flora Greta Hanna Irene Julia Karin Lara Maria Nora Olga Paula".split(),
    ("latin", "n"): "Alex Andrea Billie Chris Dana Eden Jamie Kim Lee Logan Max Noel Robin Sam Toni Val".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Денис Егор Иван Олег Павел".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Ольга Яна".split(),
    ("cyrillic", "n"): "Саша Женя Валя Слава".split(),
}
_SYLLABLES = {
    "latin": "ba be bo da de do ga ge ka ke ko la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se ta te".split(),
    "cyrillic": "ба бе бо да де до га ка ке ко ла ле ли ло ма ме ми мо на не но па пе ра ре ри ро са се та те ви".split(),
}


@dataclass(frozen=True)
class Found:
    """An entity in a text. ``value`` is the same for all spellings of one entity."""

    start: int
    end: int
    kind: str
    value: str


def _luhn(digits: str) -> int:
    """The check digit behind ``digits``."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def _iban_check(country: str, account: str) -> str:
    """The check digits of an account number."""
    number = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{98 - int(number) % 97:02d}"


def _accounts(text: str) -> Iterator[Found]:
    """Account numbers with right check digits, without groups behind them that are not theirs."""
    for m in _IBAN.finditer(text):
        parts = m[0].split(" ")
        for n in range(len(parts), 0, -1):
            shown = " ".join(parts[:n])
            value = shown.replace(" ", "")
            if len(value) >= 15 and _iban_check(value[:2], value[4:]) == value[2:4]:
                yield Found(m.start(), m.start() + len(shown), "iban", value)
                break


def _emails(text: str) -> Iterator[Found]:
    at = text.find("@")
    while at >= 0:
        local, domain = _LOCAL.search(text[max(0, at - 64) : at]), _DOMAIN.match(text, at)
        if local and domain:
            start = at - len(local[0])
            yield Found(start, domain.end(), "email", text[start : domain.end()].lower())
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[Found]:
    """IPv6 addresses with a digit, so that the scope operator between words is none."""
    for m in _IP6.finditer(text):
        shown = m[0] if m[0].endswith("::") else m[0].rstrip(":")
        try:
            value = str(ipaddress.IPv6Address(shown))
        except ValueError:
            continue
        if any(c.isdigit() for c in shown):
            yield Found(m.start(), m.start() + len(shown), "ip", value)


def _announced_phones(text: str) -> Iterator[Found]:
    for m in _PLAIN.finditer(text):
        digits = _digits(m[0])
        if 7 <= len(digits) <= 15 and _PHONE_WORD.search(text[max(0, m.start() - _NEAR) : m.start()]):
            yield Found(m.start(), m.end(), "phone", digits)


def _cards(text: str) -> Iterator[Found]:
    """Cards with a right check digit, also among other numbers such as expiry dates.

    A card begins and ends where groups of digits do. Where several readings of a run are
    right, those of known issuers go first, then longer ones, then earlier ones.
    """
    for run in _RUN.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, *run.span())]
        right = []
        for i, (start, _) in enumerate(groups):
            value = ""
            for a, end in groups[i : i + 19]:
                value += text[a:end]
                if len(value) > 19:
                    break
                if len(value) >= 13 and _luhn(value[:-1]) == int(value[-1]):
                    right.append((_ISSUED.fullmatch(value) is None, -len(value), start, end, value))
        taken: list[tuple[int, int]] = []
        for _, _, start, end, value in sorted(right):
            place = bisect.bisect(taken, (start, end))
            before, behind = taken[place - 1 : place], taken[place : place + 1]
            if (not before or before[0][1] <= start) and (not behind or end <= behind[0][0]):
                taken.insert(place, (start, end))
                yield Found(start, end, "card", value)


def _numbers(text: str, pattern: re.Pattern[str], kind: str, fits: Callable[[str], bool]) -> Iterator[Found]:
    for m in pattern.finditer(text):
        value = m[0] if kind == "ip" else _digits(m[0])
        if fits(value):
            yield Found(m.start(), m.end(), kind, value)


def _titled(text: str) -> Iterator[tuple[str, list[re.Match[str]]]]:
    """Gender and the parts of each name behind titles, the family name last."""
    words: set[str] | None = None
    for m in _ANNOUNCED.finditer(text):
        part = _PART.match(text, m.end())
        if not part[0][0].isupper():
            continue
        parts, full = [part], len(part[0]) > 1
        while full < MOST_NAMES:
            between = _BETWEEN.match(text, part.end())
            if between is None:
                break
            initial, gap = len(part[0]) == 1, between[1]
            part = _PART.match(text, between.end())
            if not part[0][0].isupper() or (gap.strip() or not gap) and not (initial and gap):
                break
            if "\n" in gap:
                words = {p[0] for p in _PART.finditer(text)} if words is None else words  # read once
                if gap.count("\n") > 1 or part[0].lower() in words:
                    break  # a word that begins the next line
            parts.append(part)
            full += len(part[0]) > 1
            if full == MOST_NAMES:
                break
        genders = {_TITLES[t] for t in re.findall(_TITLE, m[1])} - {"n"}
        yield genders.pop() if len(genders) == 1 else "n", parts


def _settled(votes: Counter[str]) -> str:
    """The gender that most mentions give, "n" if none does."""
    return "n" if not votes["m"] and not votes["f"] else "m" if votes["m"] > votes["f"] else "f"


def _persons(text: str) -> Iterator[Found]:
    """Each name of a person is an entity of its own, so that "Mr X" and "Mr Y X" agree on X.

    Names behind a title are also found where they stand alone, as whole words that begin
    with a capital. A given name has the gender that its titles in the text say most often.
    """
    known: dict[str, set[str]] = {}
    votes: dict[str, Counter[str]] = {}
    roles: dict[int, tuple[int, str, str]] = {}
    for gender, parts in _titled(text):
        for part in parts:
            role, name = "family" if part is parts[-1] else "given", part[0].lower()
            roles[part.start()] = part.end(), role, name
            if len(name) > 1:
                known.setdefault(name, set()).add(role)
            if role == "given":
                votes.setdefault(name, Counter())[gender] += 1
    if not roles:
        return
    others = [m for m in _PART.finditer(text) if m[0][0].isupper()]
    spans = []
    for m in others:
        whole = m.start() in roles or m[0].lower() in known or "-" not in m[0]
        spans += [m] if whole else [p for p in _LETTERS.finditer(text, *m.span()) if p[0][0].isupper()]
    spans = [m for m in spans if m.start() in roles or m[0].lower() in known and _alone(text, m)]
    for m, behind in zip(spans, [*spans[1:], None]):
        end, role, name = roles.get(m.start(), (m.end(), "", m[0].lower()))
        if not role:
            # A given name where a family name follows, else a family name if it is one.
            follows = behind is not None and "family" in known.get(behind[0].lower(), ())
            follows = follows and text[m.end() : behind.start()].isspace()
            given = "given" in known[name] and (follows or "family" not in known[name])
            role = "given" if given else "family"
        part = f"given {_settled(votes[name])}" if role == "given" else role
        yield Found(m.start(), end, "person", f"{part} {_script(name)} {name}")


def _alone(text: str, m: re.Match[str]) -> bool:
    before, behind = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
    return not (before == "_" or before.isalnum() or behind == "_" or behind.isalnum())


def find(text: str) -> list[Found]:
    """The entities of a whole text in their order; earlier types win where spans overlap."""
    found: list[Found] = []

    def add(more: Iterator[Found]) -> None:
        """Keep the entities of a type and blank them out, all in one pass."""
        nonlocal text
        new = sorted(more, key=lambda f: f.start)
        if not new:
            return
        found.extend(new)
        parts, at = [], 0
        for f in new:
            if f.end > at:
                start = max(f.start, at)
                parts += [text[at:start], "\0" * (f.end - start)]
                at = f.end
        text = "".join([*parts, text[at:]])

    if "@" in text:
        add(_emails(text))
    add(_accounts(text))
    add(_cards(text))
    if ":" in text:
        add(_addresses(text))
    add(_numbers(text, _IP, "ip", lambda d: True))
    add(_numbers(text, _SSN, "ssn", lambda d: True))
    add(_numbers(text, _PHONE, "phone", lambda d: 7 <= len(d) <= 15))
    add(_announced_phones(text))
    add(_persons(text))
    return sorted(found, key=lambda f: f.start)


def permuted(number: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. ``size`` - 1: a Feistel network, walked until it is inside."""
    side = math.isqrt(max(size - 1, 0)) + 1
    while True:
        left, right = divmod(number, side)
        for turn in range(6):
            said = f"{turn}|{tweak}|{size}|{right}".encode()
            mixed = int.from_bytes(hashlib.shake_256(key + said).digest(side.bit_length() // 8 + 9), "big")
            left, right = right, (left + mixed) % side
        number = left * side + right
        if number < size:
            return number


def _number(digits: str, key: bytes, tweak: str) -> str:
    return str(permuted(int(digits), 10 ** len(digits), key, tweak)).zfill(len(digits)) if digits else ""


def _classes(text: str, key: bytes, tweak: str) -> str:
    """Letters become letters and digits become digits, all others stay."""
    sizes = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in text]
    number = 0
    for c, size in zip(text, sizes):
        at = ord(c) - ord("a") if size == 26 else ord(c) - ord("0") if size == 10 else 0
        number = number * size + at % size
    number = permuted(number, math.prod(sizes), key, tweak)
    made = []
    for c, size in zip(reversed(text), reversed(sizes)):
        number, at = divmod(number, size)
        made.append(chr(ord("a") + at) if size == 26 else str(at) if size == 10 else c)
    return "".join(reversed(made))


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """What stands for ``value``, in the form of ``value``."""
    tweak = f"{kind}|{attempt}"
    if kind == "card":
        body = value[0] + _number(value[1:-1], key, tweak)
        return body + str(_luhn(body))
    if kind == "iban":
        made = _classes(value[4:].lower(), key, f"{tweak}|{value[:2]}").upper()
        return value[:2] + _iban_check(value[:2], made) + made
    if kind == "ssn":
        made = value
        while True:  # the next number of the same cycle that can be given out
            made = _number(made, key, tweak)
            if _SSN.fullmatch(f"{made[:3]}-{made[3:5]}-{made[5:]}"):
                return made
    if kind == "phone":
        kept = max(0, len(value) - 10)
        tail = value[kept:]
        first, rest = divmod(int(tail), 10 ** (len(tail) - 1))
        if first > 1:  # a number that does not begin with 0 or 1 goes to another one
            return value[:kept] + str(permuted(int(tail) - 2 * 10 ** (len(tail) - 1), 8 * 10 ** (len(tail) - 1), key, tweak) + 2 * 10 ** (len(tail) - 1))
        return value[:kept] + str(first) + _number(tail[1:], key, tweak)
    if kind == "ip" and ":" in value:
        return str(ipaddress.IPv6Address(permuted(int(ipaddress.IPv6Address(value)), 1 << 128, key, tweak)))
    if kind == "ip":
        a, b, c, d = map(int, value.split("."))
        n = permuted((a << 24) + (b << 16) + (c << 8) + d, 1 << 32, key, tweak)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "email":
        local, _, domain = value.partition("@")
        name, _, top = domain.rpartition(".")
        local += "a" * max(0, attempt - 7)
        return f"{_classes(local, key, f'{tweak}|{domain}')}@{_classes(name, key, 'domain')}.{top}"
    part, *gender, script, name = value.split(" ")
    mixed = int.from_bytes(hashlib.blake2b(f"{tweak}|{value}".encode(), key=key, digest_size=8).digest(), "big")
    if part == "given":
        first = [n for n in _GIVEN.get((script, gender[0]), _GIVEN["latin", "n"]) if not name.startswith(n.lower())]
        mixed, at = divmod(mixed, len(first))
        return f"given {gender[0]} {script} {first[at].lower()}{_spelled(mixed, script, 4 + attempt // 8)}"
    return f"family {script} {_spelled(mixed, script, 6 + attempt // 8)}"


def _spelled(number: int, script: str, parts: int) -> str:
    made = []
    for _ in range(parts):
        number, at = divmod(number, len(_SYLLABLES[script]))
        made.append(_SYLLABLES[script][at])
    return "".join(made)


def dressed(kind: str, made: str, shown: str) -> str:
    """The surrogate in the spelling of the entity: separators, capitals."""
    if kind == "iban":
        signs = iter(made)
        return "".join(c if c == " " else next(signs) for c in shown)
    if kind in ("card", "phone", "ssn"):
        digits = iter(made)
        return "".join(next(digits) if "0" <= c <= "9" else c for c in shown)
    if kind == "person":
        name = made.rsplit(" ", 1)[1]
        if len(shown) == 1:
            return next(c for c in name if c != shown.lower()).upper()
        return name.upper() if len(shown) > 1 and shown.isupper() else name.capitalize()
    return made.upper() if kind == "email" and shown.isupper() else made


def replaced(text: str, key: bytes, moves: dict[str, dict]) -> tuple[str, Counter[str]]:
    """``text`` with surrogates, and how many entities of each type it had.

    ``moves`` has ``value`` and ``attempt`` of entities that don't keep their first surrogate:
    contested ones, and names whose gender the corpus settles in another way than the text.
    """
    parts, at, counts = [], 0, Counter()
    for f in find(text):
        move = moves.get(f"{f.kind}|{f.value}") or {"value": f.value, "attempt": 0}
        made = surrogate(f.kind, move["value"], key, move["attempt"])
        parts += [text[at : f.start], dressed(f.kind, made, text[f.start : f.end])]
        at = f.end
        counts[f.kind] += 1
    return "".join([*parts, text[at:]]), counts


def _occurrences(docs: DataFrame, text: str) -> DataFrame:
    """``hash`` of the text, ``kind`` and ``value`` of the entities of all texts."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, kind, value)
                for i, t in enumerate(batch.column(1))
                for kind, value in dict.fromkeys((f.kind, f.value) for f in find(t.as_py()))
            ]
            places, kinds, values = zip(*rows) if rows else ((), (), ())
            owner = batch.column(0).take(pa.array(places, pa.int64()))
            columns = [owner, pa.array(kinds, pa.string()), pa.array(values, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "kind", "value"])

    rows = docs.filter(F.col(text).isNotNull()).select(F.sha2(text, 256).alias("hash"), F.col(text).alias("text"))
    return rows.mapInArrow(found, "hash string, kind string, value string")


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["kind"], batch["value"], batch["attempt"])
            yield batch.assign(made=[surrogate(k, v, key, a) for k, v, a in rows])

    return entities.mapInPandas(made, "kind string, value string, attempt int, made string")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``value``, ``attempt`` and ``made`` of all different entities.

    Checked over the whole corpus: no two entities of a type share a surrogate, and none is a
    real value of the corpus. Who loses tries again; each round has only the losers, and
    surrogates once given stay. The first by value keeps a contested surrogate. From the eighth
    attempt on, addresses and names grow longer, so that their room cannot run out; it fails
    after ``ATTEMPTS`` rounds, when most numbers of a format are real ones.
    """
    real = settle(entities.distinct(), "entities")
    taken, waiting = None, real.withColumn("attempt", F.lit(0))
    for _ in range(ATTEMPTS):
        tried = settle(_with_surrogates(waiting, key), "tried")
        first = tried.groupBy("kind", "made").agg(F.min("value").alias("value"))
        free = first.join(real.select("kind", F.col("value").alias("made")), ["kind", "made"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("kind", "made"), ["kind", "made"], "left_anti")
        won = tried.join(free, ["kind", "value", "made"], "left_semi")
        won = settle(won if taken is None else taken.unionByName(won), "taken")
        lost = settle(tried.join(won, ["kind", "value"], "left_anti"), "lost")
        taken = won
        if lost.isEmpty():
            return taken
        waiting = lost.select("kind", "value", (F.col("attempt") + 1).cast("int").alias("attempt"))
    raise RuntimeError("some formats have no free surrogates left")


def _one_gender(seen: DataFrame) -> DataFrame:
    """``value`` and ``settled`` of given names that the corpus gives another gender than a text."""
    part = lambda n: F.split("value", " ")[n]
    given = seen.filter((F.col("kind") == "person") & F.col("value").startswith("given ")).select(
        "value", part(1).alias("gender"), part(2).alias("script"), part(3).alias("name")
    )
    says = lambda g: F.count_if(F.col("gender") == g)
    settled = given.groupBy("script", "name").agg(
        F.when((says("m") == 0) & (says("f") == 0), "n").when(says("m") > says("f"), "m").otherwise("f").alias("most")
    )
    other = given.distinct().join(settled, ["script", "name"]).filter("gender <> most")
    return other.select(
        F.lit("person").alias("kind"), "value", F.concat_ws(" ", F.lit("given"), "most", "script", "name").alias("settled")
    )


def replace_pii(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with its texts rewritten, and ``pii_counts``, a map from type to entities.

    E-mail addresses, account numbers (IBAN) and payment cards with right check digits, IP
    addresses (4 and 6), social security numbers of the form 3-2-4, phone
    numbers (7 to 15 digits: behind + or 00, North American 3-3-4, national ones with a leading
    0 and a separator behind the area, and any form right behind a word such as "phone") and
    names behind a title are replaced, the latter also where they stand without one in the
    same text. A surrogate keeps type, format, length, script, top domain and the gender that
    a name's titles give most often in the corpus; the same entity has the same surrogate
    everywhere and different entities have different ones. Whoever has the secret ``key``
    can tell which is which; runs with the same key agree but for contested surrogates.

    An initial gets another letter and nothing more: the letters are too few to be kept apart.
    Work on a text grows in proportion to its length and its entities, however long it is.

    A NULL text stays NULL with an empty map; texts without entities are returned unchanged.
    Repeated rows are rewritten alike. An empty table gives an empty result. Other columns
    are passed through; one called ``pii_counts`` is replaced.
    """
    docs = docs.drop("pii_counts")
    seen = settle(_occurrences(docs, text), "occurrences")
    seen = seen.join(settle(_one_gender(seen), "genders"), ["kind", "value"], "left")
    seen = seen.withColumn("settled", F.coalesce("settled", "value"))
    given = assign(seen.select("kind", F.col("settled").alias("value")), key)
    contested = given.filter("attempt > 0").select("kind", F.col("value").alias("settled"), "attempt")
    moved = seen.join(contested, ["kind", "settled"], "left").filter("attempt is not null or settled <> value")
    move = F.struct(F.col("settled").alias("value"), F.coalesce("attempt", F.lit(0)).alias("attempt"))
    name = F.concat_ws("|", "kind", "value")
    moves = settle(
        moved.groupBy("hash").agg(
            F.map_from_entries(F.collect_set(F.struct(name.alias("name"), move.alias("move")))).alias("moves")
        ),
        "moves",
    )
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    row = F.struct(F.lit(True).alias("__row"), *others).alias("row")
    rows = docs.select(row, F.col(text).alias("text"), F.sha2(text, 256).alias("hash"))
    rows = rows.join(moves, "hash", "left").select("row", "text", "moves")

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for t, moves in zip(batch.column(1), batch.column(2)):
                value = t.as_py()
                new, found = (None, {}) if value is None else replaced(value, key, dict(moves.as_py() or ()))
                texts.append(new)
                counts.append(sorted(found.items()))
            columns = [batch.column(0), pa.array(texts, pa.string())]
            columns.append(pa.array(counts, pa.map_(pa.string(), pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "pii_counts"])

    schema = StructType(
        [
            StructField("row", rows.schema["row"].dataType, False),
            StructField("text", StringType()),
            StructField("pii_counts", MapType(StringType(), LongType())),
        ]
    )
    new = rows.mapInArrow(rewritten, schema)
    kept = [F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    return new.select(*kept, "pii_counts")
