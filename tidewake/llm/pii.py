"""Personal data and secrets replaced by keyed surrogates of the same type.

Detected entities are e-mail addresses, telephone numbers, IPv4 addresses, payment cards (issuer and
check digit), social security numbers, IBANs, access keys, assigned passwords and tokens, and people
named after a title; names of such people are found again in the same text without the title.  An
entity's surrogate depends on its canonical form and the key alone, so every mention of it in any
document gets the same one.  Strings with a format are moved by a keyed permutation of all strings of
that format: letters stay letters of their case, digits digits, check digits are recomputed; the
domain of an address moves on its own.  Given and family names are mapped apart, word by word, so that
``Mr. Smith`` and ``Mr. John Smith`` share what they share; given names follow the gender of the title.
A title without a gender takes the gender that the name has elsewhere in the table, if it has one alone.

The distinct entities of the whole table are checked: where two of one type meet in one surrogate, or
a surrogate is itself an entity of the table, all but the first take their next attempt until none is
left.  After ``IN_FORMAT`` attempts a surrogate gets a further character with each, so that a format
whose strings are all taken ends, too.  Exceptions of that kind are few; up to ``BROADCAST_EXCEPTIONS``
reach the tasks as a broadcast, more of them by a join on a digest of those texts that hold one.

The key comes from ``surrogate_key``; whoever has it can undo the permutations.

Edge cases: null text stays null with no entity; empty tables give empty results; very long texts are
searched whole; repeated rows get equal surrogates, whatever their ``doc_id``; of overlapping entities
the first type of ``PATTERNS`` wins, of one type the leftmost; other columns travel in a struct, so their
names may be any.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import secrets
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewake.llm.common import at_work, checkpointed, documents, marked, small_batches
from tidewake.llm.feistel import permute

KEY_CONF = "spark.tidewake.surrogate.key"
BROADCAST_EXCEPTIONS = 50_000
IN_FORMAT = 4
CACHED = 100_000

# Titles with the gender that they name, and given names to draw from.
TITLES = {
    "Mr": "m", "Mr.": "m", "Herr": "m", "Monsieur": "m", "M.": "m", "Señor": "m", "Sr.": "m", "господин": "m", "Господин": "m",
    "Mrs": "f", "Mrs.": "f", "Ms": "f", "Ms.": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mme.": "f", "Señora": "f", "Sra.": "f", "госпожа": "f", "Госпожа": "f",
    "HERR": "m", "MONSIEUR": "m", "SEÑOR": "m", "FRAU": "f", "MADAME": "f", "SEÑORA": "f", "Dr": "n", "Dr.": "n", "Prof.": "n", "Professor": "n",
}
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Noel", "Oscar", "Paul"),
    ("latin", "f"): ("Alma", "Berta", "Clara", "Diana", "Elsa", "Flora", "Greta", "Helena", "Irma", "Julia", "Karla", "Laura", "Marta", "Nora", "Olga", "Paula"),
    ("latin", "n"): ("Alexis", "Camille", "Charlie", "Dominique", "Eden", "Kim", "Robin", "Sascha"),
    ("cyrillic", "m"): ("Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Павел"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Ирина", "Мария"),
    ("cyrillic", "n"): ("Валя", "Женя", "Саша", "Слава"),
    ("greek", "m"): ("Ανδρέας", "Γιώργος", "Δημήτρης", "Νίκος"), ("greek", "f"): ("Άννα", "Ελένη", "Μαρία", "Σοφία"), ("greek", "n"): ("Άρης", "Φώτης"),
    ("arabic", "m"): ("أحمد", "حسن", "خالد", "عمر"), ("arabic", "f"): ("سارة", "فاطمة", "ليلى", "مريم"), ("arabic", "n"): ("نور", "صباح"),
    ("han", "m"): ("伟", "强"), ("han", "f"): ("芳", "丽"), ("han", "n"): ("文", "宁"),
}
_SYLLABLES = {
    "latin": [a + b for a in "bdfgklmnprstvz" for b in ("a", "e", "i", "o", "u", "an", "el", "or")],
    "cyrillic": [a + b for a in "бвгдзклмнпрст" for b in ("а", "е", "и", "о", "у", "ан", "ел", "ор")],
    "greek": [a + b for a in "βγδζθκλμνπρτφ" for b in ("α", "ε", "ι", "ο", "ου", "αν", "ελ", "ορ")],
    "arabic": [a + b for a in "بتدرسفقكلمن" for b in ("ا", "و", "ي", "ان", "ير")],
    "han": list("安白包常陈程崔戴邓丁董杜段范方冯高葛龚顾郭韩郝何贺侯胡黄贾江姜蒋金康孔赖雷黎李梁廖林刘龙卢陆罗吕马毛孟莫倪"),
}

#: Lengths of IBANs by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23,
    "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31,
    "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
_TITLES = "(?:" + "|".join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True)) + ")"
# A name goes on to the end of its word, but for a genitive; scripts without spaces or case have a few characters or words.
_NAME = rf"(?!{_TITLES}\s)[\p{{Lu}}\p{{Lt}}]\p{{M}}*+(?=[\w'’])(?:[\w\p{{M}}]|['’](?![sS](?!\w))(?=\p{{L}}))*+"
_INITIAL = rf"(?!{_TITLES}\s)[\p{{Lu}}\p{{Lt}}]\p{{M}}*+(?:\.[ \-]?|[ ])"
_UNCASED = r"\p{Han}{1,4}+|\p{Hangul}{1,5}+|[\p{Hiragana}\p{Katakana}ー・]{1,12}+|\p{Lo}[\w\p{M}]++(?:[ ]\p{Lo}[\w\p{M}]++)?"
#: Words that a secret is assigned to, in the languages of the titles, and keys that tell by their first characters what they open.
_ASSIGNED = r"password|passwd|pwd|passwort|kennwort|mot de passe|contraseña|secret|token|api[_\-]?key|access[_\-]?key"
_KEY = r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_\-]{20,}|xox[abpr]-[A-Za-z0-9\-]{10,}|AIza[A-Za-z0-9_\-]{30,}|eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{4,})"
_KEYS = re.compile(rf"(?=(?P<head>AKIA|ASIA|gh[pousr]_|sk-|xox[abpr]-|AIza|eyJ)){_KEY}")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"),
    "secret": re.compile(
        rf"(?i:(?:{_ASSIGNED})\s*(?:[=:]|(?:is|ist|est|es)\s)\s*[\"']?)(?=[A-Za-z+/_\-]*[0-9])([A-Za-z0-9+/_\-]{{6,}})|(?i:(?:password|passwd|pwd|passwort|kennwort)=[\"']?)([A-Za-z0-9+/_\-]{{6,}})|(?<![A-Za-z0-9_\-])({_KEY})(?![A-Za-z0-9_\-])"
    ),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b"),
    "card": re.compile(r"(?<![0-9A-Za-z.])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])"),
    "ssn": re.compile(r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"),
    "ip": re.compile(r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?)?\([0-9]{2,4}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}(?![0-9])|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .\-]?[0-9]{1,4}){2,6}(?![0-9])|(?<![0-9.\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9])"
        r"|(?<![0-9A-Za-z.])0[1-9](?:[ .\-][0-9]{2}){4}(?![0-9])|(?<![0-9A-Za-z.])01[5-7][0-9]{1,2}[ ][0-9]{7,8}(?![0-9])|(?<![0-9A-Za-z.])0[1-9][0-9]{1,3}[\-/][0-9]{6,8}(?![0-9])|(?<=(?i:[Ttl]el|one|fax|bil)[.: ])[.: ]{0,2}0[1-9][0-9]{1,3}[ \-/]?[0-9]{3,4}[ ]?[0-9]{3,5}(?![0-9])"),
    "person": regex.compile(rf"(?<!\w){_TITLES}\s+((?:{_INITIAL}){{0,3}}{_NAME}(?:[ \-](?:{_INITIAL}){{0,3}}{_NAME}){{0,2}}|{_UNCASED})"),
}
#: Country codes of two digits; 1 and 7 have one, all others three.
_TWO_DIGIT_CODES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Issuers of payment cards by their first digits, with the lengths of their numbers.
_ISSUER = re.compile(
    r"4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}|3(?:0[0-5]|[689]\d)\d{11,13}"
    r"|35(?:2[89]|[3-8]\d)\d{12,15}|6(?:011|4[4-9]\d|5\d\d)\d{12,15}|62\d{14,17}|(?:50|5[6-9]|6[0-9])\d{10,17}"
)
_VERSION = re.compile(r"(?i)(?:\bv|\bver|version|release|firmware|build)[.:]?\s*$")
_MARKS = re.compile(r"[0-9@]")
_SECRET_WORDS = ("password", "passwd", "pwd", "passwort", "kennwort", "mot de passe", "contraseña", "secret", "token", "key", "akia", "asia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox", "aiza", "eyj")
_TITLE = re.compile("|".join(re.escape(t) + r"\s" for t in sorted(TITLES, key=len, reverse=True)))


def _kept_of_phone(form: str) -> int:
    """How many first characters say what a number is: a country's code, a national zero, or a range of mobile numbers."""
    if form.startswith("+"):
        return 2 if form[1] in "17" else 3 if form[1:3] in _TWO_DIGIT_CODES else 4
    return 3 if re.match("01[5-7]", form) else 1 if form.startswith("0") else 0


def _luhn(digits: str) -> int:
    """What the check digit after these digits has to be."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d)
    return -total % 10


def _iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _valid(kind: str, found: str) -> bool:
    if kind == "card":
        digits = re.sub(r"\D", "", found)
        return _ISSUER.fullmatch(digits) is not None and _luhn(digits[:-1]) == int(digits[-1])
    if kind == "iban":
        plain = found.replace(" ", "")
        return len(plain) >= 15 and _iban_check(plain[:2], plain[4:]) == plain[2:4]
    if kind == "phone" and found.startswith("+"):
        return 8 <= sum(c.isdigit() for c in found) <= 15
    return True


def _ibans(text: str):
    """Matches of IBANs, as spans that end with a word: of the length of their country, else the longest that its check digits allow."""
    at = 0
    while m := PATTERNS["iban"].search(text, at):
        start, end = m.span()
        places = [i for i in range(start, end) if text[i] != " "]
        ends = [i + 1 for i in places[14:] if i + 1 == len(text) or not (text[i + 1].isalnum() or text[i + 1] == "_")]
        length = IBAN_LENGTHS.get(text[start : start + 2])
        if length is not None:
            ends = [e for e in ends if e == end or len(places) >= length and e == places[length - 1] + 1]
        found = [e for e in ends if _valid("iban", text[start:e])]
        exact = [e for e in found if length is not None and len(places) >= length and e == places[length - 1] + 1]
        if found:
            at = (exact or found[-1:])[0]
            yield start, at
        else:
            at = start + 1


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, canonical form)``, in order and without overlaps; the first type of ``PATTERNS`` wins."""
    kinds = []
    if _MARKS.search(text):
        kinds = ["email"] * ("@" in text) + ["iban", "card", "ssn", "ip", "phone"]
    low = text.lower()
    if any(w in low for w in _SECRET_WORDS):
        kinds.append("secret")
    if _TITLE.search(text):
        kinds.append("person")
    taken: list[tuple[int, int, str, str]] = []
    for kind in (k for k in PATTERNS if k in kinds):
        if kind == "iban":
            taken += [(a, b, kind, canonical(kind, text[a:b], text[a:b])) for a, b in _ibans(text) if not any(a < e and b > s for s, e, *_ in taken)]
            continue
        for m in PATTERNS[kind].finditer(text):
            group = m.lastindex or 0
            start, end = m.span(group)
            found = m[group]
            if kind == "phone":
                start, found = start + len(found) - len(found.lstrip(".: ")), found.lstrip(".: ")
            if kind == "ip" and _VERSION.search(text[max(0, start - 12) : start]):
                continue
            if _valid(kind, found) and not any(start < e and s < end for s, e, *_ in taken):
                taken.append((start, end, kind, canonical(kind, found, m[0])))
    if any(kind == "person" for _, _, kind, _ in taken):
        taken += _again(text, taken)
    return sorted(taken)


def _again(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Mentions of the people in ``taken`` without a title: given and family name, or one of them."""
    people = [(text[a:b], *form.split("|")[:2]) for a, b, kind, form in taken if kind == "person"]
    wanted: dict[str, str] = {}
    for name, script, gender in people:
        given, _, family = name.rpartition(" ")
        if len(family) > 2 and family[0].isupper():
            for part in (name, family):
                wanted.setdefault(part, f"{script}|{gender}|{_plain(part)}")
        if len(given) > 2 and given[0].isupper() and not given.endswith("."):
            wanted.setdefault(given, f"{script}|{gender}|{_plain(given)} ")
    if not wanted:
        return []
    listed = "|".join(re.escape(x) for x in sorted(wanted, key=len, reverse=True))
    more = []
    for m in re.finditer(rf"(?<!\w)(?:{listed})(?!\w)", text):
        if not any(m.start() < e and s < m.end() for s, e, *_ in taken):
            more.append((*m.span(), "person", wanted[m[0]]))
    return more


def _plain(name: str) -> str:
    """A name in lower case with single spaces; initials stand apart."""
    name = unicodedata.normalize("NFC", name).replace("’", "'").replace(".", ". ")
    return " ".join(name.split()).lower()


def canonical(kind: str, found: str, whole: str) -> str:
    """What mentions of one entity have in common; a person's begins with script and gender, a given name alone ends with a space."""
    if kind in ("email", "ip"):
        return found.lower()
    if kind == "phone":
        return ("+" if found.startswith("+") else "") + re.sub(r"\D", "", found)
    if kind in ("card", "ssn", "iban"):
        return re.sub(r"[ \-]", "", found)
    if kind == "person":
        title = whole[: len(whole) - len(found)].strip()
        return f"{_script(found)}|{TITLES[title]}|{_plain(found)}"
    return found


def _script(name: str) -> str:
    """The script of a name by its first letter; Latin for those that have no surrogates of their own."""
    return next((s for s in ("cyrillic", "greek", "arabic", "han") if regex.match(rf"\p{{{s}}}", name)), "latin")


_CLASSES = (("0123456789", str.isdigit), ("abcdefghijklmnopqrstuvwxyz", lambda c: "a" <= c <= "z"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", lambda c: "A" <= c <= "Z"))


def name_parts(form: str) -> list[tuple[str, str]]:
    """``(kind, form)`` of each word of a person: given names, then the family name; words with a hyphen are several."""
    script, gender, name = form.split("|")
    words = name.split()
    given = len(words) if name.endswith(" ") else len(words) - 1
    parts = []
    for i, word in enumerate(words):
        parts += [("given", f"{script}|{gender}|{x}") if i < given else ("family", f"{script}|{x}") for x in word.split("-") if x]
    return parts


def settled_apart(kind: str, form: str) -> list[tuple[str, str]]:
    """What the table is searched for collisions by: a person by the words of the name."""
    return name_parts(form) if kind == "person" else [(kind, form)]


class Surrogates:
    """Surrogates under one key; ``exceptions`` has those of other attempts than the first."""

    def __init__(self, key: bytes, exceptions: dict[tuple[str, str], str] | None = None):
        self.key, self.exceptions = key, exceptions or {}
        self.cache: dict[tuple[str, str, int], str] = {}

    def __call__(self, kind: str, form: str, attempt: int = 0) -> str:
        """The canonical form that takes the place of ``form``."""
        found = self.cache.get((kind, form, attempt))
        if found is None:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            found = self.cache[kind, form, attempt] = self._made(kind, form, attempt)
        return found

    def settled(self, kind: str, form: str, own: dict[tuple[str, str], str]) -> str:
        """The surrogate without collisions."""
        if kind == "person":
            return self._person(form, lambda k, f: self.settled(k, f, own))
        return own.get((kind, form)) or self.exceptions.get((kind, form)) or self(kind, form)

    def _number(self, text: str) -> int:
        return int.from_bytes(hashlib.blake2b(text.encode(), key=self.key).digest(), "big")

    def _moved(self, text: str, tweak: bytes, hexadecimal: bool = False) -> str:
        """``text`` under the keyed permutation of all strings with its pattern of classes."""
        if hexadecimal:
            alphabets = ["0123456789abcdef"] * len(text)
        else:
            alphabets = [next((a for a, of in _CLASSES if c.isascii() and of(c)), c) for c in text]
        value, n = 0, 1
        for c, alphabet in zip(text, alphabets, strict=True):
            value, n = value * len(alphabet) + alphabet.index(c), n * len(alphabet)
        classes = "".join(a[0] if len(a) > 1 else a for a in alphabets).encode()
        value = permute(value, n, self.key, tweak + classes) if n > 1 else value
        out = []
        for alphabet in reversed(alphabets):
            value, at = divmod(value, len(alphabet))
            out.append(alphabet[at])
        return "".join(reversed(out))

    def _more(self, kind: str, form: str, attempt: int, alphabet: str) -> str:
        """The characters by which a surrogate outgrows a format that is full."""
        number, out = self._number(f"{kind}:{attempt}:{form}"), ""
        for _ in range(attempt - IN_FORMAT):
            number, at = divmod(number, len(alphabet))
            out += alphabet[at]
        return out

    def _person(self, form: str, of) -> str:
        script, gender, name = form.split("|")
        parts = iter([of(k, f).rpartition("|")[2] for k, f in name_parts(form)])
        words = " ".join("-".join(next(parts) for x in word.split("-") if x) for word in name.split())
        return f"{script}|{gender}|{words}" + " " * name.endswith(" ")

    def _name(self, kind: str, form: str, attempt: int) -> str:
        head, _, word = form.rpartition("|")
        script = head.partition("|")[0]
        if len(word) == 2 and word.endswith(".") or len(word) == 1 and script == "latin":
            letter = self._moved(word[0], f"initial:{attempt}:".encode())
            return f"{head}|{letter}{word[1:]}{self._more(kind, form, attempt, _CLASSES[1][0])}"
        number, syllables = self._number(f"{kind}:{attempt}:{form}"), _SYLLABLES[script]
        made, count = "", 4 + max(0, attempt - IN_FORMAT)
        if kind == "given":
            names = GIVEN[script, head.partition("|")[2]]
            number, at = divmod(number, len(names))
            made, count = names[at].lower(), attempt
        for _ in range(count):
            number, at = divmod(number, len(syllables))
            made += syllables[at]
            number = number or self._number(made)
        return f"{head}|{made}"

    def _made(self, kind: str, form: str, attempt: int) -> str:
        tweak = f"{kind}:{attempt}:".encode()
        if kind == "person":
            return self._person(form, lambda k, f: self(k, f, attempt))
        if kind in ("given", "family"):
            return self._name(kind, form, attempt)
        more = self._more(kind, form, attempt, _CLASSES[1][0] if kind in ("email", "secret") else _CLASSES[0][0])
        if kind == "email":
            local, _, domain = form.partition("@")
            name, _, top = domain.rpartition(".")
            moved = self._moved(name, f"domain:{attempt or ''}:".encode())
            return f"{self._moved(local, tweak + domain.encode())}{more}@{moved}.{top}"
        if kind == "ip":
            number = int.from_bytes(bytes(map(int, form.split("."))), "big")
            return ".".join(map(str, permute(number, 1 << 32, self.key, tweak).to_bytes(4, "big"))) + more
        if kind == "card":
            kept = 1 if form[0] == "4" else 4
            digits = form[:kept] + self._moved(form[kept:-1], tweak) + more
            return digits + str(_luhn(digits))
        if kind == "iban":
            account = self._moved(form[4:], tweak) + more
            return form[:2] + _iban_check(form[:2], account) + account
        if kind == "phone":
            keep = _kept_of_phone(form)
            return form[:keep] + self._moved(form[keep:], tweak) + more
        if kind == "secret" and (head := _KEYS.fullmatch(form)):
            at = head.end("head")
            return form[:at] + self._moved(form[at:], tweak) + more
        mixed = kind == "secret" and re.fullmatch("[0-9a-f]+", form) is not None and not form.isdigit()
        return self._moved(form, tweak, hexadecimal=mixed) + more


def shaped(kind: str, found: str, form: str) -> str:
    """The surrogate ``form`` in the shape of the mention ``found``: its case and separators."""
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(found, form, strict=True)) if len(form) == len(found) else form
    if kind in ("phone", "card", "ssn", "iban"):
        fresh = iter(c for c in form if c not in "+-")
        return "".join(next(fresh) if c.isalnum() else c for c in found) + "".join(fresh)
    if kind == "person":
        name = form.rpartition("|")[2].strip()
        if found.isupper() and len(found) > 1:
            return name.upper()
        return re.sub(r"(?<!\w)\w", lambda m: m[0].upper(), name)
    return form


def _entity_column(text: Column) -> Column:
    @F.arrow_udf("array<struct<kind:string,form:string>>")
    def find(column: pa.Array) -> pa.Array:
        at_work("pii")
        kind = pa.list_(pa.struct([("kind", pa.string()), ("form", pa.string())]))
        found = [{x for _, _, k, f in entities(t.as_py() or "") for x in settled_apart(k, f)} for t in column]
        return pa.array([[{"kind": k, "form": f} for k, f in sorted(each)] for each in found], kind)

    return find(text)


def distinct_entities(docs: DataFrame) -> DataFrame:
    """``kind, form`` of every entity of the table, names word by word."""
    return docs.select(F.explode(_entity_column(F.col("text"))).alias("e")).select("e.kind", "e.form").distinct()


def _surrogates(key: bytes):
    @F.arrow_udf(StringType())
    def make(kind: pa.Array, form: pa.Array, attempt: pa.Array) -> pa.Array:
        of = Surrogates(key)
        return pa.array([of(*x) for x in zip(kind.to_pylist(), form.to_pylist(), attempt.to_pylist(), strict=True)], pa.string())

    return make


def attempts(known: DataFrame, key: bytes) -> DataFrame:
    """``kind, form, attempt, surrogate`` without collisions, for the distinct entities ``known``."""
    make = _surrogates(key)
    settled = checkpointed(known.withColumn("attempt", F.lit(0)).withColumn("surrogate", make("kind", "form", F.lit(0))))
    for _ in itertools.count():
        first = settled.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("attempt", "form")).alias("first")).filter("n > 1")
        twice = settled.join(first, ["kind", "surrogate"]).filter(F.struct("attempt", "form") > F.col("first")).select("kind", "form")
        real = settled.select("kind", F.col("form").alias("surrogate"))
        met = settled.join(real, ["kind", "surrogate"], "left_semi").select("kind", "form")
        again = checkpointed(twice.unionByName(met).distinct())
        if again.isEmpty():
            break
        redo = settled.join(again, ["kind", "form"], "left_semi").select("kind", "form", (F.col("attempt") + 1).alias("attempt"))
        redo = redo.withColumn("surrogate", make("kind", "form", "attempt"))
        settled = checkpointed(settled.join(again, ["kind", "form"], "left_anti").unionByName(redo))
    return _one_gender(settled)


def _one_gender(settled: DataFrame) -> DataFrame:
    """Given names after a title without a gender take the surrogate that the name has with its one gender; ``attempt`` is then -1."""
    script, gender, name = (F.split_part("form", F.lit("|"), F.lit(i)) for i in (1, 2, 3))
    given = settled.filter("kind = 'given'").select(script.alias("script"), gender.alias("gender"), name.alias("name"), F.col("surrogate").alias("other"))
    sure = given.filter("gender <> 'n'").groupBy("script", "name").agg(F.count(F.lit(1)).alias("n"), F.min("other").alias("other"))
    sure = sure.filter("n = 1").select(F.lit("given").alias("kind"), F.concat_ws("|", "script", F.lit("n"), "name").alias("form"), "other")
    of = settled.join(sure, ["kind", "form"], "left")
    return of.select("kind", "form", F.when(F.col("other").isNotNull(), -1).otherwise(F.col("attempt")).alias("attempt"), F.coalesce("other", "surrogate").alias("surrogate"))


def surrogate_key(spark: SparkSession) -> bytes:
    """The key in ``KEY_CONF``; where that is unset a fresh one, which nobody can use again."""
    given = spark.conf.get(KEY_CONF, None)
    return given.encode()[:64] if given else secrets.token_bytes(32)


def _replacer(of: Surrogates):
    def replace(text: str | None, own: dict[tuple[str, str], str]) -> tuple[str | None, list[str]]:
        if text is None:
            return None, []
        out, at, kinds = [], 0, []
        for start, end, kind, form in entities(text):
            out += [text[at:start], shaped(kind, text[start:end], of.settled(kind, form, own))]
            at = end
            kinds.append(kind)
        return ("".join([*out, text[at:]]) if kinds else text), kinds

    return replace


_OWN = "array<struct<kind:string,form:string,surrogate:string>>"


def replaced(docs: DataFrame, key: bytes, broadcast_limit: int = BROADCAST_EXCEPTIONS) -> DataFrame:
    """``doc`` (all columns of ``docs``), ``new_text`` and ``kinds`` of the entities replaced, for every row."""
    spark = docs.sparkSession
    with small_batches(spark):
        settled = attempts(distinct_entities(docs), key)
    exceptions = checkpointed(settled.filter("attempt <> 0").select("kind", "form", "surrogate"))
    rows = docs.select(F.struct("*").alias("doc"))
    few = exceptions.limit(broadcast_limit + 1).collect()
    if len(few) <= broadcast_limit:
        common = {(r["kind"], r["form"]): r["surrogate"] for r in few}
        rows = rows.withColumn("own", F.lit(None).cast(_OWN))
    else:
        common = {}
        digest = F.sha2(F.col("doc.text").cast("binary"), 256)
        wanted = rows.select(digest.alias("digest"), F.explode(_entity_column(F.col("doc.text"))).alias("e")).select("digest", "e.kind", "e.form").distinct()
        own = checkpointed(wanted.join(exceptions, ["kind", "form"]).groupBy("digest").agg(F.collect_list(F.struct("kind", "form", "surrogate")).alias("own")))
        # Texts without an exception stay where they are.
        found = marked(rows, own.select(F.xxhash64("digest").alias("id")), F.xxhash64(digest))
        met = found.filter("_marked").withColumn("digest", digest).join(own, "digest", "left").select("doc", "own")
        rows = found.filter("not _marked").select("doc", F.lit(None).cast(_OWN).alias("own")).unionByName(met)
    shared = spark.sparkContext.broadcast(common)
    held: list[Surrogates] = []

    @F.arrow_udf("struct<text:string,kinds:array<string>>")
    def replace(texts: pa.Array, owns: pa.Array) -> pa.Array:
        if not held:
            at_work("pii", held.clear)
            held.append(Surrogates(key, shared.value))
        of = _replacer(held[0])
        found = [of(t.as_py(), {(e["kind"], e["form"]): e["surrogate"] for e in o.as_py() or ()}) for t, o in zip(texts, owns, strict=True)]
        return pa.StructArray.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([k for _, k in found], pa.list_(pa.string()))], ["text", "kinds"])

    return rows.select("doc", replace("doc.text", "own").alias("new")).select("doc", F.col("new.text").alias("new_text"), "new.kinds")


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """The columns of ``docs`` with the new text, and ``n_chars`` brought in line where it is there."""

    def column(name: str) -> Column:
        if name == "text":
            return F.col("new_text").alias("text")
        if name == "n_chars":
            return F.length("new_text").cast("long").alias("n_chars")
        return F.col("doc")[name].alias(name)

    return replaced(docs, key).select(*[column(c) for c in docs.columns])


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replaced(documents(spark, sf_dir), surrogate_key(spark))
    return out.select(F.col("doc.doc_id").alias("doc_id"), F.col("new_text").alias("text"), F.size("kinds").cast("long").alias("n_entities"), F.array_sort(F.array_distinct("kinds")).alias("kinds"))
