"""Personal data and secrets replaced by keyed surrogates of the same type and format."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.blocks import text_blocks, unused
from logweave.session import kept_table, materialize

# Titles that a name follows, by gender.
MALE = ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "г-н", "господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "г-жа", "госпожа"]
NEUTRAL = ["Dr", "Prof"]
# Given names for surrogates, by script and gender.
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo"],
    ("latin", "f"): ["Alma", "Berta", "Clara", "Dora", "Emma", "Frida", "Greta", "Helga", "Ida", "Julia", "Klara", "Lena"],
    ("latin", ""): ["Alex", "Chris", "Jamie", "Kim", "Lou", "Nicky", "Robin", "Sam", "Toni", "Val"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Лев", "Олег", "Павел", "Роман"],
    ("cyrillic", "f"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лидия", "Ольга", "Полина", "Раиса"],
    ("cyrillic", ""): ["Женя", "Саша", "Валя", "Слава", "Шура"],
}

# attempts that keep the form of an entity
SAME_FORM = 8
HEX = "0123456789abcdef"

_upper = "A-ZÀ-ÖØ-ÞА-ЯЁ"
_octet = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_ip = rf"(?P<ip>(?<![\d.])(?:{_octet}\.){{3}}{_octet}(?!\.?\d))"
_ssn = r"(?P<ssn>(?a:(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])))"
_phone = r"""(?P<phone>(?a:(?<![\d(])(?:\+\d{1,3}[\ .-]?)?\(?\d{3}\)?[\ .-]\d{3}[\ .-]\d{4}(?!\d)
      |\+\d{1,3}(?:[\ .-]?\d{2,4}){2,5}(?!\d)))"""
FIND = re.compile(
    rf"""
    (?P<key>\bAKIA[0-9A-Z]{{16}}\b)
  | (?P<label>(?i:password|passwd|pwd|token|secret|api[_-]?key)\b(?:\\*["'])?\s*[=:]\s*(?:\\*["'])?)(?P<secret>[^\s"',;]{{6,}})
  | (?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})
  | (?P<iban>\b[A-Z]{{2}}[0-9]{{2}}(?:\ ?[A-Z0-9]{{4}}){{2,7}}(?:\ ?[A-Z0-9]{{1,3}})?\b)
  | {_ip}
  | (?P<card>(?a:(?<!\d)\d(?:[\ -]?\d){{12,18}}(?!\d)))
  | {_ssn}
  | {_phone}
  | \b(?P<title>{"|".join(MALE + FEMALE + NEUTRAL)})\.?\ +(?P<name>[{_upper}][\w'’-]+(?:\ +[{_upper}][\w'’-]+)?)
    """,
    re.X,
)
SEPARATOR = re.compile("[ -]")
PART = re.compile(r"\w+")
WORD = re.compile(r"\w+(?:['’-]\w+)*")
POSSESSIVE = re.compile(r"['’][sS]$")
# what a run of digit groups may hold besides a card
GROUPED = re.compile(rf"{_ip}|{_ssn}|{_phone}", re.X)
# what a text must have for any of these; the JVM reads it, so each place is settled by its first character
SUSPECT = "[0-9@=:]|[{}](?:{})[.]? ".format(
    "".join(sorted({t[0] for t in MALE + FEMALE + NEUTRAL})), "|".join(sorted({t[1:] for t in MALE + FEMALE + NEUTRAL}))
)


def luhn(digits: str) -> int:
    """Sum modulo 10 of a card number; 0 for a valid one."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "")
    return "cyrillic" if name.startswith("CYRILLIC") else "latin"


def _valid(kind: str, value: str) -> bool:
    """Whether a card or an IBAN, without separators, has a right check digit."""
    return _iban_rest(value) == 1 if kind == "iban" else not luhn(value) and len(set(value)) > 1


def _checked(text: str, start: int, end: int, kind: str, again: bool) -> tuple[str, int]:
    """Kind and end of the entity at the start of a run of groups that looks like a card or an IBAN; no kind, and the
    end of the first group, if there is none.

    The run may hold more than one entity, so its beginnings up to a separator are tried too, the longest first. An SSN
    or phone at its start comes before a card, and no card ends within another entity. All groups but the last
    of a shorter card, and of one that begins behind another group (``again``), have four digits at least.
    """
    ends = [m.start() for m in SEPARATOR.finditer(text, start, end)] + [end]
    inner = [] if kind == "iban" else [m for s in [start, *[e + 1 for e in ends[:-1]]] if (m := GROUPED.match(text, s))]
    if inner and inner[0].start() == start:
        return inner[0].lastgroup, inner[0].end()
    least = 15 if kind == "iban" else 13
    for place in range(len(ends) - 1, -1, -1):
        value = SEPARATOR.sub("", text[start : ends[place]])
        if len(value) < least:
            break
        shorter = kind == "card" and (again or ends[place] < end)
        if shorter and any(b - a < 5 for a, b in zip([start - 1, *ends], ends[:place], strict=False)):
            continue
        if _valid(kind, value) and not any(m.start() < ends[place] < m.end() for m in inner):
            return kind, ends[place]
    return "", ends[0]


def _name_words(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of words as names are made of: whole ones, without a possessive ending, and their parts."""
    for m in WORD.finditer(text):
        end = m.end() - (2 if POSSESSIVE.search(m[0]) else 0)
        yield m.start(), end
        if not text[m.start() : end].isalnum():
            yield from (part.span() for part in PART.finditer(text, m.start(), end))


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and canonical value of all entities of a text, in order and without overlap.

    Spellings of one entity have one canonical value: digits alone for numbers, the last ten for phones,
    lower case for addresses and names. A name's words are entities of their own, so a surname by itself is the same as
    behind a given name. Names are found behind titles; their words are then names wherever else they stand as
    capitalised words, unless the text has such a word more often in lower case ("Rodeo Dr. The"). Long numbers are cards, and IBANs are such, only with a right check digit; what stands
    next to them is searched by itself.
    """
    found = list(_found(text))
    kinds: dict[str, str] = {}
    for _, _, kind, value in found:
        if kind.startswith(("given", "surname")):
            kinds.setdefault(value, kind)
    if not kinds:
        return found
    small, others = Counter(), []
    ends, starts = [e[1] for e in found], [e[0] for e in found]
    last = 0
    for start, end in _name_words(text):
        value = text[start:end].lower()
        if value not in kinds or start < last:
            continue
        if not text[start].isupper():
            small[value] += 1
        elif bisect_right(ends, start) == bisect_left(starts, end):  # no entity is there
            others.append((start, end, kinds[value], value))
            last = end
    large = Counter(e[3] for e in found) + Counter(e[3] for e in others)
    return sorted(found + [e for e in others if small[e[3]] <= large[e[3]]])


def _found(text: str) -> Iterator[tuple[int, int, str, str]]:
    """The entities whose form or title shows them."""
    at, run = 0, 0  # run: the end of the run of groups that the last match began
    while m := FIND.search(text, at):
        kind, (start, at) = m.lastgroup, m.span(m.lastgroup)
        if kind == "name":
            gender = "m" if m["title"] in MALE else "f" if m["title"] in FEMALE else ""
            words = list(re.finditer(r"\S+", m["name"]))
            for place, word in enumerate(words):
                begin, name = start + word.start(), POSSESSIVE.sub("", word[0]).rstrip("'’-")
                role = f"given-{gender}" if place < len(words) - 1 else f"surname-{gender if _script(name) == 'cyrillic' else ''}"
                yield begin, begin + len(name), f"{role}-{_script(name)}", name.lower()
            continue
        if kind in ("card", "iban"):
            again, run = start < run, max(run, at)
            kind, at = _checked(text, start, at, kind, again)
            if not kind:
                continue
        canonical = text[start:at]
        if kind in ("card", "ssn", "phone"):
            canonical = re.sub(r"\D", "", canonical)
            if kind == "phone":
                canonical = canonical[-10:]
        elif kind == "email":
            canonical = canonical.lower()
        elif kind == "iban":
            canonical = canonical.replace(" ", "")
        yield start, at, kind, canonical


class _Stream:
    """Numbers that follow from key, kind, value and attempt."""

    def __init__(self, key: bytes, *parts: str):
        seed = hmac.new(key, "\x1f".join(parts).encode(), hashlib.sha256).digest()
        self.number = int.from_bytes(seed + hashlib.sha256(seed).digest(), "little")

    def below(self, limit: int) -> int:
        if self.number < limit << 64:  # go on from what is left
            seed = hashlib.sha256(self.number.to_bytes(64, "little") + b"+").digest()
            self.number = int.from_bytes(seed + hashlib.sha256(seed).digest(), "little")
        self.number, rest = divmod(self.number, limit)
        return rest

    def like(self, text: str, hexadecimal: str = "") -> str:
        """Each letter by a letter of its case, each digit by a digit; or hexadecimal digits by such digits."""
        out = []
        for c in text:
            if c in hexadecimal:
                out.append(hexadecimal[self.below(16)])
            elif c.isdigit():
                out.append(str(self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """A canonical value of the same kind and form that stands for ``value``.

    From the attempt ``SAME_FORM`` on the form may become longer with each attempt, because a form can be used
    up: there are 65,536 addresses in 192.168.0.0/16, and nothing in ``****`` can be changed.
    """
    stream = _Stream(key, kind, value, str(attempt))
    longer = max(0, attempt + 1 - SAME_FORM)
    if kind == "key":
        return "AKIA" + stream.like(value[4:]) + stream.like("A" * longer)
    if kind == "secret":
        digits = next((d for d in (HEX, HEX.upper()) if set(value) <= set(d)), "")
        return stream.like(value, digits) + stream.like("a" * longer)
    if kind == "email":
        local, _, domain = value.partition("@")
        head, dot, end = domain.rpartition(".")
        return f"{stream.like(local)}{stream.like('a' * longer)}@{stream.like(head)}{dot}{end}"
    if kind == "iban":
        body = value[:2] + "00" + stream.like(value[4:] + "0" * longer)
        return f"{value[:2]}{98 - _iban_rest(body):02d}{body[4:]}"
    if kind == "ip":
        if longer:  # a unique local address of the newer kind
            return "fd" + stream.like("0" * 2, HEX) + "".join(":" + stream.like("0000", HEX) for _ in range(7))
        first, second = map(int, value.split(".")[:2])
        rest = [str(stream.below(256)) for _ in range(3)]
        if ipaddress.ip_address(value).is_global:
            while True:
                made = f"{1 + stream.below(223)}.{rest[0]}.{rest[1]}.{rest[2]}"
                if ipaddress.ip_address(made).is_global:
                    return made
                rest = [str(stream.below(256)) for _ in range(3)]
        return f"{first}.{second}.{rest[1]}.{rest[2]}"
    if kind == "card":
        body = value[0] + stream.like(value[1:-1] + "0" * longer)
        return body + str(-luhn(body + "0") % 10)
    if kind in ("ssn", "phone"):
        return str(2 + stream.below(7)) + stream.like(value[1:] + "0" * longer)
    role, gender, script = kind.split("-")
    if role == "given":
        names = GIVEN[script, gender]
        made = names[stream.below(len(names))]
        return (made + _syllables(stream, script, longer) if longer else made).lower()
    ends = {"m": "ов", "f": "ова", "": "ко"}
    made = _syllables(stream, script, 2 + min(2, attempt) + longer)
    return made + (ends[gender] if script == "cyrillic" else "")


def _syllables(stream: _Stream, script: str, number: int) -> str:
    first, second = ("bdfgklmnprstvw", "aeiou") if script == "latin" else ("бвгдзклмнпрст", "аеиоу")
    return "".join(first[stream.below(len(first))] + second[stream.below(len(second))] for _ in range(number)) + (
        "lnrst"[stream.below(5)] if script == "latin" else ""
    )


def rendered(raw: str, kind: str, made: str) -> str:
    """The surrogate in the spelling of ``raw``: its separators, country code or case."""
    if kind in ("card", "ssn", "phone", "iban"):
        keep = max(0, sum(c.isalnum() for c in raw) - len(made))
        out, rest = [], list(made)
        for c in raw:
            if not c.isalnum():
                out.append(c)
            elif keep:
                out.append(c)
                keep -= 1
            else:
                out.append(rest.pop(0))
        return "".join(out + rest)
    if kind.startswith(("given", "surname")):
        return made.upper() if raw.isupper() else made[0].upper() + made[1:]
    if kind == "email" and raw.isupper():
        return made.upper()
    return made


def assign_surrogates(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, made`` for distinct ``kind, value``: distinct surrogates, none equal to a value found.

    Surrogates that collide with each other or with a value of their kind are made anew, but
    for the one of the smallest value; those made before stay. It ends, as later attempts have more room.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("kind", "value", "attempt")], strict=True)
            made = [surrogate(key, *row) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, "made"])

    done, attempt = None, 0
    waiting = found
    while True:
        tried = materialize(
            waiting.select("kind", "value", F.lit(attempt).alias("attempt")).mapInArrow(
                make, "kind string, value string, attempt int, made string"
            ),
            "surrogates",
        )
        firsts = tried.groupBy("kind", "made").agg(F.min("value").alias("value"))
        good = firsts.join(found.select("kind", F.col("value").alias("made")), ["kind", "made"], "left_anti")
        if done is not None:
            good = good.join(done.select("kind", "made"), ["kind", "made"], "left_anti")
        good = materialize(good.select("kind", "value", "made"), "good-surrogates")
        done = good if done is None else materialize(done.union(good), "all-surrogates")
        waiting = tried.join(good.select("kind", "value"), ["kind", "value"], "left_anti")
        if waiting.isEmpty():
            return done
        attempt += 1


def replace_private_data(docs: DataFrame, key: bytes, count: str | None = "n_replaced") -> DataFrame:
    """All columns of ``docs`` with surrogates in ``text``, and the number of replacements as ``count``.

    A column of ``docs`` that is called like ``count`` gives way to it; with None nothing is added.

    An entity has the same surrogate everywhere, in the spelling of each place; different entities
    have different ones. Same key, same surrogates, but for collisions. Names are found behind titles, and then in the
    whole document. A null text stays
    null and an empty one empty, with nothing replaced; repeated rows and null ids count like any.

    Texts without any sign of an entity stay where they are. The distinct entities of the others get their surrogates in
    one table, are joined to the documents that mention them, and replaced there.
    """
    check, made_for = unused(docs, "check"), unused(docs, "made_for")
    # rows of one id and text have the same entities; the id spreads copies of a text
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), "text")
    suspect = F.coalesce(F.col("text").rlike(SUSPECT) | F.col("text").contains("AKIA"), F.lit(False))
    suspects = docs.filter(suspect).withColumn(check, F.md5(named))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            checks, kinds, values = [], [], []
            for check, text in zip(block.column("check").to_pylist(), block.column("text").to_pylist(), strict=True):
                for kind, value in {e[2:] for e in entities(text)}:
                    checks.append(check)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(checks, pa.string()), pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                ["check", "kind", "value"],
            )

    def entities_with_surrogates() -> DataFrame:
        texts = suspects.select(F.col(check).alias("check"), "text")
        mentions = materialize(texts.mapInArrow(find, "check string, kind string, value string").distinct(), "mentions")
        made = assign_surrogates(materialize(mentions.select("kind", "value").distinct(), "entities"), key)
        each = mentions.join(made, ["kind", "value"]).groupBy("check")
        return each.agg(F.collect_list(F.struct("kind", "value", "made")).alias("made_for"))

    known = kept_table(docs.sparkSession, "surrogates-of-texts", entities_with_surrogates).toDF(check, made_for)
    names = [c for c in docs.columns if c != count]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != count]
    schema = ", ".join(fields if count is None else [*fields, f"`{count}` int"])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            out, numbers = [], []
            for text, table in zip(block.column("text").to_pylist(), block.column(made_for).to_pylist(), strict=True):
                lookup = {(r["kind"], r["value"]): r["made"] for r in table or ()}
                parts, last, number = [], 0, 0
                for start, end, kind, value in entities(text) if lookup else ():
                    parts += [text[last:start], rendered(text[start:end], kind, lookup[kind, value])]
                    last, number = end, number + 1
                out.append("".join(parts) + text[last:])
                numbers.append(number)
            columns = [pa.array(out, pa.string()) if n == "text" else block.column(n) for n in names]
            if count is None:
                yield pa.RecordBatch.from_arrays(columns, names)
            else:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers, pa.int32())], [*names, count])

    changed = suspects.join(known, check, "left").select(*names, made_for).mapInArrow(replace, schema)
    others = docs.filter(~suspect).select(*names)
    return changed.union(others if count is None else others.withColumn(count, F.lit(0)))
