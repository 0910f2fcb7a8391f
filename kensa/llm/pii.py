"""Surrogates for personal data.

Detected entities (e-mail, IPv4 address, card number, phone number, social
security number, secret, titled name) get replacements made by a keyed hash.
A replacement keeps the entity's type and format: letters stay letters of their
case, digits digits, separators stay in place; a card number keeps its length
and whether its check digit holds; a name keeps title, gender, script and number
of parts.  One entity, however it is spelt (case, separators), has one surrogate
in all documents.

Names are keyed by part: the family name (the last part found under a title) has one
surrogate whatever the title, and given names one for each family name, their gender
told by any title the person has in the document.  So 'Mr John Smith', 'Dr John
Smith' and 'Mr Smith' stay one person, and later 'John Smith' or 'Smith' without a
title are replaced too.  Given names alone, and persons never titled, are not found.

Distinctness: all distinct entities of the corpus and their surrogates form a
table.  Where two entities meet in one surrogate, or a surrogate is itself an
entity of the corpus, all but the first try again with the next attempt, until
no collision is left.  So that any number of entities of one shape settles, the
space of surrogates grows with the attempt: an e-mail address gets a subdomain of
example.org that is a letter longer each time, a name a syllable, a phone number a
digit and a secret a character more at every fourth attempt (their length is kept
before that).  Addresses, card and social security numbers keep their length; they settle
while the corpus holds fewer than about half of all possible ones.  Attempts after the first are rare; they go to their documents by a
join, all others are computed where the text is.

Null text stays null, text without entities stays as it is.  Texts of any length
are searched whole; repeated rows are replaced alike; ids may be null or repeat.  Other
columns are kept, whatever their names (but for ``__doc``, ``__text`` and ``__late``); an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kensa.llm import common

_HEX = "0123456789abcdef"

_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = (
    ("secret", re.compile(rf"{_EDGE}[0-9a-fA-F]{{32,128}}{_END}")),
    ("secret", re.compile(r"(?i)(?:secret|token|passw(?:or)?d|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?(?P<v>[A-Za-z0-9_/+.=-]{12,})")),
    ("ip", re.compile(rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.\d)")),
    ("ssn", re.compile(rf"(?<![0-9A-Za-z-])\d{{3}}-\d{{2}}-\d{{4}}(?![0-9A-Za-z-])")),
    ("card", re.compile(rf"{_EDGE}(?:\d{{13,19}}|\d{{4}}(?:[ -]\d{{4}}){{2}}[ -]\d{{1,7}}){_END}")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![0-9A-Za-z]|\.\d)")),
)
# Titles and the gender they tell.
_TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Господин": "m", "Госпожа": "f", "Dr": "n", "Prof": "n"}
_UPPER = "".join(c for c in map(chr, range(0x10000)) if unicodedata.category(c) in ("Lu", "Lt"))
_PART = rf"[{_UPPER}](?:(?!['’]s(?!\w))['’-]?(?:[^\W\d_]|[\u0300-\u036f]))+"
_NAME = re.compile(rf"(?<!\w)(?P<t>{'|'.join(_TITLES)})\.? (?P<v>{_PART}(?: {_PART}){{0,2}})(?!\w)")
# Given names by script and gender; n is used where the title tells none.
_GIVEN = {
    ("latin", "m"): "Adrian Bruno Carl Dennis Emil Felix Gregor Hugo Ivan Jonas Konrad Leon Martin Nils Oscar Paul".split(),
    ("latin", "f"): "Alma Beate Clara Diana Elena Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula".split(),
    ("latin", "n"): "Alex Andrea Chris Dominique Eden Jamie Jean Kim Lee Morgan Noel Robin Sacha Sam Toni Val".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Игорь".split(),
    ("cyrillic", "f"): "Анна Белла Вера Галина Дарья Елена Зоя Ирина".split(),
    ("cyrillic", "n"): "Женя Саша Валя Шура Паша Слава".split(),
    ("greek", "m"): "Άρης Βασίλης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Σπύρος".split(),
    ("greek", "f"): "Άννα Δάφνη Ελένη Ζωή Ιωάννα Μαρία Νίκη Σοφία".split(),
    ("greek", "n"): "Φώτη Χρύσα Άλκη Λώρη".split(),
}
_SYLLABLES = {"latin": ("ba be do fe ga hol ka lin mar nor pe ros sta tor va wen".split(), ("er", "er")), "cyrillic": ("ба ве до га ко ли мар но пе ро ста ту".split(), ("ов", "ова")),
              "greek": ("βα γε δο κα λι μαρ νο πε ρο στα του φι".split(), ("άκης", "άκη"))}


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities in a text, not overlapping."""
    found: list[tuple[int, int, str, str]] = []     # by start: spans that don't overlap are by end too

    def add(kind, start, end, value):
        at = bisect_left(found, (start,))
        if (at == 0 or found[at - 1][1] <= start) and (at == len(found) or end <= found[at][0]):
            found.insert(at, (start, end, kind, value))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add("email", *m.span(), m[0].lower())
    if _DIGIT.search(text):
        for kind, pattern in _NUMBERS:
            for m in pattern.finditer(text):
                if m.re.groups:
                    if re.search(r"\d", m["v"]):
                        add(kind, *m.span("v"), m["v"].lower())
                else:
                    add(kind, *m.span(), m[0].lower() if kind == "secret" else m[0] if kind == "ip" else re.sub(r"\D", "", m[0]))
    people: dict[str, set[str]] = {}
    titled = []
    for m in _NAME.finditer(text):
        value = _cased(m["v"])
        titled.append((*m.span("v"), value, _TITLES[m["t"]]))
        for name in {value, value.split()[-1]}:
            people.setdefault(name, set()).add(_TITLES[m["t"]])
    for start, end, value, own in titled:
        add(f"name.{_script(value)}.{_gender(people, value, own)}", start, end, value)
    if people:
        forms = sorted({f for name in people for f in (name, name.upper())}, key=len, reverse=True)
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, forms))})(?!\w)", text):
            value = _cased(m[0])
            if value in people:
                add(f"name.{_script(value)}.{_gender(people, value, 'n')}", *m.span(), value)
    return found


def _cased(name: str) -> str:
    """A name with parts in capitals only spelt as usual."""
    return " ".join(p.title() if p.isupper() else p for p in name.split())


def _script(name: str) -> str:
    script = unicodedata.name(name.split()[-1][0], "LATIN").split()[0].lower()
    return script if script in _SYLLABLES else "latin"


def _gender(people: dict[str, set[str]], name: str, own: str) -> str:
    """The gender of a person: that of the title, else the only one other titles tell."""
    told = people[name] - {"n"}
    return own if own != "n" or len(told) != 1 else next(iter(told))


def parts(kind: str, value: str) -> list[tuple[str, str]]:
    """The entities that have surrogates: given names and the family name of a name, any other as it is."""
    if not kind.startswith("name."):
        return [(kind, value)]
    _, script, gender = kind.split(".")
    given, _, family = value.rpartition(" ")
    ends = _SYLLABLES[script][1]
    last = (f"name.{script}.{'f' if gender == 'f' and ends[0] != ends[1] else 'n'}", family)
    return [(f"given.{script}.{gender}.{family}", given), last] if given else [last]


_DIGIT = re.compile(r"\d")


class _Stream:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: bytes, *parts):
        self.key, self.parts, self.n, self.pool = key, "\x1f".join(map(str, parts)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.digest(self.key, self.parts + b"\x1f%d" % self.n, "sha256")
            self.n += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n


def luhn(digits: str) -> int:
    """The check sum of a card number, 0 if it holds."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """Canonical surrogate of a canonical entity."""
    draw = _Stream(key, kind, value, attempt)
    if kind == "ip":
        # reserved addresses first, any others when these run out
        return ".".join(map(str, [240 + draw.below(15) if attempt < 10 else 1 + draw.below(254), draw.below(256), draw.below(256), 1 + draw.below(254)]))
    if kind.startswith("name."):
        _, script, gender = kind.split(".")
        parts, endings = _SYLLABLES[script]
        count = len(value.split())
        given = _GIVEN[script, gender]
        family = "".join(parts[draw.below(len(parts))] for _ in range(3 + attempt // 4)) + endings[gender == "f"]
        return " ".join([given[draw.below(len(given))] for _ in range(count - 1)] + [family.capitalize()])
    if kind.startswith("given."):
        _, script, gender, _ = kind.split(".")
        names, syllables = _GIVEN[script, gender], _SYLLABLES[script][0]
        make = lambda: "".join(syllables[draw.below(len(syllables))] for _ in range(1 + attempt // 4)).capitalize()
        return " ".join(make() if attempt > 3 else names[draw.below(len(names))] for _ in value.split())
    if kind in ("card", "phone", "ssn"):
        lead = 1 if kind != "ssn" else 0
        more = attempt // 4 if kind == "phone" else 0
        body = value[:lead] + "".join(str(draw.below(10)) for _ in range(len(value) - lead + more))
        if kind == "card" and luhn(value) == 0:
            body = next(body[:-1] + str(d) for d in range(10) if luhn(body[:-1] + str(d)) == 0)
        return body
    local, at, _ = value.partition("@")
    keep = set(_HEX) if all(c in _HEX for c in local) and not at else None
    body = "".join(_HEX[draw.below(16)] if keep else str(draw.below(10)) if c.isdigit() else chr(97 + draw.below(26)) if c.isalpha() else c for c in local)
    if not at:
        return body + "".join(_HEX[draw.below(16)] for _ in range(attempt // 4))
    host = "".join(chr(97 + draw.below(26)) for _ in range(attempt + 2 if attempt else 0))
    return body + "@" + host + "." * (attempt > 0) + "example.org"


def render(kind: str, original: str, value: str) -> str:
    """The surrogate in the original's spelling: separators and upper case."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(value)
        return "".join([next(digits) if c.isdigit() else c for c in original] + list(digits))
    if (kind in ("email", "secret") or kind.startswith("name.")) and original.upper() == original:
        return value.upper()
    return value


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    out, at, spans = [], 0, find(text)
    for start, end, kind, value in spans:
        new = " ".join(surrogate(key, *part, attempts.get(part, 0)) for part in parts(kind, value))
        out += [text[at:start], render(kind, text[start:end], new)]
        at = end
    return "".join([*out, text[at:]]), len(spans)


def entities(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, kind, value): the distinct entities of each row."""
    kind = dict(df.dtypes)[id_column]

    def run(batches):
        for batch in batches:
            docs, kinds, values = [], [], []
            for doc, t in zip(batch.column("__doc").to_pylist(), batch.column("__text").to_pylist()):
                for k, v in {part for _, _, k, v in find(t) for part in parts(k, v)} if t else ():
                    docs.append(doc)
                    kinds.append(k)
                    values.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(docs, batch.schema.field(0).type), pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["__doc", "kind", "value"])

    return df.select(F.col(f"`{id_column}`").alias("__doc"), F.col(f"`{text}`").alias("__text")).mapInArrow(run, f"__doc {kind}, kind string, value string")


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt, surrogate) of all distinct entities, free of collisions."""
    def make(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("kind", "value", "attempt")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([surrogate(key, *r) for r in rows], pa.string())], names=["kind", "value", "attempt", "surrogate"])

    table = found.select("kind", "value").distinct().withColumn("attempt", F.lit(0))
    kinds = "kind string, value string, attempt int"
    while True:          # ends: the space of surrogates grows with the attempt, so what still collides falls to none
        table = common.scratch(table.mapInArrow(make, f"{kinds}, surrogate string"), "surrogates")
        family = F.split_part(F.col("kind"), F.lit("."), F.lit(1))
        # given names are told apart within a family name
        family = F.when(family == "given", F.concat_ws(".", family, F.split_part(F.col("kind"), F.lit("."), F.lit(4)))).otherwise(family)
        first = Window.partitionBy(family, "surrogate").orderBy("attempt", "kind", "value")
        real = table.select(family.alias("f"), F.col("value").alias("s")).distinct()
        judged = table.withColumn("again", F.row_number().over(first) > 1)
        judged = judged.join(real, (family == F.col("f")) & (F.col("surrogate") == F.col("s")), "left")
        judged = judged.select("kind", "value", (F.col("attempt") + (F.col("again") | F.col("s").isNotNull()).cast("int")).alias("next"), "attempt", "surrogate")
        judged = common.scratch(judged, "surrogates")
        if judged.where("next > attempt").isEmpty():
            return table
        table = judged.select("kind", "value", F.col("next").alias("attempt"))


def pseudonymise(df: DataFrame, key: bytes, id_column: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """``df`` with surrogates in its texts, and on request the number of entities."""
    found = common.scratch(entities(df, id_column, text), "entities")
    late = assign(found, key).where("attempt > 0").select("kind", "value", "attempt")
    late = common.scratch(found.join(late, ["kind", "value"]).groupBy("__doc").agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("__late")), "late")
    kept = df.columns
    joined = df.join(late, F.col(f"`{id_column}`").eqNullSafe(F.col("__doc")), "left").select(*[F.col(f"`{c}`") for c in kept], "__late")
    place = kept.index(text)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                new = [(None, 0) if t is None else replace(t, key, {(x["kind"], x["value"]): x["attempt"] for x in late or ()})
                       for t, late in zip(rows.column(place).to_pylist(), rows.column(len(kept)).to_pylist())]
                columns = list(rows.columns[:-1])
                columns[place] = pa.array([t for t, _ in new], pa.string())
                if count:
                    columns.append(pa.array([n for _, n in new], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *([count] if count else [])])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return joined.mapInArrow(run, schema + (f", `{count}` long" if count else ""))


def demo_key(name: str) -> bytes:
    """A key from a name, for queries and tests; production passes a secret key."""
    return hashlib.sha256(name.encode()).digest()
