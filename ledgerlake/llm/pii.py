"""Personal data replaced by surrogates that look like it.

Detected are e-mail addresses, secrets (after ``token =`` and the like, or with a known prefix),
payment cards (13 to 19 digits with a valid check digit), IBANs (valid check digits), US social
security numbers, telephone numbers, IPv4 addresses and names behind a title.

A surrogate is drawn from a keyed hash of the entity's type and normal form, so one entity has
one surrogate in all documents, however it is written. It keeps the format: letters become
letters of the same script and case, digits digits, all else stays; check digits are valid again,
numbers of an address stay in range, country codes and the kind of card stay; given names are
drawn by the gender of the title, names by script.

Collisions are found over the table of all distinct entities: a surrogate that two entities share
(the smaller one keeps it) or that is itself an entity is drawn again, until none is left. Where a
form has no free value, as when all addresses of one letter are entities, surrogates get longer
with each further attempt (an address of a network first leaves the widths of its numbers, then gets
a fifth one), so this always ends. Only
entities that were drawn again have to reach their documents, by a join on ``doc_id``; for the
others each task computes the surrogate itself.

Null texts stay null and empty ones empty. Whole texts are read. Rows that occur twice get the same
replacement twice, and rows with equal or null ``doc_id`` are all treated. Columns of ``docs`` are
passed through; ``n_entities`` is replaced if it exists. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from ledgerlake.llm.blocks import stored

MENTIONS = "doc_id long, kind string, entity string"
_DRAWN = "kind string, entity string, attempt int, surrogate string"

# Titles by gender, given names by script and gender, endings of family names by script.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Signora", "Госпожа"),
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин"),
    "": ("Dr", "Prof", "Professor"),
}
GIVEN = {
    ("latin", "f"): ("Ada", "Clara", "Elena", "Greta", "Irene", "Laura", "Marta", "Nora", "Paula", "Sofia"),
    ("latin", "m"): ("Adam", "Bruno", "David", "Emil", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Victor"),
    ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Нина", "Ольга"),
    ("cyrillic", "m"): ("Антон", "Борис", "Иван", "Олег", "Павел", "Роман"),
    ("greek", "f"): ("Άννα", "Ελένη", "Μαρία", "Σοφία"),
    ("greek", "m"): ("Γιώργος", "Νίκος", "Πέτρος", "Σπύρος"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fo", "gar", "hol", "ka", "lin", "mar", "nel", "or", "pe", "ris", "sto", "ta", "vel", "wen"),
    "cyrillic": ("ба", "ве", "го", "да", "ко", "ли", "мар", "но", "пет", "ров", "са", "ти"),
    "greek": ("βα", "γε", "δα", "κο", "λι", "μα", "νο", "πα", "ρο", "στα"),
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "accented": "àáâãäåçèéêëìíîïñòóôõöùúûü", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_ALL_TITLES = "|".join(sorted((t for own in TITLES.values() for t in own), key=lambda t: (-len(t), t)))
_GENDER = {t: g for g, own in TITLES.items() for t in own}
# Fixed values of the international numbering plan: country codes of one and of two digits; all others have three.
ONE_DIGIT = ("1", "7")
TWO_DIGITS = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98"
).split()
#: After so many collisions a form counts as full, and surrogates get longer with each further attempt.
FULL = 6
FULL_IP = 24
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"[A-ZÀ-ÖØ-ÞΑ-ΩΆ-ΏА-ЯЁ][\w'’-]+"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+%-])[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?i:\b(?:token|secret|api[_-]?key|access[_-]?key|password|passwd)\b)[\"']?\s*[:=]\s*[\"']?(?P<secret>[A-Za-z0-9+/_=-]{8,})"
    r"|(?P<prefixed>\b(?:ghp_|sk-|AKIA|xox[bp]-)[A-Za-z0-9_-]{12,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<card>(?<![\w+.-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]))"
    rf"|(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))"
    rf"|\b(?P<title>{_ALL_TITLES})\b\.? (?P<person>{_NAME}(?: {_NAME})?)"
)
_WORTH_A_LOOK = re.compile(rf"[@\d]|(?i:token|secret|key|passw)|\b(?:{_ALL_TITLES})\b")


def _luhn(digits: str) -> int:
    """The sum that a valid card number leaves at 0."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def _iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _country_digits(digits: str) -> int:
    """How many digits the country code of an international number has, by the public numbering plan."""
    return 1 if digits[:1] in ONE_DIGIT else 2 if digits[:2] in TWO_DIGITS else 3


def mentions(text: str | None) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of the entities in a text."""
    if not text or not _WORTH_A_LOOK.search(text):
        return
    for m in PATTERN.finditer(text):
        kind = m.lastgroup if m.lastgroup != "title" else "person"
        value = m[kind]
        if kind in ("secret", "prefixed"):
            normal, known = (value.lower() if re.fullmatch(r"[0-9a-fA-F]+", value) else value), any(c.isdigit() for c in value)
            out = "secret"
        elif kind == "card":
            normal = re.sub(r"\D", "", value)
            known, out = _luhn(normal) == 0 and normal.strip("0") != "", "card"
        elif kind == "iban":
            normal = value.replace(" ", "")
            known, out = _iban_rest(normal) == 1, "iban"
        elif kind in ("phone", "ssn"):
            normal, known, out = ("+" if value[0] == "+" else "") + re.sub(r"\D", "", value), True, kind
            if value[0] == "+":
                n = 1 + _country_digits(normal[1:])
                normal = f"{normal[:n]} {normal[n:]}"
        elif kind == "person":
            normal, known, out = value.lower(), True, f"person-{_GENDER[m['title']]}"
        else:
            normal, known, out = value.lower(), True, kind
        if known:
            yield m.start(kind), m.end(kind), out, normal


def _script(c: str) -> str:
    o = ord(c)
    return "cyrillic" if 0x400 <= o < 0x530 else "greek" if 0x370 <= o < 0x400 else "latin" if o < 128 else "accented"


class _Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts):
        self._key, self._text, self._left, self._at = key, "\x1f".join(map(str, parts)).encode(), b"", 0

    def below(self, n: int) -> int:
        if len(self._left) < 8:
            self._left = hashlib.blake2b(self._text + self._at.to_bytes(4, "big"), key=self._key, digest_size=64).digest()
            self._at += 1
        value, self._left = int.from_bytes(self._left[:8], "big"), self._left[8:]
        return value % n

    def like(self, c: str, alphabet: str | None = None) -> str:
        if c.isdigit():
            return str(self.below(10)) if alphabet is None else alphabet[self.below(len(alphabet))]
        if not c.isalpha():
            return c
        letters = alphabet or LETTERS[_script(c)]
        new = letters[self.below(len(letters))]
        return new.upper() if c.isupper() else new


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The replacement of a normal form, itself in normal form."""
    draw = _Draw(key, kind, entity, attempt)
    more = max(0, attempt - FULL)
    if kind == "email":
        local, _, domain = entity.partition("@")
        name, _, top = domain.rpartition(".")
        return "".join(map(draw.like, local + "a" * more)) + "@" + "".join(map(draw.like, name)) + "." + top
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", entity):
            return "".join(draw.like(c, "0123456789abcdef") for c in entity + "0" * more)
        return "".join(map(draw.like, entity + "a" * more))
    if kind == "card":
        body = entity[0] + "".join(map(draw.like, entity[1:-1] + "0" * more))
        return body + str(-_luhn(body + "0") % 10)
    if kind == "iban":
        body = "".join(map(draw.like, entity[4:] + "0" * more))
        return f"{entity[:2]}{98 - _iban_rest(f'{entity[:2]}00{body}'):02d}{body}"
    if kind == "ip":
        ranges = {1: (1, 10), 2: (10, 100), 3: (100, 256)}
        forms = [(0, 256) if more else ranges[len(o)] for o in entity.split(".")] + [(0, 256)] * max(0, attempt - FULL_IP)
        return ".".join(str(low + draw.below(high - low)) for low, high in forms)
    if kind.startswith("person"):
        gender = kind[7:] or "fm"[draw.below(2)]
        words = entity.split(" ")
        script = next((s for s in map(_script, entity) if s in ("cyrillic", "greek")), "latin")
        names, parts = GIVEN[script, gender], SYLLABLES[script]
        family = "".join(parts[draw.below(len(parts))] for _ in range(3 + attempt))
        return family if len(words) == 1 else f"{names[draw.below(len(names))].lower()} {family}"
    country, gap, rest = entity.rpartition(" ")  # telephone and social security numbers
    return country + gap + "".join(map(draw.like, rest + "0" * more))


def in_form_of(new: str, old: str, kind: str) -> str:
    """A surrogate in the layout and case of one mention."""
    if kind.startswith("person"):
        return new.upper() if old.isupper() and len(old) > 1 else new.title()
    if kind in ("card", "phone", "ssn", "iban"):
        rest = iter(c for c in new if c.isalnum())
        return "".join(next(rest) if c.isalnum() else c for c in old) + "".join(rest)
    if kind == "ip":
        return new
    if kind == "email" and len(new) > len(old):  # of a full form: the name is longer
        at = old.index("@")
        return in_form_of(new[:at], old[:at], kind) + new[at : at + len(new) - len(old)] + in_form_of(new[at + len(new) - len(old) :], old[at:], kind)
    return "".join(n.upper() if o.isupper() else n for n, o in zip(new, old)) + new[len(old) :]


def find_mentions(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each entity of each document once."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, kind, entity) for i, t in enumerate(batch.column(1).to_pylist()) for kind, entity in sorted({x[2:] for x in mentions(t)})]
            at, kind, entity = zip(*found) if found else ((), (), ())
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(kind, pa.string()), pa.array(entity, pa.string())], names=["doc_id", "kind", "entity"])

    return rows.mapInArrow(run, MENTIONS)


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """``entities`` (kind, entity, attempt) with their surrogates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            new = [surrogate(key, *row) for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "entity", "attempt", "surrogate"])

    return entities.select("kind", "entity", "attempt").mapInArrow(run, _DRAWN)


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt, surrogate) of all entities; no surrogate twice, none an entity."""
    entities = stored(found.select("kind", "entity").distinct().withColumn("attempt", F.lit(0)), "entities")
    taken = entities.select("kind", F.col("entity").alias("surrogate"))
    settled, open_ = None, entities
    while open_.head(1):
        drawn = stored(_drawn(open_, key), "surrogates")
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        least = free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"), F.min("attempt").alias("attempt"))
        won = stored(least.select("kind", "entity", "attempt", "surrogate"), "settled")
        settled = won if settled is None else settled.unionByName(won)
        taken = taken.unionByName(won.select("kind", "surrogate"))
        lost = drawn.join(won.select("kind", "entity"), ["kind", "entity"], "left_anti")
        open_ = stored(lost.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "collisions")
    return entities.sparkSession.createDataFrame([], _DRAWN) if settled is None else settled


def replace(docs: DataFrame, key: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text and n_entities, the number of replaced mentions."""
    kept = [c for c in docs.columns if c != "n_entities"]
    docs = docs.select(*kept)
    found = stored(find_mentions(docs, id_column, text_column), "mentions")
    again = stored(assign(found, key).where("attempt > 0").select("kind", "entity", "attempt"), "drawn-again")
    if again.head(1):
        own = found.join(again, ["kind", "entity"]).groupBy("doc_id").agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("_again"))
        own = own.withColumnRenamed("doc_id", "_again_id")
        rows = docs.join(own, docs[id_column].cast("long").eqNullSafe(F.col("_again_id")), "left").drop("_again_id")
    else:
        rows = docs.withColumn("_again", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>"))
    at, names = kept.index(text_column), [*kept, "n_entities"]
    schema = to_arrow_schema(docs.schema).append(pa.field("n_entities", pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for text, again in zip(batch.column(at).to_pylist(), batch.column(len(kept)).to_pylist()):
                attempts = {(x["kind"], x["entity"]): x["attempt"] for x in again or ()}
                parts, done, n = [], 0, 0
                for a, b, kind, entity in mentions(text):
                    new = surrogate(key, kind, entity, attempts.get((kind, entity), 0))
                    parts += [text[done:a], in_form_of(new, text[a:b], kind)]
                    done, n = b, n + 1
                texts.append("".join([*parts, text[done:]]) if n else text)
                numbers.append(n)
            columns = [batch.column(i) for i in range(len(kept))]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers, pa.int32())], names=names)

    return rows.mapInArrow(run, from_arrow_schema(schema))
