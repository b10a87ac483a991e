"""Personal data replaced by keyed surrogates of the same kind, format, script and gender."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import map_arrow, named, read
from brightledger.session import materialise

KEY = "surrogates-1"

#: Given names and family names by script and gender, titles by gender, words before a name.
NAMES = {
    "latin": {"f": "Anna Maria Julia Laura Sarah Emma Clara Elena Sofia Nora Alice Irene Marta Lucie Hannah Judith Eva Paula Ines Rosa".split(),
              "m": "Peter Thomas Daniel Martin Paul Simon David Victor Oscar Hugo Felix Bruno Mario Louis Georg Adam Erik Carlos Julian Leon".split(),
              "family": "Miller Fischer Keller Moreau Lambert Garcia Romero Jensen Novak Weber Baker Turner Dubois Leclerc Vidal Santos Berg Lindner Hughes Marsh".split()},
    "cyrillic": {"f": "Анна Мария Елена Ольга Ирина Вера Дарья Нина".split(), "m": "Иван Пётр Павел Олег Сергей Антон Борис Юрий".split(),
                 "family": "Иваненко Петренко Бойко Мельник Ткач Коваль Гончар Зима".split()},
    "greek": {"f": "Άννα Μαρία Ελένη Σοφία Ειρήνη Κατερίνα".split(), "m": "Γιώργος Νίκος Πέτρος Παύλος Δημήτρης Ανδρέας".split(),
              "family": "Παπάς Νικολάου Γεωργίου Δήμου Ιωάννου Παύλου".split()},
}
TITLES = {"f": "Mrs Ms Miss Madam Frau Madame Mme Mlle Señora Sra Srta Госпожа Κυρία".split(), "m": "Mr Sir Herr Monsieur Señor Sr Господин Κύριος".split(),
          "": "Dr Prof Doctor Professor".split()}
INTRODUCTIONS = ["My name is", "my name is", "Mein Name ist", "mein Name ist", "Je m'appelle", "je m'appelle", "Me llamo", "me llamo", "Меня зовут", "меня зовут"]

#: Alphabets of scripts whose blocks hold letters out of use, and what stands for characters of no class.
ALPHABETS = ["абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"]
MARKS = "*-_.:#%&+=?@^~!$/|"
#: A secret of fewer letters and digits has its other characters drawn too; so have all after so many attempts, and they grow.
LEAST_DRAWN, SAME_LENGTH = 6, 4

_NAME = r"[^\W\d_a-zà-ÿß][^\W\d_]+(?:[-'][^\W\d_]+)*"
_KINDS = [
    ("email", r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("key", r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{20,}|sk[-_](?:live[-_]|test[-_])?[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    ("secret", r"(?i:(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)(?P<secret>[^\s\"',;]{6,})"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d-])(?:\d{4}[ -]){3}\d{1,7}(?![\d-])|(?<!\d)\d{13,19}(?!\d)"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?![\w])|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"),
    ("name", rf"(?:\b(?:{'|'.join(t for ts in TITLES.values() for t in ts)})\.?\s|\b(?:{'|'.join(INTRODUCTIONS)})\s)(?P<name>{_NAME}(?: {_NAME}){{0,2}})"),
]
_ALL = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p) in enumerate(_KINDS)))
#: Every entity holds one of these (also as Java reads it): a text without them has none.
_PLAIN = ["AKIA", "ASIA", "xox", *(t for ts in TITLES.values() for t in ts), *INTRODUCTIONS]
#: The class of first characters comes first, so that most positions of a text cost one look.
def _hint(digit: str) -> str:
    return f"(?=[@+=:{digit}gs{''.join(sorted({t[0] for t in _PLAIN}))}])(?:[@+=:]|{digit}[.]?{digit}|gh[pousr]_|sk[-_]|{'|'.join(_PLAIN)})"


#: For Spark, whose digits are those of every script only by that name, and for Python.
HINT = _hint(r"\p{Nd}")
_HINT = re.compile(_hint(r"\d"))


def mentions(text: str, found: list[tuple[int, int, str, str, str]]) -> list[tuple[int, int, str, str, str]]:
    """The other whole-word mentions of the names in ``found``, as they are or in capitals, outside of ``found``."""
    forms: dict[str, dict[str, tuple[str, str]]] = {}  # by the first run of word characters, so one pass finds all
    for _, _, kind, gender, value in found:
        if kind in ("given", "family") and value[0].isupper():
            name = same(kind, value)
            for form in (name, name.upper()):
                forms.setdefault(re.match(r"\w+", form)[0], {}).setdefault(form, (kind, gender))
    taken, out, k, last = [(start, end) for start, end, *_ in found], [], 0, 0
    for m in re.finditer(r"\w+", text) if forms else ():
        start = m.start()
        if start < last:
            continue
        fits = [f for f in forms.get(m[0], ()) if text.startswith(f, start) and not re.match(r"\w", text[start + len(f):start + len(f) + 1])]
        if not fits:
            continue
        form = max(fits, key=len)
        end = start + len(form)
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if not (k < len(taken) and taken[k][0] < end):
            out.append((start, end, *forms[m[0]][form], form))
            last = end
    return out


def entities(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, gender, value) of every entity, in order and without overlap. Gender is that of a name's title.

    A name that stands after a title or an introduction is found wherever its given or family name stands in the text.
    """
    if not text or not _HINT.search(text):
        return []
    out = []
    for m in _ALL.finditer(text):
        i = int(m.lastgroup[1:]) if m.lastgroup[0] == "k" else next(k for k in range(len(_KINDS)) if m[f"k{k}"] is not None)
        kind = _KINDS[i][0]
        start, end = m.span(kind if kind in ("secret", "name") else 0)
        if kind != "name":
            out.append((start, end, kind, "", text[start:end]))
            continue
        title = text[m.start():start].strip().rstrip(".")
        gender = next((g for g, ts in TITLES.items() if title in ts), None)
        words = list(re.finditer(r"[^ ]+", text[start:end]))
        for k, w in enumerate(words):
            family = k == len(words) - 1 and (k > 0 or gender is not None)
            out.append((start + w.start(), start + w.end(), "family" if family else "given", "" if family else gender or "", w[0]))
    more = mentions(text, out) if any(e[2] in ("given", "family") for e in out) else []
    return sorted(out + more) if more else out


def same(kind: str, value: str) -> str:
    """What mentions of one entity share, whatever their spelling: digits of numbers, lower case of addresses."""
    if kind == "phone":
        country = re.match(r"\+(\d{1,3})(?=[ .(-])", value)
        rest = re.sub(r"\D", "", value[country.end():] if country else value)
        return f"{country[1]}+{rest}" if country else rest
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind in ("given", "family"):
        return value.title() if value.isupper() else value
    return value.lower() if kind == "email" else value


def _stream(key: str, *parts: str):
    """Endless keyed numbers from 0 to 255."""
    block = 0
    while True:
        yield from hmac.new(key.encode(), "\x1f".join([*parts, str(block)]).encode(), hashlib.sha256).digest()
        block += 1


def _digit(rnd) -> str:
    return str(next(b for b in rnd if b < 250) % 10)


@lru_cache(10_000)
def _class(c: str) -> str:
    """The characters that may stand for ``c``: of its script and case, else of its block and category, else marks."""
    for letters in ALPHABETS:
        for each in (letters, letters.upper()):
            if c in each:
                return each
    kind, block = unicodedata.category(c), ord(c) & ~0x7F
    own = "".join(x for x in map(chr, range(block, block + 128)) if unicodedata.category(x) == kind) if kind[0] in "LMN" else ""
    return own if len(own) > 1 else MARKS


def _drawn(text: str, rnd, marks: bool) -> str:
    """As ``_shaped``, and letters of every script, with ``marks`` other characters too, replaced by ones of their class."""
    out = []
    for c, new in zip(text, _shaped(text, rnd)):
        if not (c.isdigit() or c.isascii() and c.isalpha()) and (marks or unicodedata.category(c)[0] in "LMN"):
            letters = _class(c)
            new = letters[(next(rnd) << 8 | next(rnd)) % len(letters)]
        out.append(new)
    return "".join(out)


def _shaped(text: str, rnd) -> str:
    """Letters and digits replaced by ones of the same class; everything else stays."""
    hexed = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text)
    out = []
    for c in text:
        if c.isdigit():
            out.append(format(next(rnd) % 16, "x" if not text.isupper() else "X") if hexed and not text.isdigit() else _digit(rnd))
        elif hexed:
            out.append(format(next(rnd) % 16, "X" if c.isupper() else "x"))
        elif "a" <= c <= "z":
            out.append(chr(97 + next(b for b in rnd if b < 234) % 26))
        elif "A" <= c <= "Z":
            out.append(chr(65 + next(b for b in rnd if b < 234) % 26))
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def _script(name: str) -> str:
    c = next((c for c in name if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿" else "latin"


def surrogate(kind: str, gender: str, entity: str, attempt: int, key: str = KEY) -> str:
    """The replacement of an entity (as ``same`` gives it). Another attempt gives another one.

    Where few of a length may exist, later attempts are longer, so one that is free is always found.
    """
    rnd = _stream(key, kind, entity, str(attempt))
    more = "0" * max(0, attempt - SAME_LENGTH + 1)
    if kind in ("given", "family"):
        pools = NAMES[_script(entity)]
        pool = pools["family" if kind == "family" else gender or ("f" if next(rnd) % 2 else "m")]
        # when single names run out, double-barrelled ones follow
        return "-".join(pool[next(rnd) % len(pool)] for _ in range(attempt + 1))
    if kind == "email":
        local, _, host = entity.partition("@")
        labels = host.split(".")
        return _shaped(local, rnd) + _shaped(more, rnd) + "@" + ".".join([_shaped(x, rnd) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        octets = [str(1 + next(rnd) % 254)] + [str(next(rnd)) for _ in range(2)] + [str(1 + next(rnd) % 254)]
        return ".".join(octets)
    if kind == "card":
        new = entity[:1] + "".join(_digit(rnd) for _ in entity[1:-1])
        last = next(d for d in "0123456789" if _luhn(new + d) == 0)
        return new + (last if _luhn(entity) == 0 else _digit(rnd))
    if kind in ("phone", "ssn"):
        country, plus, rest = entity.rpartition("+")
        rest += more if kind == "phone" else ""
        return country + plus + "".join(_digit(rnd) for _ in rest)
    if kind == "iban":
        rest = _shaped(entity[4:], rnd)
        check = f"{98 - _rest97(rest + entity[:2] + '00'):02d}" if _rest97(entity[4:] + entity[:4]) == 1 else _shaped(entity[2:4], rnd)
        return entity[:2] + check + rest
    if kind == "key":
        prefix = re.match(r"AKIA|ASIA|gh[pousr]_|sk[-_](?:live[-_]|test[-_])?|xox[abprs]-", entity)[0]
        return prefix + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[next(rnd) % 32] if c.isupper() or c.isdigit() and entity.isupper() else _shaped(c, rnd) for c in entity[len(prefix):]) + ("" if prefix in ("AKIA", "ASIA") else _shaped(more, rnd))
    drawn = sum(c.isalnum() for c in entity)
    return _drawn(entity, rnd, drawn < LEAST_DRAWN or bool(more)) + _shaped(more, rnd)


def spelled(kind: str, value: str, new: str) -> str:
    """The surrogate in the format of a mention: separators, country code, capitals."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(re.sub(r"\D", "", new))
        return re.sub(r"\d", lambda _: next(digits), value) + "".join(digits)
    if kind == "iban":
        letters = iter(new)
        return "".join(c if c == " " else next(letters) for c in value)
    if kind == "email":
        host = len(value) - value.index("@")  # the local part may have become longer
        local = "".join(n.upper() if v.isupper() else n for v, n in zip(value, new[:-host]))
        return local + new[len(local):-host] + "".join(n.upper() if v.isupper() else n for v, n in zip(value[-host:], new[-host:]))
    if kind in ("given", "family", "name"):
        return new.upper() if value.isupper() else new
    return new


def _rest97(number: str) -> int:
    """Remainder of an account number read with A = 10 to Z = 35: 1 if its check digits, moved to its end, are right."""
    return int("".join(str(int(c, 36)) for c in number)) % 97


def found_entities(docs: DataFrame) -> DataFrame:
    """(digest, kind, gender, entity): the distinct entities of every text of ``docs`` that has any."""

    def work(batches):
        for b in batches:
            out = []
            for digest, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out += sorted({(digest, kind, gender, same(kind, value)) for _, _, kind, gender, value in entities(text)})
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["digest", "kind", "gender", "entity"])

    texts = docs.filter("text <> ''").select(F.sha2("text", 256).alias("digest"), "text")
    return map_arrow(texts, work, "digest string, kind string, gender string, entity string")


def joint(kind: str) -> Column:
    return F.when(F.col(kind).isin("given", "family"), "name").otherwise(F.col(kind))


def surrogates(entities_: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, entity, surrogate), one row for each distinct entity: all surrogates of a kind differ, and none is an entity.

    Given and family names are of the one kind ``name``, so a word has one surrogate wherever it stands in names: a family name
    unless more of the rows say given.
    All entities draw; those whose draw meets another's or an entity of the text draw again, until none is left. The one with
    the smallest entity keeps a contested draw, so the table is the same in any partitioning.
    """
    genders = F.max("gender").alias("gender")  # a title beats none
    part = F.when(F.sum(F.when(F.col("kind") == "given", 1).otherwise(-1)) > 0, "given").otherwise("family").alias("part")
    known = materialise(entities_.groupBy(joint("kind").alias("_kind"), "entity").agg(genders, part).withColumnRenamed("_kind", "kind"), "entities")

    def draw(attempt):
        def work(batches):
            for b in batches:
                kind, entity, gender, part = (b.column(b.schema.names.index(c)) for c in ("kind", "entity", "gender", "part"))
                each = zip(kind.to_pylist(), entity.to_pylist(), gender.to_pylist(), part.to_pylist())
                new = [surrogate(p if k == "name" else k, g, e, attempt, key) for k, e, g, p in each]
                yield pa.RecordBatch.from_arrays([kind, entity, gender, part, pa.array(new, pa.string())], names=["kind", "entity", "gender", "part", "surrogate"])

        return work

    open_, done, attempt = known, None, 0
    schema = "kind string, entity string, gender string, part string, surrogate string"
    while True:
        drawn = materialise(map_arrow(open_.select("kind", "entity", "gender", "part"), draw(attempt), schema), "draws")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        free = first.join(known.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        got = materialise(free.select("kind", "entity", "surrogate"), "surrogates")
        done = got if done is None else materialise(done.unionByName(got), "surrogates")
        open_ = materialise(drawn.drop("surrogate").join(got, ["kind", "entity"], "left_anti"), "open")
        attempt += 1
        if open_.isEmpty():
            return done


def replaced(text: str, table: dict[tuple[str, str], str]) -> tuple[str, int]:
    out, at, n = [], 0, 0
    for start, end, kind, _, value in entities(text):
        new = table.get(("name" if kind in ("given", "family") else kind, same(kind, value)))
        if new is not None:
            out += [text[at:start], spelled(kind, value, new)]
            at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def scrubbed(docs: DataFrame, key: str = KEY, count_as: str | None = None) -> DataFrame:
    """The rows of ``docs`` with every entity of ``text`` replaced; other columns stay (``n_chars``, if there, is counted anew).

    One entity has one surrogate in all texts, two entities never share one. Null and empty texts and texts without entities
    stay as they are; very long ones are read whole, rows repeated come back as often. Only texts that have entities meet the table of surrogates, by their digest. ``count_as`` names a column
    to add, of the number of replacements.
    """
    found = materialise(found_entities(docs), "found")
    table = surrogates(found, key)
    by_text = found.select("digest", joint("kind").alias("kind"), "entity").distinct().join(table, ["kind", "entity"]).groupBy("digest").agg(
        F.collect_list(F.struct("kind", "entity", "surrogate")).alias("_table"))  # bounded by one text
    packed = F.struct(*named(docs)).alias("row")  # one column, whatever the names in it
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    keyed = docs.filter(hinted).select("text", packed, F.sha2("text", 256).alias("digest"))
    joined = keyed.join(by_text.hint("merge"), "digest", "left").select("text", "_table", "row")
    plain = docs.filter(~hinted).select(packed, "text", F.lit(0).cast("bigint").alias("n"))

    def work(batches):
        for b in batches:
            texts, tables = b.column(0).to_pylist(), b.column(1).to_pylist()
            new = [(t, 0) if not e else replaced(t, {(x["kind"], x["entity"]): x["surrogate"] for x in e}) for t, e in zip(texts, tables)]
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array([x[0] for x in new], pa.string()), pa.array([x[1] for x in new], pa.int64())], names=["row", "text", "n"])

    out = map_arrow(joined, work, plain.schema).unionByName(plain)

    def column(name):
        old = F.col("row").getField(name)
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.when(F.col("n") > 0, F.length("text")).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return out.select(*map(column, docs.columns), *([F.col("n").alias(count_as)] if count_as else []))


def run_key(spark) -> str:
    """The key of a run's surrogates, from the session's ``brightledger.surrogates.key``; without it surrogates can be recomputed by anybody."""
    return spark.conf.get("brightledger.surrogates.key", KEY)


def op9_pii(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return scrubbed(docs, run_key(spark), count_as="n_replaced")


def stage(spark, docs, folder):
    """All documents with personal data replaced; nulls, empty and very long texts and repeated rows as in ``scrubbed``."""
    return scrubbed(docs, run_key(spark))
