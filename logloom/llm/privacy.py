"""Personal data replaced by keyed surrogates.

Detected entities (mail and IPv4 addresses, card and social security numbers,
phone numbers, persons named with a title) get a replacement of their own type:
digits for digits, letters of the same script and case for letters, check digits
that hold, and endings of the gender that the title tells. The replacement is
derived from ``key`` and the entity's normal form, so an entity has one surrogate
wherever and however it is written. Surrogates are distinct and are no entity of
the corpus: those that collide are derived again with the next attempt.

Null texts stay null; rows with null ``doc_id`` and repeated rows are kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import stored, texts

ATTEMPTS = 64

# Titles and the gender they tell.
MALE = ("Mr", "Mister", "Herr", "Monsieur", "Sr", "Señor", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Sra", "Señora", "Госпожа")

_TITLES = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
# A date in figures, year first or last, is no phone number.
_DATE = "|".join(
    rf"\d{{4}}{c}\d{{1,2}}{c}\d{{1,2}}(?!\d)|\d{{1,2}}{c}\d{{1,2}}{c}\d{{4}}(?!\d)|\d{{1,2}}{c}\d{{1,2}}{c}\d{{2}}(?![ .-]?\d)"
    for c in (r"\.", "-")
)
PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24})"
    r"|(?<![\d.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\d.]*\d)"
    r"|(?<![\d-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])"
    r"|(?<![\d])(?P<card>\d(?:[ -]?\d){12,18})(?!\d)"
    rf"|(?<![\w.-])(?!{_DATE})(?P<phone>(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)|\d{{2,4}})(?:[ .-]\d{{2,4}}){{2,3}})(?![\w-]|\.\d)"
    rf"|\b(?P<title>{_TITLES})\.? (?P<person>[^\W\d_][^\W\d_]{{1,30}}(?: [^\W\d_][^\W\d_]{{1,30}})?)"
)
# First and last letter of the alphabets that surrogates are made of.
SCRIPTS = (("a", "z"), ("α", "ω"), ("а", "я"))


def _luhn(digits: str) -> int:
    """The sum that is 0 modulo 10 for a valid number."""
    doubled = (int(d) * (2 if n % 2 else 1) for n, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of each entity."""
    found = []
    for m in PATTERN.finditer(text or ""):
        kind = m.lastgroup
        value = m[kind]
        start, end = m.span(kind)
        if kind == "person":
            words = value.split(" ")
            if not words[0][0].isupper():
                continue
            if not words[-1][0].isupper():
                value = words[0]
                end = start + len(value)
            kind = "male" if m["title"] in MALE else "female"
            found.append((start, end, kind, value.lower()))
        elif kind in ("email", "ip"):
            found.append((start, end, kind, value.lower()))
        else:
            digits = re.sub(r"\D", "", value)
            if kind == "card" and _luhn(digits):
                kind = "phone"
            if kind != "phone" or 7 <= len(digits) <= 19:
                found.append((start, end, kind, digits))
    return found


def _letter(c: str, n: int) -> str:
    for first, last in SCRIPTS:
        if first <= c <= last or c.isalpha() and first == "a" and c < "ʰ":
            return chr(ord(first) + n % (ord(last) - ord(first) + 1))
    return chr(ord(c) - ord(c) % 16 + n % 16) if c.isalpha() else c


def surrogate(kind: str, value: str, key: bytes, attempt: int) -> str:
    seed = hmac.new(key, f"{kind}\0{value}\0{attempt}".encode(), hashlib.sha256).digest()
    stream = hashlib.shake_256(seed).digest(2 * len(value) + 64)
    numbers = [stream[2 * n] << 8 | stream[2 * n + 1] for n in range(len(stream) // 2)]
    if kind == "ip":
        first = 10 if attempt < 4 else 1 + numbers[0] % 223
        return ".".join(map(str, [first, *(n % 256 for n in numbers[1:4])]))
    swap = lambda s: "".join(str(n % 10) if c.isdigit() else _letter(c, n) for c, n in zip(s, numbers))
    if kind == "email":
        name = value.partition("@")[0]
        more = "".join(chr(97 + n % 26) for n in numbers[-1 - 6 - attempt // 2 : -1])
        return f"{swap(name)}@{more}.example.{('com', 'net', 'org')[numbers[-1] % 3]}"
    if kind in ("male", "female"):
        out = swap(value) + "".join(_letter(value[-1], n) for n in numbers[-1 - attempt // 2 : -1])
        first, space, rest = out.partition(" ")
        end = {"a": "ao", "α": "ας", "а": "ан"}[next((s[0] for s in SCRIPTS if s[0] <= first[-1] <= s[1]), "a")]
        return first[:-1] + end[kind == "male"] + space + rest
    out = value[0] + swap(value)[1:] if kind == "phone" else swap(value)
    if kind == "card":
        rest = out[:-1]
        out = rest + str(-_luhn(rest + "0") % 10)
    return out


def _written(mention: str, kind: str, value: str) -> str:
    """``value`` in the case and punctuation of the mention."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(value)
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if mention.isupper() and len(mention) > 1:
        return value.upper()
    return value.title() if kind in ("male", "female") else value


def _mentions(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        rows = {
            (blob, kind, value)
            for blob, text in zip(batch["blob"].to_pylist(), batch["text"].to_pylist())
            for _, _, kind, value in entities(text)
        }
        columns = list(zip(*sorted(rows))) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["blob", "kind", "value"])


def _surrogates(batches: Iterator[pa.RecordBatch], key: bytes, attempt: int):
    for batch in batches:
        made = [surrogate(k, v, key, attempt) for k, v in zip(batch["kind"].to_pylist(), batch["value"].to_pylist())]
        yield pa.RecordBatch.from_arrays([batch["kind"], batch["value"], pa.array(made, pa.string())], ["kind", "value", "surrogate"])


def surrogate_table(values: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate): distinct surrogates for distinct ``values`` (kind, value)."""
    values = stored(values.distinct(), "entities")
    left, done = values, None
    for attempt in range(ATTEMPTS):
        made = left.mapInArrow(functools.partial(_surrogates, key=key, attempt=attempt), "kind string, value string, surrogate string")
        # persons of both genders share one space of names
        made = made.withColumn("space", F.expr("IF(kind IN ('male', 'female'), 'person', kind)"))
        original = values.select(F.expr("IF(kind IN ('male', 'female'), 'person', kind)").alias("space"), F.col("value").alias("surrogate")).distinct()
        free = made.join(original, ["space", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("space", "surrogate"), ["space", "surrogate"], "left_anti")
        won = free.groupBy("space", "surrogate").agg(F.min(F.struct("value", "kind")).alias("v")).select("v.kind", "v.value", "surrogate", "space")
        won = stored(won, "surrogates")
        done = won if done is None else done.unionByName(won)
        left = stored(left.join(won, ["kind", "value"], "left_anti"), "collisions")
        if left.isEmpty():
            return done.select("kind", "value", "surrogate")
    raise ValueError("no free surrogates: a format has too few values for its entities")


def _rewrite(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        out, counts = [], []
        for text, known in zip(batch["text"].to_pylist(), batch["known"].to_pylist()):
            table = {(k["kind"], k["value"]): k["surrogate"] for k in known or ()}
            parts, at, n = [], 0, 0
            for start, end, kind, value in entities(text) if table else ():
                parts += [text[at:start], _written(text[start:end], kind, table[kind, value])]
                at, n = end, n + 1
            out.append(text if not n else "".join([*parts, text[at:]]))
            counts.append(n)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string()), pa.array(counts, pa.int64())], ["doc_id", "text", "n_replaced"])


def replace_personal_data(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_replaced), one row per row of ``docs``."""
    whole = texts(docs).withColumn("blob", F.sha2("text", 256))
    mentions = stored(whole.select("blob", "text").where("text IS NOT NULL").mapInArrow(_mentions, "blob string, kind string, value string"), "mentions")
    table = surrogate_table(mentions.select("kind", "value"), key)
    known = mentions.distinct().join(table, ["kind", "value"]).groupBy("blob").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("known"))
    return whole.join(known, "blob", "left").select("doc_id", "text", "known").mapInArrow(_rewrite, "doc_id bigint, text string, n_replaced bigint")
