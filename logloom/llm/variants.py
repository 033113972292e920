"""Spelling variants of a corpus's words, by permuterm rotations.

Every word is marked with a terminator and turned: for ``word`` the rotations are
``word$``, ``ord$w``, ``rd$wo``, and so on. Without its last letter a rotation is the
prefix that the words with another letter in that place share, and it is a whole
rotation of the word that lacks the letter. So each rotation is kept twice, whole and
as that prefix; sorted, all neighbours by one replaced, inserted or deleted letter
stand side by side, and a scan compares a word with its group alone. A group has one
word at most for each letter and one without it, so the alphabet bounds it
(``LETTERS``: 90 letters), however many words there are.

A pair that differs by a replacement meets in one group. A pair that differs by one
letter of a run of equal letters would meet once for each letter of the run; only the
run's first letter counts. So counts and best neighbours add up without the pairs
being kept.

Null texts have no words, and a null ``doc_id`` counts as the empty text. Repeated rows count
as often as they occur. Other columns are ignored. Neighbours of equal count are
ranked by code points. An empty table gives no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import stored, texts

# The letters of words, and those that are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Stands behind the last letter of a word; no letter.
MARK = "$"

NEAR = "word string, near bigint, best struct<less:bigint,word:string>"


def words_of(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """Every run of letters of every text, as (doc_id, word).

    With ``damage``, runs whose checksum it divides lose the letter that the
    checksum points at: reproducible spelling mistakes.
    """
    runs = texts(docs).selectExpr(
        "coalesce(CAST(doc_id AS STRING), '') AS doc_id", f"explode(regexp_extract_all(text, r'{LETTERS}', 0)) AS run"
    )
    # Ready-made lower-casing would also change letters beyond A-Z.
    low = f"IF(octet_length(run) = char_length(run), lower(run), translate(run, '{_UPPER}', '{_LOWER}'))"
    words = runs.selectExpr("doc_id", f"{low} AS word")
    if damage is None:
        return words
    at = "CAST(pmod(h, char_length(word)) AS INT)"
    return words.withColumn("h", F.expr("crc32(concat(doc_id, ':', word))")).selectExpr(
        "doc_id",
        f"IF(h % {int(damage)} = 0, concat(substring(word, 1, {at}), substring(word, {at} + 2)), word) AS word",
    )


def frequent_words(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n): the different words, counted by partial sums."""
    long = words.where(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(key, letter, once, n) for every rotation of every word (word, n).

    With a ``letter`` the key is the rotation without it, its last letter; ``once``
    says that it is the first of its run. Without a letter the key is the whole rotation.
    """
    cut = f"""transform(sequence(1, char_length(word)), i -> struct(
        concat(substring(word, i + 1), '{MARK}', substring(word, 1, i - 1)) AS key,
        substring(word, i, 1) AS letter,
        i = 1 OR substring(word, i, 1) <> substring(word, i - 1, 1) AS once))"""
    whole = f"""transform(sequence(0, char_length(word)), i -> struct(
        concat(substring(word, i + 1), '{MARK}', substring(word, 1, i)) AS key, '' AS letter, true AS once))"""
    return words.selectExpr("n", f"inline(concat({cut}, {whole}))")


def _scan(batches: Iterator[pa.RecordBatch]):
    """Neighbours among the rows of each key, which stand together."""
    rest = None
    for batch in batches:
        if rest is not None and rest.num_rows:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        key = batch["key"]
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        yield _neighbours(batch.slice(0, starts[-1]), starts)
        rest = batch.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield _neighbours(rest, np.array([0, rest.num_rows]))


def _neighbours(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """For each word of each group: how many neighbours it has there, and the best.

    ``starts`` ends with the number of rows.
    """
    sizes = np.diff(starts)
    several = np.repeat(sizes > 1, sizes)
    found = batch.filter(pa.array(several)).to_pylist() if several.any() else []
    rows, at = [], 0
    for size in sizes[sizes > 1].tolist():
        group = found[at : at + size]
        at += size
        after, _, before = group[0]["key"].partition(MARK)
        ranked = sorted((-m["n"], before + m["letter"] + after, m["letter"], m["once"]) for m in group)
        other = [m for m in ranked if not m[2]]  # the word without a letter here
        once = [m for m in ranked if m[2] and m[3]]
        replaced = [m for m in ranked if m[2]]
        for m in ranked:
            if m[2]:
                near = len(replaced) - 1 + (len(other) if m[3] else 0)
                best = min((x for x in ranked if x is not m and (x[2] or m[3])), default=None)
            else:
                near, best = len(once), min(once, default=None)
            if near:
                rows.append((m[1], near, {"less": best[0], "word": best[1]}))
    words, near, best = zip(*rows) if rows else ((), (), ())
    kind = pa.struct([("less", pa.int64()), ("word", pa.string())])
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array(near, pa.int64()), pa.array(best, kind)], ["word", "near", "best"]
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best) for words (word, n) that have neighbours.

    ``best`` is the neighbour of the largest count, with that count negated.
    """
    # Rows of one key meet in a task: as many as there are letters, and one.
    turned = rotations(words).repartition("key").sortWithinPartitions("key")
    return turned.mapInArrow(_scan, NEAR).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms (word, form).

    Each round sends every word to where its last word leads, so chains halve.
    Counts at least double along a chain: it has no rings and is short.
    """
    hops = stored(forms.selectExpr("word", "form AS root", "true AS moved"), "hops")
    while not hops.where("moved").isEmpty():
        onward = hops.selectExpr("word AS root", "root AS next")
        hops = stored(
            hops.join(onward, "root", "left").selectExpr(
                "word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved"
            ),
            "hops",
        )
    return hops.drop("moved")


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n).

    A word's form is the neighbour of the largest count, if it is at least twice
    the word's own; its root is where following forms ends. ``words`` is read several
    times, so give it a written table.
    """
    n_form = "IF(-best.less >= 2 * n, -best.less, NULL)"
    found = stored(
        words.join(near_words(words), "word", "left").selectExpr(
            "word", "n", "coalesce(n_near, 0L) AS n_near",
            f"IF({n_form} IS NULL, NULL, best.word) AS form", f"{n_form} AS form_n",
        ),
        "variants",
    )
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").selectExpr(
        "word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n"
    )


def group_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, damage: int | None = None) -> DataFrame:
    """Spelling variants among the frequent words of ``docs`` (``doc_id``, ``text``)."""
    return spelling_variants(stored(frequent_words(words_of(docs, damage), least_length, least_count), "words"))
