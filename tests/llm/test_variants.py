import re
import zlib
from collections import Counter

import pytest
from conftest import SF_DIR

from logloom.llm.entry import op13_spelling_variants
from logloom.llm.variants import group_variants, near_words, spelling_variants, words_of

SCHEMA = "doc_id bigint, text string, word string, n int, h int, key int"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def counted(docs, damage):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


def edits(word, letters):
    cut = {word[:i] + word[i + 1 :] for i in range(len(word))}
    put = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    swapped = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return (cut | put | swapped) - {word}


def variants(counts):
    letters, out, forms = {c for w in counts for c in w}, {}, {}
    for word, n in counts.items():
        near = [w for w in edits(word, letters) if w in counts]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= 2 * n else None
        out[word] = len(near)

    def root(word):
        return root(forms[word]) if forms[word] else word

    return {
        (w, forms[w], root(w), n, out[w], counts[forms[w]] if forms[w] else None) for w, n in counts.items()
    }


def frequent(counts, length, times):
    return {w: n for w, n in counts.items() if len(w) >= length and n >= times}


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = variants(frequent(counted(docs, 97), 5, 3))
    rows = op13_spelling_variants(spark, SF_DIR).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
    assert any(f for _, f, *_ in want) and any(r not in (w, f) for w, f, r, *_ in want)


def test_runs_of_equal_letters_and_chains(spark):
    counts = {
        "aa": 1, "aaa": 9, "aab": 4, "aabb": 2, "aaab": 2, "ab": 4, "b": 50, "ba": 9, "éa": 9, "aé": 30, "a": 60,
        "aaaa": 1, "abb": 7, "c": 25, "ccc": 1, "stone": 100, "stine": 40, "stint": 15, "stnt": 5,
    }
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    rows = spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(counts) and {tuple(r) for r in rows} == variants(counts)
    assert {r.word: r.root for r in rows}["stnt"] == "stone"


def test_all_letters_in_one_place(spark):
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    counts = {f"wor{c}d": n + 3 for n, c in enumerate(letters)} | {"word": 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    rows = spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in rows} == variants(counts)


def test_odd_rows(spark):
    texts = [
        (1, None), (2, ""), (None, "Words words\tWORDS"), (3, "ÀB×÷ÿ İstanbul K ſ 12 x_y"), (3, "ÀB×÷ÿ"), (4, "Words, wards wards!"),
        (5, "wards wird" * 300), (5, "wards wird" * 300), (6, "日本 no-words"),
    ]
    docs = spark.createDataFrame([(*r, "", 1, 2, 3) for r in texts], SCHEMA).repartition(2)
    for damage in (None, 3):
        words = Counter(r.word for r in words_of(docs, damage).collect())
        want = counted(texts, damage)
        assert words == want
        rows = group_variants(docs, 2, 1, damage).select("word", "form", "root", "n", "n_near", "form_n").collect()
        assert {tuple(r) for r in rows} == variants(frequent(want, 2, 1))


@pytest.mark.parametrize("texts", [[], ["", None], ["lonely words without neighbours"]])
def test_no_neighbours(spark, texts):
    docs = spark.createDataFrame([(n, t, "", 1, 2, 3) for n, t in enumerate(texts)], SCHEMA)
    rows = group_variants(docs, 1, 1).collect()
    assert all((r.form, r.root, r.n_near) == (None, r.word, 0) for r in rows)
    assert len(rows) == sum(len((t or "").split()) for t in texts)


def test_no_words_at_all(spark):
    assert near_words(spark.createDataFrame([], "word string, n bigint")).collect() == []
