"""Language, decontamination, pages, personal data, shards and the pipeline."""

import re
import time
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import entry
from logloom.llm.decontamination import _distance, benchmark_matches, without_benchmark
from logloom.llm.html import extract_text, page_text
from logloom.llm.language import codewords, fit_languages, labelled, predict_languages, with_known_language
from logloom.llm.privacy import _luhn, entities, replace_personal_data, surrogate_table
from logloom.llm.shards import shard_documents


def test_language_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = entry.op2_language_id(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert held and sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    rows = [(n, f"the and of {n} that" if n % 2 else f"der und die {n} das", "en" if n % 2 else "de", 1.0) for n in range(40)]
    rows += [(40, None, "en", 0.0), (41, "", None, 0.0), (42, "123 !", "en", 0.0), (None, "the and that", "en", 0.0), (43, "the of " * 300_000, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    model = fit_languages(labelled(docs))
    found = {r.doc_id: r for r in predict_languages(docs, model).collect()}
    assert [found[k].lang_pred for k in (40, 41, 42)] == ["und"] * 3 and found[40].score == 0
    assert found[43].lang_pred == found[None].lang_pred == "en" and found[2].lang_pred == "de"
    kept = with_known_language(docs)
    assert kept.columns == docs.columns and kept.count() == 42
    assert predict_languages(docs, fit_languages(labelled(docs.limit(0)))).where("lang_pred = 'und'").count() == 45
    assert with_known_language(docs.limit(0)).count() == 0


def test_codewords_differ():
    for n in range(2, 40):
        codes = codewords(n)
        assert min((a != b).sum() for k, a in enumerate(codes) for b in codes[:k]) >= max(1, codes.shape[1] // 6)


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def nearest(text, item):
    n, most = len(item), int(len(item) * 0.2 + 1e-9)
    return min((_distance(text[k : k + n], item, most) for k in range(max(len(text) - n, 0) + 1)), default=most + 1) <= most


def test_decontamination_against_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()][:12]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).collect()}
    for k, (_, text) in enumerate(items):  # edited copies inside other text
        w = text.split()
        for at in range(3, len(w) - 1, 7):
            w[at] = ("changed", "", w[at] + " added")[at % 3]
        texts[1000 + k] = "some text before, " + " ".join(w).upper() + " and after"
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in benchmark_matches(docs, bench).collect()}
    expected = {(d, i) for d, t in texts.items() for i, text in items if nearest(words(t), words(text))}
    assert got <= expected and len(got) >= 0.97 * len(expected) and len(expected) >= 12


def test_decontamination_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [(1, None, ""), (2, "", ""), (3, item, ""), (3, item, ""), (None, item, ""), (4, "one two three four five six seven eight", ""), (5, "x " * 200_000 + item, "")],
        "doc_id bigint, text string, item_id string",
    )
    bench = spark.createDataFrame([(7, item), (8, None), (9, "short"), (None, "")], "item_id bigint, text string")
    rows = benchmark_matches(docs, bench).collect()
    assert Counter(r.doc_id for r in rows) == {3: 2, None: 1, 4: 1, 5: 1}
    assert {r.doc_id: (r.edits, r.start, r.end) for r in rows}[5] == (0, 200_000, 200_010)
    kept = without_benchmark(docs, bench)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == {1: 1, 2: 1, None: 1}
    assert benchmark_matches(docs, bench.limit(0)).count() == 0 and benchmark_matches(docs.limit(0), bench).count() == 0


def test_page_layout():
    page = """<head><title>no</title><body><p>One <b>two</b>
      three<p>Next<ul><li>a<li>b<ol start=3><li>c</ol></ul><div style="display: none">x<p>y</div>
      <table><tr><th>Name<th>N<tr><td>long name<td>1</table>
      <pre>  keep
   this</pre>a<br>b<script>var t = "</p>";</script><span hidden>h</span> &amp; c"""
    assert page_text(page) == (
        "One two three\n\nNext\n\n- a\n- b\n  3. c\n\nName       N\nlong name  1\n\n  keep\n   this\n\na\nb & c"
    )


def test_pages(spark):
    rows = entry.op5_html_extraction(spark, SF_DIR).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len(rows) == len(pages) and all(r.text and "track(" not in r.text and "margin:0" not in r.text for r in rows)
    odd = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "<div>" * 50_000 + "x", 1), (3, "</td><td>a</table><li>b<", 1)], "page_id bigint, html string, text int")
    assert sorted(r.text for r in extract_text(odd).collect()) == ["", "", "a\n- b<", "x"]
    assert extract_text(odd.limit(0)).count() == 0


@settings(deadline=None, max_examples=80)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<b>", "</b>", "<div>", "</div>", "<br>", "<pre>", "</pre>", 1, 1, 1]), max_size=40))
def test_no_visible_text_is_lost(tokens):
    page = "".join(f"w{n} " if t == 1 else t for n, t in enumerate(tokens))
    assert Counter(re.findall(r"w\d+", page_text(page))) == Counter(re.findall(r"w\d+", page))


def test_surrogates(spark):
    texts = {
        1: "mail Ann.Lee@Example.org or ANN.LEE@EXAMPLE.ORG, call +1 (499) 555-6503.",
        2: "ann.lee@example.org 1.2.3.4 078-05-1120 4111 1111 1111 1111; +1-499-555-6503",
        3: "Frau Anna Weber und Herr Weber, Господин Иванов", 4: None, 5: "", 6: "nothing here",
    }
    docs = spark.createDataFrame([*((k, t, 0) for k, t in texts.items()), (None, texts[2], 0), (2, texts[2], 0)], "doc_id bigint, text string, known int")
    rows = replace_personal_data(docs, b"k").collect()
    by = {r.doc_id: r.text for r in rows}
    assert len(rows) == 8 and by[None] == by[2] and (by[4], by[5], by[6]) == (None, "", "nothing here")
    assert re.fullmatch(r"mail (\S+@\S+) or (\S+), call \+1 \(\d{3}\) \d{3}-\d{4}\.", by[1])
    first, again = re.findall(r"\S+@\S+[a-zA-Z]", by[1])
    assert first == again.lower() == by[2].split()[0] and again.isupper()
    assert re.sub(r"\D", "", by[1].split("call")[1]) == re.sub(r"\D", "", by[2].split(";")[1])
    assert _luhn(re.sub(r"\D", "", by[2].split(";")[0][-19:])) == 0
    woman, man, russian = re.fullmatch(r"Frau (\S+) \S+ und Herr (\S+), Господин (\S+)", by[3]).groups()
    assert woman.endswith("a") and man.endswith("o") and all("а" <= c <= "я" for c in russian.lower())
    old = {v for t in texts.values() for *_, v in entities(t)}
    assert not old & {v for t in by.values() for *_, v in entities(t)}
    assert replace_personal_data(docs.limit(0), b"k").count() == 0


def test_surrogates_are_distinct(spark):
    values = spark.range(3000).selectExpr("'email' AS kind", "concat(id % 90 + 10, '@m', id, '.com') AS value")
    values = values.union(spark.range(900).selectExpr("'ssn'", "lpad(id, 9, '0')")).union(spark.range(60).selectExpr("'male'", "concat('b', chr(97 + id % 26))"))
    found = surrogate_table(values, b"k").collect()
    assert len(found) == values.distinct().count() == len({(r.kind, r.surrogate) for r in found})
    assert not {(r.kind, r.value) for r in found} & {(r.kind, r.surrogate) for r in found}


def test_shards(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    copies = spark.range(50).selectExpr("7 AS doc_id", "repeat('c', 700) AS text")
    odd = spark.createDataFrame([(None, None), (None, "x"), (3, ""), (4, "y" * 9000)], "doc_id bigint, text string")
    whole = docs.select("doc_id", "text").unionByName(copies).unionByName(odd).selectExpr("*", "1 AS shard")
    for step in (1, 12):
        rows = shard_documents(whole, 5000, step).collect()
        assert len(rows) == whole.count()
        size, prefixes = defaultdict(int), defaultdict(int)
        for r in rows:
            size[r.shard] += r.bytes
            for d in range(len(r.shard.split(".")[0]) + 1):
                prefixes[r.shard[:d]] += r.bytes
        big = {r.shard for r in rows if r.oversized}
        assert all(n <= 5000 or k in big for k, n in size.items())
        # only oversized buckets were split
        assert all(prefixes[k.split(".")[0][:-1]] > 5000 for k in size if k.split(".")[0])
    assert shard_documents(whole.limit(0)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    near = {r.doc_id for r in entry.op7_simhash_near_dedup(spark, SF_DIR).where("doc_id = component_id").collect()}
    known = {r.doc_id for r in entry.op2_language_id(spark, SF_DIR).where("score >= 0.5").collect()}
    leaks = {r.doc_id for r in entry.op3_benchmark_decontamination(spark, SF_DIR).collect()}
    left = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert left == (near & known) - leaks and len(left) > docs.count() / 2


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", None, 0), (2, "", None, "", 0), (None, "the and", "en", "s", 1), (4, "token=abcdefgh the", "en", "s", 1), (4, "token=abcdefgh the", "en", "s", 1)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF_DIR)
            assert out.columns == docs.columns and out.count() <= rows.count()
    secrets = corpus_pipeline.STAGES[3][1](spark, docs, SF_DIR).collect()
    assert sorted(str(r.text) for r in secrets) == ["", "None", "[secret] the", "[secret] the", "the and"]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a<math><mi>x</mi></math><svg><title>no</title><text>lab</text></svg><select><option>one<option>two</select>", "axlabonetwo"),
        ("<div style='visibility:hidden'>no<b style='color:red; visibility: Visible'>yes</b><ul><li>no</ul></div>", "yes"),
        ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
        ("<details>no<summary>sum <b>x</b></summary>no<p>no</p></details>after", "sum x\nafter"),
        ("<details open><summary>s</summary>yes</details>", "s\nyes"),
        ("<details><details><summary>no</summary></details><summary>yes</summary></details>", "yes"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
        ("<p style='background-display:none'>kept<p style='display:none'>no", "kept"),
    ],
)
def test_visible_text(html, text):
    assert page_text(html) == text


def test_pages_take_linear_time():
    def taken(n):
        began = time.process_time()
        page_text("<div><table>" + "<b>" * n + "</div>" * n)
        return time.process_time() - began

    assert taken(20_000) < 8 * max(taken(5_000), 0.02)


@pytest.mark.parametrize(
    "text, found",
    [
        ("2024-05-17 12", []),
        ("on 17.05.2024 12 30", []),
        ("10-20-30", []),
        ("+49 30 1234 567", ["+49 30 1234 567"]),
        ("01 23 45 67", ["01 23 45 67"]),
        ("+1 (843) 555-7672 170.106.47.21", ["+1 (843) 555-7672", "170.106.47.21"]),
    ],
)
def test_dates_are_no_phone_numbers(text, found):
    assert [text[a:b] for a, b, *_ in entities(text)] == found
