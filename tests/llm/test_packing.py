import zlib

import numpy as np
import public_tokenizers
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logloom.llm.entry import op1_best_fit_packing
from logloom.llm.packing import _Lengths, pack_documents, packing_plan
from logloom.llm.tokens import token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, most):
    """Every id of every document once, sequences without gaps."""
    spans, by_doc = {}, {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    assert by_doc.keys() == texts.keys()
    for doc_id, parts in by_doc.items():
        ids = whole_ids(texts[doc_id])
        for n, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            piece = ids[n * most : (n + 1) * most]
            assert (r.piece, r.start, r.length) == (n, n * most, len(piece))
            assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        assert sum(r.length for r in parts) == len(ids)
    return len(spans)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op1_best_fit_packing(spark, SF_DIR).collect()
    used = check(rows, texts, 4096)
    assert used <= -(-sum(r.length for r in rows) // 4096) + 1


def test_odd_rows(spark):
    texts = {1: None, 2: "", 3: "a b " * 9, 4: "x" * 50, 5: "don't stop now ́é <|endoftext|> 12\x1c3", 6: "same", 7: "same"}
    docs = spark.createDataFrame(
        [(k, v, 1, 2) for k, v in texts.items()], "doc_id bigint, text string, length int, salt int"
    )
    check(pack_documents(docs, PATH, 8).collect(), texts, 8)
    assert pack_documents(docs.limit(0), PATH, 8).count() == 0
    twice = docs.where("doc_id = 6").union(docs.where("doc_id = 6").selectExpr("NULL", "text", "length", "salt"))
    assert pack_documents(twice.union(twice), PATH, 8).count() == 4


def test_ids_of_a_very_long_text():
    text = "Ab'll é 1.5 " * 95_000
    assert np.frombuffer(token_ids(text, PATH), "<u4").tolist() == whole_ids(text)[:-1]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 40), max_size=200), st.integers(40, 60))
def test_plan_uses_every_piece_once(lengths, top):
    counts = np.bincount(np.array(lengths, int), minlength=top + 1)
    placed = np.zeros_like(counts)
    for pattern, times in packing_plan(counts):
        assert times > 0 and sum(n * m for n, m in pattern.items()) <= top
        for n, m in pattern.items():
            placed[n] += m * times
    assert (placed == counts).all()


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 2)), max_size=60))
def test_indexes_follow_every_change(changes):
    lengths = _Lengths(np.zeros(31, int))
    for n, count in changes:
        lengths.left[n] = count
        lengths._mark(n)
    there = [n for n in range(1, 31) if lengths.left[n]]
    for gap in range(31):
        assert lengths.doubles[gap] == sum(a + b == gap for a in there for b in there)
        assert lengths.triples[gap] == sum(a + b + c == gap for a in there for b in there for c in there)
        pairs = sum(a + b == gap and (a < b or lengths.left[a] > 1) for a in there for b in there if a <= b)
        assert lengths.pairs[gap] == pairs


def test_exact_complements_are_found():
    counts = np.zeros(101, int)
    for n in (70, 20, 10, 60, 40, 55, 30, 15, 50, 25, 13, 12):
        counts[n] += 1
    assert all(sum(n * m for n, m in p.items()) == 100 for p, _ in packing_plan(counts))
