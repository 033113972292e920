import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logloom.llm import idfile, tokens
from logloom.llm.eliasfano import SAMPLE, EliasFano
from logloom.llm.entry import op12_token_id_output
from logloom.llm.idfile import read_token_ids, token_checksums, write_token_ids
from logloom.llm.tokens import token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_plain_call(tokenizer):
    texts = [
        "hi <|endoftext|> there", "a<|endoftext|>b <|ENDOFTEXT|>", "'S'T'LL's !'s don't", "x\x00y z\xa0w\x85q 12½ ²",
        "日本語 한국어 नमस्ते 😀 é Å K", " \x1e a\x1fb  c", "a" * 5000, "µªº ×÷ß ẞ İ ſ",
    ]
    chosen = random.Random(1)
    pool = [*map(chr, range(0x250)), *"日本語한́̀ 　😀", "<|endoftext|>", "<|startoftext|>", "'s", "'re"]
    texts += ["".join(chosen.choices(pool, k=chosen.randint(0, 12))) for _ in range(3000)]
    for text in texts:
        ids = np.frombuffer(token_ids(text, PATH), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_ids_of_letters_between_marks(tokenizer):
    texts = ["(état), dogs' \"élan\" l'été 's 't' <a> <|b|> a<|> ÉTÉ, Été! x×, ÿ÷ ß... e\u0301, “ça”, 'tis '\"s"]
    chosen = random.Random(2)
    pool = [*map(chr, range(33, 127)), *"éàßÿÉÀ×÷", *"abcdest" * 8, *"'(),.<|" * 3]
    texts += ["".join(chosen.choices(pool, k=chosen.randint(1, 7))) for _ in range(6000)]
    for text in texts:
        ids = np.frombuffer(token_ids(text, PATH), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_words_met_again_are_not_merged_again(monkeypatch):
    """Beside 359,000 words with and without a mark, a word still reaches the tokenizer's model once."""
    made, packed = [0], tokens._packed

    def counted(ids):
        made[0] += 1
        return packed(ids)

    monkeypatch.setattr(tokens, "_packed", counted)
    tokens._encoder.cache_clear()
    letters = "abcdefghijklmnopqrstuvwx"
    text = " ".join(f"{a}{b}{c}{d}," for a in letters for b in letters for c in letters[:13] for d in letters).encode()
    encode = tokens._encoder(PATH)
    first = encode(text)
    once = made[0]
    assert encode(text) == first and made[0] == once
    tokens._encoder.cache_clear()


def test_ids_of_another_kind_of_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Two  spaces\n\nand <|endoftext|> é"
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(token_ids(text, path), "<u4").tolist() == ids


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(-(2**63), 2**63 - 1) | st.integers(0, 40), max_size=60), st.sampled_from([1, 40]))
def test_numbers_come_back(numbers, times):
    numbers = sorted(numbers * times)
    coded = EliasFano.from_bytes(EliasFano.of(np.array(numbers, np.int64)).to_bytes())
    assert coded.all().tolist() == numbers
    for i in {0, len(numbers) // 2, len(numbers) - 1, SAMPLE, SAMPLE - 1} & set(range(len(numbers))):
        assert coded.select(i) == numbers[i]
    for x in {*numbers[:3], 7, -1}:
        assert coded.find(x) == sum(n <= x for n in numbers)
    with pytest.raises(IndexError):
        coded.select(len(numbers))


def test_space_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 1200, 100_000))
    bits = 8 * len(EliasFano.of(ends).to_bytes()) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 0.2


def expected(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = op12_token_id_output(spark, SF_DIR).collect()
    want = expected(sorted((r.doc_id, r.text) for r in docs), tokenizer)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want


SCHEMA = "doc_id bigint, text string, ids string, start int, h int, shard int"


def test_odd_rows(spark, tokenizer, tmp_path):
    rows = [(5, "five words of some length"), (None, "no key"), (3, None), (4, ""), (3, "again"), (-9, "a " * 300), (8, "x"), (8, "x"), (None, None)]
    docs = spark.createDataFrame([(*r, "", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    write_token_ids(docs, str(tmp_path / "a"), PATH, block_ids=4)
    found = sorted(read_token_ids(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    at = 0
    for r in found:
        assert (r.start, 4 * r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    assert [r.doc_id for r in found] == [None, None, -9, 3, 3, 4, 5, 8, 8]
    texts = sorted(((k, token_ids(t, PATH) + b"\1\0\0\0") for k, t in rows), key=str)
    assert sorted(((r.doc_id, bytes(r.ids)) for r in found), key=str) == texts


def test_ranges(spark, tmp_path):
    docs = spark.range(0, 900).selectExpr("3 * id AS doc_id", "repeat('word ', CAST(id % 17 AS INT)) AS text")
    path = str(tmp_path / "a")
    write_token_ids(docs.unionByName(docs.limit(2).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")), path, PATH, block_ids=200)
    whole = {(r.doc_id, r.start, bytes(r.ids)) for r in read_token_ids(spark, path).collect()}
    for low, high in ((300, 1001), (None, 100), (2000, None), (4, 4), (5000, 6000), (3, 3)):
        part = {(r.doc_id, r.start, bytes(r.ids)) for r in read_token_ids(spark, path, low, high).collect()}
        assert part == {
            r for r in whole if (low is None or r[0] is not None and r[0] >= low) and (high is None or r[0] is None or r[0] <= high)
        }


def test_empty_table(spark, tmp_path):
    write_token_ids(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"), PATH)
    assert read_token_ids(spark, str(tmp_path / "a")).collect() == []


def test_a_reading_task_holds_few_blocks(spark, tmp_path, monkeypatch):
    """Row groups end at their size, not only after 100 blocks; no text or id goes through Python a second time."""
    monkeypatch.setitem(idfile.GROUPS, "parquet.block.size", 1 << 16)
    docs = spark.range(1, 81).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 1000), i -> id * i), ' ') AS text")
    path = str(tmp_path / "a")
    write_token_ids(docs.coalesce(1), path, PATH, block_ids=1 << 10)
    groups = []
    for file in (tmp_path / "a" / "blocks").glob("*.parquet"):
        about = pq.ParquetFile(file).metadata
        groups += [about.row_group(i) for i in range(about.num_row_groups)]
    blocks = sum(g.num_rows for g in groups)
    assert blocks == 80 and max(g.num_rows for g in groups) <= 20
    found = {(r.doc_id, r.ids_crc32) for r in token_checksums(read_token_ids(spark, path)).collect()}
    assert found == {(r.doc_id, zlib.crc32(r.ids)) for r in read_token_ids(spark, path).collect()}
