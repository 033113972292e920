"""Language identification by error-correcting output codes.

Each language has a codeword, and each bit of the code a binary linear
classifier over hashed byte n-grams. A text's language is the codeword of least
logistic loss over all bits; ``score`` is that language's share after weighing
languages by their losses, and a text is ambiguous where the runner-up's share
comes within ``MARGIN``.

The classifiers are fitted on a bounded sample of labelled rows (``sample`` rows
over all languages, expected; drawn by hash of the key), by gradient steps on the
driver: what reaches it are the non-zero counts of ``sample`` vectors, which fill
one array of ``sample`` x ``DIMS`` numbers.

A text without letters or a null text is ``und`` with score 0. Rows with null
``doc_id`` take part; rows without a label are predicted, not learned from. If
there is no labelled row at all, every text is ``und``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import stored
from logloom.llm.words import slices, text_bytes

DIMS = 1 << 12
SAMPLE = 4000
STEPS = 150
MARGIN = 0.1
UNKNOWN = "und"
LETTER = r"\p{L}"

_CLASSES = np.zeros(256, np.uint32)  # letters keep their byte, all else is one class
for _byte in range(256):
    if _byte >= 0x80 or chr(_byte).isalpha():
        _CLASSES[_byte] = ord(chr(_byte).lower()) if _byte < 0x80 else _byte


def _features(column: pa.Array) -> np.ndarray:
    """A row of scaled n-gram counts (n = 1 to 3, within the text) per text."""
    data, bounds = text_bytes(pc.utf8_lower(pa.array(column).fill_null("").cast(pa.large_string())))
    code = _CLASSES[data]
    out = np.zeros((len(bounds) - 1, DIMS), np.float32)
    grams, ends = [], []
    for n in (1, 2, 3):
        hashed = np.zeros(max(len(code) - n + 1, 0), np.uint32)
        for k in range(n):
            hashed = (hashed + code[k : k + len(hashed)] + np.uint32(1)) * np.uint32(0x9E3779B1)
        grams.append((hashed >> np.uint32(20)).astype(np.int64))
        ends.append(n - 1)
    for row, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        for hashed, cut in zip(grams, ends):
            if hi - cut > lo:
                out[row] += np.bincount(hashed[lo : hi - cut], minlength=DIMS)
    out = np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1))
    return out


def codewords(n: int) -> np.ndarray:
    """Rows of -1 and 1: all splits of up to 7 languages, else splits by hash."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        splits = [[1 if (s << 1 | 1) >> k & 1 else -1 for k in range(n)] for s in range(2 ** (n - 1) - 1)]
    else:
        bits = 8 * int(np.ceil(np.log2(n)))
        splits = [[1 if xxhash.xxh64_intdigest(f"{b}:{k}") & 1 else -1 for k in range(n)] for b in range(bits)]
    return np.array(splits, float).T


def _fit(x: np.ndarray, y: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A weight vector per bit (the last weight is the offset); languages count alike.

    ``x`` ends with a column of ones.
    """
    weight = 1 / np.bincount(y, minlength=len(codes))[y]
    weight = (weight / weight.sum())[:, None].astype(np.float32)
    target = codes[y].astype(np.float32)
    w = np.zeros((x.shape[1], codes.shape[1]), np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        slope = x.T @ (-target * weight / (1 + np.exp(np.clip(target * (x @ w), -50, 50)))) + 1e-5 * w
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        w -= 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w


def _vectors(batches: Iterator[pa.RecordBatch]):
    """The places and values of the counts that are not zero."""
    for batch in slices(batches):
        vectors = _features(batch["text"])
        places = [np.flatnonzero(v) for v in vectors]
        yield pa.RecordBatch.from_arrays(
            [
                batch["lang"],
                pa.array([p.astype("<u2").tobytes() for p in places], pa.binary()),
                pa.array([v[p].astype("<f4").tobytes() for v, p in zip(vectors, places)], pa.binary()),
            ],
            ["lang", "places", "counts"],
        )


def fit_languages(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, codewords, weights) from ``labelled`` (doc_id, text, lang).

    Rates per language are broadcast where there are at most ``sample`` languages.
    """
    rows = labelled.selectExpr("CAST(doc_id AS STRING) AS doc_id", "CAST(text AS STRING) AS text", "CAST(lang AS STRING) AS lang")
    rows = rows.where((F.col("lang") != UNKNOWN) & F.col("text").rlike(LETTER))
    share = rows.groupBy("lang").count()
    share = stored(share.selectExpr("lang AS of", f"{sample} / (count(*) OVER ()) / count AS rate"), "rates")
    if share.count() <= sample:
        share = F.broadcast(share)
    drawn = rows.join(share, F.col("lang") == F.col("of")).where("pmod(xxhash64(doc_id, 'sample'), 1000000007) < rate * 1000000007D")
    found = drawn.select("lang", "text").mapInArrow(_vectors, "lang string, places binary, counts binary").toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    codes = codewords(len(languages))
    if not languages:
        return languages, codes, np.zeros((DIMS + 1, 1), np.float32)
    x = np.zeros((len(found), DIMS + 1), np.float32)
    x[:, DIMS] = 1
    for row, (places, counts) in enumerate(zip(found["places"], found["counts"])):
        x[row, np.frombuffer(places.as_buffer(), "<u2")] = np.frombuffer(counts.as_buffer(), "<f4")
    y = np.searchsorted(languages, found["lang"].to_pylist())
    del found
    return languages, codes, _fit(x, y, codes)


def _decode(batches: Iterator[pa.RecordBatch], model):
    languages, codes, weights = model.value
    for batch in slices(batches):
        margins = _features(batch["text"]) @ weights[:-1] + weights[-1]
        loss = np.logaddexp(0, -margins[:, None, :] * codes[None]).sum(2) if languages else np.zeros((batch.num_rows, 1))
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        order = np.sort(share, axis=1)
        gap = order[:, -1] - order[:, -2] if len(languages) > 1 else np.ones(batch.num_rows)
        known = pc.match_substring_regex(batch["text"].fill_null(""), LETTER).to_numpy(zero_copy_only=False) & bool(languages)
        names = np.array(languages or [UNKNOWN], object)[loss.argmin(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(np.where(known, names, UNKNOWN), pa.string()),
                pa.array(np.where(known, share.max(1), 0.0)),
                pa.array((gap < MARGIN) & known),
            ],
            ["doc_id", "lang_pred", "score", "ambiguous"],
        )


def predict_languages(docs: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous), one row per row of ``docs``; only texts count."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")
    return rows.mapInArrow(
        functools.partial(_decode, model=sent), "doc_id bigint, lang_pred string, score double, ambiguous boolean"
    )


def held_out() -> F.Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def labelled(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())


def with_known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without those whose language can't be told: no letters, or a
    score below ``least``. Rows with null ``doc_id`` are kept if their text has letters."""
    if docs.isEmpty():
        return docs
    model = fit_languages(labelled(docs))
    known = predict_languages(docs, model).where(F.col("score") >= least).select("doc_id").distinct()
    return docs.join(known, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull() & F.col("text").rlike(LETTER)))
