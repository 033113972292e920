"""Secret scans by an incremental ledger of blobs, with SQL functions alone.

Every version of every document is addressed by the SHA-256 of its text. The
ledger says which (blob, rule, rule version) were scanned and with what result,
so only pairs it does not hold are scanned, each distinct blob once; findings
are joined back to all documents that carry the blob.

Null text counts as empty. Rows with a null ``doc_id`` and repeated rows come
out like any others; an empty table gives an empty result. Other columns are
not read. Rules are leftmost and non-overlapping per rule; a match whose
decisive group is shorter than its least length is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import stored, texts

#: Paths of one blob are spread over so many join keys.
SALTS = 32


@dataclass(frozen=True)
class Rule:
    """``decisive``: the group whose length counts (0: the whole match)."""

    name: str
    pattern: str
    decisive: int
    least: int
    version: int = 1


# The base rules, in the order that spans of one start are listed in.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)

SPAN = "struct<start:bigint,end:bigint,rank:int,kind:string>"
LEDGER = f"blob string, rule string, version int, spans array<{SPAN}>"


def _spans(rule: Rule, rank: int) -> F.Column:
    """Spans of a rule: the text between matches and the matches alternate, so
    running sums of their lengths are the places, in code points."""
    pattern = F.lit(rule.pattern)
    lengths = lambda column: F.transform(column, lambda x: F.length(x).cast("bigint"))
    parts = F.arrays_zip(
        lengths(F.split("text", rule.pattern, -1)).alias("gap"),
        lengths(F.regexp_extract_all("text", pattern, F.lit(0))).alias("size"),
        lengths(F.regexp_extract_all("text", pattern, F.lit(rule.decisive))).alias("part"),
    )
    empty = f"CAST(array() AS array<{SPAN}>)"
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(empty).alias("spans"))

    def step(done, part):
        start = done["at"] + part["gap"]
        end = start + F.coalesce(part["size"], F.lit(0).cast("bigint"))
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(rule.name).alias("kind"))
        keep = F.coalesce(part["part"] >= rule.least, F.lit(False))
        return F.struct(end.alias("at"), F.when(keep, F.array_append(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    found = F.aggregate(parts, state, step, lambda done: done["spans"])
    return F.when(F.col("text").rlike(rule.pattern), found).otherwise(F.expr(empty))


def blobs(docs: DataFrame) -> DataFrame:
    """(doc_id, text, blob)."""
    return texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))


def _current(rules: tuple[Rule, ...]) -> F.Column:
    return F.expr(" OR ".join(f"(rule = '{r.name}' AND version = {r.version})" for r in rules))


def scan_unseen(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New rows of the ledger: pairs of blob and rule version not in ``ledger``.

    Append them to the ledger's table, also those without spans. Each blob is read
    once for all rules; what the ledger knows of it says which of them are tried.
    """
    seen = ledger.where(_current(rules)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = blobs(docs).select("blob", "text").dropDuplicates(["blob"]).join(seen, "blob", "left")
    pairs = F.array(*(
        F.when(
            ~F.coalesce(F.array_contains("seen", rule.name), F.lit(False)),
            F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"), _spans(rule, rank).alias("spans")),
        )
        for rank, rule in enumerate(rules)
    ))
    return todo.select("blob", F.inline(F.array_compact(pairs)))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``(findings, new)``: (doc_id, spans) of every row, and the ledger's new rows.

    ``findings`` holds what the ledger knew and what is new, under ``rules``. A
    first scan begins with an empty ledger.
    """
    if ledger is None:
        none = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in (f.split(" ", 1) for f in LEDGER.split(", ")))
        ledger = docs.sparkSession.sql(f"SELECT {none} WHERE false")
    new = stored(scan_unseen(docs, ledger, rules), "ledger")
    known = new.unionByName(ledger.where(_current(rules)).select("blob", "rule", "version", "spans"))
    hits = (
        known.where("size(spans) > 0").groupBy("blob", "rule", "version").agg(F.first("spans").alias("spans"))
        .groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        .select("blob", F.expr("array_sort(spans, (a, b) -> CASE WHEN a.start != b.start THEN IF(a.start < b.start, -1, 1) ELSE a.rank - b.rank END)").alias("spans"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    paths = blobs(docs).select("doc_id", "blob", F.expr(f"CAST(pmod(xxhash64(doc_id), {SALTS}) AS INT)").alias("salt"))
    findings = paths.join(hits, ["blob", "salt"], "left").select(
        "doc_id", F.coalesce("spans", F.expr(f"CAST(array() AS array<{SPAN}>)")).alias("spans")
    )
    return findings, new


def redact_secrets(docs: DataFrame, mark: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced; all rows and columns stay.

    Overlapping spans are replaced as one. A null text stays null.
    """
    whole, _ = scan_secrets(docs, None, rules)
    spans = whole.where("size(spans) > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("spans").alias("all"))
    # rows of one doc_id may differ in text: rescan those few rows themselves
    ids = spans.select("doc_id")
    clean = docs.join(ids, "doc_id", "left_anti").where("doc_id IS NOT NULL")
    dirty = docs.join(ids, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    own = F.array_sort(F.flatten(F.array(*(_spans(r, n) for n, r in enumerate(rules)))))
    merged = F.aggregate(
        own,
        F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["end"]),
            F.array_append(
                F.slice(done, 1, F.size(done) - 1),
                F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")),
            ),
        ).otherwise(F.array_append(done, F.struct(s["start"].alias("start"), s["end"].alias("end")))),
    )
    text = (
        "IF(size({m}) = 0, text, concat(array_join(transform({m}, (s, i) -> substr(text, "
        "CAST(IF(i = 0, 0, {m}[greatest(i - 1, 0)].end) AS INT) + 1, CAST(s.start - IF(i = 0, 0, {m}[greatest(i - 1, 0)].end) AS INT))), {q}), "
        "{q}, substr(text, CAST({m}[size({m}) - 1].end AS INT) + 1)))"
    )
    name = "__merged_spans"
    cleaned = dirty.withColumn(name, merged).withColumn(
        "text", F.expr(text.format(m=name, q="'" + mark.replace("'", "\\'") + "'"))
    ).select(*docs.columns)
    return clean.select(*docs.columns).unionByName(cleaned)
