import hashlib
import itertools
import re
import zlib

import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import repair
from logloom.llm.entry import op11_conversation_repair
from logloom.llm.repair import Chain, repair_conversations, repair_damaged, search, transfers

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
LEGAL = re.compile("(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(kinds):
    """All edits of few rows, without a search."""
    rows = [kinds[i : i + 2] for i in range(0, len(kinds), 2)]
    choices = []
    for initial, fault in rows:
        cut = fault == "t"
        kept = [] if fault in "bd" else [("K", cut, initial), ("R", 2 + cut, "u"), ("R", 2 + cut, "a")]
        choices.append([*kept, ("D", 3, "")])
    gaps = [("", 0, ""), ("I", 2, "u"), ("I", 2, "a"), ("II", 4, "ua"), ("II", 4, "au")]
    best = None
    for edits in itertools.product(*choices):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            steps = [x for pair in itertools.zip_longest(put, edits) for x in pair if x]
            if LEGAL.fullmatch("".join(r for *_, r in steps)):
                found = sum(c for _, c, _ in steps), "".join(a for a, *_ in steps)
                best = min(best or found, found)
    return best


@pytest.mark.parametrize("n", [0, 1, 2])
def test_search_against_all_edits(n):
    for rows in itertools.product([a + b for a in "suax" for b in "-bt"], repeat=n):
        kinds = "".join(rows)
        assert search(kinds, 0, None) == cheapest(kinds), kinds


@settings(deadline=None, max_examples=40)
@given(st.lists(st.sampled_from([a + b for a in "suax" for b in "-bt"]), min_size=3, max_size=3))
def test_search_against_all_edits_of_more_rows(rows):
    assert search("".join(rows), 0, None) == cheapest("".join(rows))


def by_table(kinds):
    """Costs and audits row by row: the least (cost, audit) for each role so far."""
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    onward = (2, 2, 3, 2)
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(2):
            for state, (cost, audit) in list(best.items()):
                new = (cost + 2, audit + "I")
                best[onward[state]] = min(best.get(onward[state], new), new)
        return best

    for at in range(0, len(kinds), 2):
        initial, fault = kinds[at : at + 2]
        new = {}
        for state, (cost, audit) in inserted(best).items():
            ways = [(3, "D", state)]
            if fault not in "bd":
                ways.append((2 + (fault == "t"), "R", onward[state]))
                if (state, initial) in kept:
                    ways.append((int(fault == "t"), "K", kept[state, initial]))
            for c, a, s in ways:
                found = (cost + c, audit + a)
                new[s] = min(new.get(s, found), found)
        best = new
    best = inserted(best)
    return min(best[s] for s in (0, 3) if s in best)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.sampled_from([a + b for a in "uuuaasx" for b in "---bdt"]), max_size=70), st.integers(1, 9))
def test_blocks_chain_to_the_whole(rows, block):
    kinds = "".join(rows)
    want = by_table(kinds)
    if len(rows) <= 40:
        assert search(kinds, 0, None) == want
    chain, parts = Chain(), [kinds[i : i + 2 * block] for i in range(0, len(kinds), 2 * block)]
    for part in parts:
        chain.add(*transfers(part))
    cost, ways, closing = chain.ways()
    assert (cost, "".join(search(p, i, j)[1] for p, (i, j) in zip(parts, ways)) + closing) == want


def test_search_of_bad_blocks_is_short():
    for kinds in ("u-" * 32, "a-" * 32, "s-" * 32, "xt" * 32, "u-a-" * 16, "utat" * 16, "a-u-s-" * 10, "ud" * 32):
        assert search(kinds, 0, None) == by_table(kinds)


def damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        h = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(h, text)
        if h:
            yield from [(conv_id, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)


def brute(rows, damaging=True):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).extend(damage([r]) if damaging else [(*r[:2], *(" " if x is None else x for x in r[2:]))])
    out = set()
    for conv_id, rows in convs.items():
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, kinds = set(), ""
        for _, _, role, text in rows:
            visible = WORD.findall(text)
            fault = "b" if not visible else "d" if (role, text) in seen else "-" if visible[-1] in ".!?" else "t"
            seen.add((role, text))
            kinds += (role[:1] if role[:1] in list("sua") else "x") + fault
        initials = [r[2][:1] for r in rows]
        turns = {r[1] for r in rows} - {None}
        cost, audit = by_table(kinds)
        state, left, lines = 0, iter(rows), []
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[2:]
            if edit != "D":
                state = {"s": 1, "u": 2, "a": 3}[role[0]] if edit == "K" else (2, 2, 3, 2)[state]
                lines.append(f"{role if edit == 'K' else {2: 'user', 3: 'assistant'}[state]}:{text}")
        out.add((
            conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds[1::2].count(f) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return out


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op11_conversation_repair(spark, SF_DIR).select(*COLUMNS).collect()
    want = brute(rows)
    assert len(found) == len(want) and {tuple(r) for r in found} == want


SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, audit string, h int"


def odd_rows():
    roles = ("user", "assistant", "system", "User", "", None, "tool", "ürole")
    texts = (None, "", " \x0b\t", "Ends.", "Ends. \n", "open", "\xa0", "a\nb?", "日本。")
    yield from ((1, None, r, t) for r in roles for t in texts)
    yield from ((None, n, roles[n % 3], texts[n % 7]) for n in range(60))
    yield from ((2, 3, "user", "same.") for _ in range(50))
    yield from ((3, n // 2, roles[n % 2], f"{n % 11}.") for n in range(600))
    yield from ((4 + n, 5, roles[n % 5], texts[n % 9]) for n in range(120))
    yield (9000, -5, "user", "x" * 300_000)
    yield (9000, 2**40, "assistant", "y." * 100_000)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_odd_rows_over_many_partitions(spark, parts, monkeypatch):
    rows = list(odd_rows())
    turns = spark.createDataFrame([(*r, 7, "", 0) for r in rows], SCHEMA).repartition(5)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repair_damaged(turns).select(*COLUMNS).collect()
        plain = repair_conversations(turns).select(*COLUMNS).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == len({r[0] for r in rows}) and {tuple(r) for r in found} == brute(rows)
    assert {tuple(r) for r in plain} == brute(rows, False)


def test_a_long_conversation_in_one_partition(spark, monkeypatch):
    rows = [(1, n, ("user", "assistant")[n * n % 3 % 2], f"{n % 900}" + "." * (n % 5 > 0)) for n in range(2 * repair.LOCAL_ROWS)]
    turns = spark.createDataFrame([(*r, 0, "", 0) for r in [(0, 0, "user", "Hi."), *rows]], SCHEMA).coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = repair_conversations(turns).select(*COLUMNS).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {tuple(r) for r in found} == brute([(0, 0, "user", "Hi."), *rows], False)


def test_nothing_left(spark):
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    found = repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.", 0, "", 0)], SCHEMA)).select(*COLUMNS).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []
