"""Conversation repair against exhaustive search, whole tables against a plain version."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from starmart.llm import conversation_repair as repairing

COLUMNS = "conv_id long, turn long, role string, text string"
FIELDS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SF_DIR = "/root/testdata/sf0.001"


def exhaustive(symbols):
    """(cost, audit) over all edits with few inserts, strings compared as they are."""
    best = None

    def go(k, made, cost, audit, inserts):
        nonlocal best
        if k == len(symbols) and re.fullmatch(r"(s?(ua)+)?", made):
            best = min(best or (cost, audit), (cost, audit))
        if inserts < 3:
            for role in "ua":
                go(k, made + role, cost + 2, audit + "I", inserts + 1)
        if k < len(symbols):
            initial, must_go, truncated = symbols[k]
            go(k + 1, made, cost + 3, audit + "D", inserts)
            if not must_go:
                if initial:
                    go(k + 1, made + initial, cost + truncated, audit + "K", inserts)
                for role in "ua":
                    go(k + 1, made + role, cost + 2 + truncated, audit + "R", inserts)

    go(0, "", 0, "", 0)
    return best


def symbols_of(rng, size):
    out = []
    for _ in range(size):
        must_go = rng.random() < 0.2
        out.append((rng.choice("ssuuuaaax "), must_go, not must_go and rng.random() < 0.2))
    return out


def test_cheapest_edits_and_ties():
    rng = random.Random(1)
    for _ in range(250):
        symbols = symbols_of(rng, rng.randint(0, 4))
        assert repairing.repair(symbols) == exhaustive(symbols)


def test_fragments_chain_to_the_whole():
    rng = random.Random(2)
    for size in (1, 3, 40):
        for _ in range(40):
            symbols = symbols_of(rng, rng.randint(1, 120))
            parts = [symbols[k : k + size] for k in range(0, len(symbols), size)]
            cost, chosen = repairing.chain_fragments([repairing.fragment_ways(p) for p in parts])
            assert (cost, "".join(a for _, a in chosen)) == repairing.repair(symbols)


def plain(rows):
    """The contract read literally; the edits by a search over (row, sequence state) with whole strings."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        kept = conversations[conv]
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, marks, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not visible else 1 if (role, text) in seen else 2 if visible[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marks.append((role[:1], fault in (0, 1), fault == 2))
        cost, audit, made = cheapest(tuple(marks), tuple((r, t) for _, r, t in rows))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=str)


def cheapest(marks, rows):
    """Backward search: state is what may come next (0 start, 1 user after system, 2 assistant, 3 user or end)."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(k, state, inserts):
        ways = [(0, "", ())] if k == len(marks) and state in (0, 3) else []

        def then(cost, letter, made, rest):
            if rest:
                ways.append((cost + rest[0], letter + rest[1], made + rest[2]))

        for role, name in (("u", "user"), ("a", "assistant")):
            if (state, role) in after and inserts < 2:
                then(2, "I", (f"{name}:",), best(k, after[state, role], inserts + 1))
        if k < len(marks):
            initial, must_go, truncated = marks[k]
            then(3, "D", (), best(k + 1, state, 0))
            if not must_go:
                if (state, initial) in after:
                    then(int(truncated), "K", (":".join(rows[k]),), best(k + 1, after[state, initial], 0))
                for role, name in (("u", "user"), ("a", "assistant")):
                    if (state, role) in after:
                        then(2 + truncated, "R", (f"{name}:{rows[k][1]}",), best(k + 1, after[state, role], 0))
        return min(ways) if ways else None

    return best(0, 0, 0)


def got(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.collect()), key=str)


def made_up(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 2, 3])
            rows.append((
                rng.choice([conv, conv, conv, None]), rng.choice([turn, turn, turn, None]),
                rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]),
                rng.choice(["Hi.", "Why?", "Because", " \n", "", None, "Yes!  ", "é ß…", "long " * 50 + "."]) if rng.random() < 0.5
                else f"text {rng.random()}.",
            ))
    return list({r[:3]: r for r in rows}.values())  # ties of turn and role have no order of their own


@pytest.mark.parametrize("partitions", [1, 40])
def test_equals_plain_version(spark, partitions):
    rows = made_up(3, 60, 12)
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 AS fragment", "'x' AS copies", "2 AS plan")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(repairing.repair_conversations(df.repartition(3))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_conversation_over_many_blocks(spark):
    rng = random.Random(7)
    rows = [(5, k, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"t{k}.", "cut"])) for k in range(220)]
    df = spark.createDataFrame(rows + [(6, 0, "user", "Hi.")], COLUMNS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = repairing.settle_blocks(repairing.damage(df))
        assert blocks.where("fragment IS NOT NULL AND conv_id = 5").count() > 4
        assert got(repairing.repair_conversations(df)) == plain(rows + [(6, 0, "user", "Hi.")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_and_dropped(spark):
    df = spark.createDataFrame([], COLUMNS)
    assert repairing.repair_conversations(df).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    only = got(repairing.repair_conversations(spark.createDataFrame([(gone, 0, "user", "x.")], COLUMNS)))
    assert only == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_text_ids(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "assistant", "Yes."), ("b", 1, "user", "Hm")]
    found = got(repairing.repair_conversations(spark.createDataFrame(rows, COLUMNS.replace("conv_id long", "conv_id string"))))
    assert found == plain(rows)


def test_given_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(repairing.repair_conversations(table)) == plain(rows)
