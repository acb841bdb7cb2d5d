import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wattframe.llm import prefix_trie as trie
from wattframe.llm import queries
from wattframe.llm.common import table
from wattframe.llm.conversation_repair import cheapest_edits, damage, edited, faults, repair
from wattframe.llm.tree_contraction import subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string, dropped_ string, place string, part string, key string, a string"
LEGAL = re.compile(r"(s?(ua)+)?")


def dijkstra(turns):
    """Least cost and least letters of it, from a queue ordered by cost and letters; roles are written out and matched whole."""
    queue, most = [(0, "", 0, "")], 4 * len(turns) + 1
    while queue:
        cost, audit, at, roles = heapq.heappop(queue)
        if at == len(turns) and LEGAL.fullmatch(roles):
            return cost, audit
        steps = []
        if at < len(turns):
            letter, fault = turns[at]
            steps.append((4, "D", at + 1, roles))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                steps += [(more, "K", at + 1, roles + (letter or "?")), *((3 + more, "R", at + 1, roles + r) for r in "ua")]
        steps += [(3, "I", at, roles + r) for r in "ua"]
        for more, letter, to, now in steps:
            if cost + more <= most and re.fullmatch(r"s?(ua)*u?", now):
                heapq.heappush(queue, (cost + more, audit + letter, to, now))


@pytest.mark.parametrize("seed", range(150))
def test_edits_against_all_others(seed):
    rng = random.Random(seed)
    kinds = ["sound"] * 5 + ["truncated", "blank", "duplicate"]
    turns = [(rng.choice("uuuaaasx") if rng.random() > 0.03 else "", rng.choice(kinds)) for _ in range(rng.randrange(6))]
    assert cheapest_edits(turns) == dijkstra(turns)


def test_long_conversations_stay_quick():
    rng = random.Random(3)
    turns = [(rng.choice("uuas"), rng.choice(["sound", "sound", "truncated", "blank"])) for _ in range(20_000)]
    cost, audit = cheapest_edits(turns)
    assert len(audit.replace("I", "")) == len(turns) and cost > 0
    again = edited([(r, "") for r, _ in turns], audit)
    assert LEGAL.fullmatch("".join(r[0] for r, _ in again))


def test_faults():
    turns = [("user", "a."), ("user", "a."), ("user", " \t"), ("user", " \t"), ("assistant", "a."), ("u", "sera."), ("use", "ra.")]
    assert faults(turns) == ["sound", "duplicate", "blank", "blank", "sound", "sound", "sound"]
    assert faults([("user", "why? \n"), ("user", "so "), ("user", ".x")]) == ["sound", "truncated", "truncated"]


def plain_damage(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        mine = out[c]
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        mine += [(t, role, text)] * (2 if kind == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def plain_repair(rows):
    out = {}
    for c, turns in plain_damage(rows).items():
        seen, found = set(), []
        for _, role, text in turns:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "sound"
            found.append(fault)
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        cost, audit = dijkstra([(role[:1], fault) for (_, role, _), fault in zip(turns, found, strict=True)])
        lines, rest, before = [], iter(turns), ""
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(rest)[1:]
            if letter in "IR":
                role = "assistant" if before == "u" else "user"
            if letter != "D":
                lines.append(f"{role}:{text}")
                before = role[:1]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:], strict=False)]
        out[c] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def check_repair(spark, rows, df):
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    got = repair(damage(df), F.col("dropped")).withColumn("sha", F.sha2(lines, 256)).collect()
    want = plain_repair(rows)
    assert len(got) == len(want)
    for r in got:
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.sha) == want[r.conv_id], r.conv_id


@pytest.fixture(scope="module")
def odd_turns():
    rng = random.Random(11)
    long = "Very long. " * 20_000
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "assistant", long), (1, 2, "assistant", long),
        (2, None, "user", "No turn."), (2, None, "user", "No turn."), (2, 3, None, None), (2, -4, "assistant", ""),
        (3, 0, None, "Roleless."), (3, 1, "", "Nobody."), (3, 2, "User", "Capital?"), (3, 3, "tool", "42"),
        (None, 1, "user", "No number."), (None, 2, "assistant", "Nor here!"), (None, None, None, None),
        (-25, 0, "user", "Below zero."), (-25, 1, "assistant", "Cold…"), (4, 7, "assistant", "Last."), (4, 7, "user", "Ärger?"),
        (20, 0, "user", "Shared start."), (20, 1, "assistant", "Yes."), (5, 0, "user", ",;:\x00"), (2**62, 5, "user", "Large."),
    ]
    for c in range(30, 75):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No.", "Why", "Tell me more!", " "])))
    return rows


@pytest.fixture(scope="module")
def odd_turns_df(spark, odd_turns):
    extra = ("x",) * 5
    return spark.createDataFrame([(*r, *extra) for r in odd_turns], SCHEMA).repartition(5)


def test_repair(spark, odd_turns, odd_turns_df):
    check_repair(spark, odd_turns, odd_turns_df)


def test_repair_given_rows(spark):
    df = table(spark, "/root/testdata/sf0.001", "conversations")
    check_repair(spark, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], df)


def test_no_conversations(spark, odd_turns_df):
    none = odd_turns_df.where("false")
    assert repair(damage(none), F.col("dropped")).collect() == [] and repair(none).collect() == []
    assert trie.prefix_trie(trie.with_shared_beginnings(trie.in_order(none))).collect() == []


def test_a_conversation_that_lost_all_turns(spark):
    c = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = repair(damage(spark.createDataFrame([(c, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")), F.col("dropped")).collect()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", [])


# the trie


def brute_trie(rows, shared):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    plain = {c: [r[1:] for r in turns] for c, turns in convs.items()}
    whole = {}
    for c, turns in plain.items():
        h = 0 if c is None or not shared else zlib.crc32(str(c).encode()) % 4
        first = c if c is None else (c - c % 20 if c >= 0 else c + (-c) % 20)
        whole[c] = plain.get(first, [])[:h] + turns[h:]
    last = 2**63
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaf = lambda n: not any(m[: len(n)] == n and len(m) > len(n) for m in members)
        ends = sorted((c for c in ids if len(whole[c]) == len(node)), key=lambda c: last if c is None else c)
        small = lambda n: min((c for c in members[n] if c is not None), default=None)
        words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        out.append((
            small(node), len(node), small(node[:-1]) if node else None, len(ids), len(children), sum(map(leaf, below)),
            sum((len(members[n]) - 1) * words(n) for n in below),
            hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shared", [False, True])
def test_trie(odd_turns, odd_turns_df, shared):
    # ties in turn are ordered by hashes of the text; here all that differ also differ in role
    placed = trie.in_order(odd_turns_df)
    got = trie.prefix_trie(trie.with_shared_beginnings(placed) if shared else placed)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(odd_turns, shared)


def test_trie_with_split_nodes_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "_LEAST_SPLIT", 5)
    monkeypatch.setattr(trie, "_PIECE", 30)
    rng = random.Random(5)
    rows = [(c, t, "user", "same" if t == 0 or c % 3 == 0 else str(rng.randrange(40))) for c in range(150) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = trie.prefix_trie(trie.in_order(df))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows, False)


def test_rows_of_the_query(spark):
    got = queries.queries()["op13_prefix_trie"](spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == brute_trie(rows, True)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_subtree_sums(spark, shape):
    rng = random.Random(1)
    n = 60
    parent = {
        "chain": lambda k: k - 1 if k else None,
        "star": lambda k: 0 if k else None,
        "random": lambda k: rng.randrange(k) if k else None,
        "forest": lambda k: rng.randrange(k) if k % 10 else None,
    }[shape]
    rows = [(k, parent(k), rng.randrange(100), 1) for k in range(n)]
    want = {k: [v, 1] for k, _, v, _ in rows}
    for k, p, _, _ in reversed(rows):
        if p is not None:
            want[p][0] += want[k][0]
            want[p][1] += want[k][1]
    nodes = spark.createDataFrame(rows, "key long, parent long, v long, one long")
    got = {r.key: [r.v, r.one] for r in subtree_sums(nodes, ["v", "one"]).collect()}
    assert got == want


def test_no_forest(spark):
    nodes = spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "key long, parent long, v long")
    with pytest.raises(ValueError):
        subtree_sums(nodes, ["v"])
