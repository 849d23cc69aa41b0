"""Nodes against a dictionary of prefixes, and the query against its SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tiermill.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(sequences):
    """Node rows of {conversation: [(role, text), ...]}, by a plain dictionary of prefixes."""
    if not sequences:
        return []
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)]
        ends = sorted(c for c in convs if len(sequences[c]) == len(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(p) == len(path) + 1 for p in below), len(leaves),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def sequences_of(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in own.items()}


def rebuild(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def got(df):
    assert df.columns == COLUMNS
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_up(seed, n, most, letters):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, most)):
            rows.append((c * 37 % 251, turn if turn else None, rng.choice(["user", None, ""]), rng.choice(letters)))
    # equal turns of one conversation have no order but by hash; one row for each place is enough here
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("limit, block", [(1, 2), (12, 3), (100_000, 1024)])
def test_shards_of_any_size_give_the_same_nodes(spark, limit, block):
    letters = ["", "a", "bb", "é😀", None]
    rows = made_up(1, 90, 9, letters) + [(1000 + i, t, "user", "hot") for i in range(25) for t in range(5)]
    rows += [(2000 + i, t, "user", "hot" if t < 6 else f"own {i}") for i in range(25) for t in range(8)]
    rows += [(3000, t, "user", str(t % 3)) for t in range(40)] + [(3001, t, "user", str(t % 3) if t < 39 else "x") for t in range(40)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    want = brute(sequences_of(rows))
    assert got(prefix_trie.nodes(*prefix_trie.whole(turns), shard_turns=limit, block=block)) == want


def test_rebuilt_with_absent_sources_short_sources_and_turnless(spark):
    rows = made_up(2, 120, 4, ["a", "b"]) + [(100 * k, t, "user", f"head {t}") for k in (3, 4) for t in range(k)]
    rows += [(300 + i, t, "user", "x") for i in range(1, 60) for t in range(3)] + [(-7, 0, "user", "x"), (900_001, 0, "user", "lonely")]
    rows += [(None, 0, "user", "no conversation")]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("conv", "pos", "d", "k1", "n", "shard")})
    turns = prefix_trie.turns_of(df)
    own = sequences_of(rows)
    want = rebuild({c: t for c, t in own.items() if c >= 0})
    # for a negative id the remainder has the sign of the id, as in SQL
    h = zlib.crc32(b"-7") % 6
    want[-7] = own.get(0, [])[:h] + own[-7][h:]
    assert any(not t for t in want.values())
    assert got(prefix_trie.nodes(*prefix_trie.rebuilt(turns), shard_turns=30)) == brute(want)


def test_repeated_turns_are_turns_of_their_own_and_empty_tables_give_nothing(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, None, "", ""), (2, 0, "user", "a")]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    assert got(prefix_trie.nodes(*prefix_trie.whole(turns))) == brute(sequences_of(rows))
    none = prefix_trie.turns_of(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.nodes(*prefix_trie.rebuilt(none)).count() == 0


def test_a_conversation_over_many_tasks_keeps_its_order(spark):
    rows = [(5, t, "user", str(t)) for t in range(3_000)] + [(c, t, "user", str(t)) for c in (4, 6) for t in range(5)]
    random.Random(3).shuffle(rows)
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA).repartition(8))
    want = {(c, t, len(x)) for c, t, _, x in rows}
    assert {(r["conv"], r["pos"], r["size"]) for r in turns.collect()} == want


def test_members_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, 0, "user", "same") for c in range(-20, 200, 3)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    assert got(prefix_trie.nodes(*prefix_trie.whole(turns))) == brute(sequences_of(rows))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 6), max_size=7), max_size=30))
def test_double_array(sequences):
    base, check = prefix_trie.double_array(sequences)
    seen = {}
    for s in sequences:
        state = 0
        for i, c in enumerate(s):
            after = base[state] + c
            assert check[after] == state
            assert seen.setdefault(after, tuple(s[: i + 1])) == tuple(s[: i + 1])
            state = after
    assert sum(c >= 0 for c in check) == 1 + len({tuple(s[:i]) for s in sequences for i in range(1, len(s) + 1)})


def test_query_and_its_sql(spark):
    mine = got(queries.op12_prefix_trie(spark, SF))
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert mine == brute(rebuild(sequences_of(rows)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    res = con.execute(queries.ORACLE_SQL["op12_prefix_trie"])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(COLUMNS)
    assert sorted((tuple(r[names.index(c)] for c in COLUMNS) for r in res.fetchall()), key=str) == mine
