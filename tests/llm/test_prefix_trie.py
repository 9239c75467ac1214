"""The prefix trie against brute force, in one part and in many."""

import hashlib
import random
import re
import zlib

import pytest

from ladderline.llm import prefix_trie, queries


def brute(rows):
    """{(conv_id, depth): rest of the row}."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(c, []).append((turn is not None, turn or 0, d, (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, t in own.items():
        h, first = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(first, [])[:h] + t[h:])
    members = {}
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words
    out = {}
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if whole[c] == p))
        out[(min(m), len(p))] = (min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
    return out


def check(df, rows, parts, spark):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = prefix_trie.prefix_trie(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    cols = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    assert {(r.conv_id, r.depth): tuple(r[c] for c in cols) for r in got} == brute(rows)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_random_conversations(spark, parts, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 60)
    rnd, rows = random.Random(parts), []
    for c in rnd.sample(range(-50, 400), 160):
        for turn in range(rnd.choice([1, 1, 2, 3, 5])):
            rows.append((c, rnd.choice([turn, turn, None, 1]), rnd.choice(["user", "", None]), rnd.choice(["a b", "", None, "c d e\nf", "x"])))
    rows += [(1000 + c, t, "user", f"hello there {t}") for c in range(60) for t in range(4)]  # copies
    rows += [(None, 1, "user", "nobody's"), (7, 1, "user", "a b"), (7, 1, "user", "a b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumnRenamed("text", "text")
    check(df.selectExpr("*", "'z' AS path", "1 AS words", "2 AS part", "3 AS depth"), rows, parts, spark)


@pytest.mark.parametrize("parts", [1, 8])
def test_copies_and_prefixes_across_parts(spark, parts):
    """One chain of turns and its prefixes, each many times: ends, leaves and shared nodes span parts."""
    rows = [(20 * c, t, "u", f"turn {t}") for c in range(120) for t in range(c % 4 + 1)]
    rows += [(20 * c, t, "u", f"turn {t}" if t < 3 else f"other {c % 3}") for c in range(120, 160) for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    check(df, rows, parts, spark)


def test_turnless_conversations_and_no_rows(spark):
    """Where h reaches beyond a conversation and its family has no first one, no turn is left."""
    rows = [(c, 0, "u", "only turn") for c in (1, 2, 3, 4, 5, 6)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    check(df, rows, 2, spark)
    assert any(h != hashlib.sha256(b"").hexdigest() for (c, d), (*_, h) in brute(rows).items() if d == 0)
    assert prefix_trie.prefix_trie(df.limit(0)).collect() == []


def test_only_points_are_stored(spark):
    """A long chain without branches is one edge of the compressed tree."""
    rows = [(20, t, "u", f"turn {t}") for t in range(50)] + [(40, t, "u", f"turn {min(t, 30)}" if t < 40 else "z") for t in range(50)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    tree = prefix_trie.points(prefix_trie.rebuilt(prefix_trie.turns_of(df)))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted((r.top, r.depth) for r in tree.collect()) == [(0, 0), (1, 31), (32, 50), (32, 50)]
    check(df, rows, 4, spark)


def test_query_equals_its_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM '{sf_dir}/conversations.parquet'")
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({queries.OP11_SQL})").fetchall()
    got = queries.op11_prefix_trie(spark, sf_dir).select(*cols).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got) and len(got) > 50
