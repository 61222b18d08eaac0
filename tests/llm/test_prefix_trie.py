import hashlib
import random
import zlib

import pytest

from formtide.llm.prefix_trie import prefix_trie
from formtide.llm.queries import ORACLES, QUERIES
from tests.compare import compare

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth int, node int, entry string, place int"


def conversations_of(spark, seed=2, n=400):
    """Shared first turns, exact copies, ties, nulls, one long conversation, an id without its hundred."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), 1250, 1251, -7, -150]:
        turns = rng.randint(1, 9)
        for t in range(turns):
            text = rng.choice(["", None, "hé", "x" * 40, "🙂a"]) if t else rng.choice(["hi", "hello"])
            rows.append((c, None if t == 0 and c % 3 == 0 else t, rng.choice(["user", None, "bot"]) if t else "user", text))
    rows += [(300, t, "user", f"turn {t % 3}") for t in range(10, 150)]
    rows += [(20, 2, "user", "tie")] * 2 + [(20, 2, None, "tie")]  # equal numbers, repeated rows
    rows += [(None, 1, "user", "nobody's")] * 3
    rows += [(c, t, "user", "copy") for c in range(5000, 5900, 3) for t in range(4)]  # a large group of copies
    return spark.createDataFrame([(*r, "p", 1, 2, "e", 3) for r in rows], SCHEMA).repartition(5)


def brute_force(rows, rebuild=True):
    own = {}
    for r in rows:
        if r.conv_id is not None:
            own.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        # the remainder has the sign of the id, as in SQL
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = sum(saved[k] for k in below) + ((len(members[key]) - 1) * len(key[-1][1]) if key else 0)
    out = []
    for key, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        cells = (len(who), len(children.get(key, [])), leaves[key], saved[key])
        out.append((min(who), len(key), parent, *cells, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[1], r[0], r[-1], str(r)))


@pytest.mark.parametrize("band, rebuild", [(1 << 14, True), (60, True), (0, True), (400, False)])
def test_against_brute_force(spark, band, rebuild):
    table = conversations_of(spark)
    if not band:
        table = table.filter("turn IS NULL OR turn < 10")  # a job for every depth
    got = prefix_trie(table, rebuild=rebuild, band=band).collect()
    assert in_order(got) == in_order(brute_force(table.collect(), rebuild))


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).count() == 0
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(1, 100)}
    c = next(c for c, x in h.items() if x >= 1)  # its only turn goes, and its hundred is absent
    alone = spark.createDataFrame([(c, 0, "user", "x", "", 0, 0, "", 0)], SCHEMA)
    rows = prefix_trie(alone).collect()
    assert [tuple(r) for r in rows] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_query_equals_its_sql(spark):
    name = "op13_truncation_peeling"
    assert compare(spark, "/root/testdata/sf0.001", QUERIES[name], ORACLES[name])[0] is None
