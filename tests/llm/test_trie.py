"""The conversation trie against a plain dictionary of prefixes, and its SQL form against both."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from llm import trie
from llm.common import given

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n string, said string, row string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            told[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    told = {c: [x[3] for x in sorted(v)] for c, v in told.items()}
    built = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100 if c < 0 else c % 100
        built[c] = told.get(c - base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    out = []
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, m in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(m) - 1) * (len(path[-1][1]) if path else 0)
    for path, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(path))
        out.append((m[0], len(path), members[path[:-1]][0] if path else None, len(m), kids[path], leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, convs, letters=2, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, None]) if seed % 2 else t, rng.choice(["user", None, ""]) if t % 2 else "a", rng.choice(
                ["hé", "", None, "xx"][:letters] + ([f"own {c}"] if t > 4 else []))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(3)


CASES = {
    "random": made(1, list(range(150)) + [1000, 1001, 12345, -7, -100, -205]),
    "ordered": made(2, range(60), letters=4),
    "copies": [(c, t, "user", "same") for c in range(70) for t in range(7)] + [(500, t, "user", str(t)) for t in range(80)],
    "long": [(c, t, "user", str(t)) for c in (200, 205, 300) for t in range(400)] + [(7, 0, None, None), (7, 0, None, None), (7, None, None, None)],
    "nulls": [(None, 1, "a", "b"), (3, None, None, None), (3, None, None, None), (4, 2, "", ""), (104, 0, "a", "b")],
    "turnless": [(c, 0, "u", "t") for c in (101, 102, 103, 104, 105, 106, 207, 208)],
}


@pytest.mark.parametrize("case", CASES)
def test_trie_equals_plain_dictionary(spark, case, rows):
    assert rows(trie.trie(frame(spark, CASES[case]))) == plain(CASES[case])


def test_small_sketch_only_costs_shuffled_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(trie, "BITMAP_BITS", 32768)
    seen = []
    keep = trie.twice_seen

    def crowded(rows_, n):
        """Every third prefix is called shared, whatever the counts say."""
        cells, bits = keep(rows_, n)
        spoiled = bytes([0b01001001]) * (trie.BITMAP_BITS // 8)
        seen.append(cells)
        return cells, {b: bytes(x | y for x, y in zip(bits.get(b, bytes(len(spoiled))), spoiled, strict=True)) for b in range(2 * cells // trie.BITMAP_BITS)}

    monkeypatch.setattr(trie, "twice_seen", crowded)
    for case in ("random", "long"):
        assert rows(trie.trie(frame(spark, CASES[case]))) == plain(CASES[case])
    assert seen


def test_singletons_are_screened_before_the_shuffle(spark):
    rows_ = [(c, t, "user", f"{c} {t}") for c in range(300) for t in range(6)] + [(c, t, "user", f"s{t}") for c in (1000, 1100) for t in range(3)]
    convs, turns = trie.rebuild(frame(spark, rows_))
    table = trie.prefixes(turns)
    n = table.count()
    flagged = trie.screened(table, n)
    shared = flagged.where("shared").groupBy(*trie.KEY).count()
    assert flagged.where("not shared").groupBy(*trie.KEY).count().where("count > 1").count() == 0
    assert shared.where("count = 1").count() < n / 10


def test_given_table_and_sql(spark, small_folder, rows):
    conversations = given(spark, small_folder, "conversations")
    want = plain([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])
    assert rows(trie.trie(conversations)) == want
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{small_folder}/conversations.parquet')")
    assert sorted(duckdb.sql(trie.trie_sql()).fetchall(), key=repr) == want
    assert trie.trie(frame(spark, [])).count() == 0
