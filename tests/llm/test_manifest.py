"""The manifest against a plain Merkle tree in Python, and its SQL form against both."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from llm import manifest
from llm.common import given

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    out = []
    for name in FIELDS:
        v = getattr(row, name)
        if name == "text" and lower and v is not None:
            v = v.translate({c: c + 32 for c in range(65, 91)})
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def tree(nodes):
    """Root and, for every leaf, the list of its (left, right) siblings."""
    sides = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, groups = [], []
        for s in range(0, len(nodes), 8):
            run = nodes[s:s + 8]
            for k, group in enumerate(members[s:s + 8]):
                for m in group:
                    sides[m].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(sha(*run))
            groups.append([m for group in members[s:s + 8] for m in group])
        nodes, members = up, groups
    return nodes[0], sides


def plain(rows):
    langs = defaultdict(list)
    for r in rows:
        langs[r.lang].append(r)
    trees, out = {}, []
    for lang, members in langs.items():
        members.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in members])
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    root, beside = tree([trees[x][0] for x in order])
    for k, lang in enumerate(order):
        for r, sides in zip(langs[lang], trees[lang][1], strict=True):
            sides = sides + beside[k]
            forged = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            h = leaf(r, lower=forged)
            for left, right in sides:
                h = sha(left, h, right)
            out.append((r.doc_id, leaf(r), trees[lang][0], root, sha(*[x for s in sides for x in s]), h, h == root))
    return sorted(out, key=repr)


def test_manifest_equals_plain_trees(spark, small_folder, tricky, nothing, rows):
    for docs in (given(spark, small_folder, "documents"), tricky, tricky.limit(1), tricky.where("doc_id < 9")):
        docs = docs.cache()
        assert rows(manifest.manifest(docs)) == plain(docs.collect())
        docs.unpersist()
    assert manifest.manifest(nothing).count() == 0


@pytest.mark.parametrize("leaves", [1, 511, 512, 513, 5000])
def test_trees_of_several_blocks(spark, rows, leaves, monkeypatch):
    """Blocks of eight leaves and one level send even small trees through many rounds."""
    docs = spark.range(leaves).selectExpr(
        "id as doc_id", "'Text ' || id as text", "if(id % 7 = 0, null, 'x' || cast(id % 3 = 0 as int)) as lang", "'s' as source",
        "cast(id as long) as n_chars").cache()
    want = plain(docs.collect())
    assert rows(manifest.manifest(docs)) == want
    monkeypatch.setattr(manifest, "LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK_LEAVES", 8)
    if leaves in (1, 513):
        assert rows(manifest.manifest(docs)) == want
    docs.unpersist()


def test_sql_form(spark, small_folder, tricky, rows):
    for docs in (given(spark, small_folder, "documents"), tricky):
        documents = docs.select(*FIELDS).toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"})  # noqa: F841
        got = duckdb.sql(manifest.manifest_sql()).fetchall()
        assert sorted(got, key=repr) == rows(manifest.manifest(docs))
