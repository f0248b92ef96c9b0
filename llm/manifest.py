"""Merkle dataset manifest: concatenated-level strings.

Every row of a table is a leaf of its language's tree of arity 8; the languages' roots are the leaves of one more tree.
512 consecutive leaves make an aligned block, which keeps each of its levels as one string of hex digests: a parent is
the digest of a substring of eight digests, a leaf's siblings are what flanks it in that substring. Blocks have three
levels; their tops are the leaves of the next round of blocks, until a tree has one block. Leaves are numbered by a
range partition with offsets, so neither a language nor any other group has to fit into a task, and a block holds at
most 512 rows.

Edge cases: nulls count as ``-`` and a null language is a language of its own, before all others. Rows with equal keys
are leaves of their own, in the order of their digests (equal rows cannot be told apart). A row without a key is never
tampered with. An empty table gives an empty manifest. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import materialize
from txnlens.operators.running import running_sums

ARITY = 8
#: Levels inside a block, and its leaves.
LEVELS = 3
BLOCK_LEAVES = ARITY ** LEVELS
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """SHA-256 in hex of the parts, one after the other."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, otherwise the value after its length in bytes."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**replaced: Column) -> Column:
    return digest(*[encoded(replaced.get(c, F.col(c))) for c in FIELDS])


def _piece(level: Column, start: Column, length: Column | int) -> Column:
    """Bytes of a level from ``start`` (0-based); a level is ASCII, kept as bytes so that a slice is found at once."""
    return F.substring(level, (start + 1).cast("int"), length if isinstance(length, Column) else F.lit(length))


def _parents(level: Column) -> Column:
    """The next level: the digest of every eight, the last run as long as it is."""
    run = ARITY * DIGEST
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / run).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(_piece(level, i * run, run), 256)), "").cast("binary")


def _sides(level: Column, place: Column) -> Column:
    """What flanks the digest at ``place`` in its run of eight."""
    start = F.floor(place / ARITY) * (ARITY * DIGEST)
    before = ((place % ARITY) * DIGEST).cast("int")
    return F.struct(_piece(level, start, before).alias("left"),
                    _piece(level, start + before + DIGEST, F.lit((ARITY - 1) * DIGEST) - before).alias("right"))


def blocks_of(nodes: DataFrame) -> DataFrame:
    """``tree, block, n, items, level0..level3, top`` of ``tree, at, n, node, own`` (place and size in the tree)."""
    items = F.sort_array(F.collect_list(F.struct((F.col("at") % BLOCK_LEAVES).cast("int").alias("i"), "node", "own")))
    out = nodes.groupBy("tree", F.floor(F.col("at") / BLOCK_LEAVES).alias("block")).agg(F.max("n").alias("n"), items.alias("items"))
    out = out.withColumn("level0", F.array_join(F.transform("items", lambda x: x["node"]), "").cast("binary"))
    for level in range(1, LEVELS + 1):  # a tree of one block ends where one node is left
        below = F.col(f"level{level - 1}")
        goes_on = (F.col("n") > BLOCK_LEAVES) | (F.octet_length(below) > DIGEST)
        out = out.withColumn(f"level{level}", F.when(goes_on, _parents(below)))
    top = F.coalesce(*[F.col(f"level{i}") for i in range(LEVELS, -1, -1)]).cast("string")
    return out.select("tree", "block", "n", F.transform("items", lambda x: F.struct(x["i"].alias("i"), x["own"].alias("own"))).alias("items"),
                      *[f"level{i}" for i in range(LEVELS + 1)], top.alias("top"))


def _inside(place: Column) -> Column:
    """Siblings of a block's leaf, level by level."""
    steps = [F.when(F.col(f"level{i + 1}").isNotNull(), _sides(F.col(f"level{i}"), F.floor(place / ARITY ** i))) for i in range(LEVELS)]
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def climb(blocks: DataFrame) -> DataFrame:
    """``tree, block, above, root``: the siblings above each block's top, and its tree's root.

    Blocks are read again, so they should be a written table; every round has 1/512 of the rows of the one before.
    """
    whole = blocks.where(F.col("n") <= BLOCK_LEAVES)
    none = F.array().cast("array<struct<left: binary, right: binary>>")
    done = whole.select("tree", "block", none.alias("above"), F.col("top").alias("root"))
    parts = blocks.where(F.col("n") > BLOCK_LEAVES)
    if parts.isEmpty():
        return done
    nodes = parts.select("tree", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK_LEAVES).alias("n"),
                         F.col("top").alias("node"), F.lit(None).cast("int").alias("own"))
    upper = materialize(blocks_of(nodes), "manifest-level")
    rest = climb(upper)
    own = F.transform("items", lambda x: F.struct(
        (F.col("block") * BLOCK_LEAVES + x["i"]).alias("block"), F.concat(_inside(x["i"]), F.col("above")).alias("above")))
    return done.unionByName(upper.join(rest, ["tree", "block"]).select("tree", "root", F.inline(own)))


def _numbered(nodes: DataFrame, order: list[str], label: str) -> DataFrame:
    """Place in the tree and size of it."""
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("n"))
    placed = running_sums(nodes, ["tree"], order, {"__at": F.lit(1).cast("long")}, label=label)
    return placed.withColumn("at", F.col("__at") - 1).drop("__at").join(sizes, "tree")


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Where 3 divides the crc32 of the key's decimals, the fold starts at the leaf of the text with its ASCII capitals
    lower-cased, elsewhere at the row's own leaf.
    """
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    changes = tampers & F.col("text").cast("string").rlike("[A-Z]")
    # The texts are read once; a digest is kept for the tampered row only where it differs.
    leaves = materialize(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_of().alias("node"),
        F.when(changes, leaf_of(text=lowered)).alias("forged")), "manifest-leaves")
    placed = _numbered(leaves, ["doc_id", "node"], "manifest-order").select(
        "tree", "at", "n", "node", F.struct("doc_id", "forged").alias("own"))
    blocks = materialize(blocks_of(placed), "manifest-blocks")
    above = materialize(climb(blocks), "manifest-above")
    # The trees' roots, ordered by language, are one more tree.
    roots = above.where(F.col("block") == 0).select(F.lit("").alias("tree"), F.col("root").alias("node"), F.col("tree").alias("own"))
    tops = materialize(blocks_of(_numbered(materialize(roots, "manifest-roots"), ["own"], "manifest-roots-order")), "manifest-tops")
    trees = tops.join(climb(tops), ["tree", "block"]).select("root", F.inline(F.transform("items", lambda x: F.struct(
        x["own"].alias("tree"), F.concat(_inside(x["i"]), F.col("above")).alias("beside")))))
    known = above.withColumnRenamed("root", "subroot").join(trees, "tree").select(
        "tree", "block", "subroot", "root", F.concat("above", "beside").alias("outside"))

    def row(x: Column) -> Column:
        sides = F.concat(_inside(x["i"]), F.col("outside"))
        leaf = _piece(F.col("level0"), x["i"] * DIGEST, DIGEST).cast("string")
        proof = F.array_join(F.transform(sides, lambda s: F.concat(s["left"].cast("string"), s["right"].cast("string"))), "")
        start = F.coalesce(x["own"]["forged"], leaf)
        folded = F.aggregate(sides, start, lambda h, s: digest(s["left"], h, s["right"]))
        return F.struct(x["own"]["doc_id"].alias("doc_id"), leaf.alias("leaf"), F.sha2(proof, 256).alias("proof_sha256"),
                        folded.alias("folded_root"))

    rows = blocks.join(known, ["tree", "block"]).select("subroot", "root", F.inline(F.transform("items", row)))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


#: Rounds of the SQL form; enough for 8^7 rows a language.
SQL_ROUNDS = 7


def manifest_sql(rounds: int = SQL_ROUNDS) -> str:
    """DuckDB SQL for :func:`manifest` over ``documents``; a tree with one node passes the remaining rounds as it is."""
    def enc(value: str) -> str:
        return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(enc(text if c == 'text' else c) for c in FIELDS)})"

    step = "xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::bigint)), lambda c, i: {step})"
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), "
           f"lambda x: ascii(x)::bigint)), lambda c, b: {byte}), 4294967295)")
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [f"""l0 AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i FROM (
    SELECT row_number() OVER () AS rid, doc_id, lang, {leaf('text')} AS leaf,
           CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS h FROM documents)),
n0 AS (SELECT lang, i, leaf AS node FROM l0)"""]

    def tree(name: str, key: str) -> list[str]:
        """Rounds ``name``0..: nodes, and for every node its run and siblings."""
        out = []
        for r in range(rounds):
            out.append(f"""{name}s{r} AS (
  SELECT {key} AS key, i, node, count(*) OVER (PARTITION BY {key}) AS n,
         coalesce(string_agg(node, '') OVER (PARTITION BY {key}, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER (PARTITION BY {key}, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{r}),
{name}{r + 1} AS (
  SELECT key AS {key}, i // 8 AS i, CASE WHEN max(n) = 1 THEN max(node) ELSE sha256(string_agg(node, '' ORDER BY i)) END AS node
  FROM {name}s{r} GROUP BY key, i // 8)""")
        return out

    parts += tree("n", "lang")
    parts += [f"""m0 AS (
  SELECT 0 AS one, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, node, lang FROM n{rounds})"""]
    parts += tree("m", "one")

    def fold(source: str, name: str, key: str, base: str) -> list[str]:
        out = []
        for r in range(rounds):
            out.append(f"""{base}{r + 1} AS (
  SELECT a.* EXCLUDE (h, i, proof), a.i // 8 AS i, a.proof || s.before || s.after AS proof,
         CASE WHEN s.n = 1 THEN a.h ELSE sha256(s.before || a.h || s.after) END AS h
  FROM {base}{r} a JOIN {name}s{r} s ON s.key IS NOT DISTINCT FROM a.{key} AND s.i = a.i)""")
        return out

    parts += ["p0 AS (SELECT doc_id, lang, leaf, h, i, '' AS proof FROM l0)"] + fold("l0", "n", "lang", "p")
    parts += [f"""q0 AS (
  SELECT p.doc_id, p.leaf, m.node AS subroot, p.h, m.i, p.proof, 0 AS one FROM p{rounds} p JOIN m0 m ON m.lang IS NOT DISTINCT FROM p.lang)"""]
    parts += fold("q0", "m", "one", "q")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = r.node AS verified
FROM q{rounds} CROSS JOIN m{rounds} r"""


