"""Conversation prefix trie with count-min screening of prefix digests.

Conversations are rebuilt (the head of their hundred's first conversation, then their own tail), and every prefix gets a
digest: a running sum of four 32-bit lanes of SHA-256 over (depth, turn). Lanes add up, so the digests of a conversation
of any length come from a range partition with carried totals, never from one task.

A count-min sketch of two rows counts prefix digests in cells. A cell that counts one proves that its prefix stands in
one conversation: such a node is finished where its row is, and the tail below it with it. Only prefixes that both cells
call possibly shared are shuffled and grouped exactly; a false alarm costs a shuffled row, never a wrong one. What tasks
see of the sketch is one bit a cell (seen twice or not), at most ``MOST_CELLS`` bits a row, which bounds the broadcast
to 32 MB at any input.

Sums over subtrees need no walk of the tree: a conversation owns the nodes of which it is the smallest member, these
are the last ones of its path, and a node's subtree holds what its members own from its depth on.

Edge cases: null roles and texts are empty; rows without a conv_id belong to no conversation and are left out. Turns
with equal numbers follow their digests, equal rows count as often as they stand. A conversation without turns of its own is
known by its rows only, so ``turnless`` means that all its turns were cut. Without conversations there is no node.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import materialize
from txnlens.operators.running import running_sums

#: The head of a conversation comes from the first one of its ``FAMILY`` ids, ``HEADS`` - 1 turns at most.
FAMILY = 100
HEADS = 6
#: Cells of a row of the sketch: four a prefix, up to 16 MB of bits.
CELLS_PER_PREFIX = 4
MOST_CELLS = 1 << 27
SKETCH_ROWS = 2
#: Bits of one binary of ``bitmap_construct_agg``.
BITMAP_BITS = 32768
LANES = ("k0", "k1", "k2", "k3")
KEY = ("depth", *LANES)
ABOVE = ("up", *[f"p{i}" for i in range(4)])
EMPTY = hashlib.sha256(b"").hexdigest()
#: Ids of one chunk of text when the ends of a node are listed.
CHUNK_IDS = 4096


def _turns(conversations: DataFrame) -> DataFrame:
    """Every turn's digest and code points, with its place in the written table."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), turn.alias("said"),
        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"))


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, n`` of every rebuilt conversation, and its turns ``conv, n, own, turn, said, row, chars`` in that order."""
    turns = materialize(_turns(conversations), "trie-turns")
    place = F.struct("turn", "said", "row")
    # Spark keeps the first five a key within each map task, so a long conversation is no heavy key here.
    rank = F.row_number().over(W.partitionBy("conv").orderBy("turn", "said", "row"))
    opening = (turns.withColumn("rank", rank).where(F.col("rank") < HEADS)
               .groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("rank", "turn", "said", "row", "chars"))).alias("opening")))
    heads = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    convs = turns.groupBy("conv").agg(F.count("*").alias("turns")).join(opening, "conv").select(
        "conv", "turns", "opening", heads.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    first = opening.select(F.col("conv").alias("base"), F.col("opening").alias("lead"))
    convs = materialize(convs.join(first, "base", "left").select(
        "conv", "h", F.slice(F.coalesce("lead", F.array()), 1, F.col("h")).alias("lead"),
        F.get("opening", F.col("h") - 1).alias("cut"), F.greatest(F.col("turns") - F.col("h"), F.lit(0)).alias("tail")).withColumn(
        "n", F.size("lead") + F.col("tail")), "trie-conversations")
    led = convs.select("conv", "n", F.inline("lead")).select(
        "conv", "n", F.lit(0).alias("own"), F.col("rank").cast("long").alias("turn"), "said", "row", "chars")
    cut = convs.where(F.col("tail") > 0).select("conv", "n", "h", F.struct("cut.turn", "cut.said", "cut.row").alias("cut"))
    told = turns.join(cut, "conv").where((F.col("h") == 0) | (place > F.col("cut"))).select(
        "conv", "n", F.lit(1).alias("own"), "turn", "said", "row", "chars")
    return convs.select("conv", "n"), materialize(led.unionByName(told), "trie-rebuilt")


def _lane(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, n, depth, k0..k3, chars`` of every prefix, and ``up, p0..p3``: its parent's depth and lanes."""
    one = F.lit(1).cast("long")
    deep = running_sums(turns, ["conv"], ["own", "turn", "said", "row"], {"depth": one}, label="trie-depths")
    term = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("said")).cast("binary"), 256)
    terms = materialize(deep.select("conv", "n", "depth", "chars", *[_lane(term, i).alias(f"t{i}") for i in range(4)]), "trie-terms")
    summed = running_sums(terms, ["conv"], ["depth"], {k: F.col(f"t{i}") for i, k in enumerate(LANES)}, label="trie-prefixes")
    return summed.select("conv", "n", *KEY, "chars", (F.col("depth") - 1).alias("up"),
                         *[(F.col(k) - F.col(f"t{i}")).alias(f"p{i}") for i, k in enumerate(LANES)])


def _cells(columns: tuple[str, ...], cells: int) -> list[Column]:
    """A prefix's cell in each row of the sketch, all rows numbered through."""
    return [F.pmod(F.xxhash64(F.lit(r), *columns), F.lit(cells)) + F.lit(r * cells) for r in range(SKETCH_ROWS)]


def twice_seen(rows: DataFrame, n_rows: int) -> tuple[int, dict[int, bytes]]:
    """Cells a row, and the bits of those counted twice or more."""
    cells = BITMAP_BITS
    while cells < min(n_rows * CELLS_PER_PREFIX, MOST_CELLS):
        cells *= 2
    counted = rows.select(F.explode(F.array(*_cells(KEY, cells))).alias("cell")).groupBy("cell").count().where("count > 1")
    bitmaps = counted.groupBy(F.floor(F.col("cell") / BITMAP_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg((F.col("cell") % BITMAP_BITS)).alias("bits"))
    return cells, {r["bucket"]: bytes(r["bits"]) for r in bitmaps.toLocalIterator()}


def screened(rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with ``shared`` and ``up_shared``: whether the prefix, and the one above it, are possibly shared."""
    cells, bitmaps = twice_seen(rows, n_rows)
    sketch = rows.sparkSession.sparkContext.broadcast(bitmaps)
    total = SKETCH_ROWS * cells

    def flags(places: list[np.ndarray], bits: np.ndarray) -> np.ndarray:
        out = np.ones(len(places[0]), dtype=bool)
        for p in places:
            out &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return out

    def run(batches: Iterator[pa.RecordBatch], sketch: object, total: int) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(total // 8, dtype=np.uint8)
        for bucket, binary in sketch.value.items():
            bits[bucket * BITMAP_BITS // 8:][:BITMAP_BITS // 8] = np.frombuffer(binary, dtype=np.uint8)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            places = [columns.pop(f"c{i}").to_numpy(zero_copy_only=False) for i in range(2 * SKETCH_ROWS)]
            columns["shared"] = pa.array(flags(places[:SKETCH_ROWS], bits))
            columns["up_shared"] = pa.array(flags(places[SKETCH_ROWS:], bits) & (columns["up"].to_numpy() > 0))
            yield pa.RecordBatch.from_pydict(columns)

    asked = rows.select("*", *[c.alias(f"c{i}") for i, c in enumerate(_cells(KEY, cells) + _cells(ABOVE, cells))])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", shared boolean, up_shared boolean"
    return asked.mapInArrow(partial(run, sketch=sketch, total=total), schema)


def _ends(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` per node of ``depth, k0..k3, conv``: ids in order, made to text in chunks, then hashed as a stream.

    The ids of one node are sorted and written out by many tasks; only their text, a row for thousands of ids, goes to
    the node's task, which passes it through the hash without holding it.
    """
    placed = running_sums(ends, list(KEY), ["conv"], {"__at": F.lit(1).cast("long")}, label="trie-ends")
    chunks = placed.groupBy(*KEY, F.floor((F.col("__at") - 1) / CHUNK_IDS).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        names = list(KEY)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({**{n: pa.array([v], pa.int64()) for n, v in zip(names, last, strict=True)},
                                               "ends_sha256": [state.hexdigest()]})

        for batch in batches:
            rows = zip(*[batch.column(n).to_pylist() for n in names], strict=True)
            for key, ids in zip(rows, batch.column("ids").to_pylist(), strict=True):
                if key != last:
                    if last is not None:
                        yield closed()
                    last, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if last is not None:
            yield closed()

    schema = ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string"
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids").mapInArrow(run, schema)


def trie(conversations: DataFrame) -> DataFrame:
    """Per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    convs, turns = rebuild(conversations)
    rows = materialize(prefixes(turns), "trie-rows")
    rows = materialize(screened(rows, rows.count()), "trie-screened")
    ends_here = F.col("depth") == F.col("n")
    hash_of_conv = F.sha2(F.col("conv").cast("string").cast("binary"), 256)
    alone, shared = rows.where(~F.col("shared")), rows.where("shared")

    # Possibly shared prefixes, exactly: what a node is, its smallest member, how many pass and how many end.
    groups = materialize(shared.groupBy(*KEY).agg(
        F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.count_if(ends_here).alias("n_ends"), F.min("chars").alias("chars"),
        F.first("up_shared").alias("up_shared"), *[F.first(c).alias(c) for c in ABOVE]), "trie-groups")
    owners = groups.select(*KEY, "owner", "n_convs", "n_ends")

    # A conversation's own weights from its end up to each of its shared prefixes.
    weight = F.when(F.col("owner") == F.col("conv"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)
    childless = (F.col("owner") == F.col("conv")) & ends_here & (F.col("n_ends") == F.col("n_convs"))
    weighed = shared.select("conv", "n", *KEY, "chars").join(owners, list(KEY)).select(
        "conv", *KEY, weight.cast("long").alias("w"), childless.cast("long").alias("leaf"))
    # A tail that ends alone is one more leaf of each of its shared prefixes; its row has depth n, below all of them.
    lone_ends = alone.where(ends_here & (F.col("depth") > 1)).select(
        "conv", *KEY, F.lit(0).cast("long").alias("w"), F.lit(1).cast("long").alias("leaf"))
    path = materialize(weighed.withColumn("asks", F.lit(True)).unionByName(lone_ends.withColumn("asks", F.lit(False))), "trie-weights")
    from_end = running_sums(path, ["conv"], [F.col("depth").desc()], {"below": F.col("w"), "leaves": F.col("leaf")}, label="trie-paths")
    sums = from_end.where("asks").groupBy(*KEY).agg(F.sum("below").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    # Tops of lone tails and shared nodes look for their parents; each is one child of it.
    entries = alone.where("up_shared")
    kids = groups.where("up_shared").select(*ABOVE).unionByName(entries.select(*ABOVE)).groupBy(*ABOVE).agg(F.count("*").alias("n_children"))
    kids = kids.toDF(*KEY, "n_children")
    parents = owners.select(*KEY, F.col("owner").alias("parent")).toDF(*ABOVE, "parent")
    ends = shared.where(ends_here).select(*KEY, "conv")
    turnless = convs.where("n = 0").select(*[F.lit(0).cast("long").alias(k) for k in KEY], "conv")
    listed = materialize(_ends(materialize(ends.unionByName(turnless), "trie-end-rows")), "trie-end-digests")

    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    # One row, added up from what the conversations, the shared nodes and the lone tails say.
    said = [
        convs.select(F.col("conv").alias("conv_id"), one.alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens")),
        groups.select(F.lit(None).cast("long").alias("conv_id"), zero.alias("n_convs"), (F.col("depth") == 1).cast("long").alias("n_children"),
                      (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
                      ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")),
        alone.select(F.lit(None).cast("long").alias("conv_id"), zero.alias("n_convs"), (F.col("depth") == 1).cast("long").alias("n_children"),
                     ends_here.cast("long").alias("n_leaves"), zero.alias("saved_tokens"))]
    root = materialize(said[0].unionByName(said[1]).unionByName(said[2]).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]).where(
        "n_convs > 0").select("conv_id", zero.alias("depth"), "n_convs", "n_children", F.greatest("n_leaves", one).alias("n_leaves"), "saved_tokens"),
        "trie-root")
    found = root.first()
    root_owner = F.lit(found["conv_id"] if found else None).cast("long")

    def parent(own: Column) -> Column:
        return F.when(F.col("up") == 0, root_owner).when(F.col("up_shared"), F.col("parent")).otherwise(own)

    lone = alone.where(~F.col("up_shared")).withColumn("parent", F.lit(None).cast("long")).unionByName(
        entries.join(parents, list(ABOVE), "left")).select(
        F.col("conv").alias("conv_id"), "depth", parent(F.col("conv")).alias("parent_conv_id"), one.alias("n_convs"),
        (~ends_here).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(ends_here, hash_of_conv).otherwise(EMPTY).alias("ends_sha256"))
    nodes = (groups.join(sums, list(KEY)).join(kids, list(KEY), "left").join(listed, list(KEY), "left").join(parents, list(ABOVE), "left"))
    joined = nodes.select(
        F.col("owner").alias("conv_id"), "depth", parent(F.col("owner")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    rooted = root.join(listed.where("depth = 0").select("depth", "ends_sha256"), "depth", "left").select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    return rooted.unionByName(joined).unionByName(lone)


def trie_sql() -> str:
    """DuckDB SQL for :func:`trie` over ``conversations``; turns with equal numbers follow role and text."""
    step = "xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::bigint)), lambda c, i: {step})"
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), "
           f"lambda x: ascii(x)::bigint)), lambda c, b: {byte}), 4294967295)")
    return f"""
WITH told AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(said ORDER BY i) AS said, {crc} % {HEADS} AS h FROM told GROUP BY conv_id),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.said, [])[1:c.h], c.said[c.h + 1:]) AS said
  FROM lists c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
steps AS (
  SELECT conv_id, d AS depth, len(said) AS n, said[1:d] AS path, CASE WHEN d = 0 THEN 0 ELSE length(said[d].text) END AS chars
  FROM (SELECT conv_id, said, unnest(range(len(said) + 1)) AS d FROM built)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars, bool_and(n = depth) AS leaf,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM steps GROUP BY path, depth),
below AS (
  SELECT r.path, r.depth, sum(CASE WHEN y.leaf THEN 1 ELSE 0 END) AS n_leaves, sum((y.n_convs - 1) * y.chars) AS saved_tokens
  FROM nodes y JOIN steps r ON r.conv_id = y.conv_id AND r.depth <= y.depth GROUP BY r.path, r.depth),
kids AS (
  SELECT r.path, r.depth, count(*) AS n_children
  FROM nodes y JOIN steps r ON r.conv_id = y.conv_id AND r.depth = y.depth - 1 GROUP BY r.path, r.depth),
up AS (
  SELECT y.path, y.depth, x.conv_id AS parent_conv_id
  FROM nodes y JOIN steps r ON r.conv_id = y.conv_id AND r.depth = y.depth - 1 JOIN nodes x ON x.path = r.path AND x.depth = r.depth)
SELECT x.conv_id, x.depth::bigint AS depth, u.parent_conv_id, x.n_convs, coalesce(k.n_children, 0) AS n_children,
       b.n_leaves::bigint AS n_leaves, b.saved_tokens::bigint AS saved_tokens, x.ends_sha256
FROM nodes x JOIN below b ON b.path = x.path AND b.depth = x.depth LEFT JOIN kids k ON k.path = x.path AND k.depth = x.depth
LEFT JOIN up u ON u.path = x.path AND u.depth = x.depth"""
