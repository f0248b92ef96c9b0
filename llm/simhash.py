"""Near-duplicates by SimHash, with pivot distance tables.

A document's fingerprint has a bit set where over half of its shingles' XXH64 have it. Equal fingerprints collapse
first. Two fingerprints that differ in at most ``r`` of 64 bits agree on ``s - r`` of ``s`` segments, so each is dealt
to one cell per choice of ``s - r`` segments; ``s`` follows the number of fingerprints so that cells stay small by
chance, and the answer is the same for any ``s``. A cell that is large all the same (a family of near copies) is split
into parts that meet pairwise, so no task holds more than two parts. Inside a cell, distances to reference
fingerprints are tabled, pairs whose tables differ by more than ``r`` in any coordinate are discarded, and survivors
are verified. A cell sends a spanning tree of what it linked, not its pairs. Components follow by passing on the
smallest label and jumping along labels; every round is written to the shared folder.

The pipeline's stage keeps one document of each class of five-word Jaccard similarity of 0.8 or more. Fingerprints of
the sets link documents first (:func:`fingerprint_pairs`). No radius of a fingerprint finds all such pairs, so what is
still apart meets by a filter that misses none (:func:`prefixes`). A pair of either kind is counted from both shingle sets.

Edge cases: a null or empty text has fingerprint zero, which links like any other; null keys take part but never name
a component unless all its keys are null (then the name is null); repeated rows are returned as often as they occur;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import as_bytes, map_arrow, materialize, scratch_path
from txnlens.session import scratch

#: Fixed reference fingerprints: the first 32 outputs of a linear congruential generator.
PIVOTS = np.array(list(accumulate(range(32), lambda x, _: (x * 6364136223846793005 + 1442695040888963407) % 2**64,
                                  initial=42))[1:], dtype=np.uint64)

#: Buckets that order shingles from rare to common.
COMMON_BUCKETS = 1 << 21

#: Bits of the parities that rows of a cell carry to each other.
COARSE_BITS = 2048


def shingle_hashes(raw: bytes, shingle: int, seed: int) -> list[int]:
    """XXH64 of every run of ``shingle`` words; a shorter text is one shingle."""
    words = raw.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = list(accumulate(words, lambda at, w: at + 1 + len(w), initial=-1))[1:]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return [digest(joined, seed)]
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:], strict=False)]


def majority(hashes: list[int] | np.ndarray) -> int:
    """Signed 64-bit number with the bits that over half of the hashes have."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * total > len(hashes)).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprint(raw: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of one text."""
    return majority(shingle_hashes(raw, shingle, seed))


def row_id(key: str, text: str) -> Column:
    """A number for a row that only rows equal in key and text share (but for chance)."""
    return F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string"))


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc``, ``row`` (of :func:`row_id`) and ``fp`` of every row, without a shuffle."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            yield {"doc": batch.column(0), "row": batch.column(1), "fp": [fingerprint(x, shingle, seed) for x in as_bytes(batch.column(2))]}

    narrow = docs.select(F.col(key).cast("long").alias("doc"), row_id(key, text).alias("row"), F.col(text).cast("string").alias("text"))
    return map_arrow(narrow, "doc long, row long, fp long", pa.schema([(n, pa.int64()) for n in ("doc", "row", "fp")]), rows)


def masks(segments: int, distance: int) -> list[int]:
    """Signed masks of every choice of ``segments - distance`` of the segments of 64 bits."""
    cuts = np.linspace(0, 64, segments + 1).astype(int)
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    made = [sum(c) for c in combinations(parts, segments - distance)]
    return [m - 2**64 if m >= 2**63 else m for m in made]


def segments_for(n: int, distance: int) -> int:
    """Fewest segments whose keys are long enough for ``n`` fingerprints: about four share one by chance."""
    for s in range(distance + 1, 33):
        if n / 2.0 ** (64 * (s - distance) / s) <= 4:
            return s
    return 32


def trees(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges (places in ``values``) that connect what is linked among distinct fingerprints.

    Pivot distances are tabled once; a round compares one fingerprint with those not yet reached, discards by the
    largest coordinate difference, and verifies the rest. A component's members are tied to its smallest, so cells that
    hold the same family send the same edges, which are told once.
    """
    n = len(values)
    table = np.bitwise_count(values[:, None] ^ PIVOTS[None, :8 if n < 64 else 32]).astype(np.int8)
    left = np.arange(n)
    out: list[tuple[int, int]] = []
    while len(left):
        members, front = [left[0]], [left[0]]
        left = left[1:]
        while front and len(left):
            at = front.pop()
            near = left[np.abs(table[left, 0] - table[at, 0]) <= distance]
            near = near[np.abs(table[near] - table[at]).max(axis=1, initial=0) <= distance]
            near = near[np.bitwise_count(values[near] ^ values[at]) <= distance]
            if len(near):
                members += near.tolist()
                front += near.tolist()
                left = left[~np.isin(left, near, assume_unique=True)]
        least = min(members)
        out += [(int(x), int(least)) for x in members if x != least]
    return out


def links(distinct: DataFrame, distance: int, *, cell_rows: int = 2000) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``); their components are those of all links."""
    n = distinct.count()
    chosen = masks(segments_for(n, distance), distance)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in chosen])).alias("t", "part"))
    keyed = keyed.select("fp", F.xxhash64("t", "part").alias("cell"))  # cells that meet by chance only compare more
    # Large cells are looked for in buckets that hold a quarter of a large cell by chance: their counts combine before
    # the shuffle, and only the cells of full buckets are counted one by one.
    bucket = F.pmod("cell", F.lit(max(1, 4 * n * len(chosen) // cell_rows)))
    full = materialize(keyed.groupBy(bucket.alias("full")).agg(F.count("*").alias("n")).where(F.col("n") > cell_rows).select("full"), "full-buckets")
    sizes = keyed.join(full, bucket == F.col("full"), "left_semi").groupBy("cell").agg(F.count("*").alias("n"))
    large = materialize(sizes.where(F.col("n") > cell_rows).select(
        F.col("cell").alias("big"), F.ceil(F.col("n") / cell_rows).cast("int").alias("parts")), "large-cells")
    if large.isEmpty():
        dealt = keyed.select("cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    else:  # few by nature: a cell this large holds a family; Spark broadcasts them only if they are few
        own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
        dealt = keyed.join(large, F.col("cell") == F.col("big"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    dealt = dealt.select(F.xxhash64("cell", "i", "j").alias("cell"), "fp")
    parts = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * len(chosen) // 500_000))
    dealt = dealt.repartition(parts, "cell").sortWithinPartitions("cell", "fp")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        kept_cell, kept_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def linked(cell: np.ndarray, fp: np.ndarray) -> dict[str, object]:
            starts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1 if len(cell) else 0))
            ends = np.append(starts[1:], len(cell))
            pair = starts[ends - starts == 2]  # compared all at once
            pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= distance]
            a, b = [fp[pair]], [fp[pair + 1]]
            for lo, hi in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
                made = np.array(trees(fp[lo:hi], distance), dtype=np.int64).reshape(-1, 2) + lo
                a.append(fp[made[:, 0]])
                b.append(fp[made[:, 1]])
            return {"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)}

        for batch in batches:
            cell = np.concatenate([kept_cell, batch.column(0).to_numpy()])
            fp = np.concatenate([kept_fp, batch.column(1).to_numpy().view(np.uint64)])
            if not len(cell):
                continue
            last = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            if last:
                yield linked(cell[:last], fp[:last])
            kept_cell, kept_fp = cell[last:], fp[last:]
        if len(kept_cell):
            yield linked(kept_cell, kept_fp)

    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return map_arrow(dealt, "a long, b long", arrow, rows).distinct()


def components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """``node, label`` for every node of ``edges``: label is the smallest node it can reach.

    A round takes the smallest label among neighbors and then jumps to that label's own label; both sides of each join
    are plain tables, so Spark can split a label that many nodes share.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")), "links")
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    for _ in range(rounds):
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("theirs")), "b")
        least = labels.select("node", "label").union(seen.select("a", "theirs")).groupBy("node").agg(
            F.min("label").alias("label"), F.max("label").alias("most"))
        near = materialize(least, "near")
        jump = near.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = near.join(jump, "label").select("node", F.least("label", "further").alias("label"))
        done = near.where("label != most").isEmpty()  # all neighbors agree: every component has one label
        if done:
            return near.select("node", "label")
        labels = materialize(new, "labels")
    raise RuntimeError("components did not settle")


def classes(prints: DataFrame, distance: int) -> DataFrame:
    """``class_fp, label`` and the label's ``first_doc`` and ``first_row``: the smallest key (nulls last) and its row."""
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
    distinct = materialize(prints.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    labels = components(links(distinct.select("fp"), distance))
    named = materialize(distinct.join(labels, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("class_fp"), "first", F.coalesce("label", "fp").alias("label")), "named")
    smallest = materialize(named.groupBy(F.col("label").alias("of")).agg(F.min("first").alias("least")), "smallest")
    return materialize(named.join(smallest, F.col("label") == F.col("of")).select(
        "class_fp", "label", F.col("least.doc").alias("first_doc"), F.col("least.row").alias("first_row")), "classes")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42,
                    distance: int = 4) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    prints = materialize(fingerprints(docs, key=key, text=text, shingle=shingle, seed=seed), "fingerprints")
    return prints.join(classes(prints, distance), F.col("fp") == F.col("class_fp")).select(
        F.col("doc").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first_doc").alias("component_id"))


def shingled(docs: DataFrame, made: Callable[[Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]], Iterable[dict[str, object]]],
             arrow: pa.Schema, schema: str, *, shingle: int, seed: int = 42, rows: np.ndarray | None = None) -> DataFrame:
    """``made`` over batches of ``doc, row, text`` and their texts' distinct shingle hashes. The sets are several times the
    texts' size, so they are made anew where they are needed and not stored. ``rows`` flags the buckets of ``row`` to read."""
    wanted = None if rows is None else docs.sparkSession.sparkContext.broadcast(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        if wanted is not None:
            batches = (x.filter(pa.array(wanted.value[x.column(1).to_numpy() % len(wanted.value)])) for x in batches)
        return made((x, [np.unique(np.array(shingle_hashes(t, shingle, seed), dtype="<u8")) for t in as_bytes(x.column(2))]) for x in batches)

    return map_arrow(docs, schema, arrow, read)


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """A digest of each set."""
    return np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], dtype=np.uint64).view(np.int64)


def bucket_counts(counted: DataFrame, buckets: int) -> np.ndarray:
    """``bucket, n`` added up in a table of fixed size."""
    got = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def common_shingles(docs: DataFrame, *, shingle: int, buckets: int = COMMON_BUCKETS) -> np.ndarray:
    """How often shingles of each hash bucket occur in an eighth of the texts. It only orders shingles, rare ones first, and
    says which cells to spread; any order gives the same result."""
    def made(batches: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[dict[str, object]]:
        total = np.zeros(buckets, np.int64)
        for _, sets in batches:
            if sets:
                total += np.bincount((np.concatenate(sets) % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        used = np.flatnonzero(total > 1)
        for i in range(0, len(used), 100_000):
            yield {"bucket": used[i:i + 100_000], "n": total[used[i:i + 100_000]]}

    arrow = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
    eighth = docs.where(F.pmod("row", F.lit(8)) == 0)
    return bucket_counts(shingled(eighth, made, arrow, "bucket long, n long", shingle=shingle), buckets)


def parities(hashes: np.ndarray, bits: int = 256) -> np.ndarray:
    """Signed longs: bit i is the parity of how many hashes fall into bucket i of ``bits``, a power of two. Where two sets'
    bits differ, a member of one is missing from the other, so the sets differ in at least as many members as bits."""
    odd = np.bincount(((hashes >> np.uint64(24)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def long_parities(hashes: np.ndarray) -> np.ndarray:
    """Parities in two to four bits a member, a 20th of the set's own size; 256 bits at least."""
    return parities(hashes, max(256, 1 << (2 * len(hashes) - 1).bit_length()) if len(hashes) else 256)


def coarse(bits: np.ndarray, most: int = COARSE_BITS // 64) -> np.ndarray:
    """Parities folded to at most ``most`` longs."""
    while len(bits) > most:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def parities_differ(a: str, b: str) -> Column:
    """In how many bits two columns of long parities differ; the finer one is folded to the coarser."""
    def folded(x: str, to: str) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(to), F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(F.col(x))

    counts = F.zip_with(folded(a, b), folded(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(counts, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def prefixes(docs: DataFrame, *, shingle: int, spread: int = 20_000) -> DataFrame:
    """``cell, part, id, at``: the rarest shingles of each set, one of which any set that is similar enough shares.

    Of ``n`` shingles ``ceil(4 n / 5)`` at least are shared, so the first ``n - ceil(4 n / 5) + 1`` in an order common to
    all sets hold a shared one. Any order is right; one that puts common shingles last makes cells small. Cells that look
    larger than ``spread`` rows have parts from 1 on, others the part 0.
    """
    order = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, shingle=shingle))

    def made(batches: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[dict[str, object]]:
        told: set[int] = set()  # a task sends equal sets once
        for _, sets in batches:
            for own, hashes in zip(set_ids(sets).tolist(), sets, strict=True):
                n = len(hashes)
                if not n or own in told:
                    continue
                told.add(own)
                often = order.value[(hashes % np.uint64(len(order.value))).astype(np.int64)]
                first = np.lexsort((hashes, often))[:n - (4 * n + 4) // 5 + 1]
                parts = -(-8 * often[first] // spread)
                yield {"cell": hashes[first].view("<i8"), "part": np.where(parts > 1, 1 + own % np.maximum(parts, 1), 0).astype(np.int32),
                       "id": np.full(len(first), own), "at": np.arange(len(first), dtype=np.int32)}

    def whole(batches: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[dict[str, object]]:
        kept: list[dict[str, np.ndarray]] = []
        for x in made(batches):
            kept.append(x)
            if len(kept) == 500:
                yield {n: np.concatenate([y[n] for y in kept]) for n in x}
                kept = []
        if kept:
            yield {n: np.concatenate([y[n] for y in kept]) for n in kept[0]}

    arrow = pa.schema([("cell", pa.int64()), ("part", pa.int32()), ("id", pa.int64()), ("at", pa.int32())])
    return shingled(docs, whole, arrow, "cell long, part int, id long, at int", shingle=shingle)


def shared_prefixes(found: DataFrame) -> DataFrame:
    """``cell, id, at`` of the cells with several sets. One shuffle by cell and part, then a pass over sorted rows that holds one row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held = {n: np.zeros(0, np.int64) for n in ("cell", "part", "id", "at")}
        more = False  # the held row's cell has shown another set before

        def kept(at: dict[str, np.ndarray], before: bool, last: bool) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], bool]:
            new_id = np.ones(len(at["cell"]), bool)
            new_id[1:] = (np.diff(at["cell"]) != 0) | (np.diff(at["id"]) != 0)
            at = {n: x[new_id] for n, x in at.items()}
            same = at["cell"][1:] == at["cell"][:-1]
            several = np.zeros(len(at["cell"]), bool)
            several[1:] |= same
            several[:-1] |= same
            several[:1] |= before
            several |= at["part"] > 0
            out = several.copy()
            if not last:
                out[-1] = False
            return {n: x[out] for n, x in at.items() if n != "part"}, {n: x[-1:] for n, x in at.items()}, len(at["cell"]) > 0 and bool(several[-1])

        for batch in batches:
            if batch.num_rows:
                told, held, more = kept({n: np.concatenate([x, batch.column(n).to_numpy()]) for n, x in held.items()}, more, False)
                yield told
        if len(held["cell"]):
            yield kept(held, more, True)[0]

    arrow = pa.schema([("cell", pa.int64()), ("id", pa.int64()), ("at", pa.int32())])
    dealt = found.repartition("cell", "part").sortWithinPartitions("cell", "part", "id")
    return map_arrow(dealt, "cell long, id long, at int", arrow, rows)


def sets_of(docs: DataFrame, rows: DataFrame, *, shingle: int, buckets: int = COMMON_BUCKETS) -> DataFrame:
    """``id`` and ``hashes`` of the sets of ``rows`` and of few others (those that meet them in a bucket); a task tells each once."""
    wanted = bucket_counts(rows.select(F.pmod("row", F.lit(buckets)).alias("bucket"), F.lit(1).alias("n")).distinct(), buckets) > 0

    def made(batches: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[dict[str, object]]:
        told: set[int] = set()
        for _, sets in batches:
            own = set_ids(sets)
            new = [i for i, x in enumerate(own.tolist()) if not (x in told or told.add(x))]
            yield {"id": own[new], "hashes": [sets[i].view("<i8") for i in new]}

    arrow = pa.schema([("id", pa.int64()), ("hashes", pa.list_(pa.int64()))])
    return shingled(docs, made, arrow, "id long, hashes array<long>", shingle=shingle, rows=wanted)


def fingerprint_pairs(marks: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs ``a, b`` of ``id`` that tie sets of one fingerprint, and of two that differ in at most ``distance`` bits."""
    one = materialize(marks.groupBy("fp").agg(F.min("id").alias("one")), "prints")
    same = marks.select("id", "fp").join(one, "fp").select("id", "one")
    first, second = (one.select(F.col("fp").alias(x), F.col("one").alias(f"one_{x}")) for x in ("a", "b"))
    linked = links(one.select("fp"), distance).join(first, "a").join(second, "b").select("one_a", "one_b")
    pairs = same.unionAll(linked).select(F.least("id", "one").alias("a"), F.greatest("id", "one").alias("b"))
    return materialize(pairs.where("a < b").distinct(), "fingerprint-pairs")


def similar(docs: DataFrame, marks: DataFrame, *, shingle: int) -> DataFrame:
    """Pairs ``a, b`` of ``id`` whose components are those of all pairs with Jaccard similarity of 0.8 or more.

    Sets with close fingerprints are tied first. Then rows of a cell meet two leaders of the cell, which ties the rest of a
    family together, and rows that are still apart meet each other. Pairs whose sizes, places in the order or parities (in
    ``marks``) leave too few shingles to share are not compared; a pair that is left is counted exactly from both sets.
    """
    bits = [f"p{i}" for i in range(4)]
    own = ["id", "n", "at", *bits]

    def near(left: DataFrame, right: DataFrame, possible: Column) -> DataFrame:
        differ = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_2"))) for p in bits), F.lit(0))
        met = left.join(right, "cell").where(
            (9 * F.least(F.col("n") - F.col("at"), F.col("n_2") - F.col("at_2")) >= 4 * (F.col("n") + F.col("n_2")))
            & (9 * differ <= F.col("n") + F.col("n_2")) & possible)
        return materialize(met.select(F.least("id", "id_2").alias("a"), F.greatest("id", "id_2").alias("b")).distinct(), "pairs")

    def true(pairs: DataFrame) -> DataFrame:
        one, two = (marks.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in ("a", "b"))
        pairs = materialize(pairs.join(one, "a").join(two, "b").where(9 * parities_differ("bits_a", "bits_b") <= F.col("n_a") + F.col("n_b")).select("a", "b"), "close")
        rows = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(marks.select("id", F.col("first.row").alias("row")), "id")
        sets = materialize(sets_of(docs, rows, shingle=shingle).dropDuplicates(["id"]), "sets")
        one, two = (sets.select(F.col("id").alias(n), F.col("hashes").alias(h)) for n, h in (("a", "own"), ("b", "theirs")))
        shared = F.size(F.array_intersect("own", "theirs"))
        return pairs.join(one, "a").join(two, "b").where(9 * shared >= 4 * (F.size("own") + F.size("theirs"))).select("a", "b")

    def labelled(rows: DataFrame, tied: DataFrame, label: str) -> DataFrame:
        labels = materialize(components(tied), f"{label}-labels")
        return rows.join(labels, F.col("id") == F.col("node"), "left").withColumn("label", F.coalesce("label", "id")).drop("node")

    def still_apart(rows: DataFrame) -> DataFrame:
        cells = rows.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select(F.col("cell").alias("of"))
        return rows.join(cells, F.col("cell") == F.col("of"), "left_semi")

    def others(rows: DataFrame) -> DataFrame:
        return rows.select("cell", *[F.col(c).alias(f"{c}_2") for c in rows.columns if c != "cell"])

    alike = materialize(true(fingerprint_pairs(marks)), "alike")
    cells = shared_prefixes(prefixes(docs, shingle=shingle)).join(labelled(marks.select("id", "n", *bits), alike, "alike"), "id")
    cells = materialize(cells.select("cell", "label", *own), "shared-prefixes")
    leader = lambda seed: F.min(F.struct(F.xxhash64("id", F.lit(seed)).alias("h"), "label", *own))
    leaders = cells.groupBy("cell").agg(F.array(leader(0), leader(1)).alias("two")).select("cell", F.explode("two").alias("s")).select(
        "cell", *[F.col(f"s.{c}").alias(c) for c in ("label", *own)])
    tied = materialize(alike.union(true(near(cells, others(leaders), F.col("label") != F.col("label_2")))), "tied")
    apart = still_apart(labelled(cells.drop("label"), tied, "tied"))
    apart = materialize(apart.join(marks.select("id", "coarse"), "id"), "apart")
    possible = (F.col("label") < F.col("label_2")) & (9 * parities_differ("coarse", "coarse_2") <= F.col("n") + F.col("n_2"))
    return materialize(tied.union(true(near(apart, others(apart), possible))), "similar")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """``docs`` with one document of each class: the one of smallest key. Of rows equal in key and text one stays.

    Classes are what pairs with Jaccard similarity of 0.8 or more, over distinct shingles, connect. Texts without words
    are one class.
    """
    def identified(batches: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[dict[str, object]]:
        for batch, sets in batches:
            bits = np.array([parities(x) for x in sets], dtype=np.int64).reshape(-1, 4)
            long = [long_parities(x) for x in sets]
            yield {"doc": batch.column(0), "row": batch.column(1), "id": set_ids(sets), "n": [len(x) for x in sets],
                   "fp": [majority(x) for x in sets], "bits": long, "coarse": [coarse(x) for x in long]} | {f"p{i}": bits[:, i] for i in range(4)}

    spark = docs.sparkSession
    narrow = docs.select(F.col(key).cast("long").alias("doc"), row_id(key, text).alias("row"), F.col(text).cast("string").alias("text"))
    names = ["doc", "row", "id", "n", "fp", "p0", "p1", "p2", "p3"]
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
    out = scratch_path(spark, "kept")
    with scratch(spark):  # what the search wrote goes when the rows to keep are known
        arrow = pa.schema([*[(n, pa.int64()) for n in names], *[(n, pa.list_(pa.int64())) for n in ("bits", "coarse")]])
        found = shingled(narrow, identified, arrow, ", ".join(f"{n} long" for n in names) + ", bits array<long>, coarse array<long>", shingle=shingle)
        marks = materialize(found.groupBy("id").agg(F.min(order).alias("first"), *[F.first(n).alias(n) for n in [*names[3:], "bits", "coarse"]]), "marks")
        labels = components(similar(narrow, marks, shingle=shingle))
        least = marks.join(labels, F.col("id") == F.col("node"), "left").groupBy(F.coalesce("label", "id").alias("label")).agg(F.min("first").alias("least"))
        kept = least.select(F.col("least.row").alias("kept_row")).distinct()
        times = narrow.groupBy("row").agg(F.count("*").alias("times"))
        kept.join(times, F.col("kept_row") == F.col("row")).select("kept_row", (F.col("times") > 1).alias("repeated")).write.parquet(out)
    kept = spark.read.schema("kept_row long, repeated boolean").parquet(out)
    columns = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    own = docs.withColumnsRenamed(columns).withColumn("row", row_id(columns[key], columns[text]))
    back = [F.col(new).alias(old) for old, new in columns.items()]
    once = own.join(kept.where("NOT repeated"), F.col("row") == F.col("kept_row"), "left_semi").select(*back)
    repeats = own.join(kept.where("repeated"), F.col("row") == F.col("kept_row"), "left_semi")
    turn = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    return once.unionAll(repeats.withColumn("turn", turn).where("turn = 1").select(*back))
