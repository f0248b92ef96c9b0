"""Search, near-duplicates, repeated passages and the pipeline against brute force."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from llm import chunks, queries, simhash, topk
from llm.common import given, materialize
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def best_by_hand(vectors, k=20):
    out = []
    for q, v in vectors:
        if q % 20 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 4096), (7, 40)])
def test_search_equals_brute_force(spark, small_folder, blocks):
    table = given(spark, small_folder, "embeddings")
    vectors = [(r.vec_id, [math.floor(64 * float(x)) for x in r.embedding]) for r in table.collect()]
    found = topk.top_k(table, F.col("vec_id") % 20 == 0, query_block=blocks[0], row_block=blocks[1])
    assert sorted(tuple(r) for r in found.collect()) == best_by_hand(vectors)


def test_search_with_ties_gaps_and_repeats(spark):
    rows = [(i, [0.5, -0.25, 1.0]) for i in range(0, 90)] + [(100, [1.0, None, 0.0]), (101, [float("nan"), 0.0, 1.0]), (102, None), (None, [9.0, 9.0, 9.0]),
                                                             (0, [0.5, -0.25, 1.0]), (103, [float("inf"), 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    found = sorted(tuple(r) for r in topk.top_k(table, F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)), row_block=16, query_block=2).collect())
    assert found == best_by_hand([(i, [32, -16, 64]) for i in range(90)])
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = table.where("vec_id IN (20, 3, 4)")
    assert sorted(tuple(r) for r in topk.top_k(few, F.col("vec_id") % 20 == 0).collect()) == [(20, 1, 3, 5376), (20, 2, 4, 5376)]


def test_large_numbers_stay_exact(spark):
    table = spark.createDataFrame([(0, [2.0**24, 3.0]), (1, [2.0**24, 1.0]), (2, [2.0**24, 0.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**60 + 192 * 64), (2, 2**60)]


def print_by_hand(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, distance):
    """Component of every fingerprint by comparing all pairs."""
    values = sorted(set(prints))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def test_fingerprints_and_components_equal_all_pairs(spark, small_folder, tricky, nothing):
    for docs in (given(spark, small_folder, "documents"), tricky):
        made = [(d.doc_id, print_by_hand(d.text)) for d in docs.collect()]
        root = groups_by_hand([p for _, p in made], 4)
        least = defaultdict(list)
        for i, p in made:
            least[root[p]].append(i)
        want = [(i, f"{p:016x}", min((x for x in least[root[p]] if x is not None), default=None)) for i, p in made]
        assert sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("cell_rows", [2000, 16])
def test_families_and_chains_are_whole(spark, cell_rows):
    """Chance, chains and a family of near copies, with cells split and not."""
    pick = np.random.default_rng(5)
    flip = lambda v, n: v ^ sum(1 << int(b) for b in pick.choice(64, n, replace=False))
    values = [int(x) for x in pick.integers(0, 2**63, 300)]
    seed = values[0]
    values += [flip(seed, int(pick.integers(1, 5))) for _ in range(150)]
    for _ in range(30):
        values.append(flip(values[-1], 4))
    values += [0, 2**64 - 1, 15, 31]
    signed = [v - 2**64 if v >= 2**63 else v for v in set(values)]
    for distance in (4, 6):
        root = groups_by_hand([v % 2**64 for v in signed], distance)
        table = materialize(spark.createDataFrame([(v,) for v in signed], "fp long"), "values")
        found = {r.node: r.label for r in simhash.components(simhash.links(table, distance, cell_rows=cell_rows)).collect()}
        got, want = defaultdict(set), defaultdict(set)
        for v in signed:
            got[found.get(v, v)].add(v)
            want[root[v % 2**64]].add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_masks_find_every_pair_within_reach():
    pick = np.random.default_rng(2)
    for segments in range(5, 11):
        chosen = simhash.masks(segments, 4)
        for _ in range(200):
            a = int(pick.integers(0, 2**63))
            b = a ^ sum(1 << int(x) for x in pick.choice(64, int(pick.integers(0, 5)), replace=False))
            assert any((a & m) == (b & m) for m in chosen)


def test_one_document_of_each_group_stays(tricky, nothing):
    kept = simhash.keep_one(tricky)
    assert kept.columns == tricky.columns
    made = [(d.doc_id, d.text) for d in kept.collect()]
    base = prose(1, 120)
    assert sum((t or "").startswith(base) for _, t in made) == 1 and (0, base) in made
    assert sum(not (t or "").strip() for _, t in made) == 1
    assert {i for i, _ in made} >= {3, 4, 8, 9, 10, 11, 12, 13, 14, -7}
    assert simhash.keep_one(nothing).count() == 0


def jaccard_groups_by_hand(texts):
    """Component of every text by comparing all pairs' five-word shingles, at 0.8."""
    sets = []
    for text in texts:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * len(a & b) >= 4 * len(a | b) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def test_near_duplicates_are_those_of_all_jaccard_pairs(spark, small_folder):
    """Copies with a growing number of changed words, around 0.8, and a family; also the given texts."""
    made, pick = [], np.random.default_rng(3)
    for i in range(40):
        words = prose(7000 + i, 60 + 7 * i).split()
        made.append(" ".join(words))
        for changes in range(1, 6):
            other = list(words)
            for at in pick.choice(len(words), min(len(words), changes * max(1, len(words) // 120)), replace=False):
                other[at] = f"changed{at}"
            made.append(" ".join(other))
    base = prose(8000, 300).split()
    made += [" ".join(f"w{i}" if j == 7 * i % 300 else w for j, w in enumerate(base)) for i in range(60)]
    texts = made + [r.text for r in given(spark, small_folder, "documents").orderBy("doc_id").limit(300).collect()]
    label = jaccard_groups_by_hand(texts)
    want = {label.index(x) for x in label}
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(table).collect()} == want
    assert 40 < len(want) < len(texts)


def test_fingerprints_link_near_copies(spark, monkeypatch):
    """Without the filter by prefixes, copies whose fingerprints differ in few bits are still found."""
    base = prose(8100, 400).split()
    texts = [" ".join(base), " ".join([*base[:200], "other", *base[201:]]), " ".join(base[:399]), prose(8101, 400)]
    prints = [simhash.majority(np.unique(np.array(simhash.shingle_hashes(t.encode(), 5, 42), dtype="<u8"))) for t in texts]
    near = {i for i in range(1, 4) if (prints[i] ^ prints[0]) % 2**64 == 0 or bin((prints[i] ^ prints[0]) % 2**64).count("1") <= 4}
    assert near and 3 not in near
    plain = simhash.prefixes
    monkeypatch.setattr(simhash, "prefixes", lambda docs, **settings: plain(docs, **settings).limit(0))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(table).collect()} == {0, 1, 2, 3} - near


def test_long_texts_with_shared_passages_are_told_apart_in_the_cells(spark, monkeypatch):
    """Every two share seven tenths of their text, less than a class needs: no pair of them leaves the cells."""
    base, met, plain = [f"w{i}" for i in range(900)], [], simhash.materialize
    texts = [" ".join([*base[:70 * i], *[f"own{i}x{j}" for j in range(135)], *base[70 * i + 135:]]) for i in range(0, 11, 2)]

    def watched(df, label="step", **settings):
        out = plain(df, label, **settings)
        if label == "pairs":
            met.append(out.count())
        return out

    monkeypatch.setattr(simhash, "materialize", watched)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert simhash.keep_one(table).count() == len(texts)
    assert met[-1] == 0


def test_chunks_do_not_shift():
    text = prose(7, 3000).encode()
    for cut in (0, 5, 700, 7001):
        other = text[:cut] + b"one more word " + text[cut:]
        a, b = chunks.Chunks([text]), chunks.Chunks([b"before it", other])
        assert len(set(a.digest.tolist()) - set(b.digest.tolist())) <= 6
    whole = chunks.Chunks([b"", text, b"", b"x"])
    assert b"".join(text[i:j] for t, i, j in zip(whole.text, whole.start, whole.end, strict=True) if t == 1) == text
    assert whole.words.sum() == 3001 and (whole.end > whole.start).all()
    assert max(np.diff(chunks.Chunks([b"\xc3\xa9" * 40000]).start), default=0) < 20000


def test_passages_go_and_clean_texts_stay(spark, tricky, nothing):
    passages = [prose(1000 + i, 55 + i) for i in range(30)]
    docs, planted = [], {}
    for i in range(60):
        docs.append((i, prose(i, 100) + "\n" + passages[i % 30] + " " + prose(500 + i, 90)))
        planted[i] = passages[i % 30]
    docs += [(100 + i, prose(2000 + i, 150)) for i in range(20)]
    docs.append((None, docs[-1][1]))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in chunks.find_repeats(table, block_bytes=9000).collect()}
    assert len(rows) == len(docs)
    texts = dict(docs)
    for i, r in rows.items():
        spans = [tuple(map(int, s.split(":"))) for s in r.removed.split(",")] if r.removed else []
        left = "".join(texts[i][a:b] for a, b in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(texts[i])], strict=True))
        assert left == r.kept_text and r.n_words == len(WORD.findall(texts[i]))
        if i is None or i < 30 or 100 <= i < 119:
            assert (r.n_removed_words == 0) == (i != 119), i
        elif i < 60:
            assert r.n_removed_words >= 20
            at = texts[i].index(planted[i])
            assert all(at - 1 <= a and b <= at + len(planted[i]) + 1 for a, b in spans)
    assert rows[119].kept_text == ""  # the null key comes first, so its copy stays
    kept = chunks.remove_repeats(tricky)
    assert kept.columns == tricky.columns and kept.count() <= tricky.count()
    assert {r.doc_id for r in tricky.collect()} - {r.doc_id for r in kept.collect()} <= {0, 1, 2}
    assert chunks.find_repeats(nothing).count() == 0 and chunks.remove_repeats(nothing).count() == 0


def test_phrases_seen_apart_stay(spark):
    """A text put together from other texts' chunks stays; one that copies a stretch of theirs loses it to the last chunk."""
    sources = [prose(3000 + i, 200) for i in range(12)]
    parts = []
    for text in sources:
        cut = chunks.Chunks([text.encode()])
        parts.append([text.encode()[a:b].decode() for a, b in zip(cut.start, cut.end, strict=True)])
    mixed = "".join(parts[i % 12][3 + i // 12] for i in range(48))
    inside = chunks.Chunks([sources[0].encode()])
    stretch = "".join(parts[0][5:5 + int(np.searchsorted(np.cumsum(inside.words[5:]), 23)) + 1])
    copied = prose(3100, 40) + "\n" + stretch + prose(3101, 40)
    table = spark.createDataFrame([*enumerate(sources), (20, mixed), (21, copied)], "doc_id long, text string")
    rows = {r.doc_id: r for r in chunks.find_repeats(table).collect()}
    assert all(rows[i].removed == "" for i in [*range(12), 20])
    (a, b), = [tuple(map(int, x.split(":"))) for x in rows[21].removed.split(",")]
    assert copied[a:b].strip() in stretch and len(copied[a:b].split()) >= 20


def test_texts_without_spaces_are_deduplicated(spark):
    """Copies go whole; a passage inside one long run goes but for the chunks at its ends, and what is around it stays."""
    pick = np.random.default_rng(11)
    run = lambda n: "".join(chr(0x4E00 + int(x)) for x in pick.integers(0, 3000, n))
    one, passage, short = run(900), run(900), run(60)
    docs = [(0, one), (1, one), (2, run(400) + passage + run(400)), (3, run(500) + passage + run(300)), (4, short), (5, short), (6, run(700))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in chunks.find_repeats(table).collect()}
    assert [rows[i].removed for i in (0, 2, 4, 5, 6)] == [""] * 5 and rows[1].kept_text == ""
    (a, b), = [tuple(map(int, x.split(":"))) for x in rows[3].removed.split(",")]
    assert 500 <= a < b <= 1400 and b - a >= 600
    kept = {r.doc_id: r.text for r in chunks.remove_repeats(table).collect()}
    assert sorted(kept) == [0, 2, 3, 4, 5, 6] and kept[3] == docs[3][1][:a] + docs[3][1][b:]
    ascii_run = "".join(chr(97 + int(x)) for x in pick.integers(0, 26, 3000))
    assert [r.removed for r in chunks.find_repeats(spark.createDataFrame([(0, ascii_run), (1, ascii_run)], table.schema)).orderBy("doc_id").collect()] == ["", "0:3000"]


def test_pipeline_stages(spark, small_folder, tricky, nothing):
    for docs in (given(spark, small_folder, "documents"), tricky, nothing):
        start = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            new = materialize(stage(spark, docs, small_folder), "stage")
            if name != "best-fit packing":
                assert new.columns == docs.columns and new.count() <= docs.count()
            if name == "quality rules":
                assert all(len(WORD.findall(r.text)) >= 50 for r in new.collect())
            if name == "SimHash near-dedup":
                before = sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in docs.collect())
                label = jaccard_groups_by_hand([t for _, t in before])
                want = sorted(before[i] for i in set(label.index(x) for x in label))
                assert sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in new.collect()) == want
            if name == "substring dedup":
                assert all(r.n_chars == len(r.text) for r in new.collect())
            if name == "PII":
                assert new.count() == docs.count()
                assert not any(re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", r.text) for r in new.collect())
            docs = new
        assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert (docs.count() > 0) == (start > 0)


def test_pipeline_equals_its_stages_by_hand(spark, small_folder):
    """run() against the stages' operators applied one by one to the table, documents and tokens counted."""
    from llm import packing, pii, quality

    docs = given(spark, small_folder, "documents")
    by_hand = pii.mask_personal_data(chunks.remove_repeats(simhash.keep_one(quality.keep_good(docs))))
    want = packing.pieces(by_hand.withColumn("n_chars", F.length("text")))
    got = corpus_pipeline.run(spark, small_folder)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(tuple(r) for r in got.select(columns).collect()) == sorted(tuple(r) for r in want.select(columns).collect())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_return_a_row_per_document(spark, small_folder, name):
    found = queries.queries()[name](spark, small_folder)
    n = given(spark, small_folder, "documents").count()
    assert found.count() == n or name.startswith(("op5", "op9", "op13"))
