"""Similarity joins, vector links, archives and the pipeline against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import components, shingles, signature_tree, vector_graph, warc
from creditloom.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def smallest_reachable(ids, linked):
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for i, r in enumerate(root):
        if ids[i] is not None:
            least[r] = min(least.get(r, ids[i]), ids[i])
    return [least.get(r) for r in root]


def near_texts(seed, n):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 4, 6, 15, 40, 90, 300]))] for _ in range(n // 4)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
        texts.append(" ".join(words[:rng.choice([len(words), len(words) - 1])]) or "W7")
    return texts


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, documents, words, percent):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(1000 + i, t) for i, t in enumerate(near_texts(words, 260))]
    docs = spark.createDataFrame([(*r, "clash") for r in texts], "doc_id long, text string, root string").repartition(4)
    sets = [shingle_set(t, words) for _, t in texts]
    size = [len(s) for s in sets]

    def linked(i, j):
        if not size[i] or not size[j] or 100 * min(size[i], size[j]) < percent * max(size[i], size[j]):
            return False
        both = len(sets[i] & sets[j])
        return 100 * both >= percent * (size[i] + size[j] - both)

    classes = smallest_reachable([i for i, _ in texts], linked)
    wanted = sorted(((i, n, c) for (i, _), n, c in zip(texts, size, classes)), key=str)
    found = signature_tree.jaccard_components(docs, words, percent)
    assert sorted((tuple(r)[:3] for r in found.collect()), key=str) == wanted
    left = signature_tree.representatives(docs, words, percent)
    assert left.columns == docs.columns
    groups = {c for c, n in zip(classes, size) if n and c is not None}
    kept = [r["doc_id"] for r in left.collect() if r["doc_id"] is not None and shingle_set(r["text"], words)]
    assert sorted(kept) == sorted([*groups, 4])  # two groups of different texts have the id 4


def test_texts_without_words_stay_whoever_shares_their_id(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text), (2, text), (2, ""), (2, " \n"), (2, None), (3, text + " x"), (3, "other words of the same id"), (3, "\t"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in signature_tree.representatives(docs).collect()]
    assert sorted(left, key=str) == sorted([rows[i] for i in (0, 2, 3, 4, 6, 7, 8)], key=str)


def test_large_components_are_joined_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(signature_tree, "TASK_HASHES", 500)
    texts = near_texts(9, 150)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingle_set(t, 3) for t in texts]
    wanted = smallest_reachable(list(range(len(texts))), lambda i, j: 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]))
    found = signature_tree.jaccard_components(docs, 3, 90).orderBy("doc_id").collect()
    assert [r["component_id"] for r in found] == wanted


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key_whatever_is_frequent(percent):
    rng = np.random.default_rng(percent)
    for share in (0.0, 0.5, 1.0):
        frequent = rng.random(signature_tree.BUCKETS) < share
        for n in (12, 40, 300, 900):
            one = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            lost = int(n * (100 - percent) / (100 + percent))
            other = np.unique(np.concatenate([one[lost:], rng.integers(0, 1 << 63, lost).astype(np.uint64)]))
            both = len(np.intersect1d(one, other))
            if 100 * both < percent * (len(one) + len(other) - both):
                continue
            hashes = np.concatenate([one, other])
            sets = shingles.Sets(hashes, np.repeat([0, 1], [len(one), len(other)]), np.array([len(one), len(other)]))
            keys, owners = signature_tree.routing_keys(sets, percent, frequent)
            assert set(keys[owners == 0]) & set(keys[owners == 1])


@pytest.mark.parametrize("percent", [80, 90])
def test_sets_without_common_shingles_share_no_key(percent):
    rng = np.random.default_rng(percent)
    frequent = rng.random(signature_tree.BUCKETS) < 0.4
    drawn = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in rng.integers(60, 70, 300)]
    sizes = np.array([len(x) for x in drawn])
    sets = shingles.Sets(np.concatenate(drawn), np.repeat(np.arange(len(drawn)), sizes), sizes)
    keys, owners = signature_tree.routing_keys(sets, percent, frequent)
    assert len(np.unique(keys)) == len(np.unique(np.stack([keys, owners.astype(np.uint64)]), axis=1).T)


def test_no_documents_no_components(nothing):
    assert signature_tree.jaccard_components(nothing).count() == 0
    assert signature_tree.representatives(nothing).count() == 0


def test_tree_loses_no_pair():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in rng.integers(1, 400, 120)]
    sets += [np.unique(np.concatenate([s[rng.random(len(s)) > 0.04], s[:1]])) for s in sets]
    found = {p for x, y in signature_tree.Tree(sets, np.zeros(len(sets), int)).pairs(90) for p in zip(x.tolist(), y.tolist())}
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                assert (i, j) in found


def test_paths_and_stars_have_one_root(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(5, 5), (1, 2), (2, 1)]
    rows = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in rows} == {i: 100 for i in range(101, 141)} | {i: 7 for i in range(8, 30)} | {2: 1}


def test_links_of_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 8))
    vectors = [(base[i % 40] + rng.normal(size=8) * rng.choice([0.0, 0.05, 0.2])).tolist() for i in range(400)]
    rows = [(i, v, i % 3, "k") for i, v in enumerate(vectors)]
    rows += [(500, None, 1, "k"), (501, [0.0] * 8, 1, "k"), (502, [float("nan")] * 8, 1, "k"), (503, [None] * 8, 1, "k"),
             (504, vectors[0], None, "k"), (505, [1.0, 2.0], 1, "k"), (506, [], 1, "k"), (507, [x * 1e200 for x in vectors[0]], 0, "k")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, kept string").repartition(4)
    usable = {r[0]: np.array(r[1], float) for r in rows[:400] + rows[-1:]}
    unit = {i: v / np.abs(v).max() for i, v in usable.items()}
    unit = {i: v / np.sqrt((v * v).sum()) for i, v in unit.items()}
    label = {r[0]: r[2] for r in rows}
    ids = [r[0] for r in rows]

    def linked(i, j):
        a, b = ids[i], ids[j]
        return a in unit and b in unit and label[a] == label[b] and float(unit[a] @ unit[b]) >= 0.98

    wanted = dict(zip(ids, smallest_reachable(ids, linked)))
    links = {a: sum(linked(i, j) for j in range(len(ids)) if j != i) for i, a in enumerate(ids)}
    small = vector_graph.Settings(shard_points=40, block_points=30, sample=100)
    for settings in (vector_graph.Settings(), small):
        found = {r["vec_id"]: r for r in vector_graph.near_duplicates(table, settings=settings).collect()}
        assert {i: r["n_links"] for i, r in found.items()} == links
        assert {i: r["component_id"] for i, r in found.items()} == wanted
        assert all(r["kept"] == (i == wanted[i]) for i, r in found.items())
    assert vector_graph.near_duplicates(table.limit(0)).count() == 0


def grouped_vectors(seed, groups, members, others, length=32):
    """Unit vectors: groups of members at equal distances from each other, among unrelated ones."""
    rng = np.random.default_rng(seed)
    base = np.repeat(rng.normal(size=(groups, length)), members, 0)
    x = np.concatenate([base + 0.08 * rng.normal(size=base.shape), rng.normal(size=(others, length))])
    return x / np.sqrt((x * x).sum(1))[:, None]


def test_dense_groups_are_reached_from_other_blocks():
    settings = vector_graph.Settings()
    x = grouped_vectors(8, 100, 60, 2000, 64)
    queries = np.arange(0, len(x), 8)
    none = np.full(len(queries), -1)  # as asked from another block: the query is no point of this one
    true = {*zip(*(a.tolist() for a in vector_graph.exact_search(x, x[queries], none, settings)))}
    both = x[queries] @ x.T >= settings.threshold
    assert true == {*zip(*(a.tolist() for a in np.nonzero(both)))} and len(true) > 20_000
    found = {*zip(*(a.tolist() for a in vector_graph.search(
        x, np.concatenate(vector_graph.build_lists(x, settings), 1), x[queries], none, settings)))}
    assert found <= true and len(found) >= 0.99 * len(true)


def test_recall_below_the_limit_is_made_exact(spark):
    x = grouped_vectors(9, 4, 40, 40)
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    poor = vector_graph.Settings(degree=1, candidates=1, long_edges=0, beam=1, rounds=1, least_recall=1.0)
    found = {r["vec_id"]: r for r in vector_graph.near_duplicates(table, settings=poor).collect()}
    assert [found[i]["n_links"] for i in range(len(x))] == ((x @ x.T >= 0.98).sum(1) - 1).tolist()
    assert {r["recall"] for r in found.values()} == {1.0}


def test_archives_give_every_page_back(spark):
    texts = ["<p>a</p>", "", None, "x\r\n\r\nWARC/1.1\r\n\r\ny", "<p>a</p>", "é " * 9000, "<p>a</p>", "", "one"]
    rows = [(i, f"http://h/{i}\n", t, "d") for i, t in enumerate(texts)] + [(None, None, "null id", "d"), (8, "u", "one", "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string").repartition(3)
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.resolved(pages), path, 100)
    found = warc.resolve_revisits(warc.read_archives(spark, path)).collect()
    assert len(found) == len(rows)
    by_id = {r["record_id"]: r for r in found}
    import base64
    import hashlib
    for i, t in enumerate(texts):
        body = (t or "").encode()
        last = max(j for j, other in enumerate(texts) if (other or "") == (t or ""))
        r = by_id[str(i)]
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == last else ("revisit", str(last)))
    empty = scratch_path(spark, "archives")
    warc.write_archives(warc.resolved(pages.limit(0)), empty, 0)
    assert warc.read_archives(spark, empty).count() == 0


def test_shingles_of_odd_texts():
    import pyarrow as pa
    texts = pa.array(["", None, "A b", "a B", "one two three four", "x" * 300 + " y z", " \t\n", "ab c", "a bc"])
    sets = shingles.shingle_sets(texts, 3)
    assert sets.sizes.tolist() == [0, 0, 1, 1, 2, 1, 0, 1, 1]
    marks = sets.signature()
    assert marks[2] == marks[3] and marks[7] != marks[8] and marks[0] == marks[1]


def test_pipeline_stages_apply_their_decisions(spark, tmp_path):
    words = [f"word{i}" for i in range(900)]
    rng = random.Random(4)
    prose = lambda: " ".join(rng.choice(words) for _ in range(120)) + "."
    clean = [prose() for _ in range(8)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(clean)]
    rows += [(20, clean[0], "en", "s0", 1), (21, clean[1] + " more", "en", None, 1), (22, "LOUD!! " * 90, "en", "s0", 1), (23, None, None, None, None),
             (24, prose() + " call +1 (415) 555-2671", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, left, None)
        assert left.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in left.collect()}
    assert sorted(left) == [*range(8), 24] and all(left[i] == clean[i] for i in range(8)) and "555-2671" not in left[24]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path))
    total = packed.agg(F.sum("length")).first()[0]
    assert total > 1000 and packed.where("length < 1 OR length > 1024").count() == 0


def test_pipeline_of_nothing(spark, nothing, tmp_path):
    nothing.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.lit(0).cast("long").alias("n_chars")).write.parquet(
        f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
