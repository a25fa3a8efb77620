"""Phrases, exact duplicates and spelling variants against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import exact_dedup, phrases, spelling
from creditloom.llm.count_automata import CountAutomaton, cut, ordered, summed, union


def random_paths(rng, n, order=3, alphabet=6):
    keys = rng.integers(1, alphabet, (n, order)).astype(np.uint32)
    keys[np.arange(order)[None, :] >= rng.integers(1, order + 1, n)[:, None]] = 0
    return summed(keys, rng.integers(1, 4, n))


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("n", [0, 1, 40, 2000])
def test_automata_keep_their_paths(order, n):
    rng = np.random.default_rng(n + order)
    keys, weights = random_paths(rng, n, order)
    automaton = CountAutomaton.from_bytes(CountAutomaton.of_paths(keys, weights).to_bytes())
    found, amounts = automaton.paths()
    assert found.tolist() == keys.tolist() and amounts.tolist() == weights.tolist()
    asked = np.unique(np.concatenate([random_paths(rng, 50, order, 8)[0], keys]), axis=0)
    wanted = dict(zip(map(tuple, keys.tolist()), weights.tolist()))
    assert automaton.composed(asked).tolist() == [wanted.get(tuple(k), 0) for k in asked.tolist()]


def test_positions_count_all_prefixes_and_states_are_shared():
    rng = np.random.default_rng(5)
    keys = rng.integers(1, 5, (500, 3)).astype(np.uint32)
    keys[400:, 2] = 0
    automaton = CountAutomaton.of_positions(keys[ordered(keys)])
    wanted = Counter(tuple(row[:d]) for row in keys.tolist() for d in (1, 2, 3) if row[d - 1])
    found, weights = automaton.paths()
    assert {tuple(w for w in k if w): n for k, n in zip(found.tolist(), weights.tolist())} == wanted
    one = np.array([[a, b, 7] for a in range(1, 30) for b in range(1, 30)], np.uint32)
    shared = CountAutomaton.of_paths(one, np.ones(len(one), np.int64))
    assert len(shared.labels[-1]) == 1 and len(shared.paths()[0]) == len(one)


def test_union_of_cut_automata_is_the_whole():
    rng = np.random.default_rng(6)
    parts = [random_paths(rng, 300) for _ in range(4)]
    cuts = np.unique(random_paths(rng, 5)[0], axis=0)
    ranges = defaultdict(list)
    for keys, weights in parts:
        for r, automaton in cut(keys, weights, cuts):
            ranges[r].append(automaton)
    united = [union(ranges[r], 3) for r in sorted(ranges)]
    keys, weights = summed(np.concatenate([k for k, _ in parts]), np.concatenate([w for _, w in parts]))
    assert np.concatenate([k for k, _ in united]).tolist() == keys.tolist()
    assert np.concatenate([w for _, w in united]).tolist() == weights.tolist()


def plain_collocations(rows, least, top, longest):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        outer = Counter()
        for p, a in found.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    outer[p[i:i + n]] = max(outer[p[i:i + n]], a)
        scored = []
        for p, a in found.items():
            if p in outer and 100 * outer[p] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_equal_plain_counts(spark, longest):
    rng = random.Random(longest)
    words = ["new", "York", "de", "la", "Été", "x'y", "a b", "\x01", "-", "the", "of"]
    texts = [None, "", " \t ", ". , ;"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
              for _ in range(160)]
    rows = [(rng.choice(["en", "fr", "en", None]), t) for t in texts] * 2
    docs = spark.createDataFrame([(lang, t, "n", 1) for lang, t in rows], "lang string, text string, phrase string, n int").repartition(5)
    found = phrases.collocations(docs, longest=longest, least=4, top=40, shard_words=300, range_entries=150)
    found = sorted(map(tuple, found.collect()))
    assert found == plain_collocations(rows, 4, 40, longest) and len(found) > 60
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_cuts_of_many_shards_follow_samples(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SAMPLED", 16)  # in this process only: cuts are read from samples the tasks made
    rng = random.Random(2)
    rows = [("en", " ".join(f"w{int(rng.paretovariate(0.7)) % 90}" for _ in range(300))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    made = phrases.shards(docs, shard_words=1000)
    frequent = phrases.frequent_words(made, 10)
    automata = phrases.shard_automata(made, frequent, 3)
    sampled = automata.select(F.size("sample").alias("n")).agg(F.sum("n")).first()[0]
    cuts = phrases.range_cuts(automata, 3, 500)
    assert len(cuts) <= max(sampled, 1) and cuts.tolist() == sorted(cuts.tolist())
    counts = phrases.range_counts(automata, cuts, 3, 10)
    keys, weights = union([CountAutomaton.from_bytes(r["automaton"]) for r in counts.collect()], 3)
    name = {r["id"]: r["word"] for r in frequent.collect()}
    wanted = Counter()
    for _, t in rows:
        w = t.split()
        for n in (1, 2, 3):
            wanted.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    assert {tuple(name[x] for x in k if x): n for k, n in zip(keys.tolist(), weights.tolist())} == {
        k: n for k, n in wanted.items() if n >= 10}


def plain_groups(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    return groups


@pytest.mark.parametrize("bucket, table", [(1 << 25, 1 << 25), (4000, 3000), (300, 200)])
def test_exact_groups(spark, documents, nothing, bucket, table):
    rng = random.Random(1)
    more = [(100 + i, rng.choice(["same", "x" * 500, f"t{i % 40}", "same "]), None, "n", i) for i in range(400)]
    docs = documents.unionByName(spark.createDataFrame(more, documents.schema)).repartition(7)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = plain_groups(given)
    found = exact_dedup.verdicts(docs, bucket_bytes=bucket, table_bytes=table).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(k for k, _ in given)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): (t, g) for t, g in groups.items()}
    kept = Counter()
    for r in found:
        _, group = by_digest[r["text_sha256"]]
        assert r["group_size"] == len(group) and r["keep_id"] == max((i for i in group if i is not None), default=None)
        assert r["doc_id"] in group and (not r["kept"] or r["doc_id"] == r["keep_id"])
        kept[r["text_sha256"]] += r["kept"]
    assert kept == Counter(dict.fromkeys(by_digest, 1))
    left = exact_dedup.unique(docs, "doc_id", "text")
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.verdicts(nothing).count() == 0 and exact_dedup.unique(nothing).columns == nothing.columns


def test_tables_compare_contents_not_hashes():
    table = exact_dedup.ContentTable(10_000)
    numbers = [table.entry(7, b"%d" % (i % 900)) for i in range(1800)]
    assert numbers[:900] == numbers[900:] and len(set(numbers)) >= 100 and -1 in numbers
    found = {n for n in numbers if n >= 0}
    assert found == set(range(len(table.contents)))


def plain_words(rows, slip, least_letters=6, least=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least_letters:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def plain_variants(counts):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out, form = {}, {}
    for w, n in counts.items():
        found = [v for v in counts if v != w and near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
        out[w] = [len(found)]
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, counts[w], out[w][0], counts.get(form[w]))
    return sorted(out.values(), key=str)


@pytest.mark.parametrize("partitions", [1, 6])
def test_variants_equal_plain_comparison(spark, partitions):
    rng = random.Random(partitions)
    letters = "abÀÿ×"
    words = {"aaaaaa": 700, "aaaaa" * 2: 3, "a" * 400: 9, "a" * 401: 60}
    for _ in range(500):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 9)))
        words[w] = int(rng.paretovariate(0.5)) % 3000 + 5
        at = rng.randrange(len(w))
        words[w[:at] + rng.choice(letters) + w[at:]] = rng.randint(5, 40)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = spelling.variants(table).select("word", "form", "root", "n", "n_near", "form_n").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(tuple, found), key=str) == plain_variants(words)


def test_words_of_documents(spark, documents, nothing):
    rng = random.Random(9)
    base = ["Strasse", "étranger", "Étranger", "colour", "color", "colours", "überall", "short", "longest", "ÀÁÂÃÄÅ"]
    rows = [(i if i % 9 else None, " ".join(rng.choice(base) + rng.choice(["", "1", ",", "Ā", "-"]) for _ in range(90)), None, "", 1)
            for i in range(60)]
    docs = documents.unionByName(spark.createDataFrame(rows, documents.schema)).repartition(4)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = spelling.spelling_variants(docs, slip=7)
    assert sorted(map(tuple, found.collect()), key=str) == plain_variants(plain_words(given, 7))
    assert spelling.spelling_variants(nothing).count() == 0
