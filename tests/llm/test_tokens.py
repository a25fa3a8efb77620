"""Tokenizing, packing, Huffman files and the source mix against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from corpus_texts import TEXTS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditloom.llm import huffman, mixing, packing
from creditloom.llm.shingles import mixed
from creditloom.llm.tokens import pieces_of
from creditloom.session import scratch_path

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path):
    plain = Tokenizer.from_file(path)
    odd = ["  a  b", "a \n b", "a\n\n  b c", "'s 't ' s", "\u039f\u0394\u039f\u03a3 \u039f\u0394\u039f\u03a3", "a\x1c b \x85c", " \n \n  x",
           "x.\nY z, \u0130stanbul", "a\u0301 e\u0301", "1 2 3  4", "hello <|endoftext|> x", "<|endoftext|>", "a<|ENDOFTEXT|>b <|startoftext|>",
           "it.\nThe", "a\nb\nc d\ne", "end.\n\nNew\n", "\nx", "x \ny", "x\n y", "It's\nfine'\n's", "stepf$$$ x%%%\n&&&y ###", "a)(b ab)( cd''.",
           "\u00c9t\u00e9!\n\u00c9t\u00e9?!", "don't.\nDon't, DON'T!", "ab_cd_ ef__\n_gh", "x\u0301.\ny", "\u00df.\r\nz", "w1. 2w, 3.\n4", "q" * 50 + "\nr",
           "<|endoftext|> <|endof text|> x", "x <|endoftext|", "<|", "|>", "a <|endoftext|>\n\n b <|STARTOFTEXT|> c"]
    texts = TEXTS + odd
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, pieces_of(path).encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


def test_best_multiset_is_closest_to_capacity():
    rng = np.random.default_rng(3)
    for _ in range(30):
        counts = {int(n): int(rng.integers(1, 4)) for n in rng.integers(1, 20, 5)}
        capacity = int(rng.integers(1, 60))
        chosen = packing.best_multiset(counts, capacity)
        assert all(chosen[n] <= counts[n] for n in chosen)
        sums = {sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*[range(c + 1) for c in counts.values()])}
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= capacity)


def test_plan_places_every_token_once_and_pads_one_window():
    histogram = {1: 3, 5: 20, 6: 20, 9: 7, 10: 31}
    plan, windows = packing.packing_plan(histogram, 16)
    filled, seen = Counter(), Counter()
    for origin, lo, hi, start, length, window, offset in plan:
        for rank in range(lo, hi):
            seen.update((origin, rank, start + i) for i in range(length))
            filled.update((window + rank - lo, offset + i) for i in range(length))
    assert set(seen) == {(n, r, i) for n, c in histogram.items() for r in range(c) for i in range(n)}
    assert set(seen.values()) == set(filled.values()) == {1}
    used = Counter(w for w, _ in filled)
    assert sorted(used.values())[1:] == [16] * (windows - 1)


def test_packed_pieces_hold_the_documents(documents, nothing):
    rows = packing.packed(documents, BYTES, window=64).collect()
    plain = Tokenizer.from_file(BYTES)
    wanted = Counter((r["doc_id"], i) for r in documents.collect() for i in plain.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    found = Counter((r["doc_id"], i) for r in rows for i in np.frombuffer(r["ids"], "<u4").tolist())
    assert found == wanted
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in windows.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(places))]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 64
    assert sum(sum(n for _, n in p) < 64 for p in windows.values()) <= 1
    assert packing.packed(nothing, BYTES).count() == 0


@pytest.mark.parametrize("used, n", [(1, 10), (2, 40), (900, 5_000), (40_000, 300_000), (150_000, 400_000)])
def test_huffman_round_trip_and_limit(used, n):
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, n) - 1, used - 1)
    lengths = huffman.code_lengths(np.bincount(ids))
    assert lengths.max() <= huffman.bit_limit(used)
    if used > 1 << huffman.TABLE_BITS:
        ids = np.concatenate([ids, np.arange(used)])  # all ids occur, so codes are longer than the table
        lengths = huffman.code_lengths(np.bincount(ids))
        assert huffman.TABLE_BITS < lengths.max() <= huffman.bit_limit(used)
        n = len(ids)
    stream, checkpoints = huffman.encode_block(ids, huffman.canonical(lengths), lengths)
    assert (huffman.decode_block(stream, checkpoints, n, huffman.decoding_table(lengths)) == ids).all()


def test_limited_lengths_are_optimal_among_short_codes():
    counts = np.array([1, 1, 2, 4, 8, 16, 32])
    best = min(sum(int(c) * n for c, n in zip(counts, lengths)) for lengths in itertools.product(range(1, 5), repeat=7)
               if sum(2.0 ** -n for n in lengths) <= 1)
    assert int((counts * huffman.code_lengths(counts, 4)).sum()) == best


def test_files_give_every_document_back(spark, documents, nothing):
    path = scratch_path(spark, "coded")
    huffman.write(documents, path, WORDS, 2)
    rows = huffman.read(spark, path).orderBy("start").collect()
    plain = Tokenizer.from_file(WORDS)
    wanted = Counter((r["doc_id"], zlib.crc32(np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
                     for r in documents.collect())
    assert Counter((r["doc_id"], zlib.crc32(r["ids"])) for r in rows) == wanted
    assert [r["start"] for r in rows] == [0, *itertools.accumulate(r["n"] for r in rows)][:-1]
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    files = sorted(Path(f"{path}/blocks").rglob("*.parquet"))
    stored = [i for f in files for r in pq.read_table(f, columns=["doc_ids"], partitioning=None).column(0).to_pylist() for i in r]
    assert stored == ids
    empty = scratch_path(spark, "coded")
    huffman.write(nothing, empty, WORDS, 2)
    assert huffman.read(spark, empty).count() == 0


def test_targets_stop_at_three_times_a_source():
    found = mixing.targets({"a": 10, "b": 1000, "c": 0}, {"a": 3, "b": 1, "c": 1}, 1010, 3)
    assert found == {"a": 30.0, "b": 980.0, "c": 0.0}
    assert mixing.cyclic_weights(["b", None, "a", "\U0001f600", "\uffff"]) == {"a": 1, "b": 2, "\uffff": 3, "\U0001f600": 1, None: 2}


def test_draws_and_permutations_are_complete():
    slots = np.array([5, 0, 1000, 37])
    draws = mixing.ShardDraws(slots, 7, 1)
    found = [draws.shard(j) for j in range(7)]
    counts = np.array([c for c, _ in found])
    assert (counts.sum(0) == slots).all() and np.ptp(counts.sum(1)) <= 1
    assert (np.array([b for _, b in found]) == np.cumsum(counts, 0) - counts).all()
    alone = [mixing.ShardDraws(slots, 7, 1).shard(j)[0] for j in (5, 2)]
    assert (np.array(alone) == counts[[5, 2]]).all()
    for n in (1, 2, 5, 1000):
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 9))) == list(range(n))


def test_mix_takes_whole_passes_and_meets_targets(documents, nothing):
    table = mixing.taken_words(*mixing.mix(documents, block_words=16)).toPandas()
    assert len(table) == documents.count() and (table["taken"] <= 3 * table["size"]).all()
    for _, g in table.groupby(table["source"].fillna("none")):
        assert abs(g["taken"].sum() - g["target"].iat[0]) <= 40
    words = mixing.mixed_texts(documents, block_words=16)
    assert words.columns == documents.columns
    assert words.agg(F.sum(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))).first()[0] == table["taken"].sum()
    assert mixing.taken_words(*mixing.mix(nothing)).count() == 0 and mixing.mixed_blocks(nothing).count() == 0


@pytest.fixture(scope="module")
def sourced(spark):
    """A source with a third of all words, a null source, small ones, repeated rows, and columns of inner names."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i * 7 % 60)), ["hot", None, "b", "c"][max(0, i % 6 - 2)], "x", i) for i in range(150)]
    rows += rows[:5]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, row long")


def plain_mix(docs, block_words, seed, shard_slots):
    """Texts of all slots, from streams in memory."""
    streams, sizes = {}, Counter()
    for r in sorted(docs.withColumn("h", F.xxhash64("doc_id", "text")).collect(), key=lambda r: r["h"]):
        words = (r["text"] or "").split()
        streams.setdefault(r["source"], []).extend((r["doc_id"], w) for w in words)
        sizes[r["source"]] += len(words)
    names = sorted(s for s in streams if s is not None) + [None]
    goals = mixing.targets(sizes, mixing.cyclic_weights(list(sizes)), sum(sizes.values()), 3)
    blocks = [-(-len(streams[s]) // block_words) for s in names]
    slots = np.array([min(3 * b, round(goals[s] * b / sizes[s])) for s, b in zip(names, blocks)])
    draws = mixing.ShardDraws(slots, -(-int(slots.sum()) // shard_slots), seed)
    out, taken, seen = {}, Counter(), [set() for _ in names]
    for shard in range(draws.shards):
        counts, before = draws.shard(shard)
        for i, s in enumerate(names):
            for o in range(counts[i]):
                turn, place = divmod(int(before[i]) + o, blocks[i])
                key = int.from_bytes(hashlib.blake2b(f"{seed}|{s!r}".encode(), digest_size=8).digest()) + turn
                block = int(mixing.permuted(np.array([place]), np.array([blocks[i]]), mixed(np.array([key & (1 << 64) - 1], np.uint64)))[0])
                assert (turn, block) not in seen[i]
                seen[i].add((turn, block))
                words = streams[s][block * block_words:(block + 1) * block_words]
                out[shard, s, turn, block] = " ".join(w for _, w in words)
                taken.update(d for d, _ in words)
    return out, taken


def test_mix_equals_plain_streams(spark, sourced, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 40)
    wanted, taken = plain_mix(sourced, 16, 42, 40)
    found = mixing.mixed_blocks(sourced, block_words=16).collect()
    assert {(r["shard"], r["source"], r["pass"], r["block"]): r["text"] for r in found} == wanted
    by_shard = Counter(r["shard"] for r in found)
    assert len(by_shard) > 3 and np.ptp(list(by_shard.values())) <= 1
    for shard, n in by_shard.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    results = []
    for parts, cell_rows in ((1, 50_000), (9, 20)):
        monkeypatch.setattr(mixing, "CELL_ROWS", cell_rows)
        docs = sourced.repartition(parts, F.rand(parts))
        table = mixing.taken_words(*mixing.mix(docs, block_words=16, keep=("doc_id", "size", "row")))
        assert table.select("held.*").columns == ["doc_id", "size", "row"]
        results.append(Counter())
        for r in table.collect():
            results[-1][r["held"]["doc_id"]] += r["taken"]
    assert results[0] == results[1] == Counter({i: taken[i] for i in results[0]})


def test_mix_of_very_many_sources(spark):
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"), F.concat(F.lit("host"), F.col("id") % 20_000).alias("source"))
    table = mixing.taken_words(*mixing.mix(docs, block_words=4))
    facts = table.agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max(F.expr("taken / size")).alias("most")).first()
    assert facts["n"] == 60_000 and abs(facts["taken"] - 300_000) < 30_000 and facts["most"] <= 3


def test_encoding_is_not_interrupted_by_collections():
    """Thousands of words and lists are held while a batch is encoded; none of them can be garbage."""
    import gc

    from creditloom.llm.tokens import Pieces
    pieces, seen = Pieces(public_tokenizers.path("word_bpe_49k.json")), []
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + k % 26)}{'xyz'[k % 3]} {k * i}" for k in range(40)) + "\nline\n" * 30 for i in range(400)]
    gc.callbacks.append(lambda phase, info: seen.append(phase))
    try:
        found = pieces.encode(texts)
    finally:
        gc.callbacks.pop()
    assert not seen and gc.isenabled()
    assert found[7] == np.array(pieces.whole.encode(texts[7], add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_a_word_is_looked_up_once_for_many_texts(path, monkeypatch):
    """Looking up every occurrence took most of the time of tokenizing."""
    from creditloom.llm import tokens

    class Counting(dict):
        asked = 0

        def get(self, *key):
            Counting.asked += 1
            return super().get(*key)

    pieces = tokens.Pieces(path)
    pieces.known, pieces.bare = Counting(), Counting()
    texts = ["The first words, and the first words.\nThe words", "", None, "words \u4e2d", "q" * 60 + " words " + "z" * 60 + "\n" + "q" * 60 + " and"] * 100
    wanted = [np.array(pieces.whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert pieces.encode(texts) == wanted and Counting.asked < 40
    monkeypatch.setattr(tokens, "MAX_CHARACTERS", 100)
    assert pieces.encode(texts) == wanted and max(map(len, pieces.known)) <= tokens.LONGEST_PIECE
