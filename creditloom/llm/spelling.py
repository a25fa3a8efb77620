"""Spelling variants: integer pairs of trie nodes join words that differ by one inserted, deleted or replaced code point.

The prefixes of all words are the nodes of a trie, their suffixes those of the
trie of the reversed words. Both tries are numbered over sorted words: a word
shares the nodes of the prefix it has in common with the word before it and opens
new ones, so a task needs its own range of words and the path it starts from.

A word split before position i is the pair (prefix node i, suffix node i); with
position i skipped it is (prefix node i, suffix node i + 1). Two words with one
skipped pair in common differ in that position alone. A skipped pair of one word
that is a split pair of another is an insertion. Of equal neighbouring letters
only the first is skipped against splits, so every pair of words meets in one
place. A pair of nodes is met by at most one split word and by one skipped word
per code point of the alphabet: groups are bounded by it.

Defined results: null and empty texts have no words; a null id counts as an empty
one; repeated rows count as often as they occur; a word without near words has 0
of them and no form; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join

from .tables import kept

LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
SLIP = 199
HELD_WORDS = 400_000


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
                  slip: int = SLIP) -> DataFrame:
    """``word, n``: runs of Latin letters, ASCII in lower case, of at least ``least_letters`` code points.

    Where ``slip`` divides h, the unsigned crc32 of ``<id>:<run>``, the run loses its
    code point h % length. Tasks count in a bounded dictionary before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All letters are in Latin-1, where a code point is a byte; lower() of bytes changes A-Z only.
        runs = re.compile(rb"[A-Za-z\xc0-\xff]{%d,}" % least_letters).findall
        total: dict[bytes, int] = {}

        def flushed() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        crc32 = zlib.crc32
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                some = batch.slice(lo, 200)
                for key, value in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    before = crc32(f"{'' if key is None else key}:".encode())
                    for w, n in Counter(runs((value or "").encode("latin-1", "replace").lower())).items():
                        h = crc32(w if w.isascii() else w.decode("latin-1").encode(), before)
                        if h % slip == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < least_letters:
                                continue
                        total[w] = total.get(w, 0) + n
                if len(total) > HELD_WORDS:
                    yield flushed()
                    total.clear()
        yield flushed()

    found = docs.select(F.col(doc_id).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame, column: str, nodes: str) -> DataFrame:
    """``words`` with ``place``, the rank of ``column`` among all, and the numbers of its trie nodes, one per prefix.

    The root is 0 and left out. A task marks the path of its first word with
    negative depths; the driver, with the first and last word of every task, says
    which of those nodes an earlier task has opened.
    """
    names = words.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    at = names.index(column)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, opened, path, last = TaskContext.get().partitionId(), 0, 0, None, ""
        for batch in batches:
            out = []
            for word in batch.column(at).to_pylist():
                if path is None:
                    path = list(range(-1, -len(word) - 1, -1))
                else:
                    shared = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
                    path = path[:shared] + list(range(opened + 1, opened + 1 + len(word) - shared))
                    opened += len(word) - shared
                out.append(path)
                last = word
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(out), part, np.int64)), pa.array(np.arange(place, place + len(out))),
                 pa.array(out, pa.list_(pa.int64()))], names=[*names, "part", "local_place", "path"])
            place += len(out)

    ordered = words.repartitionByRange(column).sortWithinPartitions(column)
    local = kept(ordered.mapInArrow(number, f"{fields}, part long, local_place long, path array<long>"), "trie")
    ends = local.groupBy("part").agg(F.count("*").alias("k"), F.min(column).alias("first"), F.max(column).alias("last"),
                                     F.max_by("path", column).alias("path"), F.max(F.array_max("path")).alias("opened"))
    starts, before, known, rank, opened = [], "", [], 0, 0
    for r in sorted(ends.collect(), key=lambda r: r["part"]):  # one row per task
        shared = next((i for i, (a, b) in enumerate(zip(before, r["first"])) if a != b), min(len(before), len(r["first"])))
        inherited = known[:shared] + list(range(opened + 1, opened + 1 + len(r["first"]) - shared))
        opened += len(r["first"]) - shared
        starts.append((r["part"], rank, opened, inherited))
        known = [inherited[-x - 1] if x < 0 else x + opened for x in r["path"]]
        before, rank, opened = r["last"], rank + r["k"], opened + max(r["opened"] or 0, 0)
    facts = words.sparkSession.createDataFrame(starts, "part long, rank long, opened long, inherited array<long>")
    joined = lookup_join(local, facts, ["part"])
    number_of = F.expr("transform(path, x -> if(x < 0, element_at(inherited, cast(-x as int)), x + opened))")
    return joined.select(*names, F.expr("rank + local_place").alias("place"), number_of.alias(nodes))


def node_pairs(words: DataFrame) -> DataFrame:
    """``p, s, kind, id, n``: every split (kind 0) and skipped pair of nodes, kind 2 where a run of equal letters starts, else 1."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4000):
                ids, n, word, forward, backward = batch.slice(lo, 4000).columns
                letters = np.frombuffer("".join(word.to_pylist()).encode("utf-32-le"), np.uint32)
                f, b = (np.asarray(c.flatten()) for c in (forward, backward))
                size = np.asarray(forward.value_lengths())
                begin = np.cumsum(size) - size
                for skipped in (0, 1):  # positions 0..length of a split, 0..length - 1 of a skip
                    times = size + 1 - skipped
                    owner = np.repeat(np.arange(len(size)), times)
                    i = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    after = size[owner] - i - skipped  # letters of the suffix
                    p = np.where(i > 0, f[np.maximum(begin[owner] + i - 1, 0)], 0)
                    s = np.where(after > 0, b[np.maximum(begin[owner] + after - 1, 0)], 0)
                    if skipped:
                        here = begin[owner] + i
                        kind = 1 + ((i == 0) | (letters[here] != letters[np.maximum(here - 1, 0)])).astype(np.int8)
                    else:
                        kind = np.zeros(len(i), np.int8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p), pa.array(s), pa.array(kind), pa.array(np.asarray(ids)[owner]), pa.array(np.asarray(n)[owner])],
                        names=["p", "s", "kind", "id", "n"])

    return words.select("id", "n", "word", "forward", "backward").mapInArrow(pairs, "p long, s long, kind byte, id long, n long")


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best``: how many words are near, and the one of largest count (struct of -count and id)."""
    member = F.struct((-F.col("n")).alias("m"), "id", "kind")
    groups = pairs.groupBy("p", "s").agg(F.sort_array(F.collect_list(member)).alias("met")).where("size(met) > 1")
    each = groups.select(F.explode("met").alias("me"), "met").withColumn("near", F.expr(
        "filter(met, v -> v.id <> me.id AND (v.kind > 0 AND me.kind > 0 OR v.kind + me.kind = 2))")).where("size(near) > 0")
    best = F.expr("struct(near[0].m AS m, near[0].id AS id)")
    return each.groupBy("me.id").agg(F.sum(F.size("near")).alias("n_near"), F.min(best).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``id, root``: where the chain of ``id, form`` ends. Every round doubles the steps taken; counts rise along a chain by the
    form factor, so rounds grow with the logarithm of the logarithm of the largest count."""
    now = kept(links.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        following = kept(now.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")), "roots")
        now = following.drop("moved")
        if following.where("moved").isEmpty():
            return now


def variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``word, n``; words are distinct and not empty."""
    forward = numbered(words, "word", "forward").withColumnRenamed("place", "id")
    both = numbered(forward.withColumn("back", F.reverse("word")), "back", "backward").drop("back", "place")
    both = kept(both, "nodes")
    near = kept(near_words(node_pairs(both)), "near")
    table = both.select("id", "word", "n").join(near, "id", "left")
    formed = kept(table.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.expr(f"if(-best.m >= {factor} * n, best.id, NULL)").alias("form_id"),
                               F.expr(f"if(-best.m >= {factor} * n, -best.m, NULL)").alias("form_n")), "forms")
    ends = roots(formed.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    spelled = formed.select("id", "word")
    out = formed.join(ends, "id", "left")
    out = out.join(spelled.toDF("form_id", "form"), "form_id", "left").join(spelled.toDF("root", "root_word"), "root", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
                      least_count: int = LEAST_COUNT, factor: int = FORM_FACTOR, slip: int = SLIP) -> DataFrame:
    """The variants of all words of ``docs`` that occur at least ``least_count`` times."""
    words = counted_words(docs, doc_id, text, least_letters, slip).where(F.col("n") >= least_count)
    return variants(kept(words, "words"), factor)
