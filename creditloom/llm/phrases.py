"""Phrase collocations by weighted acyclic automata.

Tasks cut texts into shards of word numbers of their own, with the counts of
their words. Counts are summed per language; words that are frequent enough for
a phrase get one number each, every other word ends the n-grams it stands in, as
a mark between pieces does. The sorted n-grams of a shard become a count
transducer; transducers are cut at the same n-grams into prefix ranges of about
equal size, and the parts of a range are united into one, weights summed, where
rare n-grams are dropped. A range then sends the parts of its phrases, as an
acceptor per target, to the ranges they fall into; composed with the transducer
there, they come back with their counts. A range asks for a part once, so no
word, however frequent, gathers rows.

Through the driver pass the cuts, one n-gram per ``RANGE_ENTRIES`` n-grams of all
shards (12 bytes each, 30 MB for 10^13 n-grams); they are broadcast.

Defined results: a null text is an empty one, without words; a null language is
``und``; document ids are not used; repeated rows count as often as they occur;
texts of any length; an empty table gives an empty result; extra columns are
ignored. Equal scores and counts are ranked by the bytes of the phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join

from .count_automata import CountAutomaton, comparable, cut, ordered, summed, union
from .tables import kept

LONGEST = 3
LEAST_COUNT = 10
TOP = 2000
SCALE = 1_000_000
COVERED_PERCENT = 50
SHARD_WORDS = 4 << 20
RANGE_ENTRIES = 2 << 20
SAMPLED = 1 << 15
RANKED_TOGETHER = 200_000
SLICE = 200

# Bytes that part pieces, and the upper-case letters.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_BETWEEN = b"\xff"  # in no UTF-8 text
_BYTES = bytes.maketrans(bytes(range(65, 91)) + PIECE_ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(PIECE_ENDS) + b" ")


class _Numbers(dict):
    """Numbers from 1 in order of first use; 0 is the mark between pieces."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def shards(docs: DataFrame, text: str = "text", lang: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``shard, lang, total, words, counts, stream``: the texts as numbers into ``words``, 0 after every piece; written once."""
    def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, serial, held = TaskContext.get().partitionId() << 24, 0, {}

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal serial
            for name, (numbers, streams) in held.items():
                stream = np.concatenate(streams)
                counts = np.bincount(stream, minlength=len(numbers))[1:]
                words = [w.decode() for w in list(numbers)[1:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + serial]), pa.array([name]), pa.array([int(counts.sum())]), pa.array([words], pa.list_(pa.string())),
                     pa.array([counts], pa.list_(pa.int64())), pa.array([stream.tobytes()], pa.binary())],
                    names=["shard", "lang", "total", "words", "counts", "stream"])
                serial += 1
            held.clear()

        size = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                some, by_lang = batch.slice(lo, SLICE), {}
                for name, value in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    by_lang.setdefault(name, []).append(value)
                for name, texts in by_lang.items():
                    content = b"\n".join([*texts, b""]).translate(_BYTES).replace(b"\n", b" " + _BETWEEN + b" ")
                    numbers, streams = held.setdefault(name, (_Numbers({_BETWEEN: 0}), []))
                    found = content.split()
                    streams.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                    size += len(found)
                if size >= shard_words:
                    yield from flushed()
                    size = 0
        yield from flushed()

    given = docs.select(F.coalesce(F.col(lang), F.lit("und")), F.coalesce(F.col(text), F.lit("")).cast("binary"))
    made = given.mapInArrow(cut_words, "shard long, lang string, total long, words array<string>, counts array<long>, stream binary")
    return kept(made, "shards", compression="zstd")


def frequent_words(made: DataFrame, least: int) -> DataFrame:
    """``lang, word, id``: words that occur at least ``least`` times, numbered from 1."""
    words = made.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word"))
    found = words.agg(F.sum("w.counts").alias("n")).where(F.col("n") >= least).select(
        "lang", "word", F.spark_partition_id().cast("long").alias("part"),
        F.expr("monotonically_increasing_id() & ((1L << 33) - 1)").alias("place"))
    found = kept(found, "frequent")
    shifts = found.groupBy("part").agg(F.count("*").alias("k")).select(  # one row per task
        "part", F.expr("coalesce(sum(k) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("shift"))
    return lookup_join(found, shifts, ["part"]).select("lang", "word", F.expr("shift + place + 1").alias("id"))


def shard_automata(made: DataFrame, frequent: DataFrame, longest: int) -> DataFrame:
    """``entries, sample, automaton`` of every shard; ``sample`` has every ``SAMPLED``-th n-gram. Written once."""
    places = made.select("shard", "lang", F.posexplode("words").alias("place", "word"))
    numbers = places.join(frequent, ["lang", "word"]).select(F.col("shard").alias("owner"), "place", "id")

    def build(shard: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        for number, stream in zip(shard.column("shard").to_pylist(), shard.column("stream").to_pylist()):
            stream = np.frombuffer(stream, np.uint32)
            ids = np.zeros(int(stream.max(initial=0)) + 1, np.uint32)
            ids[np.asarray(known.column("place")) + 1] = np.asarray(known.column("id"))
            at = ids[stream]
            keys = np.zeros((len(at), longest), np.uint32)
            for d in range(longest):
                keys[:len(at) - d, d] = at[d:]
                if d:
                    keys[:, d] *= keys[:, d - 1] != 0
            keys = keys[at != 0]
            keys = keys[ordered(keys)]
            automaton = CountAutomaton.of_positions(keys)
            paths, _ = automaton.paths()
            sample = paths[(number * 0x9E3779B1 & 0xFFFFFFFF) % SAMPLED::SAMPLED]
            out.append((len(paths), sample.astype(np.int64).tolist(), automaton.to_bytes()))
        entries, sample, blobs = zip(*out) if out else ((), (), ())
        return pa.table([pa.array(entries, pa.int64()), pa.array(sample, pa.list_(pa.list_(pa.int64()))), pa.array(blobs, pa.binary())],
                        names=["entries", "sample", "automaton"])

    pairs = made.select("shard", "stream").groupBy("shard").cogroup(numbers.groupBy("owner"))
    return kept(pairs.applyInArrow(build, "entries long, sample array<array<long>>, automaton binary"), "automata", compression="zstd")


def range_cuts(automata: DataFrame, longest: int, range_entries: int) -> np.ndarray:
    """The n-grams at which prefix ranges of about ``range_entries`` start, but for the first range."""
    total = automata.agg(F.sum("entries")).first()[0] or 0
    ranges = math.ceil(total / range_entries)
    if ranges < 2:
        return np.zeros((0, longest), np.uint32)
    keys = automata.select(F.explode("sample").alias("key")).repartitionByRange(ranges, "key")
    found = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key")).collect()
    return np.array(sorted(r["key"] for r in found)[1:], np.uint32).reshape(-1, longest)


def _dealt(rows: DataFrame, ranges: int, to: str, *then: str) -> DataFrame:
    return rows.repartitionById(ranges, F.col(to).cast("int")).sortWithinPartitions(to, *then)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows with the same first column, which follow each other."""
    held: list[tuple] = []
    for batch in batches:
        for lo in range(0, batch.num_rows, 100):
            for row in zip(*(c.to_pylist() for c in batch.slice(lo, 100).columns)):
                if held and row[0] != held[0][0]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def range_counts(automata: DataFrame, cuts: np.ndarray, longest: int, least: int) -> DataFrame:
    """``target, automaton``: per prefix range the union of all shards, without n-grams rarer than ``least``; written once."""
    shared = automata.sparkSession.sparkContext.broadcast(cuts)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                parts = cut(*CountAutomaton.from_bytes(data.as_py()).paths(), shared.value)
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in parts], pa.int64()),
                                                  pa.array([a.to_bytes() for _, a in parts], pa.binary())], names=["target", "automaton"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            keys, weights = union([CountAutomaton.from_bytes(data) for _, data in rows], longest)
            often = weights >= least
            united = CountAutomaton.of_paths(keys[often], weights[often]).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]], pa.int64()), pa.array([united], pa.binary())], names=["target", "automaton"])

    parts = automata.select("automaton").mapInArrow(split, "target long, automaton binary")
    return kept(_dealt(parts, len(cuts) + 1, "target").mapInArrow(unite, "target long, automaton binary"), "counts")


def _cuts_of(keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per number of first words k: the rows longer than k, their first k words and the rest."""
    out = []
    length = (keys != 0).sum(1)
    for k in range(1, keys.shape[1]):
        rows = np.flatnonzero(length > k)
        first, rest = np.zeros((len(rows), keys.shape[1]), np.uint32), np.zeros((len(rows), keys.shape[1]), np.uint32)
        first[:, :k] = keys[rows, :k]
        rest[:, :keys.shape[1] - k] = keys[rows, k:]
        out.append((rows, first, rest))
    return out


def candidates(counts: DataFrame, cuts: np.ndarray, longest: int, scale: int) -> DataFrame:
    """``words`` (numbers), ``a, l, r, score`` of every n-gram of at least two words, at its lowest-scoring cut; written once."""
    ranges = len(cuts) + 1
    shared = counts.sparkSession.sparkContext.broadcast(cuts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, data in zip(*(c.to_pylist() for c in batch.columns)):
                keys, _ = CountAutomaton.from_bytes(data).paths()
                parts = np.concatenate([np.zeros((0, longest), np.uint32), *[p for _, a, b in _cuts_of(keys) for p in (a, b)]])
                asked = cut(*summed(parts, np.ones(len(parts), np.int64)), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in asked], pa.int64()), pa.array([origin] * len(asked), pa.int64()),
                     pa.array([a.to_bytes() for _, a in asked], pa.binary())], names=["target", "origin", "automaton"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, data), *asked in _grouped(batches):
            transducer = CountAutomaton.from_bytes(data)
            for _, origin, acceptor in asked:
                keys, _ = CountAutomaton.from_bytes(acceptor).paths()
                found = CountAutomaton.of_paths(keys, transducer.composed(keys)).to_bytes()
                yield pa.RecordBatch.from_arrays([pa.array([origin], pa.int64()), pa.array([1], pa.int64()), pa.array([found], pa.binary())],
                                                 names=["target", "origin", "automaton"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, data), *answers in _grouped(batches):
            keys, weights = CountAutomaton.from_bytes(data).paths()
            part, count = union([CountAutomaton.from_bytes(a) for _, _, a in answers], longest)
            index, amounts = comparable(part), count.astype(object)
            best, left, right = [np.full(len(keys), None, object) for _ in range(3)]
            for rows, first, rest in _cuts_of(keys):
                if not len(rows):
                    continue
                l, r = (amounts[np.searchsorted(index, comparable(p))] for p in (first, rest))
                found = scale * weights[rows].astype(object) ** 2 // (l * r)  # Python integers: exact at any size
                lower = np.array([b is None or s < b for s, b in zip(found, best[rows])], bool)
                best[rows[lower]], left[rows[lower]], right[rows[lower]] = found[lower], l[lower], r[lower]
            real = np.flatnonzero((keys != 0).sum(1) > 1)
            for at in range(0, len(real), 20_000):
                some = real[at:at + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([[w for w in row if w] for row in keys[some].tolist()], pa.list_(pa.int64())), pa.array(weights[some]),
                     *[pa.array(x[some].tolist(), pa.int64()) for x in (left, right, best)]], names=["words", "a", "l", "r", "score"])

    own = counts.select("target", F.lit(-1).cast("long").alias("origin"), "automaton")  # before all that it answers or reads
    fields = "target long, origin long, automaton binary"
    asked = _dealt(own.unionByName(counts.mapInArrow(ask, fields)), ranges, "target", "origin")
    answers = kept(asked.mapInArrow(answer, fields), "answers")
    scored = _dealt(own.unionByName(answers), ranges, "target", "origin")
    return kept(scored.mapInArrow(score, "words array<long>, a long, l long, r long, score long"), "candidates")


def uncovered(found: DataFrame, percent: int) -> DataFrame:
    """Without phrases that lie in a longer one which has at least ``percent`` of their count."""
    inner = F.expr("flatten(transform(sequence(2, greatest(size(words) - 1, 2)), n -> "
                   "transform(sequence(1, size(words) - n + 1), i -> slice(words, i, n))))")
    longer = found.where("size(words) > 2").select(F.explode(inner).alias("words"), F.col("a").alias("outer"))
    most = longer.groupBy("words").agg(F.max("outer").alias("outer"))
    return found.join(most, "words", "left").where(f"outer IS NULL OR 100 * outer < {percent} * a").drop("outer")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST_COUNT,
                 top: int = TOP, scale: int = SCALE, covered_percent: int = COVERED_PERCENT, shard_words: int = SHARD_WORDS,
                 range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language."""
    made = shards(docs, text, lang, shard_words)
    totals = made.groupBy("lang").agg(F.sum("total").alias("n"))
    frequent = frequent_words(made, least)
    automata = shard_automata(made, frequent, longest)
    cuts = range_cuts(automata, longest, range_entries)
    counts = range_counts(automata, cuts, longest, least)
    found = uncovered(candidates(counts, cuts, longest, scale), covered_percent)

    spelled = found.select("*", F.posexplode("words").alias("place", "id")).join(frequent, "id")
    phrase = F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda w: w["word"]))
    table = spelled.groupBy("words", "lang", "a", "l", "r", "score").agg(phrase.alias("phrase"))
    table = kept(table.drop("words"), "phrases")

    # Ranked in parts first: a language of any size sends at most its first rows of every part on.
    parts = math.ceil(table.count() / RANKED_TOGETHER)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(max(parts, 1))).alias("part")
    first = table.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = first.where(F.col("rank") <= top).drop("part").withColumn("rank", last.cast("long")).where(F.col("rank") <= top)
    return lookup_join(ranked, totals, ["lang"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
