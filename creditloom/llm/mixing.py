"""Mixing sources to target weights with fixed-length blocks and index permutations.

The words of each source form one stream, in the order of a hash of id and text,
cut into blocks of ``block_words``. Targets follow from sizes and weights alone.
Every output shard draws how many of its slots go to each source from a
multinomial over what the sources still have to give, so shards vary like a
random mix and totals meet the targets. Shards are the leaves of a tree whose
nodes draw how their slots divide between their halves, so a task draws for its
own shards without those before them. The k-th slot of a source takes block
``permutation(k mod blocks)`` of pass ``k div blocks``; each pass has its own
keyed permutation, so no block repeats within a pass, and no more than
``max_repeats`` passes exist. Slots and the pieces of documents meet in one join
by (source, block).

Positions in a stream are sums over cells of the hash, whose number follows from
the rows, and sums inside a cell: a source of any size is never gathered, and
nothing depends on files, partitions or cores.

Through the driver pass one row per source, at most ``MAX_SOURCES``; tasks get
three numbers of each.

Defined results: a null text has no words; null is a source of its own, last in
order; documents without words take nothing; null and repeated ids are rows like
all others, and rows equal in id and text may be exchanged; an empty table gives
an empty result; extra columns are ignored unless named in ``keep``, where they
keep their names. Runs with the same seed and rows agree.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join

from .quality_rules import SPACE
from .shingles import mixed
from .tables import kept

MAX_SOURCES = 4_000_000
SHARD_SLOTS = 8192
CELL_ROWS = 50_000


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], total: float, max_repeats: int) -> dict:
    """Share ``total`` by weight; what would pass ``max_repeats`` times a source's size is shared again."""
    found, open_sources, left = {}, set(sizes), float(total)
    while open_sources:
        unit = left / sum(weights[s] for s in open_sources)
        full = {s for s in open_sources if weights[s] * unit > max_repeats * sizes[s]}
        if not full:
            return found | {s: weights[s] * unit for s in open_sources}
        found |= {s: float(max_repeats * sizes[s]) for s in full}
        left -= sum(max_repeats * sizes[s] for s in full)
        open_sources -= full
    return found


def cyclic_weights(sources: list[str | None], cycle: tuple[int, ...] = (1, 2, 3)) -> dict[str | None, int]:
    """Weights in turn for the sources in order of code points, null last."""
    ordered = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def permuted(index: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Keyed permutation of range(size), element by element: a Feistel network walked until back in range."""
    index, keys = index.astype(np.uint64), keys.astype(np.uint64)
    half = np.array([max(1, (max(int(n) - 1, 1).bit_length() + 1) // 2) for n in sizes], np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, open_rows = index.copy(), np.arange(len(index))
    while len(open_rows):
        h, m, k, x = half[open_rows], low[open_rows], keys[open_rows], out[open_rows]
        left, right = x >> h, x & m
        for i in range(6):
            mixed = (right + k + np.uint64(i + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(29)
            left, right = right, left ^ (mixed & m)
        out[open_rows] = left << h | right
        open_rows = open_rows[out[open_rows] >= sizes[open_rows].astype(np.uint64)]
    return out.astype(np.int64)


def drawn(counts: np.ndarray, wanted: int, rng: np.random.Generator) -> np.ndarray:
    """``wanted`` of the things counted, by a multinomial that is drawn again for what a source does not have."""
    found = np.zeros_like(counts)
    while missing := wanted - int(found.sum()):
        free = counts - found
        found += np.minimum(rng.multinomial(missing, free / free.sum()), free)
    return found


class ShardDraws:
    """Slots of every source in every shard: a tree of draws over ranges of shards, walked from its root."""

    def __init__(self, slots: np.ndarray, shards: int, seed: int) -> None:
        self.slots, self.shards, self.seed = slots.astype(np.int64), shards, seed
        self.total = int(self.slots.sum())
        self.path: dict[tuple[int, int], np.ndarray] = {}

    def size(self, low: int, high: int) -> int:
        """Slots of the shards from ``low`` on and before ``high``."""
        return self.total * high // self.shards - self.total * low // self.shards

    def shard(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Slots of every source in a shard, and in all shards before it."""
        low, high, counts, before, path = 0, self.shards, self.slots, np.zeros_like(self.slots), {}
        while high - low > 1:
            middle = (low + high) // 2
            left = self.path.get((low, high))
            if left is None:
                rng = np.random.Generator(np.random.Philox(key=[self.seed, low << 32 | high]))
                left = drawn(counts, self.size(low, middle), rng)
            path[low, high] = left
            if number < middle:
                counts, high = left, middle
            else:
                counts, before, low = counts - left, before + left, middle
        self.path = path  # the next shard shares its beginning
        return counts, before


def laid_out(docs: DataFrame, source: str = "source", text: str = "text", keep: tuple[str, ...] = ("doc_id",),
             doc_id: str = "doc_id") -> DataFrame:
    """``k0``, ``k1`` .. (the ``keep`` columns), ``row`` (a number of its own), ``source``, ``size`` in words and ``h``, the place
    in the source's stream; written once."""
    size = F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), "")).cast("long")
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(source).cast("string").alias("source"),
                       size.alias("size"), F.xxhash64(doc_id, text).alias("h"))
    return kept(rows.withColumn("row", F.monotonically_increasing_id()), "layout")


def positions(layout: DataFrame) -> DataFrame:
    """``index, row, size, start``: the words before a document in its source's stream; documents without words are left out.

    ``layout`` has ``index``, a number per source.
    """
    rows = layout.where("size > 0").select("index", "row", "size", "h")
    bits = max(0, math.ceil(math.log2(max(rows.count(), 1) / CELL_ROWS)))
    # Cells are dealt by source and cell as one key: two columns would let Spark deal by the source alone.
    cell = F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.withColumn("cell", F.struct(F.col("index").alias("i"), cell.alias("c")))
    cells = rows.groupBy("cell").agg(F.sum("size").alias("words"))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    cells = cells.select("cell", F.expr(f"coalesce(sum(words) OVER (PARTITION BY cell.i ORDER BY cell.c {before}), 0)").alias("shift"))
    inside = F.expr(f"coalesce(sum(size) OVER (PARTITION BY cell ORDER BY h, row {before}), 0)")
    return rows.join(cells, "cell").select("index", "row", "size", (F.col("shift") + inside).alias("start"))


def mix(docs: DataFrame, source: str = "source", text: str = "text", keep: tuple[str, ...] = ("doc_id",),
        total_share: float = 1.0, max_repeats: int = 3, block_words: int = 128, seed: int = 42,
        weights: dict[str | None, float] | None = None, doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The documents with their targets, and the pieces that fill the slots of the mix.

    First table: ``held`` (a struct of the ``keep`` columns), ``row, source, size, source_size, target``.
    Second: ``shard, slot, source, pass, block, row, at, from_word, to_word``, one
    row per piece of a document in a slot; ``at`` orders the pieces of a block.
    """
    spark = docs.sparkSession
    layout = laid_out(docs, source, text, keep, doc_id)
    per_source = kept(layout.groupBy("source").agg(F.sum("size").alias("n")), "sizes")
    if (found := per_source.count()) > MAX_SOURCES:
        raise ValueError(f"{found} sources; at most {MAX_SOURCES} are mixed")
    sizes = {r["source"]: r["n"] for r in per_source.collect()}
    weights = weights or cyclic_weights(list(sizes))
    goals = targets(sizes, weights, total_share * sum(sizes.values()), max_repeats)

    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    blocks = np.array([math.ceil(sizes[s] / block_words) for s in names], np.int64)
    slots = np.array([min(max_repeats * b, round(goals[s] * b / sizes[s])) if b else 0 for s, b in zip(names, blocks)], np.int64)
    keys = np.array([int.from_bytes(hashlib.blake2b(f"{seed}|{s!r}".encode(), digest_size=8).digest()) for s in names], np.uint64)
    facts = spark.createDataFrame([(s, i, int(sizes[s]), float(goals[s])) for i, s in enumerate(names)],
                                  "source string, index long, source_size long, target double")
    known = lookup_join(layout, facts, ["source"])

    shards = math.ceil(int(slots.sum()) / SHARD_SLOTS)
    shared = spark.sparkContext.broadcast((slots, blocks, keys))  # at most MAX_SOURCES rows

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, blocks, keys = shared.value
        draws = ShardDraws(slots, shards, seed)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts, before = draws.shard(shard)
                own = np.flatnonzero(counts)
                index = np.repeat(own, counts[own])
                place = np.arange(len(index))
                k = before[index] + place - np.repeat(np.cumsum(counts[own]) - counts[own], counts[own])
                turn = k // blocks[index]
                key = np.full(len(index), seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(shard)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), shard)), pa.array(permuted(place, np.full(len(index), len(index)), mixed(key))),
                     pa.array(index), pa.array(turn),
                     pa.array(permuted(k % blocks[index], blocks[index], mixed(keys[index] + turn.astype(np.uint64))))],
                    names=["shard", "slot", "index", "pass", "block"])

    numbers = spark.range(0, shards, 1, max(1, math.ceil(shards / 64)))
    drawn_slots = numbers.mapInArrow(place, "shard long, slot long, index long, pass long, block long")
    b = block_words
    pieces = positions(known).withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})"))).select(
        F.col("index").alias("__i"), F.col("block").alias("__b"), "row", F.expr(f"greatest(block * {b}, start)").alias("at"),
        F.expr(f"greatest(block * {b} - start, 0)").alias("from_word"),
        F.expr(f"least((block + 1) * {b} - start, size)").alias("to_word"))
    # Both sides grow with the corpus, whatever their estimates before the expansion say: never broadcast.
    filled = drawn_slots.hint("merge").join(pieces, F.expr("block = __b AND index = __i"))
    named = lookup_join(filled, facts.select("index", "source"), ["index"])
    held = F.struct(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]).alias("held")
    return (known.select(held, "row", "source", "size", "source_size", "target"),
            named.select("shard", "slot", "source", "pass", "block", "row", "at", "from_word", "to_word"))


def taken_words(known: DataFrame, filled: DataFrame) -> DataFrame:
    """The first table of ``mix`` with ``taken``, the words the mix takes of each document, repeats counted."""
    taken = filled.groupBy(F.col("row").alias("__row")).agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return known.join(taken, F.col("row") == F.col("__row"), "left").drop("__row").fillna(0, ["taken"])


def _words_of(spans: Column) -> Column:
    """The words of an array of spans of ``__w``, parted by spaces."""
    return F.array_join(F.flatten(F.transform(spans, lambda s: F.slice(
        "__w", (s["from_word"] + 1).cast("int"), (s["to_word"] - s["from_word"]).cast("int")))), " ")


def mixed_texts(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """The columns of ``docs``, one row per document and pass of the mix, with the words that this pass takes.

    A document taken whole keeps its text as it is; otherwise the taken words
    follow each other, parted by spaces.
    """
    known, filled = mix(docs, source, text, tuple(docs.columns), doc_id=doc_id, **settings)
    spans = filled.groupBy(F.col("row").alias("__row"), "pass").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("spans"),
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    words = F.array_remove(F.split(F.col("held")[text], SPACE), "")
    found = known.join(spans, F.col("row") == F.col("__row")).withColumn("__w", F.when(F.col("taken") < F.col("size"), words))
    part = F.when(F.col("taken") < F.col("size"), _words_of(F.col("spans"))).otherwise(F.col("held")[text])
    return found.select(*[(part if c == text else F.col("held")[c]).alias(c) for c in docs.columns])


def mixed_blocks(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """``shard, slot, source, pass, block, text``: the blocks of words that fill the slots of every output shard."""
    known, filled = mix(docs, source, text, (text,), doc_id=doc_id, **settings)
    piece = F.struct("at", "shard", "slot", "pass", "block", "from_word", "to_word")
    pieces = filled.groupBy(F.col("row").alias("__row")).agg(F.collect_list(piece).alias("pieces"))  # bounded by the document
    words = F.array_remove(F.split(F.col("held")[text], SPACE), "")
    found = known.join(pieces, F.col("row") == F.col("__row")).withColumn("__w", words)
    parts = F.transform("pieces", lambda p: F.struct(p["shard"].alias("shard"), p["slot"].alias("slot"), p["pass"].alias("pass"),
                                                     p["block"].alias("block"), p["at"].alias("at"), _words_of(F.array(p)).alias("part")))
    return found.select("source", F.explode(parts).alias("p")).groupBy("p.shard", "p.slot", "source", "p.pass", "p.block").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p.at", "p.part"))), lambda x: x["part"]), " ").alias("text"))
