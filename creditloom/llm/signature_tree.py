"""Similarity join of word n-gram sets with signature trees.

All pairs of texts with Jaccard similarity of at least ``percent`` / 100 are
linked; the result is each text's set size and component. Nothing is missed:

1. Texts of equal sets are one node, known by the hash of its set.
2. Routing. Sizes fall into bands, so that linked nodes lie in the same or in
   neighbouring bands. For a pair of bands the symmetric difference of linked
   sets is at most ``d``. Hashes are dealt into ``d + s`` parts: at least ``s``
   parts of linked sets are equal. The key of a part is the hash of its
   shingles. Parts have levels: those with several shingles, a rare one among
   them, say most, then come single rare ones, common ones, single common ones,
   and parts without any. The key of a lower level is sent only by a set of which
   ``s`` or more parts lie there or below: if the best of the parts that linked
   sets share has this level, that holds for both. A set with ``s`` or more empty
   parts is dealt anew, which the other does too if it shares only empty ones;
   only after the last deal are empty parts keys. So linked nodes share a key in
   any case, while passages and lines that many texts share connect few others.
   (Which shingles are rare follows from counts over all texts in hashed
   buckets; it decides the work, never the result.) Nodes that share a key are
   connected by a star, not in pairs.
3. The components of these stars hold all links. Their sets are dealt to tasks,
   large components in pairs of blocks, and joined there by a signature tree:
   its nodes hold the OR of the token bitmaps below them and ranges of sizes; a
   dual traversal drops pairs of nodes whose largest possible overlap is too
   small, and the remaining pairs of texts are compared exactly, unless they
   are connected already.

Keys are made unique within a task before the shuffle, so a frequent key
arrives at most once from every task.

Defined results: null and empty texts, and texts without words, have size 0 and
are their own component; a null id takes the smallest id it is linked with, or
null; rows with equal ids are separate texts; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from creditloom.functions.lookup import lookup_join

from .components import components
from .shingles import Sets, mixed, shingle_sets, slices
from .tables import kept

FANOUT = 16
TASK_HASHES = 2_000_000
SPARE_PARTS = 3
BUCKETS = 1 << 17
DEALS = 3
EMPTY = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


def size_bands(percent: int, longest: int) -> np.ndarray:
    """Largest size of each band; the next band starts above it. Linked sizes are at most one band apart."""
    tops, low = [], 1
    while not tops or tops[-1] < longest:
        tops.append(low * 100 // percent)
        low = tops[-1] + 1
    tops.append(low * 100 // percent)
    return np.array(tops)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS


def bucket_counts(docs: DataFrame, words: int, text: str) -> np.ndarray:
    """Shingles of all texts by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                total += np.bincount(_buckets(shingle_sets(batch.column(0).slice(a, b - a), words).hashes), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))
    found = np.zeros(BUCKETS)
    for r in counts.toLocalIterator():  # at most BUCKETS rows
        found[r["bucket"]] = r["n"]
    return found


def frequent_buckets(counts: np.ndarray) -> np.ndarray:
    """Buckets that hold clearly more shingles than an even spread would give."""
    even = counts.mean()
    return counts > even + 8 * np.sqrt(even) + 50


def _part_levels(counts: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """How little a part says, from its shingles and its rare ones: 0 rare and others, 1 one rare, 2 some common, 3 one common, 4 none."""
    return np.where(rare > 0, np.where(counts > 1, 0, 1), np.where(counts > 1, 2, np.where(counts > 0, 3, EMPTY)))


def routing_keys(sets: Sets, percent: int, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets and the position of each key's set."""
    frequent = np.zeros(BUCKETS, bool) if frequent is None else frequent
    tops = size_bands(percent, int(sets.sizes.max(initial=1)))
    band = np.searchsorted(tops, sets.sizes)
    rare = ~frequent[_buckets(sets.hashes)]
    found_keys, found_owners = [], []
    for lower in (0, 1):  # a set is in the lower or in the upper band of a pair
        pair = band - lower
        low = np.maximum(pair, 0)
        differ = (100 - percent) * (tops[low] + tops[low + 1]) // (100 + percent)
        spare = SPARE_PARTS + differ // 12
        dealt = (sets.sizes > 0) & (pair >= 0) & (differ > 0)
        for deal in range(DEALS):
            parts = np.where(dealt, differ + spare, 0)
            base = np.cumsum(parts) - parts
            mine = np.flatnonzero(parts[sets.owner] > 0)
            owner, scrambled = sets.owner[mine], mixed(sets.hashes[mine], 11 + 20 * deal)
            place = base[owner] + (scrambled >> np.uint64(20)).astype(np.int64) % parts[owner]
            content = np.zeros(int(parts.sum()), np.uint64)
            np.add.at(content, place, mixed(scrambled, 13))
            level = _part_levels(np.bincount(place, minlength=len(content)), np.bincount(place[rare[mine]], minlength=len(content)))
            holder = np.repeat(np.arange(len(parts)), parts)
            number = np.arange(len(content)) - base[holder]
            sent = level == 0
            for at_least in range(1, EMPTY + 1):
                enough = np.bincount(holder[level >= at_least], minlength=len(parts)) >= spare
                sent |= (level == at_least) & enough[holder]
            dealt = dealt & enough  # with too many empty parts a set is dealt again
            if deal < DEALS - 1:
                sent &= level < EMPTY
            salt = (pair[holder].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64) + (np.uint64(deal) << np.uint64(24))
            keys = mixed(content + mixed(salt, 17), 19)
            found_keys.append(keys[sent])
            found_owners.append(holder[sent])
            if not dealt.any():
                break
    return np.concatenate(found_keys), np.concatenate(found_owners)


def _first_of_each(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_index=True)[1]


def set_table(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, node`` of every text; written once."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(a, b - a), words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sets.sizes.astype(np.int64)),
                     pa.array(sets.signature().view(np.int64))], names=["doc_id", "n_shingles", "node"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return kept(rows.mapInArrow(measure, f"doc_id {kind}, n_shingles long, node long"), "sets")


def candidate_edges(docs: DataFrame, words: int, percent: int, text: str) -> DataFrame:
    """``a, b``: stars over the nodes that share a routing key."""
    counts = bucket_counts(docs, words, text)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_buckets(counts))  # one flag per bucket
    parts = math.ceil(counts.sum() / TASK_HASHES)  # a set has fewer keys than shingles, but for very small ones

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_nodes, size = [], [], 0

        def flush() -> pa.RecordBatch:
            keys, nodes = np.concatenate(held_keys), np.concatenate(held_nodes)
            order = np.argsort(keys, kind="stable")
            keys, nodes = keys[order], nodes[order]
            new = np.append(True, keys[1:] != keys[:-1])
            run = np.flatnonzero(new)[np.cumsum(new) - 1]
            tied = (nodes != nodes[run]) & ~new
            ties = np.unique(np.stack([nodes[tied], nodes[run][tied]]), axis=1)
            tie_keys = mixed(ties[0] * _ODD + ties[1], 23)  # a key of their own for what this task connects already
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([keys[new], tie_keys, tie_keys]).view(np.int64)),
                 pa.array(np.concatenate([nodes[new], ties[0], ties[1]]).view(np.int64))], names=["key", "node"])

        for batch in batches:
            for a, b in slices(batch.column(0)):
                sets = shingle_sets(batch.column(0).slice(a, b - a), words)
                nodes = sets.signature()
                chosen = np.zeros(len(nodes), bool)
                chosen[_first_of_each(nodes)] = True
                mine = chosen[sets.owner]
                keys, owners = routing_keys(Sets(sets.hashes[mine], sets.owner[mine], np.where(chosen, sets.sizes, 0)), percent,
                                            frequent.value)
                held_keys.append(keys)
                held_nodes.append(nodes[owners])
                size += len(keys)
                if size > 2_000_000:
                    yield flush()
                    held_keys, held_nodes, size = [], [], 0
        if size:
            yield flush()

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_node = None, None
        for batch in batches:
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            new = np.append(last_key is None or keys[0] != last_key, keys[1:] != keys[:-1])
            at = np.cumsum(new) - 1
            firsts = nodes[new]
            first = np.where(at >= 0, firsts[np.maximum(at, 0)] if len(firsts) else 0, last_node if last_node is not None else 0)
            last_key, last_node = keys[-1], first[-1]
            other = nodes != first
            pairs = np.unique(np.stack([nodes[other], first[other]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(route, "key long, node long")
    # More partitions than usual where the keys of one would not be sorted in memory; else adaptive execution chooses.
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "key") if parts > usual else rows.repartition("key")
    return dealt.sortWithinPartitions("key").mapInArrow(connect, "a long, b long")


class Tree:
    """Signature tree over sets in a given order: level 0 is the sets, every node above covers ``FANOUT`` below it."""

    def __init__(self, hashes: list[np.ndarray], group: np.ndarray) -> None:
        sizes = np.array([len(h) for h in hashes])
        width = 1 << int(np.clip(np.ceil(np.log2(4 * np.median(sizes) + 1)), 9, 14))
        bits = np.zeros((len(hashes), width // 8), np.uint8)
        for i, h in enumerate(hashes):
            place = (h & np.uint64(width - 1)).astype(np.int64)
            np.bitwise_or.at(bits[i], place >> 3, (1 << (place & 7)).astype(np.uint8))
        bits = bits.view(np.uint64)
        lost = sizes - np.bitwise_count(bits).sum(1)
        self.levels = [(bits, sizes, sizes, lost, group, group)]
        while len(self.levels[-1][0]) > FANOUT:
            bits, low, high, lost, first, last = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.maximum.reduceat(lost, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))

    def _possible(self, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Whether some set below x and some set below y can be similar enough, judged by sizes and bitmaps."""
        bits, low, high, lost, first, last = self.levels[level]
        fits = (first[x] <= last[y]) & (first[y] <= last[x])
        fits &= (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
        at = np.flatnonzero(fits)
        for part in np.array_split(at, len(at) // 20_000 + 1):
            a, b = x[part], y[part]
            overlap = np.bitwise_count(bits[a] & bits[b]).sum(1).astype(np.int64) + np.minimum(lost[a], lost[b])
            overlap = np.minimum(overlap, np.minimum(high[a], high[b]))
            fits[part] = (100 + percent) * overlap >= percent * (low[a] + low[b])
        return fits

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs x < y of sets that may be similar, by dual traversal from the top, in pieces of bounded size."""
        top = len(self.levels) - 1
        x, y = np.triu_indices(len(self.levels[top][0]))
        stack = [(top, x, y)]
        while stack:
            level, x, y = stack.pop()
            keep = self._possible(level, x, y, percent)
            x, y = x[keep], y[keep]
            if not level:
                if (apart := x < y).any():
                    yield x[apart], y[apart]
                continue
            below = len(self.levels[level - 1][0])
            for lo in reversed(range(0, len(x), 512)):  # 512 pairs of nodes are at most 131,072 below them
                a = (x[lo:lo + 512, None, None] * FANOUT + np.arange(FANOUT)[None, :, None])
                b = (y[lo:lo + 512, None, None] * FANOUT + np.arange(FANOUT)[None, None, :])
                a, b = (z.ravel() for z in np.broadcast_arrays(a, b))
                inside = (a < below) & (b < below) & (a <= b)
                stack.append((level - 1, a[inside], b[inside]))


def similar_links(nodes: np.ndarray, hashes: list[np.ndarray], group: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct sets; pairs of different groups are not links."""
    order = np.lexsort(([len(h) for h in hashes], group))
    nodes, hashes, group = nodes[order], [hashes[i] for i in order], group[order]
    tree, root = Tree(hashes, group), np.arange(len(nodes))
    sizes = tree.levels[0][1]
    values, dense = np.unique(np.concatenate(hashes), return_inverse=True)
    ends = np.cumsum(sizes)
    mark, links = np.zeros(len(values), bool), []
    for x, y in tree.pairs(percent):
        open_pairs = (root[x] != root[y]) & (group[x] == group[y])
        x, y = x[open_pairs], y[open_pairs]
        by = np.argsort(x, kind="stable")
        x, y = x[by], y[by]
        cuts = np.append(np.flatnonzero(np.diff(x, prepend=-1)), len(x))
        for lo, hi in zip(cuts, cuts[1:]):
            p, others = x[lo], y[lo:hi]
            others = others[root[others] != root[p]]
            if not len(others):
                continue
            mine = dense[ends[p] - sizes[p]:ends[p]]
            mark[mine] = True
            spans = np.concatenate([dense[ends[o] - sizes[o]:ends[o]] for o in others])
            shared = np.add.reduceat(mark[spans].astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
            mark[mine] = False
            for o in others[100 * shared >= percent * (sizes[p] + sizes[others] - shared)]:
                if root[o] != root[p]:
                    links.append((int(nodes[o]), int(nodes[p])))
                    root[root == root[o]] = root[p]
    return links


def verified_edges(docs: DataFrame, table: DataFrame, rough: DataFrame, words: int, percent: int, doc_id: str,
                   text: str) -> DataFrame:
    """``a, b``: links that connect all linked nodes, found inside the components ``rough`` (node, root)."""
    spark = docs.sparkSession
    members = rough.unionByName(rough.select(F.col("root").alias("node"), "root").distinct())
    chosen = table.where("n_shingles > 0").join(members, "node").groupBy("node", "root").agg(
        F.min("doc_id").alias("__id"), F.first("n_shingles").alias("n"))
    chosen = kept(chosen, "chosen")
    weight = chosen.groupBy("root").agg(F.sum("n").alias("total"))
    all_hashes = chosen.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-all_hashes // TASK_HASHES))
    # A light component shares a bucket with others; a heavy one is cut into blocks, and every pair of blocks meets.
    blocks = weight.select("root", F.expr(f"CAST(ceil(total / {TASK_HASHES}D) AS INT)").alias("blocks")).where("blocks > 1")
    planned = lookup_join(chosen, blocks, ["root"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)")
    planned = planned.withColumn("mine", mine).withColumn("unit", F.when(
        F.col("blocks") == 1, F.array(F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(buckets)).cast("string"))))
        .otherwise(F.expr("transform(sequence(0, blocks - 1), o -> concat_ws(':', root, least(mine, o), greatest(mine, o)))")))
    planned = kept(planned.select(F.col("__id"), F.col("node").alias("__node"), "root", "unit"), "planned")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(0)):
                part = batch.slice(a, b - a)
                found = shingle_sets(part.column(0), words)
                right = np.flatnonzero(found.signature().view(np.int64) == part.column(1).to_numpy())
                ends = found.ends
                content = [found.hashes[ends[i] - found.sizes[i]:ends[i]].tobytes() for i in right]
                taken = pa.RecordBatch.from_arrays(
                    [part.column(c).take(pa.array(right)) for c in (1, 2, 3)] + [pa.array(content, pa.binary())],
                    names=["node", "root", "unit", "hashes"])
                yield taken

    rows = lookup_join(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")), planned, ["__id"], "inner")
    rows = rows.select("text", "__node", "root", "unit").mapInArrow(
        sets, "node long, root long, unit array<string>, hashes binary")
    rows = rows.withColumn("unit", F.explode("unit"))

    def join(unit: pd.DataFrame) -> pd.DataFrame:
        unit = unit.drop_duplicates("node")
        links = similar_links(unit["node"].to_numpy(), [np.frombuffer(h, np.uint64) for h in unit["hashes"]],
                              unit["root"].to_numpy(), percent)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return rows.groupBy("unit").applyInPandas(join, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every text, ``node``, the hash of its set, and ``class``, that of its component."""
    table = set_table(docs, words, doc_id, text)
    rough = components(candidate_edges(docs, words, percent, text))
    exact = components(verified_edges(docs, table, rough, words, percent, doc_id, text))
    found = lookup_join(table, exact, ["node"]).withColumn("class", F.when(
        F.col("n_shingles") > 0, F.coalesce("root", "node")))
    least = found.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    return lookup_join(found, least, ["class"]).select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "node", "class")


def with_node(rows: DataFrame, words: int, text: str) -> DataFrame:
    """Adds ``node``, the hash of the text's set."""
    at = rows.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(at)):
                part = batch.slice(a, b - a)
                nodes = shingle_sets(part.column(at), words).signature().view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes)], names=[*part.schema.names, "node"])

    return rows.mapInArrow(add, StructType([*rows.schema.fields, StructField("node", LongType())]))


def representatives(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of every component only the row of the smallest id.

    Texts without words and rows without an id stay. Where rows of a component
    share its smallest id, one of them stays.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*columns)
    key, body = (columns[docs.columns.index(c)] for c in (doc_id, text))
    found = kept(jaccard_components(rows, words, percent, key, body).where("doc_id IS NOT NULL AND n_shingles > 0"), "classes")
    marked = found.groupBy(F.col("doc_id").alias("named")).agg(
        F.min("component_id").alias("c"), F.count("*").alias("n")).where("c <> named OR n > 1").select("named", "n")
    # A text without words is in no component, whoever shares its id.
    named = F.when(F.col(body).rlike(r"[^\x20\x09-\x0D]"), F.col(key))
    joined = lookup_join(rows.withColumn("named", named), marked, ["named"])
    single = joined.where("n IS NULL").select(*columns)
    # Rows that share their id are told apart by their sets.
    chosen = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(key), "class").agg(
        F.min("node").alias("node")).drop("class")
    repeated = with_node(joined.where("n > 1").select(*columns), words, body)
    repeated = repeated.join(chosen, [key, "node"]).dropDuplicates([key, "node"]).select(*columns)
    return single.unionByName(repeated).toDF(*docs.columns)
