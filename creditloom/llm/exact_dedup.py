"""Exact deduplication by Grace hashing: spill files of hash buckets, open-addressing tables, complete content.

Every task first folds the equal texts it reads in a table of bounded size, so a
group of copies leaves a task as one record, however large the group is. Records
are then dealt to buckets by the hash of their text and written out by the
exchange; a bucket is read into one open-addressing table that compares contents
in every byte. A table that is full spills what it has not seen yet: those
records are written and dealt again by another hash, until every bucket fits. The
records of one text may themselves pass a bucket's size (long texts with copies
in very many tasks); they are folded in parts before they are dealt again whole.

The hash only places records. Two texts are equal when their bytes are.

Defined results: a null text is an empty one; of equal texts the row of the
largest id stays, null ids being smallest; of rows equal in text and id one
stays; an empty table gives an empty result; extra columns are ignored unless
named in ``keep``, under any names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from creditloom.functions.lookup import lookup_join

from .tables import kept

BUCKET_BYTES = 32 << 20
TABLE_BYTES = 96 << 20
ROW_BYTES = 64
FOLDED_TOGETHER = 8


class ContentTable:
    """Distinct contents by open addressing with linear probing; ``hashes`` are given, equality is that of all bytes."""

    def __init__(self, max_bytes: int) -> None:
        self.max_bytes, self.bytes = max_bytes, 0
        self.slots, self.mask = [-1] * 1024, 1023
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def entry(self, h: int, content: bytes) -> int:
        """The number of the content, entered if it is new; -1 if it is new and the table is full."""
        at = h & self.mask
        while (found := self.slots[at]) >= 0:
            if self.hashes[found] == h and self.contents[found] == content:
                return found
            at = (at + 1) & self.mask
        if self.contents and self.bytes + len(content) > self.max_bytes:
            return -1
        self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + ROW_BYTES
        if 2 * len(self.contents) > self.mask:
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = [-1] * (self.mask + 1)
        for number, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = number


def _better(a: tuple[Any, int], b: tuple[Any, int]) -> tuple[Any, int]:
    """Of two (id, row) the one that stays: the larger id, null last, then the smaller row."""
    if a[0] is None or b[0] is None or a[0] == b[0]:
        return b if (a[0] is None, a[1]) > (b[0] is None, b[1]) else a
    return a if a[0] > b[0] else b


def _batches(rows: list[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        columns = zip(*rows[at:at + size])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def folded(docs: DataFrame, doc_id: str, text: str, keep: tuple[str, ...], table_bytes: int) -> DataFrame:
    """One row per document with the record ``g`` it went into, and one per record: a text, its rows and the one that stays.

    Written once; ``content`` is null for documents, whose rows are told by it.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    held = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    schema = ", ".join([f"doc_id {kind}, row long, g long, h long, size long, n long, content binary", *held])
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    given = docs.select(F.col(doc_id).alias("doc_id"), content.alias("content"), F.xxhash64(content).alias("h"),
                        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    nothing = (None,) * len(keep)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        row = g = first
        table, counts, best = ContentTable(table_bytes), [], []

        def records() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(counts), 500):
                some = range(at, min(at + 500, len(counts)))
                yield from _batches([(best[e][0], best[e][1], g + e, table.hashes[e], len(table.contents[e]), counts[e],
                                      table.contents[e], *nothing) for e in some], arrow)

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                ids, contents, hashes, *extra = (c.to_pylist() for c in batch.slice(lo, 500).columns)
                members = []
                for i, (key, value, h) in enumerate(zip(ids, contents, hashes)):
                    e = table.entry(h, value)
                    if e < 0:
                        yield from records()
                        g += len(counts)
                        table, counts, best = ContentTable(table_bytes), [], []
                        e = table.entry(h, value)
                    if e == len(counts):
                        counts.append(1)
                        best.append((key, row))
                    else:
                        counts[e] += 1
                        best[e] = _better(best[e], (key, row))
                    members.append((key, row, g + e, None, None, None, None, *[c[i] for c in extra]))
                    row += 1
                yield from _batches(members, arrow)
        yield from records()

    return kept(given.mapInArrow(fold, schema), "folded", compression="zstd")


def grouped(records: DataFrame, bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES, level: int = 0) -> DataFrame:
    """``g, keep_id, keep_row, n, sha256`` for every record ``g, h, size, n, doc_id, row, content``."""
    weight = F.sum(F.col("size") + ROW_BYTES)
    total = records.agg(weight).first()[0] or 0
    buckets = max(records.sparkSession.sparkContext.defaultParallelism, math.ceil(total / bucket_bytes))
    # The records of one text alone pass a bucket: at most total / bucket_bytes such texts.
    heavy = records.groupBy("h").agg(weight.alias("w"), F.count("*").alias("k")).where(F.col("w") > bucket_bytes)
    heavy = heavy.select("h", F.least(F.ceil(F.col("w") / bucket_bytes), F.ceil(F.col("k") / FOLDED_TOGETHER)).alias("parts"))
    dealt = lookup_join(records.select("g", "h", "size", "n", "doc_id", "row", "content"), heavy.where("parts > 1"), ["h"])
    dealt = dealt.withColumn("part", F.expr("if(parts IS NULL, -1L, pmod(xxhash64(g), parts))")).drop("parts")
    dealt = dealt.repartition(buckets, F.xxhash64("h", F.lit(level), "part"))

    kind = records.schema["doc_id"].dataType.simpleString()
    schema = f"again boolean, g long, root long, h long, size long, n long, doc_id {kind}, row long, content binary, sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(table_bytes)
        counts, best, roots, whole, entered = [], [], [], [], []
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                spilled = []
                for g, h, size, n, key, row, content, part in zip(*(c.to_pylist() for c in batch.slice(lo, 500).columns)):
                    e = table.entry(h, content)
                    if e < 0:
                        spilled.append((True, g, None, h, size, n, key, row, content, None))
                        continue
                    if e == len(counts):
                        counts.append(n)
                        best.append((key, row))
                        roots.append(g)
                        whole.append(part < 0)
                    else:
                        counts[e] += n
                        best[e] = _better(best[e], (key, row))
                    if part < 0 or g != roots[e]:
                        entered.append((g, e))
                yield from _batches(spilled, arrow)
        digests = [hashlib.sha256(c).hexdigest() if final else None for c, final in zip(table.contents, whole)]
        for at in range(0, len(entered), 20_000):
            yield from _batches([
                (False, g, roots[e], None, None, counts[e] if whole[e] else None, *(best[e] if whole[e] else (None, None)), None,
                 digests[e]) for g, e in entered[at:at + 20_000]], arrow)
        parts = [e for e, final in enumerate(whole) if not final]
        for at in range(0, len(parts), 500):
            yield from _batches([(True, roots[e], None, table.hashes[e], len(table.contents[e]), counts[e], *best[e],
                                  table.contents[e], None) for e in parts[at:at + 500]], arrow)

    out = kept(dealt.mapInArrow(fill, schema), "buckets", compression="zstd")
    facts = ["g", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "n", "sha256"]
    done = out.where("NOT again AND n IS NOT NULL").select(*facts)
    more = out.where("again")
    if more.isEmpty():
        return done
    deeper = grouped(more, bucket_bytes, table_bytes, level + 1)
    parts = out.where("NOT again AND n IS NULL").select("g", "root")
    linked = parts.join(deeper.withColumnRenamed("g", "root"), "root").drop("root")
    return done.unionByName(linked.select(*deeper.columns)).unionByName(deeper)


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
             bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row, and the columns named in ``keep`` as a struct ``held``."""
    rows = folded(docs, doc_id, text, keep, table_bytes)
    facts = grouped(rows.where("content IS NOT NULL"), bucket_bytes, table_bytes)
    held = F.struct(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]).alias("held")
    joined = rows.where("content IS NULL").drop("n", "h", "size", "content").join(facts, "g")
    return joined.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"),
                         F.col("sha256").alias("text_sha256"), *([held] if keep else []))


def unique(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns as they are."""
    return verdicts(docs, doc_id, text, keep=tuple(docs.columns)).where("kept").select("held.*")
