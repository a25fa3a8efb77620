"""Token ids in files of length-limited canonical Huffman codes.

Global counts of the ids give length-limited code lengths by package-merge: at
most 16 bits, or two more than a fixed code for larger vocabularies takes, up to
32. Lengths alone define the canonical code. Ids are stored in blocks of whole
documents, in ascending order of document. A block is independent: it holds its
bit stream and a bit offset for every ``STRIDE`` ids, so a decoder starts at all
checkpoints at once and steps through them with one table of 2^16 entries; the
few codes of more bits are found in a second, sorted one.

A file set is a folder with ``codebook`` (id, bits), ``blocks`` and their
``schema``, written by Spark. Blocks lie in a folder per range of documents; folders and their files
in the order of their names hold the documents in ascending order. Only the
codebook, at most one row per id of the vocabulary, passes through the driver.

Defined results: a null text is an empty one, a document of its end id alone;
null document ids come first; rows with equal ids follow each other in a fixed
order of their texts' hashes; an empty table gives files without blocks; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from creditloom.functions.lookup import lookup_join

from .tables import kept
from .tokens import pieces_of

TABLE_BITS = 16
LONGEST_CODE = 32
STRIDE = 128
BLOCK_IDS = 1 << 18


def bit_limit(used: int) -> int:
    """The longest code that ``used`` different ids get."""
    return TABLE_BITS if used <= 1 << TABLE_BITS else min((used - 1).bit_length() + 2, LONGEST_CODE)


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that do not occur."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    limit = bit_limit(len(used)) if limit is None else limit
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)  # exact below 2^53
    packages, leaf_levels = np.empty(0), []
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        place = np.argsort(merged, kind="stable")
        leaf_levels.append(place < len(leaves))
        merged = merged[place]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    wanted = 2 * len(used) - 2
    for is_leaf in reversed(leaf_levels):
        n = int(is_leaf[:wanted].sum())
        lengths[order[:n]] += 1
        wanted = 2 * (wanted - n)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of every id: codes ascend with (length, id)."""
    codes = np.zeros(len(lengths), np.int64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    code, bits = 0, 0
    for i in order[np.searchsorted(lengths[order], 1):].tolist():
        code <<= int(lengths[i]) - bits
        bits = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


@dataclass(frozen=True)
class DecodingTable:
    """For every 16-bit window of a stream, the id that starts it and its bits (0 bits: a longer code); longer codes, filled up
    to 32 bits, in ascending order with their ids and bits."""

    ids: np.ndarray
    bits: np.ndarray
    long_codes: np.ndarray
    long_ids: np.ndarray
    long_bits: np.ndarray


def decoding_table(lengths: np.ndarray) -> DecodingTable:
    """Both tables of a canonical code."""
    codes, used = canonical(lengths), np.flatnonzero(lengths)
    short, long = used[lengths[used] <= TABLE_BITS], used[lengths[used] > TABLE_BITS]
    ids, bits = np.zeros(1 << TABLE_BITS, np.int64), np.zeros(1 << TABLE_BITS, np.int64)
    order = short[np.argsort(codes[short] << (TABLE_BITS - lengths[short]), kind="stable")]
    widths = 1 << (TABLE_BITS - lengths[order])
    ids[:widths.sum()], bits[:widths.sum()] = np.repeat(order, widths), np.repeat(lengths[order], widths)
    if not len(long):
        bits[widths.sum():] = 1  # no stream holds these windows, but for the zeros behind its end
    filled = codes[long] << (LONGEST_CODE - lengths[long])
    order = np.argsort(filled, kind="stable")
    return DecodingTable(ids, bits, filled[order], long[order], lengths[long][order])


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Bit stream, first bit highest, and the bit offset of every ``STRIDE``-th id."""
    bits = lengths[ids]
    ends = np.cumsum(bits)
    starts = ends - bits
    word, free = starts >> 5, 64 - (starts & 31) - bits
    shifted = codes[ids].astype(np.uint64) << free.astype(np.uint64)
    size = (int(ends[-1]) >> 5) + 2 if len(ids) else 1
    # Codes do not overlap, so sums of their 32-bit halves are exact and equal to a union of bits.
    stream = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), size)
    stream[1:] += np.bincount(word, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), size)[:-1]
    return stream.astype(">u4").tobytes(), starts[::STRIDE].astype("<u4").tobytes()


def decode_block(stream: bytes, checkpoints: bytes, n: int, table: DecodingTable) -> np.ndarray:
    """The ids of a block, decoded from all checkpoints side by side."""
    words = np.append(np.frombuffer(stream, ">u4").astype(np.uint64), np.uint64(0))
    at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
    out = np.zeros((len(at), STRIDE), np.int64)
    last = (len(words) - 2) << 5
    for step in range(min(STRIDE, n)):
        word = at >> 5
        pair = words[word] << np.uint64(32) | words[word + 1]
        window = (pair >> (32 - (at & 31)).astype(np.uint64)).astype(np.int64) & 0xFFFFFFFF
        start = window >> (LONGEST_CODE - TABLE_BITS)
        found, bits = table.ids[start], table.bits[start]
        if len(table.long_codes) and not bits.all():
            lane = np.flatnonzero(bits == 0)
            place = np.searchsorted(table.long_codes, window[lane], "right") - 1
            found[lane], bits[lane] = table.long_ids[place], table.long_bits[place]
        out[:, step] = found
        at = np.minimum(at + bits, last)  # the last lane may run past its ids
    return out.ravel()[:n]


def in_order(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """Documents in ascending order of id with their ids, numbered inside their partition; written once."""
    kind = docs.schema[doc_id].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, end = pieces_of(tokenizer), np.array([end_id], "<u4").tobytes()
        part, at, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                ids = [b + end for b in pieces.encode(some.column(1).to_pylist())]
                n = np.array([len(b) // 4 for b in ids])
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.full(len(n), part)), pa.array(np.arange(at, at + len(n))),
                     pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                    names=["doc_id", "part", "place", "local_start", "n", "ids"])
                at += len(n)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    schema = f"doc_id {kind.simpleString()}, part long, place long, local_start long, n long, ids binary"
    return kept(rows.select("doc_id", "text").mapInArrow(encode, schema), "ids", compression="zstd")


def counted(ids: DataFrame) -> dict[int, int]:
    """How often every id occurs; counted per task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                found = np.bincount(np.frombuffer(b"".join(batch.column(0).slice(lo, 2000).to_pylist()), "<u4"))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in rows.collect()}


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenize ``docs`` and write the file set below ``path``."""
    spark = docs.sparkSession
    rows = in_order(docs, tokenizer, end_id, doc_id, text)
    totals = counted(rows)
    counts = np.zeros(max(totals, default=0) + 1, np.int64)
    counts[list(totals)] = list(totals.values())
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, bits long").coalesce(
        1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast((canonical(lengths), lengths))  # at most one entry per id of the vocabulary

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = shared.value

        def block(held: list[dict]) -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(d["ids"] for d in held), "<u4").astype(np.int64)
            stream, checkpoints = encode_block(ids, codes, bits)
            row = {"part": held[0]["part"], "first_place": held[0]["place"], "first_start": held[0]["local_start"],
                   "n": len(ids), "doc_ids": [d["doc_id"] for d in held], "doc_lengths": [d["n"] for d in held],
                   "checkpoints": checkpoints, "stream": stream}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        held, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                for d in batch.slice(lo, 500).to_pylist():
                    if held and (size + d["n"] > BLOCK_IDS or d["part"] != held[0]["part"] or d["place"] != held[-1]["place"] + 1):
                        yield block(held)
                        held, size = [], 0
                    held.append(d)
                    size += d["n"]
        if held:
            yield block(held)

    kind = rows.schema["doc_id"].dataType
    schema = (f"part long, first_place long, first_start long, n long, doc_ids array<{kind.simpleString()}>, "
              "doc_lengths array<long>, checkpoints binary, stream binary")
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    made = rows.mapInArrow(blocks, schema).withColumn("range", F.format_string("%08d", "part"))
    made.sortWithinPartitions("range", "first_place").write.partitionBy("range").option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame([(schema,)], "value string").coalesce(1).write.text(f"{path}/schema")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file set: ``doc_id, start, n, ids``; ``start`` counts the ids of all documents before it."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # at most one row per id of the vocabulary
    lengths = np.zeros(max((r["id"] for r in book), default=0) + 1, np.int64)
    for r in book:
        lengths[r["id"]] = r["bits"]
    shared = spark.sparkContext.broadcast(decoding_table(lengths))
    blocks = spark.read.schema(spark.read.text(f"{path}/schema").first()[0]).parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, n, docs, sizes, checkpoints, stream = (c[row] for c in batch.columns)
                ids = decode_block(stream.as_py(), checkpoints.as_py(), n.as_py(), shared.value)
                sizes = np.array(sizes.as_py())
                ends = np.cumsum(sizes)
                content = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(np.full(len(sizes), part.as_py())), pa.array(first.as_py() + ends - sizes),
                     pa.array(sizes), pa.array([content[4 * (e - s):4 * e] for s, e in zip(sizes, ends)], pa.binary())],
                    names=["doc_id", "part", "local_start", "n", "ids"])

    rows = blocks.select("part", "first_start", "n", "doc_ids", "doc_lengths", "checkpoints", "stream").mapInArrow(
        decode, f"doc_id {kind.simpleString()}, part long, local_start long, n long, ids binary")
    shifts = blocks.groupBy("part").agg(F.sum("n").alias("n")).select(  # one row per written partition
        "part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("shift"))
    return lookup_join(rows, shifts, ["part"]).select("doc_id", F.expr("shift + local_start").alias("start"), "n", "ids")
