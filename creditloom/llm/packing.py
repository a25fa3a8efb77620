"""Packing documents into fixed windows by minimum bin slack.

Documents are tokenized once. Whole windows are cut off the front of long
documents; what remains of each is shorter than a window, so the corpus is a
histogram of at most ``window - 1`` lengths. The plan is made on that histogram
alone: a bitset subset-sum over the lengths and their counts finds the multiset
that fills a window, started with the longest remaining length, closest to its
capacity; the multiset is read back from the bitsets and used for as many
windows as the counts allow. Where no multiset fills the window, one more
remainder is cut to fill it, so that only the very last window is padded.

A remainder's place follows from its length and its rank among equal lengths.
Ranks are counted inside each task while tokenizing and shifted by the totals
of the tasks before, so no length, however frequent, is gathered anywhere.

Defined results: a null text is an empty one, a document of its end id alone;
null and repeated ids are rows like all others; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join

from .tables import kept
from .tokens import pieces_of

Placement = tuple[int, int, int, int, int, int, int]


@dataclass
class Segment:
    """``count`` equal pieces: from ``start`` in the remainders of length ``origin`` with ranks from ``rank`` on."""

    origin: int
    rank: int
    count: int
    start: int


def best_multiset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and numbers whose sum comes closest to ``capacity`` without passing it.

    One integer holds the reachable sums as bits. Counts are split into powers
    of two; the bitset before every step is kept to read the choice back.
    """
    within = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n in counts if n <= capacity and counts[n]), reverse=True):
        left, size = min(counts[length], capacity // length), 1
        while left:
            size = min(size, left)
            steps.append((reach, length, size))
            reach |= (reach << (length * size)) & within
            left, size = left - size, size * 2
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, defaultdict(int)
    for before, length, size in reversed(steps):
        if not before >> total & 1:
            total -= length * size
            chosen[length] += size
    return dict(chosen)


def packing_plan(histogram: dict[int, int], window: int) -> tuple[list[Placement], int]:
    """Where the pieces of all remainders go, and how many windows they take.

    Each placement is (length, first rank, rank after the last, start in the
    remainder, piece length, window of the first rank, offset): consecutive
    ranks go to consecutive windows.
    """
    counts = {n: c for n, c in histogram.items() if c}
    segments = {n: deque([Segment(n, 0, c, 0)]) for n, c in counts.items()}
    plan: list[Placement] = []
    windows = 0

    def take(length: int, number: int) -> list[Segment]:
        taken = []
        while number:
            head = segments[length][0]
            n = min(number, head.count)
            taken.append(Segment(head.origin, head.rank, n, head.start))
            head.rank, head.count, number = head.rank + n, head.count - n, number - n
            counts[length] -= n
            if not head.count:
                segments[length].popleft()
        if not counts[length]:
            del counts[length]
        return taken

    def place(pieces: list[Segment], length: int, offset: int) -> None:
        at = windows
        for s in pieces:
            plan.append((s.origin, s.rank, s.rank + s.count, s.start, length, at, offset))
            at += s.count

    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = best_multiset(counts, window - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        slack = window - sum(n * k for n, k in chosen.items())
        spare = max((n for n in counts if counts[n] > chosen.get(n, 0)), default=0) if slack else 0
        need = dict(chosen)
        if spare:
            need[spare] = need.get(spare, 0) + 1
        times = min(counts[n] // k for n, k in need.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            for _ in range(chosen[length]):
                place(take(length, times), length, offset)
                offset += length
        if spare:
            cut = take(spare, times)
            place(cut, slack, offset)
            rest = spare - slack
            segments.setdefault(rest, deque()).extend(Segment(s.origin, s.rank, s.count, s.start + slack) for s in cut)
            counts[rest] = counts.get(rest, 0) + times
        windows += times
    return plan, windows


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, window: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every document, and its ranks among the windows and equal remainders of its task; written once."""
    kind = docs.schema[doc_id].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, end = pieces_of(tokenizer), np.array([end_id], "<u4").tobytes()
        part, wholes, seen = TaskContext.get().partitionId(), 0, defaultdict(int)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids = [b + end for b in pieces.encode(some.column(1).to_pylist())]
                n = [len(b) // 4 for b in ids]
                ranks, before = [], []
                for k in n:
                    before.append(wholes)
                    wholes += k // window
                    ranks.append(seen[k % window])
                    seen[k % window] += 1
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([part] * len(n), pa.int64()), pa.array(n, pa.int64()),
                     pa.array([k % window for k in n], pa.int64()), pa.array(ranks, pa.int64()),
                     pa.array(before, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "part", "doc_tokens", "rest", "local_rank", "local_wholes", "ids"])

    schema = f"doc_id {kind.simpleString()}, part long, doc_tokens long, rest long, local_rank long, local_wholes long, ids binary"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, schema)
    return kept(rows, "tokens", compression="zstd")


def packed(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = 1024, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    """
    spark = docs.sparkSession
    rows = tokenized(docs, tokenizer, end_id, window, doc_id, text)

    # At most window - 1 rows reach the driver, and the plan's size follows from them, not from the corpus.
    per_task = kept(rows.groupBy("part", "rest").agg(
        F.count("*").alias("n"), F.sum((F.col("doc_tokens") - F.col("rest")) / window).cast("long").alias("wholes")), "lengths")
    histogram = {r["rest"]: r["n"] for r in per_task.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    plan, windows = packing_plan(histogram, window)

    before = "ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = per_task.select("part", "rest", F.expr(f"coalesce(sum(n) OVER (PARTITION BY rest {before}), 0)").alias("shift"))
    wholes = per_task.groupBy("part").agg(F.sum("wholes").alias("n")).select(  # one row per task
        "part", F.expr(f"coalesce(sum(n) OVER ({before}), 0)").alias("shift"))

    def piece(df: DataFrame, start: str, length: str, sequence: str, offset: str) -> DataFrame:
        return df.select("doc_id", F.expr(start).alias("start"), F.expr(length).alias("length"),
                         F.expr(f"substring(ids, cast(4 * ({start}) + 1 AS INT), cast(4 * ({length}) AS INT))").alias("ids"),
                         "doc_tokens", F.expr(sequence).alias("sequence_id"), F.expr(offset).alias("offset"))

    long = lookup_join(rows.where(f"doc_tokens >= {window}"), wholes, ["part"])
    long = long.withColumn("k", F.explode(F.expr(f"sequence(0L, doc_tokens div {window} - 1)")))
    whole = piece(long, f"k * {window}", f"{window}L", f"{windows} + shift + local_wholes + k", "0L")
    if not plan:
        return whole
    placements = spark.createDataFrame(
        [(int(a), int(b), int(c), int(d), int(e), int(f), int(g)) for a, b, c, d, e, f, g in plan],
        "origin long, from_rank long, to_rank long, piece_start long, piece_length long, first_window long, place long")
    rests = lookup_join(rows.where("rest > 0"), offsets, ["part", "rest"]).withColumn("rank", F.col("shift") + F.col("local_rank"))
    placed = rests.join(F.broadcast(placements), F.expr("rest = origin AND rank >= from_rank AND rank < to_rank"))
    rest = piece(placed, "doc_tokens - rest + piece_start", "piece_length", "first_window + rank - from_rank", "place")
    return whole.unionByName(rest)
