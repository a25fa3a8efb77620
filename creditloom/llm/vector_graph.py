"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors are compared within a label by cosine in double precision; links have a
cosine of at least ``threshold``.

1. Vectors of equal direction bytes and label are one point with a count.
2. Centroids of every label are fitted on a bounded sample. A point's home is
   its nearest centroid's shard; it also joins every shard whose Voronoi border
   is no farther than the linking distance. So whatever links with a point lies
   in the point's home shard, and links are counted there, without emitting pairs.
3. In every shard, or block of a large one, each point's candidates are pruned
   robustly (a candidate goes when a kept one is closer to it by ``alpha``), and
   ``long_edges`` slots besides hold random points of the block. The adjacency
   lists of a point from all its shards are united, and pruned again where they
   are searched.
4. The points of a shard are searched for on the united graph: greedily with a
   beam, from the query's own point, the medoid and points far from each other,
   then expanding around every point found within range until no more come into
   range. Found links are verified in double precision and counted; a spanning
   forest of them connects components.
5. An audit compares found with true links of a bounded query set against all
   points; below ``least_recall`` the search is repeated with a wider beam. If
   the last round is still below it, all shards are searched exactly, block
   against block: a point's links lie in its home shard, so none is lost.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those with a null label, link with nothing and are their own
component; a null id is carried (its links count, it names no component unless
alone); vectors of different lengths do not link; repeated rows link with each
other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join

from .components import components
from .tables import kept


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows per label that centroids are fitted on, ``audit`` the points whose recall is measured."""

    threshold: float = 0.98
    degree: int = 16
    long_edges: int = 8
    starts: int = 64
    candidates: int = 48
    alpha: float = 1.2
    beam: int = 32
    shard_points: int = 8000
    block_points: int = 12_000
    most_centroids: int = 512
    sample: int = 20_000
    audit: int = 500
    least_recall: float = 0.95
    rounds: int = 3


def unit_rows(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of equal length, and which rows have one."""
    length = next((len(v) for v in vectors if v is not None and len(v)), 1)
    usable = np.array([v is not None and len(v) == length for v in vectors], bool)
    x = np.zeros((len(vectors), length))
    for i in np.flatnonzero(usable):
        x[i] = np.array([np.nan if c is None else c for c in vectors[i]], np.float64)
    usable &= np.isfinite(x).all(1)
    x[~usable] = 0
    x /= np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)  # keeps squares finite
    norm = np.sqrt((x * x).sum(1))
    usable &= norm > 0
    return x / np.maximum(norm, 1e-300)[:, None], usable


def points_of(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, unit, point`` of every row; ``point`` is null where the vector links with nothing."""
    def normalise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = list(batch["v"])
            lengths = np.array([-1 if v is None else len(v) for v in vectors])
            units = [None] * len(vectors)
            for length in set(lengths.tolist()):
                at = np.flatnonzero(lengths == length)
                x, usable = unit_rows([vectors[i] for i in at])
                for i, unit, good in zip(at, x, usable):
                    if good and batch["label"].iat[i] is not None:
                        units[i] = unit.astype("<f8").tobytes()
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "unit": units})

    kind = rows.schema[vec_id].dataType.simpleString()
    found = rows.select(F.col(vec_id).alias("vec_id"), F.concat_ws(":", F.size(vector).cast("string"), F.col(label).cast(
        "string")).alias("l"), F.col(label).isNull().alias("none"), F.col(vector).alias("v"))
    found = found.select("vec_id", F.when(~F.col("none"), F.col("l")).alias("label"), "v")
    made = found.mapInPandas(normalise, f"vec_id {kind}, label string, unit binary")
    return kept(made.withColumn("point", F.when(F.col("unit").isNotNull(), F.xxhash64("label", "unit"))), "points")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def fit_centroids(points: DataFrame, settings: Settings) -> DataFrame:
    """``label, centroids`` of every label, by k-means on the points of smallest hash, at most ``sample`` of them on average."""
    sizes = points.groupBy("label").agg(F.count("*").alias("n"))
    share = F.col("point").bitwiseAND(F.lit((1 << 40) - 1)) < F.lit(float(settings.sample) * (1 << 40)) / F.col("n")
    drawn = lookup_join(points.select("label", "point", "unit"), sizes, ["label"]).where(share)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("point")
        x, n = _matrix(group["unit"]), int(group["n"].iat[0])
        k = int(min(max(1, -(-n // settings.shard_points)), settings.most_centroids, len(x)))
        c = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(8):
            nearest = (x @ c.T - (c * c).sum(1) / 2).argmax(1)
            held = np.bincount(nearest, minlength=k)
            sums = np.zeros_like(c)
            np.add.at(sums, nearest, x)
            c = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], c)
        c = np.unique(c, axis=0)
        return pd.DataFrame({"label": [group["label"].iat[0]], "centroids": [c.astype("<f8").tobytes()]})

    return drawn.groupBy("label").applyInPandas(fit, "label string, centroids binary")


def sharded(points: DataFrame, centroids: DataFrame, settings: Settings) -> DataFrame:
    """``point, label, unit, n, shard, home``: every point in its home shard and in those within linking distance."""
    reach = np.sqrt(2 - 2 * settings.threshold) + 1e-9

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby("label"):
                x = _matrix(part["unit"])
                c = np.frombuffer(part["centroids"].iat[0], "<f8").reshape(-1, x.shape[1])
                squared = (c * c).sum(1) - 2 * (x @ c.T)
                home = squared.argmin(1)
                apart = np.sqrt(np.maximum(((c[:, None] - c[None]) ** 2).sum(2), 0)) if len(c) <= 64 else np.stack(
                    [np.sqrt(((c - row) ** 2).sum(1)) for row in c])
                border = squared - squared[np.arange(len(x)), home][:, None] <= 2 * reach * apart[home] + 1e-9
                border[np.arange(len(x)), home] = True
                row, shard = np.nonzero(border)
                yield pd.DataFrame({"point": part["point"].to_numpy()[row], "label": part["label"].to_numpy()[row],
                                    "unit": part["unit"].to_numpy()[row], "n": part["n"].to_numpy()[row],
                                    "shard": shard, "home": shard == home[row]})

    joined = lookup_join(points, centroids, ["label"], "inner")
    return joined.mapInPandas(assign, "point long, label string, unit binary, n long, shard int, home boolean")


def build_lists(x: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Robust-pruned neighbours of every point of a block, -1 where there are fewer, and its long edges."""
    n = len(x)
    width = min(settings.candidates, n - 1)
    if width < 1:
        return np.full((n, 1), -1), np.full((n, 1), -1)
    out = []
    for lo in range(0, n, 256):
        s = x[lo:lo + 256] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        near = np.argpartition(-s, width - 1, 1)[:, :width]
        out.append(pruned_lists(x, near, np.arange(lo, lo + len(s)), settings.degree, settings.alpha))
    far = np.random.default_rng(n).integers(0, n, (n, settings.long_edges))  # never pruned: they keep the graph in one piece
    return np.concatenate(out), np.where(far == np.arange(n)[:, None], -1, far)


def pruned_lists(x: np.ndarray, near: np.ndarray, rows: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of the candidates ``near`` of the points ``rows``."""
    view = np.concatenate([x[rows], x])  # rows first, then all points
    return _prune_rows(np.where(near >= 0, near + len(rows), -1), view, len(rows), degree, alpha)


def _prune_rows(near: np.ndarray, view: np.ndarray, rows: int, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning, all rows side by side: the nearest open candidate is kept and closes those it is closer to."""
    there = near >= 0
    v = view[np.maximum(near, 0)]
    distance = np.sqrt(np.maximum(2 - 2 * np.einsum("ijk,ik->ij", v, view[:rows]), 0))
    open_, chosen = there.copy(), np.full((rows, degree), -1)
    at = np.arange(rows)
    for d in range(degree):
        first = np.where(open_, distance, np.inf).argmin(1)
        some = open_[at, first]
        if not some.any():
            break
        chosen[some, d] = near[some, first[some]] - rows
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("ijk,ik->ij", v, v[at, first]), 0))
        open_ &= alpha * between > distance
        open_[at, first] = False
    return chosen


def start_points(x: np.ndarray, many: int) -> np.ndarray:
    """The medoid, and points that each lie as far as possible from those before."""
    starts = [int((x @ x.mean(0)).argmax())]
    nearest = x @ x[starts[0]]
    while len(starts) < min(many, len(x)):
        starts.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[starts[-1]])
    return np.array(starts)


def exact_search(x: np.ndarray, vectors: np.ndarray, own: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (query, point) with cosine of at least the threshold."""
    r, p = np.nonzero(vectors @ x.T >= settings.threshold - 1e-9)
    exact = np.concatenate([np.einsum("ij,ij->i", vectors[r[i:i + 50_000]], x[p[i:i + 50_000]])
                            for i in range(0, len(r), 50_000)]) if len(r) else np.zeros(0)
    right = (exact >= settings.threshold) & (own[r] != p)
    return r[right], p[right]


def search(x: np.ndarray, lists: np.ndarray, vectors: np.ndarray, own: np.ndarray,
           settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) with cosine of at least the threshold, found on the graph; ``own`` is a query's point or -1.

    Every query walks greedily from its own point and the start points, expanding
    the nearest point not yet expanded, ``beam`` times; then every point within
    range is expanded, until no new one comes into range.
    """
    n, q = len(x), len(vectors)
    starts_at = start_points(x, settings.starts)
    rough_x, rough_vectors = x.astype(np.float32), vectors.astype(np.float32)
    score = np.full((q, n), -np.inf, np.float32)
    expanded = np.zeros((q, n), bool)
    score[:, starts_at] = vectors @ x[starts_at].T
    there = np.flatnonzero(own >= 0)
    score[there, own[there]] = 1
    # Lists as both directions, so that an edge is walked either way.
    a, slot = np.nonzero(lists >= 0)
    b = lists[a, slot]
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.argsort(source, kind="stable")
    target, starts = target[order], np.searchsorted(source[order], np.arange(n + 1))

    def expand(row: np.ndarray, point: np.ndarray) -> None:
        expanded[row, point] = True
        many = starts[point + 1] - starts[point]
        base = np.repeat(starts[point], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        r, p = np.repeat(row, many), target[base]
        fresh = score[r, p] == -np.inf
        r, p = r[fresh], p[fresh]
        for part in range(0, len(r), 50_000):
            i, j = r[part:part + 50_000], p[part:part + 50_000]
            score[i, j] = np.einsum("ij,ij->i", rough_vectors[i], rough_x[j])

    rows = np.arange(q)
    for _ in range(min(settings.beam, n)):
        open_score = np.where(expanded, -np.inf, score)
        best = open_score.argmax(1)
        some = open_score[rows, best] > -np.inf
        if not some.any():
            break
        expand(rows[some], best[some])
    near = settings.threshold - 1e-5  # single precision; verified below
    while True:
        r, p = np.nonzero((score >= near) & ~expanded)
        if not len(r):
            break
        for part in range(0, len(r), 20_000):
            expand(r[part:part + 20_000], p[part:part + 20_000])
    r, p = np.nonzero(score >= near)
    exact = np.concatenate([np.einsum("ij,ij->i", vectors[r[i:i + 50_000]], x[p[i:i + 50_000]])
                            for i in range(0, len(r), 50_000)]) if len(r) else np.zeros(0)
    right = (exact >= settings.threshold) & (own[r] != p)
    return r[right], p[right]


def blocked(members: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``block``: 0, or one of several where a shard is large."""
    sizes = members.groupBy("label", "shard").agg(F.expr(f"CAST(ceil(count(*) / {settings.block_points}D) AS INT)").alias("blocks"))
    joined = lookup_join(members, sizes, ["label", "shard"])
    return joined.withColumn("block", F.expr("CAST(pmod(xxhash64(point, 1), blocks) AS INT)"))


def adjacency(members: DataFrame, settings: Settings) -> DataFrame:
    """``point, near, far``: the united lists of every point over its shards and blocks."""
    def build(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("point")
        x, ids = _matrix(block["unit"]), block["point"].to_numpy()
        near, far = ([ids[row[row >= 0]] for row in part] for part in build_lists(x, settings))
        return pd.DataFrame({"point": ids, "near": near, "far": far})

    lists = members.select("point", "unit", "label", "shard", "block").groupBy("label", "shard", "block").applyInPandas(
        build, "point long, near array<long>, far array<long>")
    return lists.groupBy("point").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("near", "far")])


def _placed(lists: pd.Series, ids: np.ndarray) -> np.ndarray:
    """The lists as places in the sorted ``ids``, -1 where a list is shorter; others' points are left out."""
    lists = [v if v is not None else [] for v in lists]
    out = np.full((len(ids), max(1, max(len(v) for v in lists))), -1)
    for i, v in enumerate(lists):
        v = np.asarray(v, np.int64)
        place = np.minimum(np.searchsorted(ids, v), len(ids) - 1)
        place = place[ids[place] == v]
        out[i, :len(place)] = place
    return out


def searched(members: DataFrame, lists: DataFrame, settings: Settings, exact: bool = False) -> DataFrame:
    """``point, links, other``: links found for home points (with null ``other``), and edges that connect them.

    Every block of a shard is searched for all home points of the shard, so a
    large shard meets itself in pairs of blocks. ``exact`` compares all points of
    a pair of blocks instead of walking the graph.
    """
    graph = members.join(lists, "point", "left")
    asked = graph.where("home").withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "shard", F.col("at").alias("in_block"), F.col("block").alias("from_block"), "point", "unit", "n",
        *[F.lit(None).cast("array<long>").alias(c) for c in ("near", "far")], F.lit(True).alias("asks"))
    stored = graph.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "shard", F.col("block").alias("in_block"), F.col("from").alias("from_block"), "point", "unit", "n", "near", "far",
        F.lit(False).alias("asks"))

    def find(unit: pd.DataFrame) -> pd.DataFrame:
        held = unit[~unit["asks"]].sort_values("point")
        asking = unit[unit["asks"]].sort_values("point")
        if held.empty or asking.empty:
            return pd.DataFrame({"point": [], "links": [], "other": []}).astype({"point": "int64", "links": "int64"})
        ids, x, n = held["point"].to_numpy(), _matrix(held["unit"]), held["n"].to_numpy()
        if not exact:
            near = _placed(held["near"], ids)
            if near.shape[1] > 2 * settings.degree:
                near = np.concatenate([pruned_lists(x, near[lo:lo + 256], np.arange(lo, min(lo + 256, len(ids))),
                                                    2 * settings.degree, settings.alpha) for lo in range(0, len(ids), 256)])
            lists = np.concatenate([near, _placed(held["far"], ids)], 1)
        asked_ids, vectors = asking["point"].to_numpy(), _matrix(asking["unit"])
        place = np.minimum(np.searchsorted(ids, asked_ids), len(ids) - 1)
        own = np.where(ids[place] == asked_ids, place, -1)
        links, edges = np.zeros(len(asked_ids), np.int64), []
        for lo in range(0, len(own), 1000):
            some = vectors[lo:lo + 1000], own[lo:lo + 1000], settings
            r, p = exact_search(x, *some) if exact else search(x, lists, *some)
            np.add.at(links, r + lo, n[p])
            edges.append((asked_ids[r + lo], ids[p]))
        a, b = (np.concatenate([e[i] for e in edges]) for i in (0, 1))
        forest = spanning(a, b)
        return pd.concat([pd.DataFrame({"point": asked_ids, "links": links, "other": pd.NA}),
                          pd.DataFrame({"point": forest[0], "links": 0, "other": forest[1]})]).astype({"other": "Int64"})

    keys = ["label", "shard", "in_block", "from_block"]
    return asked.unionByName(stored).groupBy(*keys).applyInPandas(find, "point long, links long, other long")


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the given edges connect: every node with the smallest one of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            break
    apart = root != np.arange(len(nodes))
    return nodes[apart], nodes[root[apart]]


def audited(points: DataFrame, counts: DataFrame, settings: Settings) -> float:
    """Found share of the true links of at most about ``audit`` points, by brute force against all points."""
    total = points.count()
    share = settings.audit / max(total, 1)
    chosen = points.where(F.expr(f"(point & 1073741823) < {share * (1 << 30)}D")).select("point", "label", "unit")
    chosen = chosen.join(counts, "point").select("label", "unit", "links").collect()  # bounded by the sample
    if not chosen:
        return 1.0
    by_label: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for label in {r["label"] for r in chosen}:
        rows = [r for r in chosen if r["label"] == label]
        by_label[label] = (np.stack([np.frombuffer(r["unit"], "<f8") for r in rows]), np.array([r["links"] for r in rows]))
    shared = points.sparkSession.sparkContext.broadcast(by_label)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        true = 0
        for batch in batches:
            for label, part in batch.groupby("label"):
                if label in shared.value:
                    hits = shared.value[label][0] @ _matrix(part["unit"]).T >= settings.threshold
                    true += int((hits * part["n"].to_numpy()).sum())
        yield pd.DataFrame({"true": [true]})

    true = points.select("label", "unit", "n").mapInPandas(count, "true long").agg(F.sum("true")).first()[0] or 0
    own = points.where(F.expr(f"(point & 1073741823) < {share * (1 << 30)}D")).agg(F.sum("n")).first()[0] or 0
    found = sum(int(v[1].sum()) for v in by_label.values())
    return 1.0 if true <= own else found / (true - own)


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector, and ``recall`` as audited."""
    table = points_of(rows, vec_id, vector, label)
    points = kept(table.where("point IS NOT NULL").groupBy("point").agg(
        F.first("label").alias("label"), F.first("unit").alias("unit"), F.count("*").alias("n")), "points")
    members = kept(blocked(sharded(points, fit_centroids(points, settings), settings), settings), "members")
    lists = kept(adjacency(members, settings), "lists")
    for attempt in range(settings.rounds + 1):
        wider = Settings(**{**settings.__dict__, "beam": settings.beam << attempt})
        found = kept(searched(members, lists, wider, exact=attempt == settings.rounds), "found")
        counts = found.where("other IS NULL").groupBy("point").agg(F.sum("links").alias("links"))
        recall = audited(points, counts, settings)
        if recall >= settings.least_recall:
            break
    roots = components(found.where("other IS NOT NULL").select(F.col("point").alias("a"), F.col("other").alias("b")))
    classes = points.select("point", "n").join(counts, "point", "left").join(
        roots.withColumnRenamed("node", "point"), "point", "left").select(
        "point", F.expr("n - 1 + coalesce(links, 0)").alias("links"), F.coalesce("root", "point").alias("class"))
    full = lookup_join(table.select("vec_id", "point"), classes, ["point"])
    least = full.where("class IS NOT NULL").groupBy("class").agg(F.min("vec_id").alias("least"))
    return lookup_join(full, least, ["class"]).select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("least", "vec_id"), F.lit(True)).alias("kept"), F.lit(recall).alias("recall"))
