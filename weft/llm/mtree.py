"""Exact top-k by integer inner product with M-trees.

A vector's components become floor(64 x). With M the largest norm, a stored vector v gets
one more component sqrt(M^2 - |v|^2) and a query q a zero; then the squared Euclidean
distance is |q|^2 + M^2 - 2 q.v, so the nearest neighbours are those of the largest inner
product, and a metric tree finds them. Distances only steer the search; scores are exact integers.

1. Equal vectors are one entry that keeps the smallest ids, k rows of an id at most, until
   k are left without any one id (no query can return more of them). The entries are dealt to the nearest of at most ``PIVOTS`` pivots, and a pivot's
   entries, if more than ``TREE_ROWS``, to several trees by a hash.
2. A task builds each M-tree from pages of at most ``PAGE`` entries: an entry has the distance
   to its page's router, a page its covering radius.
3. Equal queries are one search. Each first searches the trees of its nearest pivot, which
   bounds its k-th score; then those trees whose pivot distance less covering radius does
   not exceed that bound. Inside a tree pages are visited best first, each by all queries of the
   block that its bound admits; an entry is passed over without computing its distance where
   the stored distance to the router bounds it away (triangle inequality).
4. Queries meet trees in blocks of at most ``QUERY_ROWS``; each (tree, block) gives for each query
   its best k ids and as many more as the query's own id has rows, and these are ranked together.

Vectors that are null, or hold a null or a component that is not finite, take no part.
Shorter vectors count as padded with zeros. Scaled components must be below 2^24 in
magnitude, so that all sums are exact. Null ids take no part. Rows that repeat an id are
candidates of their own, and query rows that repeat an id are ranked together under that id,
each with all its candidates, as OP8_SQL does; a query never returns its own id.
No queries or candidates: no rows."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm.common import materialise, table

SCALE = 64
PIVOTS = 256
PIVOT_ROWS = 4096  # entries that a pivot is meant to have
TREE_ROWS = 8192
QUERY_ROWS = 4096
PAGE = 64
NEAREST = 2  # leaves of a query that are visited before all others
SLACK = 1e-6  # relative, for rounding of distances


class MTree:
    """Pages over points (float64 rows). Built bottom up; searched best first."""

    def __init__(self, points: np.ndarray, page: int = PAGE):
        self.points = points
        # a page: level (0 holds points), entries, distances to the router sorted with them
        self.pages: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.routers: list[np.ndarray] = []
        self.radii: list[float] = []
        level, keys, centres, reach = 0, np.arange(len(points)), points, np.zeros(len(points))
        while True:
            first = len(self.pages)
            for rows in self._grouped(centres, page):
                router = centres[rows].mean(axis=0)
                away = np.sqrt(((centres[rows] - router) ** 2).sum(axis=1))
                by = np.argsort(away, kind="stable")
                self.pages.append((level, keys[rows][by], away[by]))
                self.routers.append(router)
                self.radii.append(float((away + reach[rows]).max()))
            keys = np.arange(first, len(self.pages))
            centres, reach = np.array(self.routers[first:]), np.array(self.radii[first:])
            level += 1
            if len(keys) == 1:
                break
        self.centre_of = np.array(self.routers)
        self.radius_of = np.array(self.radii)

    @staticmethod
    def _grouped(x: np.ndarray, page: int) -> list[np.ndarray]:
        """Rows in groups of at most ``page``: nearest of evenly spread rows, then by distance."""
        out, work = [], [np.arange(len(x))]
        while work:
            rows = work.pop()
            if len(rows) <= page:
                out.append(rows)
                continue
            k = min(math.ceil(2 * len(rows) / page), 64)
            centres = x[rows[np.linspace(0, len(rows) - 1, k).astype(int)]]
            near = ((centres ** 2).sum(axis=1)[None] - 2 * x[rows] @ centres.T).argmin(axis=1)
            parts = [rows[near == c] for c in range(k) if (near == c).any()]
            if len(parts) == 1:  # no way to tell them apart
                parts = [rows[i:i + page] for i in range(0, len(rows), page)]
            small = sorted((p for p in parts if len(p) <= page // 2), key=len)
            work.extend(p for p in parts if len(p) > page // 2)
            joined: list[np.ndarray] = []
            for p in small:  # neighbours of one parent share a page
                joined.append(p)
                if sum(map(len, joined)) > page // 2:
                    out.append(np.concatenate(joined)) if sum(map(len, joined)) <= page else out.extend(joined)
                    joined = []
            if joined:
                out.append(np.concatenate(joined))
        return out

    def search(self, query: np.ndarray, score, k: int, kth: float, distance_of) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores that hold the ``k`` best, ties with the k-th included.

        score(rows) gives exact scores, kth is a score that the k-th best is known to
        reach, distance_of(score) the distance that a score means."""
        found_rows: list[np.ndarray] = []
        found: list[np.ndarray] = []
        best = np.full(0, -np.inf)
        limit = distance_of(kth)
        root = len(self.pages) - 1
        from_root = float(np.sqrt(((self.centre_of[root] - query) ** 2).sum()))
        heap = [(max(0.0, from_root - self.radius_of[root]), root, from_root)]
        while heap:
            bound, number, away = heapq.heappop(heap)
            if bound > limit:
                break
            level, entries, from_router = self.pages[number]
            if level == 0:
                a, b = np.searchsorted(from_router, [away - limit, away + limit + 1e-12])
                rows = entries[max(a - 1, 0):b + 1]
                scores = score(rows)
                ok = scores >= kth
                rows, scores = rows[ok], scores[ok]
                if not len(rows):
                    continue
                found_rows.append(rows)
                found.append(scores)
                best = np.concatenate([best, scores])
                if len(best) > k:
                    best = np.partition(best, len(best) - k)[-k:]
                if len(best) == k and best.min() > kth:
                    kth = float(best.min())
                    limit = distance_of(kth)
            else:
                near = np.abs(away - from_router) - self.radius_of[entries] <= limit
                entries = entries[near]
                apart = np.sqrt(((self.centre_of[entries] - query) ** 2).sum(axis=1))
                bounds = np.maximum(apart - self.radius_of[entries], 0)
                for b, e, d in zip(bounds.tolist(), entries.tolist(), apart.tolist(), strict=True):
                    if b <= limit:
                        heapq.heappush(heap, (b, e, d))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        rows, scores = np.concatenate(found_rows), np.concatenate(found)
        ok = scores >= kth
        return rows[ok], scores[ok]


    def search_many(self, queries: np.ndarray, score, need: np.ndarray, kth: np.ndarray, distance_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, row, score) of the ``need`` best of each query, ties with the last included.

        As ``search``, for many queries: a page is compared at once with all queries that its
        bound admits. Each query's nearest leaves come first, then the others by their bounds,
        each taken only by the queries whose bound, as it is by then, still admits it.
        score(rows, numbers) gives exact scores, a row for each query."""
        kth, limit = kth.astype(np.float64).copy(), distance_of(kth, np.arange(len(queries)))
        best = np.full((len(queries), int(need.max())), -np.inf)  # sorted by columns, the best last
        width = best.shape[1]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def apart(numbers: np.ndarray, routers: np.ndarray) -> np.ndarray:
            own, other = queries[numbers], self.centre_of[routers]
            return np.sqrt(np.maximum((own ** 2).sum(axis=1)[:, None] + (other ** 2).sum(axis=1)[None] - 2 * own @ other.T, 0))

        def visit(page: int, numbers: np.ndarray, away: np.ndarray) -> None:
            _, entries, from_router = self.pages[page]
            near = np.abs(away[:, None] - from_router[None]) <= limit[numbers][:, None] * (1 + SLACK) + SLACK
            rows = np.flatnonzero(near.any(axis=0))
            some = np.flatnonzero(near.any(axis=1))
            if not len(rows):
                return
            numbers, entries = numbers[some], entries[rows]
            scores = np.where(near[np.ix_(some, rows)], score(entries, numbers), -np.inf)
            ok = scores >= kth[numbers][:, None]
            hit = np.flatnonzero(ok.any(axis=1))
            if not len(hit):
                return
            at, which = np.nonzero(ok)
            found.append((numbers[at], entries[which], scores[at, which]))
            numbers = numbers[hit]
            both = np.concatenate([best[numbers], np.where(ok[hit], scores[hit], -np.inf)], axis=1)
            best[numbers] = np.sort(np.partition(both, both.shape[1] - width, axis=1)[:, -width:], axis=1)
            reached = best[numbers, width - need[numbers]]
            better = reached > kth[numbers]
            kth[numbers[better]] = reached[better]
            limit[numbers[better]] = distance_of(kth[numbers[better]], numbers[better])

        root = len(self.pages) - 1
        every = np.arange(len(queries))
        work, leaves = [(root, every, apart(every, np.array([root]))[:, 0])], []
        while work:
            page, numbers, away = work.pop()
            level, entries, from_router = self.pages[page]
            if level == 0:
                leaves.append((page, numbers, away, np.maximum(away - self.radius_of[page], 0)))
                continue
            reach = self.radius_of[entries][None]
            slack = limit[numbers][:, None] * (1 + SLACK) + SLACK
            near = np.abs(away[:, None] - from_router[None]) - reach <= slack
            rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if not len(rows):
                continue
            distance = apart(numbers[rows], entries[columns])
            near = near[np.ix_(rows, columns)] & (distance - reach[:, columns] <= slack[rows])
            for c in np.flatnonzero(near.any(axis=0)).tolist():
                own = np.flatnonzero(near[:, c])
                work.append((int(entries[columns[c]]), numbers[rows[own]], distance[own, c]))
        if not leaves:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        number = np.concatenate([n for _, n, _, _ in leaves])
        leaf = np.repeat(np.arange(len(leaves)), [len(n) for _, n, _, _ in leaves])
        away, bound = np.concatenate([a for _, _, a, _ in leaves]), np.concatenate([b for _, _, _, b in leaves])
        by = np.lexsort((away, number))
        starts = np.flatnonzero(np.concatenate([[True], number[by][1:] != number[by][:-1]]))
        place = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
        first = np.zeros(len(by), bool)
        first[by[place < NEAREST]] = True
        for part in (np.flatnonzero(first), np.flatnonzero(~first)):
            part = part[np.argsort(leaf[part], kind="stable")]
            groups = np.split(part, np.flatnonzero(np.diff(leaf[part])) + 1) if len(part) else []
            for own in sorted(groups, key=lambda g: float(bound[g].min())):
                own = own[bound[own] <= limit[number[own]] * (1 + SLACK) + SLACK]
                if len(own):
                    visit(leaves[leaf[own[0]]][0], number[own], away[own])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        number, rows, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        ok = scores >= kth[number]
        return number[ok], rows[ok], scores[ok]


def scaled(column: str) -> Column:
    """floor(64 x) of a vector's components; null where the vector takes no part."""
    x = F.col(column)
    fine = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))), F.lit(False))
    return F.when(fine, F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of lists of numbers as a matrix, padded with zeros."""
    out = np.zeros((len(column), dims))
    flat, ends = np.asarray(column.flatten()), np.cumsum(np.asarray(pa.compute.list_value_length(column)))
    sizes = np.diff(np.concatenate([[0], ends]))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def _lifted(points: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([points, np.sqrt(np.maximum(top - (points ** 2).sum(axis=1), 0))[:, None]], axis=1)


TREE_KEY = "pivot long, tree long, block long"
HIT_SCHEMA = "query long, need long, vec_id long, score long"


def _searcher(dims: int, top: float):
    def search(trees: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("query", "need", "vec_id", "score")})
        if not len(trees) or not len(queries):
            return empty
        trees, queries = trees.combine_chunks(), queries.combine_chunks()
        points = _matrix(trees.column("v").chunk(0), dims)
        ids = trees.column("ids").chunk(0)
        many = np.asarray(pa.compute.list_value_length(ids))
        flat, first = np.asarray(ids.flatten()), np.cumsum(many) - many
        tree = MTree(_lifted(points, top))
        wanted = _matrix(queries.column("v").chunk(0), dims)
        size = (wanted ** 2).sum(axis=1) + top
        need = np.asarray(queries.column("need"))

        def distance_of(scores: np.ndarray, numbers: np.ndarray) -> np.ndarray:
            with np.errstate(invalid="ignore"):
                return np.where(np.isneginf(scores), np.inf, np.sqrt(np.maximum(size[numbers] - 2 * scores, 0.0)) * (1 + SLACK) + SLACK)

        number, rows, scores = tree.search_many(np.concatenate([wanted, np.zeros((len(wanted), 1))], axis=1), lambda r, n: wanted[n] @ points[r].T,
                                                need, np.asarray(queries.column("kth")).astype(np.float64), distance_of)
        copies = many[rows]
        vec = flat[np.repeat(first[rows], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)]
        number, scores = np.repeat(number, copies), np.repeat(scores, copies).astype(np.int64)
        by = np.lexsort((vec, -scores, number))
        number, vec, scores = number[by], vec[by], scores[by]
        starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else np.zeros(0, np.int64)
        place = np.arange(len(number)) - np.repeat(starts, np.diff(np.append(starts, len(number))))
        ok = place < need[number]
        return pa.table({"query": pa.array(np.asarray(queries.column("query"))[number[ok]], pa.int64()), "need": pa.array(need[number[ok]], pa.int64()),
                         "vec_id": pa.array(vec[ok], pa.int64()), "score": pa.array(scores[ok], pa.int64())})

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k other rows of the highest
    inner product, ties to the smaller id."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where("v is not null and vec_id is not null"))
    rows = materialise(rows, "vectors")
    square = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x * x)
    dims, top = rows.agg(F.max(F.size("v")), F.max(square)).first()
    dims, top = dims or 1, float(top or 0)
    # rows of one id and vector; no query returns more than k of them
    same = materialise(rows.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("n"), F.least(F.count_if("asks"), F.lit(k)).alias("asked")), "same")
    before = F.sum("n").over(Window.partitionBy("v").orderBy("vec_id")) - F.col("n")
    entries = (same.withColumn("before", before).where(F.col("before") < 2 * k)
               .groupBy("v").agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("n").cast("int"))))).alias("ids")))
    entries = materialise(entries, "entries")
    own_rows = same.groupBy("vec_id").agg(F.sum("n").alias("own"), F.sum("asked").alias("asked")).where("asked > 0").select("vec_id", "own")
    asked = (same.where("asked > 0").join(own_rows, "vec_id").groupBy("v")
             .agg((F.max("own") + k).alias("need")))
    queries = materialise(asked.withColumn("query", F.monotonically_increasing_id()), "queries")  # a number for equal queries

    # at most PIVOTS pivots, whatever the size
    n = entries.count()
    chosen = entries.orderBy(F.xxhash64("v"), "v").limit(min(PIVOTS, max(1, math.ceil(n / PIVOT_ROWS)))).select("v").collect()
    pivots = np.zeros((max(len(chosen), 1), dims))
    for i, r in enumerate(chosen):
        pivots[i, :len(r["v"])] = r["v"]
    lifted = _lifted(pivots, top)

    def nearest(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if len(batch):
                points = _lifted(_matrix(batch.column("v"), dims), top)
                near = ((lifted ** 2).sum(axis=1)[None] - 2 * points @ lifted.T).argmin(axis=1)
                away = np.sqrt(((points - lifted[near]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int64()), pa.array(away)], [*batch.schema.names, "pivot", "away"])

    dealt = materialise(entries.mapInArrow(nearest, "v array<long>, ids array<long>, pivot long, away double"), "dealt")
    sizes = dealt.groupBy("pivot").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()  # a row for each pivot
    trees_of = np.ones(len(pivots), np.int64)
    radius = np.full(len(pivots), -np.inf)
    for r in sizes:
        trees_of[r["pivot"]] = math.ceil(r["n"] / TREE_ROWS)
        radius[r["pivot"]] = r["radius"]
    blocks = max(1, math.ceil(queries.count() / QUERY_ROWS))
    tree_count = F.element_at(F.array(*(F.lit(int(t)) for t in trees_of)), (F.col("pivot") + 1).cast("int"))
    forest = dealt.select("pivot", F.pmod(F.xxhash64("v"), tree_count).alias("tree"), "v", "ids")

    def routed(first: bool):
        def route(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in found:
                if not len(batch):
                    continue
                q = _matrix(batch.column("v"), dims)
                home_to = np.sqrt(np.maximum((lifted ** 2).sum(axis=1)[None] + (q ** 2).sum(axis=1)[:, None] - 2 * q @ lifted[:, :dims].T, 0))
                usable = np.isfinite(radius)
                bound = np.where(usable[None], home_to - radius[None], np.inf)
                home = np.where(usable[None], home_to, np.inf).argmin(axis=1)
                if first:
                    row, pivot = np.arange(len(q)), home
                    kth = np.full(len(q), -np.inf)
                else:
                    kth = np.asarray(batch.column("kth")).astype(np.float64)
                    with np.errstate(invalid="ignore"):
                        limit = np.sqrt(np.maximum((q ** 2).sum(axis=1) + top - 2 * kth, 0)) * (1 + SLACK) + SLACK
                    go = usable[None] & (bound <= limit[:, None] + SLACK * (1 + home_to))
                    go[np.arange(len(q)), home] = False
                    row, pivot = np.nonzero(go)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query").take(pa.array(row)), batch.column("need").take(pa.array(row)), batch.column("v").take(pa.array(row)), pa.array(kth[row]), pa.array(pivot, pa.int64())],
                    ["query", "need", "v", "kth", "pivot"])
        return route

    def visit(asking: DataFrame, first: bool) -> DataFrame:
        sent = (asking.mapInArrow(routed(first), "query long, need long, v array<long>, kth double, pivot long")
                .withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), (tree_count - 1).cast("long"))))
                .withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("long")))
        stored = forest.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        key = ["pivot", "tree", "block"]
        return stored.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(_searcher(dims, top), HIT_SCHEMA)

    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = materialise(visit(queries, True), "hits")
    bound = (near.withColumn("place", F.row_number().over(ranked)).where(F.col("place") == F.col("need")).select("query", F.col("score").cast("double").alias("kth")))
    asking = queries.join(bound, "query", "left").select("query", "need", "v", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))
    hits = near.union(visit(asking, False))
    best = hits.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= F.col("need")).select("query", "vec_id", "score")
    # every query row of a search takes its result, without its own id
    named = (same.where("asked > 0").join(queries, "v")
             .select(F.col("vec_id").alias("query_id"), "query", F.explode(F.sequence(F.lit(1).cast("long"), "asked")).alias("copy")))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (named.join(best, "query").where("vec_id <> query_id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of every twentieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
