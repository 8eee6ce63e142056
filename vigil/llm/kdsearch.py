"""Exact top-k search by inner product, one KD-tree per shard (operator 11).

1. Vectors become whole numbers, floor(1024 * x), and are stored with a row number.
2. Cells: median splits fitted on a bounded sample deal every row to a cell; a cell with more rows
   than a shard may hold is salted over several shards by row number, so a vector that a third of all
   rows repeat spreads too. Each cell's tight bounding box covers all its rows.
3. A task holds one shard at a time: a KD-tree by median splits, tight boxes in every node.
   The inner product of a query q with any row of a box is at most sum(max(q_d lo_d, q_d hi_d)). Queries
   pass by in blocks; each keeps a frontier of nodes, takes the best first, and drops nodes below its
   kth score (at an equal score: nodes whose smallest id is larger than the kth id).
4. Two waves: a query visits the first shard of its best cell; with the kth score from there it visits the
   shards of those cells only whose box can still hold a better row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigil.llm import common
from vigil.session import scratch_path

SCALE, K, EVERY = 1024, 10, 100
#: Rows that one task holds at a time, and rows of a leaf.
SHARD_ROWS, LEAF = 131_072, 64
#: Rows that the cells are fitted on, and those a cell needs among them: at most
#: SAMPLE_ROWS / CELL_SAMPLE boxes are broadcast, whatever the number of rows.
SAMPLE_ROWS, CELL_SAMPLE = 16_384, 8
#: Queries searched together, and tasks of a wave at most.
BLOCK, MAX_TASKS = 256, 20_000
#: Sums of products up to here are exact in doubles.
EXACT = 2.0 ** 53
NO_ID = np.iinfo(np.int64).max
ROW = "pos long, vec_id long, dim int, v binary"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(pos, vec_id, dim, v) of the vectors that take part; v: int16 components, or doubles where these do not fit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dims, blobs = [], [], []
            for k, x in enumerate(batch.column(2).to_pylist()):
                if x is None or None in x:
                    continue
                with np.errstate(over="ignore"):
                    v = np.floor(np.asarray(x, np.float64) * scale)
                if not np.isfinite(v).all():
                    continue
                keep.append(k)
                dims.append(len(v))
                blobs.append((v.astype("<i2") if not len(v) or np.abs(v).max() < 2**15 else v.astype("<f8")).tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(dims, pa.int32()),
                                              pa.array(blobs, pa.binary())], ["pos", "vec_id", "dim", "v"])

    return (vectors.select(F.monotonically_increasing_id().alias("pos"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .mapInArrow(run, ROW))


def matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    """Rows of one dimension as doubles."""
    if dim and len({len(b) for b in blobs}) > 1:
        return np.stack([np.frombuffer(b, "<i2" if len(b) == 2 * dim else "<f8").astype(np.float64) for b in blobs])
    kind = "<i2" if not dim or not blobs or len(blobs[0]) == 2 * dim else "<f8"
    return np.frombuffer(b"".join(blobs), kind).astype(np.float64).reshape(len(blobs), dim)


class Cells:
    """A complete binary tree of median splits; cell numbers are its leaves from left to right."""

    def __init__(self, sample: np.ndarray, wanted: int):
        most = max(1, len(sample) // CELL_SAMPLE)
        self.depth = max(0, min(math.floor(math.log2(most)), math.ceil(math.log2(max(1, wanted)))))
        self.dim = sample.shape[1]
        self.axis = np.zeros((1 << self.depth), np.int64)  # by heap number, from 1
        self.cut = np.zeros((1 << self.depth))
        parts = {1: sample}
        for node in range(1, 1 << self.depth):
            own = parts.pop(node)
            axis = int(np.argmax(own.max(0) - own.min(0))) if len(own) and self.dim else 0
            cut = float(np.median(own[:, axis])) if len(own) and self.dim else 0.0
            self.axis[node], self.cut[node] = axis, cut
            right = own[:, axis] > cut if self.dim else np.zeros(len(own), bool)
            parts[2 * node], parts[2 * node + 1] = own[~right], own[right]

    def of(self, rows: np.ndarray) -> np.ndarray:
        node = np.ones(len(rows), np.int64)
        for _ in range(self.depth if self.dim else 0):
            node = 2 * node + (rows[np.arange(len(rows)), self.axis[node]] > self.cut[node])
        return node - (1 << self.depth if self.dim else 1)


class KdTree:
    """Median splits of the widest axis down to LEAF rows; lo, hi and the smallest id of every node."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order, self.start, self.end, self.child = np.arange(len(rows)), [0], [len(rows)], [0]
        lo, hi, node = [], [], 0
        while node < len(self.start):
            a, b = self.start[node], self.end[node]
            own = rows[order[a:b]]
            lo.append(own.min(0))
            hi.append(own.max(0))
            if b - a > leaf:
                wide = hi[-1] - lo[-1]
                axis = int(np.argmax(wide)) if len(wide) else 0
                # rows that agree everywhere are split by id, so that ties are settled by whole nodes
                key = own[:, axis] if len(wide) and wide[axis] > 0 else ids[order[a:b]]
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(key, half)]
                self.child[node] = len(self.start)
                for s, e in ((a, a + half), (a + half, b)):
                    self.start.append(s)
                    self.end.append(e)
                    self.child.append(0)
            node += 1
        self.order, self.lo, self.hi = order, np.array(lo), np.array(hi)
        self.start, self.end, self.child = map(np.array, (self.start, self.end, self.child))
        self.rows = rows[order]
        self.ids = ids[order]
        self.least = np.zeros(len(self.start), np.int64)
        for node in range(len(self.start) - 1, -1, -1):
            c = self.child[node]
            self.least[node] = min(self.least[c], self.least[c + 1]) if c else self.ids[self.start[node]:self.end[node]].min()

    def bound(self, q: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products of rows q with the boxes of the nodes, pair by pair."""
        out = np.empty(len(q))
        for i in range(0, len(q), 1 << 14):
            a, b = q[i:i + (1 << 14)], node[i:i + (1 << 14)]
            out[i:i + (1 << 14)] = (np.einsum("ij,ij->i", np.maximum(self.q[a], 0), self.hi[b])
                                    + np.einsum("ij,ij->i", np.minimum(self.q[a], 0), self.lo[b]))
        return out

    def search(self, queries: np.ndarray, own: np.ndarray, pos: np.ndarray, kth: np.ndarray, kth_id: np.ndarray,
               k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, score, row) of the best k rows of each query that beat its kth score; rows as given.

        own: row numbers of the queries, never found; pos: of the tree's rows as given. kth, kth_id: the
        scores and ids to beat, from other shards; changed in place.
        """
        self.q, tree_pos = queries, pos[self.order]
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        bound = self.bound(q, node)
        top = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))  # query, score, row in tree order
        take, rounds, depth = 1, 0, int(np.ceil(np.log2(max(2, len(self.rows) / LEAF)))) + 1

        def open_(q, node, bound):
            return (bound > kth[q]) | ((bound == kth[q]) & (self.least[node] <= kth_id[q]))

        while True:
            live = open_(q, node, bound)
            q, node, bound = q[live], node[live], bound[live]
            if not len(q):
                break
            by = np.lexsort((-bound, q))  # each query's best nodes first
            q, node, bound = q[by], node[by], bound[by]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            now = place < take
            inner = now & (self.child[node] > 0)
            found = []
            leaf = np.flatnonzero(now & ~inner)
            leaf = leaf[np.argsort(node[leaf], kind="stable")]
            for group in np.split(leaf, np.flatnonzero(np.diff(node[leaf])) + 1) if len(leaf) else ():
                a, b = self.start[node[group[0]]], self.end[node[group[0]]]
                score = queries[q[group]] @ self.rows[a:b].T
                hit, row = np.nonzero(score >= kth[q[group]][:, None])
                found.append((q[group][hit], score[hit, row], row + a))
            if found:
                top = self._merged(top, found, own, tree_pos, kth, kth_id, k)
            kids = np.concatenate([self.child[node[inner]], self.child[node[inner]] + 1])
            of = np.concatenate([q[inner], q[inner]])
            q, bound = np.concatenate([q[~now], of]), np.concatenate([bound[~now], self.bound(of, kids)])
            node = np.concatenate([node[~now], kids])
            rounds += 1
            if rounds > depth:  # every query has been down to its best leaf
                take *= 2
        return top[0], top[1], self.order[top[2]]

    def _merged(self, top, found, own, tree_pos, kth, kth_id, k):
        q, score, row = (np.concatenate(x) for x in zip(top, *found, strict=True))
        other = tree_pos[row] != own[q]
        q, score, row = q[other], score[other], row[other]
        by = np.lexsort((tree_pos[row], self.ids[row], -score, q))
        q, score, row = q[by], score[by], row[by]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        first = place < k
        last = place == k - 1
        better = (score[last] > kth[q[last]]) | ((score[last] == kth[q[last]]) & (self.ids[row[last]] < kth_id[q[last]]))
        kth[q[last][better]], kth_id[q[last][better]] = score[last][better], self.ids[row[last]][better]
        return q[first], score[first], row[first]


def plain_search(rows, ids, pos, queries, own, k):
    """For components beyond 2^53 sums: Python's whole numbers, all rows; scores end at the limits of a long."""
    whole = [[int(x) for x in r] for r in rows]
    for i, q in enumerate(queries):
        q = [int(x) for x in q]
        scored = sorted((-sum(a * b for a, b in zip(q, r, strict=True)), ids[j], pos[j], j) for j, r in enumerate(whole) if pos[j] != own[i])
        for s, _, _, j in scored[:k]:
            yield i, max(-2**63, min(2**63 - 1, -s)), j


RESULT = pa.schema([("q_pos", pa.int64()), ("query_id", pa.int64()), ("pos", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Shard:
    """What a task holds: the vectors of one shard by dimension, their trees once queries come."""

    def __init__(self):
        self.number, self.blobs, self.trees = None, {}, {}

    def add(self, dims: list[int], pos: list[int], ids: list[int | None], blobs: list[bytes]) -> None:
        for d, p, i, b in zip(dims, pos, ids, blobs, strict=True):
            self.blobs.setdefault(d, ([], [], []))
            for at, x in zip(self.blobs[d], (p, NO_ID if i is None else i, b), strict=True):
                at.append(x)

    def answer(self, dim: int, own: list[int], query_ids: list[int], blobs: list[bytes], kth: np.ndarray, kth_id: np.ndarray,
               k: int) -> pa.RecordBatch | None:
        if dim not in self.blobs:
            return None
        pos, ids, raw = self.blobs[dim]
        if dim not in self.trees:
            rows = matrix(raw, dim)
            raw.clear()
            self.trees[dim] = (rows, np.array(ids, np.int64), np.array(pos, np.int64), np.abs(rows).max(initial=0.0), [])
        rows, ids, pos, most, tree = self.trees[dim]
        queries, own = matrix(blobs, dim), np.array(own, np.int64)
        if most * np.abs(queries).max(initial=0.0) * max(dim, 1) >= EXACT:
            hits = list(plain_search(rows, ids, pos, queries, own, k))
            q, score, row = (np.array([h[c] for h in hits], np.int64) for c in range(3))
        else:
            if not tree:
                tree.append(KdTree(rows, ids))
            q, score, row = tree[0].search(queries, own, pos, kth, kth_id, k)
        found = ids[row]
        return pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(np.array(query_ids, np.int64)[q]), pa.array(pos[row]),
                                           pa.array(found, mask=found == NO_ID), pa.array(score.astype(np.int64))], schema=RESULT)


def searched(rows: DataFrame, queries: DataFrame, tasks: int, k: int) -> DataFrame:
    """Best k of each (query, shard) visit. rows: shard + ROW; queries: the same with kth, kth_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            number, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(number)], strict=True):
                if a == b:
                    continue
                pos, ids, dims, blobs = (batch.column(c).slice(a, b - a).to_pylist() for c in range(2, 6))
                if shard.number != number[a]:
                    shard = Shard()
                    shard.number = number[a]
                if not kind[a]:
                    shard.add(dims, pos, ids, blobs)
                    continue
                kth = batch.column(6).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.float64)
                kth_id = batch.column(7).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                for dim in set(dims):
                    at = [i for i, d in enumerate(dims) if d == dim]
                    for part in (at[i:i + BLOCK] for i in range(0, len(at), BLOCK)):
                        out = shard.answer(dim, [pos[i] for i in part], [ids[i] for i in part], [blobs[i] for i in part],
                                           kth[part], kth_id[part], k)
                        if out is not None:
                            yield out

    cols = ["shard", "kind", "pos", "vec_id", "dim", "v", "kth", "kth_id"]
    both = (rows.withColumns({"kind": F.lit(0), "kth": F.lit(0.0), "kth_id": F.lit(0).cast("long")}).select(*cols)
            .unionByName(queries.withColumn("kind", F.lit(1)).select(*cols)))
    dealt = both.repartitionById(tasks, F.col("shard")).sortWithinPartitions("shard", "kind").select(*cols)
    return dealt.mapInArrow(run, "q_pos long, query_id long, pos long, vec_id long, score long")


def _boxes(placed: DataFrame) -> DataFrame:
    """(cell, dim, lo, hi, n): tight box and count of each cell; each task folds its own rows first."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, dim = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            dim = batch.column(1)[0].as_py()
            new = [batch.column(0).to_numpy(), *(matrix(batch.column(c).to_pylist(), dim) for c in (2, 3)), batch.column(4).to_numpy()]
            cell, lo, hi, n = new if held is None else (np.concatenate(x) for x in zip(held, new, strict=True))
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            held = [cell[starts], np.minimum.reduceat(lo[order], starts, axis=0), np.maximum.reduceat(hi[order], starts, axis=0),
                    np.add.reduceat(n[order], starts)]
        if held is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array(held[0]), pa.array(np.full(len(held[0]), dim, np.int32)),
                *(pa.array([x.astype("<f8").tobytes() for x in held[k]], pa.binary()) for k in (1, 2)),
                pa.array(held[3])], ["cell", "dim", "lo", "hi", "n"])

    schema = "cell long, dim int, lo binary, hi binary, n long"
    rows = placed.select("cell", "dim", F.col("v").alias("lo"), F.col("v").alias("hi"), F.lit(1).cast("long").alias("n"))
    return rows.mapInArrow(fold, schema).repartition("cell").mapInArrow(fold, schema)


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows by inner product for each row whose vec_id `every` divides.

    Reads `vec_id` and `embedding`. Vectors that are null, hold a null or non-finite component, or one whose
    `scale`-fold is not finite, take no part. Ties go to the smaller vec_id; null vec_ids come last and are no
    queries. A row is never its own result, but another row with its vec_id may be: each repeated row asks and is
    found by itself. Vectors meet vectors of their own dimension only. Scores beyond a long end at its limits.
    An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "kdsearch")
    quantised(vectors, scale).write.mode("overwrite").parquet(f"{path}/vectors")
    stored = spark.read.parquet(f"{path}/vectors")
    total = stored.count()
    # dimensions that the table mixes are cells of their own (numbers below 0); the most frequent one is split
    main = stored.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = main[0]["dim"] if main else 0
    sample = (stored.where(F.col("dim") == dim).sample(min(1.0, SAMPLE_ROWS / max(1, total)), seed=11)
              .select("v").limit(2 * SAMPLE_ROWS).collect())
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / shard_rows))
    cells = Cells(matrix([r["v"] for r in sample], dim), wanted)
    shared = spark.sparkContext.broadcast(cells)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            cell = np.minimum(-1, -dims.astype(np.int64) - 1)
            at = np.flatnonzero(dims == shared.value.dim)
            if len(at):
                cell[at] = shared.value.of(matrix(batch.column(3).take(pa.array(at)).to_pylist(), shared.value.dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["pos", "vec_id", "dim", "v", "cell"])

    stored.mapInArrow(place, ROW + ", cell long").write.mode("overwrite").parquet(f"{path}/placed")
    placed = spark.read.parquet(f"{path}/placed")
    boxes = _boxes(placed.where("cell >= 0")).collect()  # at most SAMPLE_ROWS / CELL_SAMPLE cells
    capacity = max(1, math.ceil(total / wanted))
    number, base, spread = {}, 0, []
    for r in sorted(boxes, key=lambda r: r["cell"]):
        salts = math.ceil(r["n"] / capacity)
        number[r["cell"]] = (base, salts)
        spread.append((r["cell"], base, salts))
        base += salts
    shards = base
    # rows of other dimensions: one family of shards behind the others
    odd = placed.where("cell < 0").count()
    odd_shards = math.ceil(odd / capacity)
    tasks = max(1, min(MAX_TASKS, shards + odd_shards))
    where = F.broadcast(spark.createDataFrame(spread, "cell long, base long, salts long"))
    salt = F.pmod(F.xxhash64("pos"), F.col("salts"))
    rows = placed.where("cell >= 0").join(where, "cell").withColumn("shard", (F.col("base") + salt).cast("int")).drop("base", "salts")
    if odd:
        rows = rows.unionByName(placed.where("cell < 0").withColumn(
            "shard", (F.lit(shards) + F.pmod(F.xxhash64("pos"), F.lit(odd_shards))).cast("int")))
    rows = rows.drop("cell")

    lo, hi = (matrix([r[c] for r in boxes], dim) if boxes else np.zeros((0, dim)) for c in ("lo", "hi"))
    begin = np.array([number[r["cell"]][0] for r in boxes], np.int64)
    length = np.array([number[r["cell"]][1] for r in boxes], np.int64)
    routes = spark.sparkContext.broadcast((dim, lo, hi, begin, length, shards, odd_shards))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with the first shard of its best cell, -1 where its dimension has no cells."""
        dim, lo, hi, begin, *_ = routes.value
        for batch in batches:
            home = np.full(batch.num_rows, -1, np.int32)
            same = np.flatnonzero(batch.column(2).to_numpy() == dim)
            for part in (same[i:i + BLOCK] for i in range(0, len(same), BLOCK)):
                q = matrix(batch.column(3).take(pa.array(part)).to_pylist(), dim)
                home[part] = begin[(np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T).argmax(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], ["pos", "vec_id", "dim", "v", "home"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries, with the kth score from their home, once for every other shard that may hold a better row."""
        dim, lo, hi, begin, length, shards, odd_shards = routes.value
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(i, BLOCK)
                dims, kth, home = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 4, 6))
                at, to = [], []
                same = np.flatnonzero(dims == dim)
                if len(same):
                    q = matrix(batch.column(3).take(pa.array(same)).to_pylist(), dim)
                    bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
                    bound += np.abs(bound) * 1e-9  # sums beyond EXACT are rounded
                    for r, c in zip(*np.nonzero(~(bound < kth[same][:, None])), strict=True):
                        some = [s for s in range(begin[c], begin[c] + length[c]) if s != home[same[r]]]
                        at += [int(same[r])] * len(some)
                        to += some
                for r in np.flatnonzero(dims != dim).tolist():
                    at += [r] * odd_shards
                    to += range(shards, shards + odd_shards)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at, pa.int64())).columns[:6], pa.array(to, pa.int32())],
                                                 ["pos", "vec_id", "dim", "v", "kth", "kth_id", "shard"])

    none, last = F.lit(float("-inf")), F.lit(NO_ID).cast("long")
    stored.where(F.col("vec_id") % every == 0).mapInArrow(homes, ROW + ", home int").write.mode("overwrite").parquet(f"{path}/queries")
    queries = spark.read.parquet(f"{path}/queries")
    start = queries.where("home >= 0").select("pos", "vec_id", "dim", "v", none.alias("kth"), last.alias("kth_id"), F.col("home").alias("shard"))
    searched(rows, start, tasks, k).write.mode("overwrite").parquet(f"{path}/first")
    first = spark.read.parquet(f"{path}/first")
    order = Window.partitionBy("q_pos").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "pos")
    known = (first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
             .select(F.col("q_pos").alias("_q"), F.col("score").cast("double").alias("kth"), F.coalesce("vec_id", last).alias("kth_id")))
    again = (queries.join(known, F.col("pos") == F.col("_q"), "left")
             .select("pos", "vec_id", "dim", "v", F.coalesce("kth", none).alias("kth"), F.coalesce("kth_id", last).alias("kth_id"), "home"))
    rest = searched(rows, again.mapInArrow(others, ROW + ", kth double, kth_id long, shard int"), tasks, k)
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op11_kdsearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows by integer inner product for every hundredth vector."""
    return top_k(common.table(spark, sf_dir, "embeddings"))


OP11_SQL = """
with v as (select row_number() over () as pos, vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e
           from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
     s as (select q.pos as q_pos, q.vec_id as query_id, c.pos, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
           from v q join v c on q.pos <> c.pos and len(q.e) = len(c.e) where q.vec_id % 100 = 0),
     r as (select *, row_number() over (partition by q_pos order by score desc, vec_id nulls last, pos) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""
