"""SimHash near-duplicates with a Gray-order hierarchical index (operator 10).

1. Fingerprints: 64 bits by majority over the XXH64 values (seed 42) of a text's
   3-word shingles, repeats included. Texts with one fingerprint are one class.
2. Upper nodes: two fingerprints within `max_distance` bits agree on at least one of
   max_distance + 1 blocks of bits. A node is a mask and the bits shared under it; each
   class goes to the nodes of its blocks. A node with more members than `NODE_ROWS` is
   split: the bits that its mask leaves free are cut into blocks again, so hot groups spread
   over many nodes with longer shared patterns, and no pair within the distance is lost. Each
   round counts nodes with a partial aggregate; a node is never gathered to be counted.
3. Lower nodes: a task takes its nodes one after another, sorted by Gray rank of the
   fingerprints, so neighbours share long bit patterns. Runs of `FAN` rows share a masked
   pattern; runs of runs share a shorter one. A search goes from the top with the bit differences
   accumulated so far and drops a whole run as soon as they exceed the distance.
4. A node emits a spanning forest of its links (one edge a member at most), never all
   pairs. Components follow by alternating large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vigil.llm import common
from vigil.session import scratch_path

SHINGLE, MAX_DISTANCE, SEED = 3, 3, 42
#: A node with more classes than this is split as long as its mask leaves bits to split by.
NODE_ROWS = 1024
#: Nodes are split at most so often; then at most 2^(free bits) classes are left in one.
SPLITS = 3
#: Rows of a lower node, and lower nodes of the one above it.
FAN = 16
#: Query and row pairs that a search looks at once (memory bound).
SEARCH_PAIRS = 1 << 20


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """64-bit SimHash of a text; 0 without words. bytes.lower/split are A-Z and \\x20 \\x09-\\x0D only."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        grams = [b" ".join(parts)]
    else:
        grams = list(map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False)))
    digest = xxhash.xxh64_digest
    ones, n = np.zeros(64, np.int64), len(grams)
    for i in range(0, n, 1 << 16):
        raw = b"".join([digest(g, SEED) for g in grams[i:i + (1 << 16)]])
        rows = np.frombuffer(raw, np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, column: str, words: int = SHINGLE) -> DataFrame:
    """`docs` with the SimHash of its whole text (null: empty) as a signed long."""
    @F.pandas_udf("long")
    def simhash(texts):
        import pandas as pd
        return pd.Series(np.array([fingerprint(t or "", words) for t in texts], np.uint64).astype(np.int64))

    return docs.withColumn(column, simhash("text"))


def blocks(mask: int, parts: int) -> list[int]:
    """The bits of a mask in `parts` runs of nearly equal size, as masks."""
    bits = [b for b in range(64) if mask >> b & 1]
    cut = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[cut[k]:cut[k + 1]]) for k in range(parts)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(fp: Column) -> Column:
    """Position of a bit pattern in Gray order: prefix exclusive-or of its bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def upper_nodes(classes: DataFrame, max_distance: int, node_rows: int, path: str) -> DataFrame:
    """(mask, bits, fp) of every class in its nodes, each at most `node_rows` large where bits allow.

    `classes` has distinct `fp`. Masks come from repeated halving rules, so there are at
    most (max_distance + 1)^k of them after k rounds; the data never go to the driver.
    """
    spark, parts = classes.sparkSession, max_distance + 1
    full = (1 << 64) - 1
    masks = {0: blocks(full, parts)}  # mask -> its children
    open_rows = classes.select(F.lit(0).cast("long").alias("mask"), "fp")
    done = None
    for round_ in range(SPLITS + 1):
        # the masks of a round follow from constants, not from the data
        rule = F.create_map(*[x for m, kids in masks.items() for x in (
            F.lit(signed(m)), F.array(*[F.lit(signed(m | k)) for k in kids]))])
        nodes = (open_rows.select(F.explode(rule[F.col("mask")]).alias("mask"), "fp")
                 .withColumn("bits", F.col("fp").bitwiseAND(F.col("mask"))))
        masks = {m | k: blocks(full & ~(m | k), parts) for m, kids in masks.items() for k in kids}
        leaves, open_rows = nodes, None
        if round_ < SPLITS and all(all(kids) for kids in masks.values()):
            nodes.write.mode("overwrite").parquet(f"{path}/round{round_}")
            nodes = spark.read.parquet(f"{path}/round{round_}")
            crowded = (nodes.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > node_rows).select("mask", "bits"))
            crowded.write.mode("overwrite").parquet(f"{path}/crowded{round_}")
            crowded = spark.read.parquet(f"{path}/crowded{round_}")
            leaves = nodes
            if not crowded.isEmpty():
                leaves = nodes.join(crowded, ["mask", "bits"], "left_anti")
                open_rows = nodes.join(crowded, ["mask", "bits"], "left_semi").select("mask", "fp")
        leaves = leaves.select("mask", "bits", "fp")
        done = leaves if done is None else done.unionByName(leaves)
        if open_rows is None:
            break
    return done


class GrayTree:
    """Hierarchical index over fingerprints of one node in Gray order.

    Level 0 is the rows. A node of level k covers FAN nodes of level k - 1 and holds
    the mask of the bits that all rows under it share, and those bits. A child's
    mask holds only bits that its parent's does not, so differences add up on the way down.
    """

    def __init__(self, fps: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (own mask, pattern) from the top
        masks, bits = [np.full(len(fps), np.uint64(0xFFFFFFFFFFFFFFFF))], [fps]
        while len(bits[-1]) > FAN:
            starts = np.arange(0, len(bits[-1]), FAN)
            agree = np.bitwise_and.reduceat(masks[-1], starts)
            low, high = np.bitwise_and.reduceat(bits[-1], starts), np.bitwise_or.reduceat(bits[-1], starts)
            masks.append(agree & ~(low ^ high))
            bits.append(low & masks[-1])
        for k in range(len(bits) - 1, -1, -1):
            own = masks[k]
            if k + 1 < len(bits):  # factored out into the parent
                own = own & ~np.repeat(masks[k + 1], FAN)[:len(own)]
            self.levels.append((own, bits[k] & own))

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs within the distance."""
        own, pattern = self.levels[0]
        n = len(own)
        q = np.repeat(np.arange(len(queries)), n)
        node = np.tile(np.arange(n), len(queries))
        gap = np.zeros(len(q), np.uint8)
        for depth, (own, pattern) in enumerate(self.levels):
            if depth:
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                q, gap = np.repeat(q, FAN), np.repeat(gap, FAN)
                real = node < len(own)
                node, q, gap = node[real], q[real], gap[real]
            gap = gap + np.bitwise_count((queries[q] & own[node]) ^ pattern[node])
            near = gap <= distance  # the rest goes, with everything under it
            q, node, gap = q[near], node[near], gap[near]
        return q, node


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of rows a and b, in place: minima first, then shortcuts."""
    while True:
        x, y = parent[a], parent[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def spanning_links(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(smaller row, row) edges that connect rows of one node exactly as their links do."""
    n = len(fps)
    parent = np.arange(n)
    if n <= 2 * FAN:
        a, b = np.triu_indices(n, 1)
        near = np.bitwise_count(fps[a] ^ fps[b]) <= distance
        merge(parent, a[near], b[near])
    else:
        tree = GrayTree(fps)
        step = max(1, SEARCH_PAIRS // n)
        for i in range(0, n, step):
            a, b = tree.search(fps[i:i + step], distance)
            a = a + i
            later = a < b
            merge(parent, a[later], b[later])
    rows = np.flatnonzero(parent != np.arange(n))
    return parent[rows], rows


def _small_nodes(mask: np.ndarray, bits: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all nodes in a batch of whole nodes, sorted by node; returns rows."""
    edge = np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1
    begins, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(fps)]])
    sizes = ends - begins
    parent = np.arange(len(fps))
    # small nodes at once: rows at offset k in the same node
    small = np.repeat(sizes <= FAN, sizes)
    node = np.repeat(np.arange(len(sizes)), sizes)
    for k in range(1, min(FAN, len(fps))):
        a = np.flatnonzero((node[:-k] == node[k:]) & small[:-k])
        if not len(a):
            break
        a = a[np.bitwise_count(fps[a] ^ fps[a + k]) <= distance]
        merge(parent, a, a + k)
    for b, e in zip(begins[sizes > FAN].tolist(), ends[sizes > FAN].tolist(), strict=True):
        low, high = spanning_links(fps[b:e], distance)
        parent[high + b] = low + b
    rows = np.flatnonzero(parent != np.arange(len(fps)))
    return parent[rows], rows


def links(nodes: DataFrame, max_distance: int) -> DataFrame:
    """(a, b) fingerprint edges that connect the classes as their links within the distance do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3  # the last node of a batch may go on in the next

        def emit(cols: list[np.ndarray]) -> pa.RecordBatch:
            fps = cols[2].view(np.uint64)
            a, b = _small_nodes(cols[0], cols[1], fps, max_distance)
            return pa.RecordBatch.from_arrays([pa.array(cols[2][a]), pa.array(cols[2][b])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = [np.concatenate([x, y]) for x, y in zip(held, new, strict=True)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield emit([c[:cut] for c in cols])
        if len(held[0]):
            yield emit(held)

    placed = (nodes.select("mask", "bits", "fp").repartition("mask", "bits")
              .withColumn("_rank", gray_rank(F.col("fp"))).sortWithinPartitions("mask", "bits", "_rank")
              .select("mask", "bits", "fp"))
    return placed.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes that have edges.

    Large-star and small-star steps until nothing changes; each round is written to the
    shared folder, so a lost executor repeats one step only. Hot nodes: minima are
    partial aggregates, and joins are left to skew splitting.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    # u > v in every edge
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if current.isEmpty():
        return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = None
    for k in range(64):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = stored(large, f"large{k}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        current = stored(small, f"small{k}")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _resolve(docs: DataFrame, words: int, max_distance: int, node_rows: int,
             carry: bool) -> tuple[DataFrame, DataFrame]:
    """Marked rows (doc_id, fp, perhaps _row) and, of each fp, component_id and keeper.

    keeper: the fingerprint of the row that stands for the component.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *([F.struct(*docs.columns).alias("_row")] if carry else []))
    with_fingerprint(slim, "fp", words).drop("text").write.mode("overwrite").parquet(f"{path}/marked")
    marked = spark.read.parquet(f"{path}/marked")

    marked.groupBy("fp").agg(F.min("doc_id").alias("least")).write.mode("overwrite").parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    edges = links(upper_nodes(classes.select("fp"), max_distance, node_rows, path), max_distance)
    rooted = classes.join(components(edges, path), F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.isnull("least").alias("none"), "least", "fp")).alias("first"))
    named = rooted.join(first, "root").select("fp", F.col("first.least").alias("component_id"), F.col("first.fp").alias("keeper"))
    named.write.mode("overwrite").parquet(f"{path}/named")
    return marked, spark.read.parquet(f"{path}/named")


def find_components(docs: DataFrame, words: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of `docs`.

    Reads `doc_id` and `text`; null text is empty, its fingerprint zero, linked like any other.
    Rows with equal fingerprints are linked whatever their texts. component_id is the
    smallest doc_id of the component; null doc_ids are never the smallest, and a
    component without any other has a null component_id. Repeated rows come back as often
    as they came. An empty table gives an empty result.
    """
    marked, named = _resolve(docs, words, max_distance, node_rows, False)
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of `docs`, all columns, of each component: the one with the smallest doc_id.

    Where rows repeat that doc_id, or all doc_ids of a component are null, the row with
    the smallest fingerprint stays, and any one of rows that tie in that too. Rows meet
    their component by fingerprint and doc_id, so large groups spread over all tasks; whole
    rows are shuffled once.
    """
    marked, named = _resolve(docs, words, max_distance, NODE_ROWS, True)
    keepers = named.where("fp = keeper").select(F.col("fp").alias("k"), "component_id")
    top = marked.join(keepers, (F.col("fp") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("component_id")), "left_semi")
    once = Window.partitionBy("fp", F.coalesce("doc_id", F.lit(0)), F.isnull("doc_id")).orderBy(F.lit(0))
    return top.withColumn("_rank", F.row_number().over(once)).where("_rank = 1").select("_row.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 3 bits."""
    return find_components(common.table(spark, sf_dir, "documents"))
