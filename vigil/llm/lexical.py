"""Ranked lexical search with LEMP-style norm buckets (operator 13).

A document's impact vector holds, for each term of some item, what one occurrence of the term in
an item adds to the score: w * ((1000000000 * tf) div (1000 * tf + 12 * m)). A score is the inner product with the
item's term counts. For the bounds both sides carry a factor sqrt(w), as doubles.

1. One pass over the texts stores (n, term numbers, frequencies) per document; counts over all of them give N, L, df.
2. Scores of a bounded sample of documents give each item a kth score that its result reaches at least.
3. Every task sorts its vectors by length and cuts them into buckets. An item passes a bucket over, and with it
   the rest of the task, where |item| * (longest vector of the bucket) is below its kth score (Cauchy-Schwarz).
4. In a bucket, an item's focus is its largest coordinates: a vector's exact sum over these, plus Cauchy-Schwarz for the
   lengths that remain on both sides, bounds the score.
5. Survivors are scored again over all coordinates in 64-bit integers, and raise the task's kth score.

Items are read in blocks of bounded size, each block searched against all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigil.llm import common
from vigil.session import scratch_path

K = 20
#: Fixed values of the score.
WEIGHT, IMPACT, LENGTH, BASE_LENGTH = 1000, 1_000_000_000, 25, 75
#: Items and bytes of their texts (at least one item) searched at a time; their terms are broadcast.
BLOCK_ITEMS, BLOCK_BYTES = 2000, 8 << 20
#: Documents whose scores give the first kth scores.
SAMPLE_DOCUMENTS = 16_384
#: Vectors of a bucket, and the share of an item's squared length that its focus covers.
BUCKET, FOCUS = 512, 0.8
#: Bytes of a text counted at once.
PIECE = 1 << 20
#: Lower-case A-Z; letters, digits and everything beyond ASCII stay, all else separates.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(raw: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists."""
    raw, at = raw.translate(FOLD), 0
    while len(raw) - at > size:
        end = raw.find(b" ", at + size)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end
    yield raw[at:].split() if at else raw.split()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf): of every document with a term its number of terms, and those of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, lengths, sizes, number, tf = [], [], [0], [], []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, counts = 0, Counter()
                for part in terms(raw or b""):
                    n += len(part)
                    counts.update(part)
                if not n:
                    continue
                own = sorted((known[t], c) for t, c in counts.items() if t in known)
                ids.append(i)
                lengths.append(n)
                sizes.append(sizes[-1] + len(own))
                number += [t for t, _ in own]
                tf += [c for _, c in own]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(number, pa.int32())),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(tf, pa.int32()))], ["doc_id", "n", "term", "tf"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>"))


def frequencies(stored: DataFrame, size: int) -> np.ndarray:
    """Documents holding each of the vocabulary's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for r in stored.select("term").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]  # as many rows as the block has terms
    return out


class Scorer:
    """What tasks need of a block of items: weights, statistics, and the items' terms, counts and bounds."""

    def __init__(self, items: list[tuple[int | None, dict[int, int]]], df: np.ndarray, documents: int, total: int):
        self.documents, self.total = documents, total
        self.weight = np.array([math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        self.root = np.sqrt(self.weight.astype(np.float64))
        self.items = []
        for item_id, counts in items:
            term = np.array(sorted(counts), np.int64)
            count = np.array([counts[t] for t in term.tolist()], np.int64)
            q = count * self.root[term]
            by = np.argsort(-q, kind="stable")
            square = np.cumsum(q[by] ** 2)
            focus = by[:int(np.searchsorted(square, FOCUS * square[-1])) + 1] if len(by) else by
            rest = math.sqrt(max(0.0, float((q ** 2).sum() - (q[focus] ** 2).sum())))
            self.items.append((item_id, term, count, math.sqrt(float((q ** 2).sum())), term[focus], q[focus], rest))

    def impacts(self, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Integer impacts without their weight, entry by entry; `sizes`: entries of each document."""
        m = np.repeat(BASE_LENGTH + LENGTH * n * self.documents // self.total, sizes)
        return IMPACT * tf // (1000 * tf + 12 * m)

    def lengths(self, impact: np.ndarray, sizes: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Euclidean lengths of documents, with sqrt(w) on each coordinate."""
        row = np.repeat(np.arange(len(sizes)), sizes)
        return np.sqrt(np.bincount(row, weights=self.weight[term] * impact.astype(np.float64) ** 2, minlength=len(sizes)))


def _columns(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, ...]:
    """n, entries per document, term, tf from column `first` on."""
    n, term, tf = (batch.column(first + k) for k in range(3))
    return (n.to_numpy(), np.diff(term.offsets.to_numpy()), *(x.flatten().to_numpy().astype(np.int64) for x in (term, tf)))


class Bucket:
    """Up to BUCKET impact vectors, their entries by term."""

    def __init__(self, scorer: Scorer, ids: pa.Array, n, sizes, term, tf):
        impact = scorer.impacts(n, sizes, term, tf)
        self.length = scorer.lengths(impact, sizes, term)
        by = np.argsort(term, kind="stable")
        self.row = np.repeat(np.arange(len(sizes)), sizes)[by]
        self.value = (scorer.weight[term] * impact)[by]
        self.coordinate = (scorer.root[term] * impact)[by]
        self.begin = np.searchsorted(term[by], np.arange(len(scorer.weight) + 1))
        self.ids = ids

    def entries(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some terms, and which of the terms each belongs to."""
        a, size = self.begin[term], self.begin[term + 1] - self.begin[term]
        which = np.repeat(np.arange(len(term)), size)
        return np.arange(len(which)) + np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size), which

    def scored(self, item: tuple, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of the vectors that score at least `least` (1 or more) for an item."""
        _, term, count, _, focus, q, rest = item
        at, which = self.entries(focus)
        own, rows = self.coordinate[at], self.row[at]
        known = np.bincount(rows, weights=q[which] * own, minlength=len(self.length))
        square = np.bincount(rows, weights=own ** 2, minlength=len(self.length))
        bound = known + rest * np.sqrt(np.maximum(self.length ** 2 - square, 0))
        alive = bound * (1 + 1e-9) + 1e-6 * self.length >= least
        if not alive.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, which = self.entries(term)
        keep = alive[self.row[at]]
        at, which = at[keep], which[keep]
        score = np.zeros(len(self.length), np.int64)
        np.add.at(score, self.row[at], self.value[at] * count[which])
        row = np.flatnonzero(score >= least)
        return row, score[row]


RESULT = "item int, doc_id long, score long"


def _searched(stored: DataFrame, scorer, least, k: int) -> DataFrame:
    """Each task's best k documents of every item. least: kth scores known before, by item."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sizes, term, tf = _columns(batch, 1)
            length = scorer.value.lengths(scorer.value.impacts(n, sizes, term, tf), sizes, term)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length)], ["doc_id", "n", "term", "tf", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, kth = scorer.value.items, np.array(least.value, np.int64)
        norms = np.array([x[3] for x in items])
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(items)  # doc_id, null, score
        done = False
        for whole in batches:
            for i in range(0, 0 if done else whole.num_rows, BUCKET):
                batch = whole.slice(i, BUCKET)
                longest = batch.column(4)[0].as_py()
                open_ = np.flatnonzero(norms * longest * (1 + 1e-9) >= kth)
                if not len(open_):
                    done = True  # the vectors that follow are no longer
                    break
                bucket = Bucket(scorer.value, batch.column(0), *_columns(batch, 1))
                for j in open_.tolist():
                    row, score = bucket.scored(items[j], int(kth[j]))
                    if not len(row):
                        continue
                    ids = bucket.ids.take(pa.array(row))
                    new = (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), score)
                    ids, none, score = (np.concatenate(x) for x in zip(best[j], new, strict=True))
                    by = np.lexsort((ids, none, -score))[:k]
                    best[j] = (ids[by], none[by], score[by])
                    if len(by) == k:
                        kth[j] = max(kth[j], best[j][2][-1])
        number = np.repeat(np.arange(len(items), dtype=np.int32), [len(x[0]) for x in best])
        ids, none, score = (np.concatenate(x) for x in zip(*best, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids, mask=none), pa.array(score)], ["item", "doc_id", "score"])

    ordered = (stored.mapInArrow(measured, "doc_id long, n long, term array<int>, tf array<int>, length double")
               .where("length > 0").sortWithinPartitions(F.desc("length")))
    found = ordered.mapInArrow(run, RESULT)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items with the counts of their terms, in blocks of bounded size, streamed through the driver."""
    block, held = [], 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    for r in rows.toLocalIterator():
        raw = bytes(r["text"] or b"")
        if block and (len(block) >= BLOCK_ITEMS or held + len(raw) > BLOCK_BYTES):
            yield block
            block, held = [], 0
        counts = Counter()
        for part in terms(raw):
            counts.update(part)
        if counts:
            block.append((r["item_id"], counts))
            held += len(raw)
    if block:
        yield block


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0.

    Reads `doc_id` and `text`, `item_id` and `text`; null texts have no terms. Repeated rows are documents and items
    of their own: a repeated document takes several ranks, a repeated item has its ranks repeated. Null doc_ids
    come last among equal scores. Items without terms and empty tables have no rows.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in _blocks(items):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, counts in block for t in counts}))}
        numbered = [(i, {vocabulary[t]: c for t, c in counts.items()}) for i, counts in block]
        path = scratch_path(spark, "lexical")
        vectors(docs, vocabulary).write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        documents, total = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            continue
        scorer = spark.sparkContext.broadcast(Scorer(numbered, frequencies(stored, len(vocabulary)), documents, total))
        sample = stored.sample(min(1.0, SAMPLE_DOCUMENTS / documents), seed=13).limit(2 * SAMPLE_DOCUMENTS)
        seeds = _searched(sample, scorer, spark.sparkContext.broadcast([1] * len(block)), k)
        kth = [1] * len(block)
        for r in seeds.where(F.col("rank") == k).select("item", "score").collect():  # one row an item at most
            kth[r["item"]] = r["score"]
        found = _searched(stored, scorer, spark.sparkContext.broadcast(kth), k)
        names = F.broadcast(spark.createDataFrame([(j, i) for j, (i, _) in enumerate(block)], "item int, item_id long"))
        out = out.unionByName(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for each benchmark item."""
    return ranked(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term"""
OP13_SQL = f"""
with d as (select row_number() over () as pos, doc_id, text from documents),
     i as (select row_number() over () as item, item_id, text from benchmark),
     dt as (select pos, term, count(*) as tf from (select pos, {_TERMS} from d) group by pos, term),
     it as (select item, term, count(*) as c from (select item, {_TERMS} from i) group by item, term),
     n as (select pos, cast(sum(tf) as bigint) as n from dt group by pos),
     t as (select count(*) as docs, cast(sum(n) as bigint) as total from n),
     w as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w from dt, t group by term, docs),
     s as (select item, pos, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) as bigint) as score
           from it join dt using (term) join w using (term) join n using (pos), t group by item, pos),
     r as (select item, doc_id, score, row_number() over (partition by item order by score desc, doc_id nulls last) as rank
           from s join d using (pos) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from r join i using (item) where rank <= 20
"""
