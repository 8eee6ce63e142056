"""I-Match document fingerprints (operator 8).

Terms are runs of word characters after lower-casing. The lexicon keeps the terms
whose inverse document frequency lies in a band: those in at least `LOW` and at most
`HIGH` of the documents. A fingerprint is a hash of the document's sorted distinct lexicon
terms, followed by hashes of the terms that fall into each of `SUBSETS` randomised
subsets of the lexicon at each of several sampling rates. Dense subsets notice
any change; sparse ones survive large edits: where a subset holds few terms of two texts, it
agrees about as often as the texts share terms, so the share of agreeing hashes in
the sparsest subsets that say anything is a likeness.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import common
from vigil.session import scratch_path

#: Band of document frequencies, as shares of all documents.
LOW, HIGH = 0.002, 0.2
#: A term in the lexicon is in this many documents at least.
MIN_DOCUMENTS = 2
#: Sampling rates of the randomised subsets, dense to sparse, and subsets of each.
RATES = (1 / 2, 1 / 8, 1 / 32, 1 / 128, 1 / 512)
SUBSETS = 16
#: Hashes that a likeness rests on where texts are long enough.
ENOUGH = 16
#: Documents that are counted together before rare terms are set aside.
BLOCK_DOCUMENTS = 10_000
#: The lexicon's size follows from LOW: at most (distinct terms a document) / LOW. Beyond this
#: many candidates they are counted by a shuffle instead of a broadcast.
MAX_CANDIDATES = 1_000_000

WORD = re.compile(r"\w+")


def terms(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def _counted(docs: DataFrame, wanted=None, low: float = 0.0) -> DataFrame:
    """(term, n): documents with the term, by block; without `wanted` only terms in at least `low` of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = Counter(), 0
        keep = wanted.value if wanted is not None else None

        def flush() -> pa.RecordBatch:
            some = counts if keep is not None else {t: c for t, c in counts.items() if c >= low * n}
            return pa.RecordBatch.from_arrays([pa.array(list(some), pa.string()), pa.array(list(some.values()), pa.int64())], ["term", "n"])

        for batch in batches:
            for text in common.strings(batch.column(0)):
                own = terms(text)
                counts.update(own if keep is None else own & keep)
                n += 1
                if n >= BLOCK_DOCUMENTS:
                    yield flush()
                    counts, n = Counter(), 0
        if n:
            yield flush()

    return docs.select(common.text_of().alias("text")).mapInArrow(run, "term string, n long")


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, max_candidates: int = MAX_CANDIDATES) -> list[str]:
    """Sorted terms whose exact document frequency lies in the band.

    A term in `low` of all documents is in `low` of the documents of some block, so
    blocks name candidates and a second pass counts these over all documents.
    """
    spark = docs.sparkSession
    total = docs.count()
    path = scratch_path(spark, "imatch-candidates")
    _counted(docs, low=low).select("term").distinct().write.mode("overwrite").parquet(path)
    candidates = spark.read.parquet(path)
    if candidates.count() <= max_candidates:
        wanted = spark.sparkContext.broadcast(frozenset(r[0] for r in candidates.collect()))
        counts = _counted(docs, wanted)
    else:
        counts = _counted(docs).join(candidates, "term", "left_semi")
    least = max(MIN_DOCUMENTS, math.ceil(low * total))
    band = (counts.groupBy("term").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= least) & (F.col("n") <= max(least, high * total))))
    return sorted(r["term"] for r in band.select("term").collect())  # bounded by `low`


class Fingerprinter:
    """Fingerprints under one lexicon; made once in a worker."""

    def __init__(self, words: list[str]):
        self.place = {t: i for i, t in enumerate(words)}
        self.hashes = np.array([xxhash.xxh64_intdigest(t.encode()) for t in words], np.uint64)
        self.member = np.zeros((len(words), len(RATES) * SUBSETS), bool)
        for k in range(len(RATES) * SUBSETS):
            mixed = (self.hashes ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(29)
            self.member[:, k] = mixed < np.uint64(int(RATES[k // SUBSETS] * 2**64))

    def __call__(self, text: str) -> tuple[int, np.ndarray]:
        """Hash of all lexicon terms, and 16-bit hashes of the subsets, 0 where a subset has none."""
        own, short = terms(text), np.zeros(self.member.shape[1], np.uint16)
        at = np.array(sorted(i for i in map(self.place.get, own) if i is not None), np.int64)
        if not len(at):  # nothing in the band: all terms speak, apart from texts that have band terms
            return xxhash.xxh64_intdigest("\n".join(sorted(own)).encode("utf-8", "surrogatepass"), 1), short
        hashes = self.hashes[at]
        # the terms of one subset after another, sorted in each
        subset, term = np.nonzero(self.member[at].T)
        raw = hashes[term].tobytes()
        ends = (8 * np.searchsorted(subset, np.arange(len(short)), side="right")).tolist()
        begin = 0
        for k, end in enumerate(ends):
            if end > begin:
                short[k] = xxhash.xxh64_intdigest(raw[begin:end], k) % 0xFFFF + 1
                begin = end
        return xxhash.xxh64_intdigest(hashes.tobytes()), short


def written(fp: tuple[int, np.ndarray]) -> str:
    return f"{fp[0]:016x}" + fp[1].astype(">u2").tobytes().hex()


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """0 to 1: agreeing subset hashes, sparsest subsets first, until ENOUGH of them have terms."""
    if a[0] == b[0]:
        return 1.0
    x, y = a[1].reshape(-1, SUBSETS)[::-1], b[1].reshape(-1, SUBSETS)[::-1]
    seen, same = np.cumsum(((x > 0) | (y > 0)).sum(1)), np.cumsum(((x == y) & (x > 0)).sum(1))
    level = min(int(np.searchsorted(seen, ENOUGH)), len(seen) - 1)
    return float(same[level] / seen[level]) if seen[level] else 0.0


@functools.lru_cache(maxsize=1)
def _fingerprinter(words: tuple[str, ...]) -> Fingerprinter:
    return Fingerprinter(list(words))


def neighbours(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, later, doc_id, text): rows by descending doc_id in buckets of consecutive ids.

    Each bucket is followed by a copy (`later` = 1) of the first row of the next one; the last
    by the first of all. So the successor of every row is beside it, and no task
    sees more than its bucket. Null doc_ids, which have no place in the order, have `later` = -1.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    placed = slim.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(buckets)))
                             .otherwise(common.by_range(slim, "doc_id", buckets)).cast("int"))
    # the largest id of each bucket: as many rows as buckets
    tops = [(r["bucket"], r["top"]) for r in placed.where("doc_id is not null").groupBy("bucket").agg(F.max("doc_id").alias("top"))
            .orderBy(F.desc("bucket")).collect()]
    after = [(tops[(k + 1) % len(tops)][1], tops[k][0]) for k in range(len(tops))]
    copies = F.broadcast(spark.createDataFrame(after, "top long, before int").groupBy("top").agg(F.collect_list("before").alias("before")))
    own = F.array(F.struct(F.col("bucket"), F.when(F.col("doc_id").isNull(), -1).otherwise(0).alias("later")))
    more = F.transform(F.coalesce("before", F.array().cast("array<int>")), lambda b: F.struct(b.alias("bucket"), F.lit(1).alias("later")))
    return (placed.join(copies, F.col("doc_id") == F.col("top"), "left")
            .select(F.explode(F.concat(own, more)).alias("to"), "doc_id", "text")
            .select("to.bucket", "to.later", "doc_id", "text"))


def fingerprints(docs: DataFrame, words: list[str], buckets: int | None = None) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, one row per row of `docs`.

    Reads `doc_id` and `text` (null: empty). Edited: the last floor(n/2) code points give way
    to the first as many, or all, of the next text by descending doc_id; after the last
    comes the first. Rows with one doc_id follow each other in an order by text hash. A
    row with a null doc_id stands alone: its next text is its own. Repeated rows come back as
    often as they came. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(words))
    buckets = buckets or max(2, min(1000, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
              ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = _fingerprinter(shared.value)
        held = None  # (bucket, doc_id, text, fingerprint) that waits for its successor

        def row(own, following) -> tuple:
            _, i, text, fp = own
            n = len(text)
            edited = text[:n - n // 2] + following[2][:n // 2]
            ep = mark(edited)
            return (i, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(fp), written(ep),
                    likeness(fp, ep), likeness(fp, following[3]))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)],
                                              [n for n, _ in fields])

        for batch in batches:
            out = []
            for bucket, later, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if later == 1 and held is None:
                    continue  # tied copies beyond the first
                this = (bucket, i, text, mark(text))
                if later < 0:
                    out.append(row(this, this))
                    continue
                if held is not None:
                    out.append(row(held, this))
                held = None if later else this
            if out:
                yield batch_of(out)

    # bucket k is task k: ids are dealt by the bounds, not by a hash of them
    rows = neighbours(docs, buckets).repartitionById(buckets, F.col("bucket")).withColumn("_tie", F.xxhash64("text"))
    ordered = rows.sortWithinPartitions("bucket", "later", F.desc("doc_id"), "_tie").select("bucket", "later", "doc_id", "text")
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of all documents and of their edited texts."""
    docs = common.table(spark, sf_dir, "documents")
    return fingerprints(docs, lexicon(docs))
