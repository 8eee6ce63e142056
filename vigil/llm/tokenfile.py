"""Token ids in Simple-8b files (operator 6).

File format: Parquet rows, one per block of whole documents with about `BLOCK_IDS` ids. Parquet
is the container because Spark commits its files atomically to any store; the ids are in `words`:

  shard     the Spark partition that wrote the block; shards follow each other in doc_id order
  block     number of the block in its shard
  first     ids of the shard before this block
  doc_ids   the documents of the block, in ascending order
  ends      where they end, counted in ids from the beginning of the block
  n_ids     ids in the block
  words     little-endian 64-bit words
  escapes   ids that no selector of the block can hold, little-endian 64-bit, in order

A word is a selector in the top 4 bits and values in the lower 60, the first value lowest:
selectors 1-14 hold COUNTS[s] values of 60 // COUNTS[s] bits. Selector 15 takes the next id
from `escapes` (ids of 2^60 and more).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigil.llm import common, tokens
from vigil.session import scratch_path

END_ID = 0
BLOCK_IDS = 1 << 16
#: How many values a word holds under selectors 1 to 14.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
BITS = np.array([0, *(60 // COUNTS[1:15]), 60])
ESCAPE = 15
#: How many of the selectors' widths are too narrow for each id of two bytes.
SMALL = np.searchsorted(1 << np.unique(BITS[1:15]), np.arange(1 << 16), side="right").astype(np.uint8)

BLOCK_SCHEMA = ("shard int, block long, first long, doc_ids array<long>, ends array<long>, "
                "n_ids long, words binary, escapes binary")
DOC_SCHEMA = "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def encode_words(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Simple-8b words and escapes of ids (unsigned 64-bit).

    Greedy: at every position the selector that holds the most of the next ids.
    """
    n = len(ids)
    if not n:
        return b"", b""
    ids = ids.astype(np.uint64)
    best = np.full(n, ESCAPE, np.uint8)
    levels = np.unique(BITS[1:15])
    # how many of the widths are too narrow for each id
    borders = np.uint64(1) << levels.astype(np.uint64)
    if int(ids.max()) < len(SMALL):
        width = SMALL[ids.astype(np.intp)]
    else:
        width = np.searchsorted(borders, ids, side="right").astype(np.uint8)
    widest = int(width.max())
    for s in range(14, 0, -1):  # from one value a word to sixty: each holds at fewer positions
        c, level = int(COUNTS[s]), int(np.searchsorted(levels, BITS[s]))
        if c > n:
            break
        if level >= widest:
            best[:n - c + 1] = s
            continue
        fits, reach = width <= level, 1  # fits[p]: the `reach` values from p on are narrow enough
        while reach < c:
            more = min(reach, c - reach)
            fits = fits[:-more] & fits[more:]
            reach += more
        if not fits.any():
            break
        np.copyto(best[:len(fits)], np.uint8(s), where=fits)
    at = _visited(COUNTS[best])
    chosen = best[at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        if s != ESCAPE:
            rows = np.flatnonzero(chosen == s)
            begin, packed = at[rows], words[rows]
            for k in range(COUNTS[s]):
                packed |= ids[begin + k] << np.uint64(k * BITS[s])
            words[rows] = packed
    return words.astype("<u8").tobytes(), ids[at[chosen == ESCAPE]].astype("<u8").tobytes()


def _visited(step: np.ndarray) -> np.ndarray:
    """Positions that one comes to from 0 by going step[p] on from each position p."""
    n = len(step)
    jumps = [np.append(np.minimum(np.arange(n) + step, n), n)]
    for _ in range(2):  # by 1, 2 and 4 steps
        jumps.append(jumps[-1].take(jumps[-1]))
    far, heads, p = memoryview(jumps.pop()), [], 0
    while p < n:
        heads.append(p)
        p = far[p]
    at = np.array(heads)
    for jump in reversed(jumps):
        at = np.stack([at, jump.take(at)], axis=1).ravel()
    return at[at < n]


def decode_words(words: bytes, escapes: bytes) -> np.ndarray:
    """Ids of a block, one numpy operation per selector and slot."""
    w = np.frombuffer(words, "<u8")
    selector = (w >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    at = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[at[rows]] = np.frombuffer(escapes, "<u8")
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNTS[s]):
            out[at[rows] + k] = (w[rows] >> np.uint64(k * BITS[s])) & mask
    return out


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
              block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents to `path` in ascending order of doc_id (nulls first).

    Reads `doc_id` and `text` only. Null text is empty: the end id alone. Rows with
    the same doc_id follow each other in order of their text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(tokenizer_path, True)
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).to_pylist()
            ids, offsets = tokens.with_end(*coder.encode(batch.column(1)), end_id)
            rows, done = [], 0
            while done < len(names):
                begin = int(offsets[done])
                upto = max(done + 1, int(np.searchsorted(offsets, begin + block_ids, side="right")) - 1)
                end = int(offsets[upto])
                words, escapes = encode_words(ids[begin:end])
                rows.append({"shard": shard, "block": block, "first": first, "doc_ids": names[done:upto],
                             "ends": (offsets[1 + done:1 + upto] - begin).tolist(), "n_ids": end - begin,
                             "words": words, "escapes": escapes})
                block, first, done = block + 1, first + end - begin, upto
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("n_ids", pa.int64()),
                ("words", pa.binary()), ("escapes", pa.binary())]))

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    shards = max(2, min(4000, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # the borders come from the ids alone, so texts are read once
    ordered = (slim.withColumn("shard", common.by_range(slim, "doc_id", shards)).repartitionById(shards, F.col("shard"))
               .select("doc_id", "text").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(run, BLOCK_SCHEMA).write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    Blocks are decoded independently of each other, one at a time in a task.
    """
    blocks = spark.read.parquet(path)
    # one row per shard: as many as the writer had tasks, whatever the number of ids
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))

    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = memoryview(decode_words(row["words"], row["escapes"]).astype("<u4")).cast("B")
                ends = np.array(row["ends"], np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_pydict({
                    "shard": np.full(len(ends), row["shard"], np.int32), "doc_id": row["doc_ids"],
                    "local_start": row["first"] + begins, "n_tokens": ends - begins,
                    "ids_crc32": [zlib.crc32(raw[a:b]) for a, b in zip((4 * begins).tolist(), (4 * ends).tolist(), strict=True)],
                }, schema)

    return (blocks.select("shard", "first", "doc_ids", "ends", "words", "escapes").mapInArrow(run, DOC_SCHEMA)
            .join(bases, "shard")
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))


def op6_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written in Simple-8b files and read back from them."""
    path = scratch_path(spark, "tokenfile")
    write_ids(common.table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_ids(spark, path)
