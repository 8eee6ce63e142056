"""Packing documents into training windows (operator 3).

Order-preserving dynamic programming. The documents of a partition form one
stream of ids; a window is a stretch of it of at most `window` ids. Windows may
end at document ends, at sentence ends, or inside long sentences every `stride`
ids. For a cut at position p with penalty c(p)

    cost(p) = c(p) + min over earlier cuts q, p - q <= window, of cost(q) + window - (p - q)

so each cut needs the minimum of cost(q) - (window - q) over a sliding range,
which a monotone queue gives in constant time. The penalty of a cut says how
many ids of padding it is worth to avoid it.

Memory: the stream is cut and emitted in stretches of at least `STRETCH` ids, so
a task holds one stretch and one Arrow batch, however large its partition is.
The rest of a stretch (less than a window) begins the next one, so only the end
of a partition is padded. No shuffle: a partition's documents stay in its order.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from vigil.llm import common, tokens

WINDOW = 2048
END_ID = 1
#: Padding ids that a cut inside a document is worth avoiding: after a sentence, within one.
SENTENCE_PENALTY, INNER_PENALTY = 4, 24
#: Within a sentence, every so many ids are a possible cut.
STRIDE = 32
STRETCH = 256 * WINDOW
#: The memory of chunks is smaller than the encoder's default: a stretch needs room too.
CACHE_CHARS = 5_000_000

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def choose_cuts(positions: list[int], penalties: list[int], window: int) -> list[int]:
    """Positions of the cheapest cuts, the last position included.

    `positions` increase by at most `window` from 0 on. Cost: padding of each
    window plus the penalties of its cut, the last one's penalty excluded.
    """
    n = len(positions)
    if not n:
        return []
    # value(q) = cost(q) + q; cost(p) = penalty(p) + window - p + min value over p - q <= window
    at, best_from = [0, *positions], [0] * (n + 1)
    queue: deque[tuple[int, int]] = deque([(0, 0)])
    push, pop, left = queue.append, queue.pop, queue.popleft
    for j in range(1, n + 1):
        p = at[j]
        low = p - window
        while at[queue[0][1]] < low:
            left()
        value, i = queue[0]
        best_from[j] = i
        value += window + penalties[j - 1]  # cost(p) + p
        while queue and queue[-1][0] >= value:
            pop()
        push((value, j))
    cuts, j = [], n
    while j:
        cuts.append(at[j])
        j = best_from[j]
    return cuts[::-1]


def sentence_ends(path: str) -> np.ndarray:
    """For each id, whether its token ends a sentence (punctuation with . ! or ?)."""
    vocab = tokens.encoder(path, False, CACHE_CHARS).tokenizer.get_vocab()
    ends = np.zeros(max(vocab.values()) + 1, bool)
    for token, i in vocab.items():
        ends[i] = bool(re.fullmatch(r"\W*[.!?]\W*</w>", token))
    return ends


def candidates(ids: np.ndarray, doc_ends: np.ndarray, is_end: np.ndarray,
               window: int) -> tuple[list[int], list[int]]:
    """Possible cuts of a stream and their penalties: document ends, sentence ends, inner strides."""
    stride = min(STRIDE, window)
    inner = np.arange(stride, len(ids) + 1, stride)
    sentence = np.flatnonzero(is_end[np.minimum(ids, len(is_end) - 1)]) + 1
    penalty = np.full(len(ids) + 1, -1, np.int32)
    penalty[inner] = INNER_PENALTY
    penalty[sentence] = SENTENCE_PENALTY
    penalty[doc_ends] = 0
    penalty[0] = -1
    where = np.flatnonzero(penalty >= 0)
    return where.tolist(), penalty[where].tolist()


class Packer:
    """Packs one partition's documents; `add` and `finish` return complete pieces as columns."""

    def __init__(self, partition: int, is_end: np.ndarray, window: int, stretch: int):
        self.next_sequence = partition << 32
        self.is_end, self.window, self.stretch = is_end, window, stretch
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[tuple] = []      # (doc_id, ids of the document before the stream, its total)
        self.lengths: list[int] = []     # ids of each of these documents in the stream

    def add(self, doc_ids: list, ids: np.ndarray, offsets: np.ndarray) -> dict | None:
        sizes = np.diff(offsets).tolist()
        self.ids = np.concatenate([self.ids, ids])
        self.docs += [(d, 0, n) for d, n in zip(doc_ids, sizes, strict=True)]
        self.lengths += sizes
        return self._emit(False) if len(self.ids) >= self.stretch else None

    def finish(self) -> dict | None:
        return self._emit(True) if len(self.ids) else None

    def _emit(self, last: bool) -> dict:
        ends = np.cumsum(np.array(self.lengths, np.int64))
        where, penalties = candidates(self.ids, ends, self.is_end, self.window)
        if not where or where[-1] != len(self.ids):
            where.append(len(self.ids))
            penalties.append(0)
        cuts = choose_cuts(where, penalties, self.window)
        if not last:
            cuts.pop()  # the stream goes on
        # pieces: between neighbouring borders, where borders are cuts and document ends
        cut_at = np.array(cuts, np.int64)
        stop = int(cut_at[-1])
        borders = np.unique(np.concatenate([[0], cut_at, ends[ends <= stop]]))
        begin, finish = borders[:-1], borders[1:]
        doc = np.searchsorted(ends, begin, side="right")
        before = ends - np.array(self.lengths, np.int64)
        sequence = np.searchsorted(cut_at, begin, side="right")
        seq_start = np.concatenate([[0], cut_at])[sequence]
        shift = np.array([d[1] for d in self.docs], np.int64)
        raw = self.ids[:stop].astype("<u4").tobytes()
        out = {
            "doc_id": [self.docs[k][0] for k in doc.tolist()],
            "start": begin - before[doc] + shift[doc],
            "length": finish - begin,
            "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), finish.tolist(), strict=True)],
            "doc_tokens": np.array([d[2] for d in self.docs], np.int64)[doc],
            "sequence_id": self.next_sequence + sequence,
            "offset": begin - seq_start,
        }
        self.next_sequence += len(cuts)
        # documents with nothing left go; the one that is cut goes on behind its first part
        done = int(np.searchsorted(ends, stop, side="right"))
        self.docs, self.lengths = self.docs[done:], self.lengths[done:]
        if self.docs and before[done] < stop:
            cut = stop - int(before[done])
            d, gone, total = self.docs[0]
            self.docs[0], self.lengths[0] = (d, gone + cut, total), self.lengths[0] - cut
        self.ids = self.ids[stop:]
        return out


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
         stretch: int = STRETCH) -> DataFrame:
    """Pieces of documents in windows of at most `window` ids.

    Reads `doc_id` and `text`; other columns, whatever their names, are left out.
    Null text is empty: such a document is its end id alone. Null doc_ids and
    repeated rows are packed like any other row. An empty table gives no pieces.
    Every id of every document lies in exactly one piece; offsets are gapless from 0.
    `sequence_id` is unique: the number of the Spark partition times 2^32, plus a
    running number. Documents keep their order within a partition.
    """
    if not 1 <= window <= stretch:
        raise ValueError(f"a stretch of {stretch} ids must hold a window of {window}, and a window an id")
    arrow = pa.schema([(n, pa.int64()) for n in re.findall(r"(\w+) long", SCHEMA)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(tokenizer_path, False, CACHE_CHARS)
        packer = Packer(TaskContext.get().partitionId(), sentence_ends(tokenizer_path), window, stretch)
        for batch in batches:
            if batch.num_rows:
                ids, offsets = tokens.with_end(*coder.encode(common.strings(batch.column(1))), end_id)
                if (out := packer.add(batch.column(0).to_pylist(), ids, offsets)) is not None:
                    yield pa.RecordBatch.from_pydict(out, arrow)
        if (out := packer.finish()) is not None:
            yield pa.RecordBatch.from_pydict(out, arrow)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.text_of().alias("text")).mapInArrow(run, SCHEMA)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 ids; one row per piece."""
    return pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
