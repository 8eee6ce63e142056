"""SentencePiece models on the tokenizers library (operator 1).

The model file is parsed from its protobuf wire format and rebuilt as a tokenizers
pipeline: normaliser (precompiled character map, white space rules, dummy prefix), the
white space marker, a unigram or BPE model from the pieces and scores, and byte fallback.
Texts are cut before white space markers, where no piece of the vocabulary can cross, and
each distinct chunk is encoded once; new chunks go to the library's threads in batches.
Every distinct chunk that can stand alone is also encoded by the SentencePiece library itself, and a document's
`parity` says whether all its chunks agree; a text with any other chunk, and every text where the model
normalises, is compared as a whole. Settings that are not rebuilt are an error.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from vigil.llm import common, tokens

#: The white space marker; piece types and model types of the file format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Threads of the tokenizers library in each Python worker.
THREADS = 2


@dataclass(frozen=True)
class Model:
    pieces: tuple[tuple[str, float, int], ...]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    collapse: bool

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            value, at = raw[at:at + n], at + n
        yield key >> 3, value


def parse_model(raw: bytes) -> Model:
    """Pieces, trainer and normaliser settings of a model file (field numbers are the format's)."""
    pieces, trainer, normaliser = [], {}, {}
    for number, value in fields(raw):
        if number == 1:
            f = dict(fields(value))
            score = struct.unpack("<f", f[2])[0] if 2 in f else 0.0
            pieces.append((f[1].decode(), score, f.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normaliser = dict(fields(value))
    if trainer.get(24, 0) or not normaliser.get(5, 1):
        raise ValueError("white space as suffix and white space that is not escaped are not rebuilt")
    return Model(tuple(pieces), trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), normaliser.get(2, b""),
                 bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)))


def run_merges(lengths: set[int]) -> list[tuple[int, int]]:
    """Pairs that runs of the marker grow by, when all run pieces have one score.

    The leftmost pair that makes a piece wins each time, so the first run grows as far
    as it can; the pair with the longer left part goes first.
    """
    row, used = [1] * (2 * max(lengths, default=1) + 2), set()
    while (k := next((k for k in range(len(row) - 1) if row[k] + row[k + 1] in lengths), None)) is not None:
        used.add((row[k], row[k + 1]))
        row[k:k + 2] = [row[k] + row[k + 1]]
    return sorted(used, reverse=True)


def merges(pieces: tuple[tuple[str, float, int], ...]) -> list[tuple[str, str]]:
    """Pairs that make up a piece, best piece first; runs of the marker by `run_merges`."""
    known = {p for p, _, t in pieces if t in (NORMAL, USER)}
    runs = {p: s for p, s, t in pieces if t in (NORMAL, USER) and set(p) == {SPACE} and len(p) > 1}
    tied = len(set(runs.values())) == 1
    ranked = []
    for piece, score, kind in pieces:
        if kind in (NORMAL, USER) and len(piece) > 1 and not (tied and piece in runs):
            for k in range(1, len(piece)):
                if piece[:k] in known and piece[k:] in known:
                    ranked.append((-score, len(ranked), (piece[:k], piece[k:])))
    if tied:
        score = next(iter(runs.values()))
        for a, b in run_merges({len(p) for p in runs}):
            ranked.append((-score, len(ranked), (SPACE * a, SPACE * b)))
    return [pair for *_, pair in sorted(ranked)]


def cuttable(model: Model) -> bool:
    """No piece has the marker behind another character, so texts can be cut before it."""
    return all(re.fullmatch(f"{SPACE}*[^{SPACE}]*", p) for p, _, t in model.pieces if t in (NORMAL, USER))


def build_normalizer(model: Model) -> normalizers.Normalizer | None:
    """Character map and white space rules; the marker and prefix are added behind it."""
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.collapse:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    return normalizers.Sequence(steps) if steps else None


def build_tokenizer(model: Model, normalise: bool = True) -> Tokenizer:
    """The model as a tokenizers pipeline."""
    if model.kind == BPE:
        core = models.BPE(vocab={p: i for i, (p, _, _) in enumerate(model.pieces)}, merges=merges(model.pieces),
                          unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        # control pieces are never found in texts: their names there are out of reach
        vocab = [(p if t in (NORMAL, USER, BYTE, UNKNOWN) else f"\x00{i}", s) for i, (p, s, t) in enumerate(model.pieces)]
        core = models.Unigram(vocab, unk_id=model.unknown, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    out = Tokenizer(core)
    if normalise:
        first = build_normalizer(model)
        out.normalizer = normalizers.Sequence([*([first] if first else []), *([normalizers.Prepend(SPACE)] if model.dummy_prefix else []),
                                               normalizers.Replace(" ", SPACE)])
    if cuttable(model):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}*[^{SPACE}]+|{SPACE}+"), "isolated")
    out.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse(),
                                     *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    return out


class PieceEncoder(tokens.ChunkEncoder):
    """`encode` and `decode` of texts; `agree` holds, chunk by chunk, whether SentencePiece gives the same ids (-1: not asked)."""

    def __init__(self, path: str):
        import sentencepiece
        with open(path, "rb") as f:
            self.model = parse_model(f.read())
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalise = build_normalizer(self.model)
        if not cuttable(self.model):
            raise ValueError("pieces cross white space: encode whole texts with build_tokenizer")
        self.bytes = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN
                      else p.replace(SPACE, " ").encode() for p, _, t in self.model.pieces]
        super().__init__(build_tokenizer(self.model, normalise=False), True)
        # bytes of the marked text that an id stands for; unknown pieces cannot be told, so chunks go alone then
        self.width = np.array([1 if t == BYTE else len(p.encode()) for p, _, t in self.model.pieces], np.int64)

    def _forget(self) -> None:
        super()._forget()
        self.agree = np.zeros(1 << 12, np.int8)

    def _learn(self, chunks: list[str]) -> None:
        joint = [c for c in chunks if c[:1] == SPACE and c[-1:] != SPACE] if self.model.byte_fallback else []
        rest = set(joint)
        alone = [c for c in chunks if c not in rest]
        # several batches at once for the library's threads
        parts = [joint[i:i + tokens.TOGETHER] for i in range(0, len(joint), tokens.TOGETHER)]
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(["".join(p) for p in parts], add_special_tokens=False)]
        lists: list[list[int]] = []
        for part, ids in zip(parts, coded, strict=True):
            at = np.cumsum(self.width[ids])
            ends = np.cumsum([len(c.encode()) for c in part])
            cuts = np.searchsorted(at, ends)
            if cuts[-1] < len(at) and (at[cuts] == ends).all():
                cuts = [0, *(cuts + 1).tolist()]
                lists += [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            else:
                lists += self._ids(part)
        lists += self._ids(alone)
        names = joint + alone
        # the library adds the prefix itself; without one no chunk can be told from the beginning of a text
        agree = self._reference(names) if self.model.dummy_prefix else [None] * len(names)
        ids = np.array([i for x in lists for i in x], np.uint32)
        same = np.array([-1 if a is None else a == b for a, b in zip(agree, lists, strict=True)], np.int8)
        self._remember(names, ids, np.array([len(x) for x in lists], np.int64), same)

    def _extra(self, at: np.ndarray) -> np.ndarray:
        return self.agree[at]

    def _remember(self, names: list[str], ids: np.ndarray, sizes: np.ndarray, extra: np.ndarray | None = None) -> None:
        n, m = len(self.place), len(names)
        while n + m > len(self.agree):
            self.agree = np.concatenate([self.agree, np.zeros_like(self.agree)])
        self.agree[n:n + m] = extra
        super()._remember(names, ids, sizes)

    def _reference(self, chunks: list[str]) -> list[list[int] | None]:
        own = [c[1:].replace(SPACE, " ") for c in chunks]
        # white space alone or at an edge means something else to a text than within one
        fit = [bool(t) and not (self.model.collapse and (t != t.strip(" ") or "  " in t)) and c[:1] == SPACE for t, c in zip(own, chunks, strict=True)]
        ids = iter(self.reference.encode([t for t, f in zip(own, fit, strict=True) if f], num_threads=1))
        return [next(ids) if f else None for f in fit]

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        names, codes = (x.to_numpy(zero_copy_only=False) for x in (coded.dictionary, coded.indices))
        names = names.tolist()
        at = self._places([SPACE + x for x in names])[codes] if names else np.zeros(0, np.int64)
        if not self.model.dummy_prefix and len(counts):
            firsts = np.cumsum(counts) - counts
            at[firsts] = self._places([names[k] for k in codes[firsts]])
        return at, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, row offsets, and each text's parity with SentencePiece."""
        self._begin()
        raw = texts
        if self.normalise:
            texts = [self.normalise.normalize_str(t) for t in texts]
        odd = re.compile(f"^ |  | $|{SPACE}|^$")
        slow = [i for i, t in enumerate(texts) if odd.search(t)]
        fast = np.setdiff1d(np.arange(len(texts)), slow)
        some, their = self._cut(pa.array([texts[i] for i in fast], pa.large_string()))
        prefix = SPACE if self.model.dummy_prefix else ""
        rows = [re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", (prefix + texts[i]).replace(" ", SPACE)) if texts[i] else [] for i in slow]
        counts = np.zeros(len(texts), np.int64)
        counts[fast], counts[slow] = their, [len(r) for r in rows]
        starts = np.cumsum(counts) - counts
        at = np.empty(int(counts.sum()), np.int64)
        at[tokens.ragged(starts[fast], their)] = some
        at[tokens.ragged(starts[slow], counts[slow])] = self._places([c for r in rows for c in r])
        sizes = self.sizes[at]
        ids = self.pool[tokens.ragged(self.starts[at], sizes)]
        edges = np.concatenate([[0], np.cumsum(counts)])
        offsets = np.concatenate([[0], np.cumsum(sizes)])[edges]

        def some(marked: np.ndarray) -> np.ndarray:
            n = np.concatenate([[0], np.cumsum(marked)])
            return n[edges[1:]] > n[edges[:-1]]

        same = ~some(self.agree[at] == 0)
        whole = np.flatnonzero(some(self.agree[at] < 0) | (self.normalise is not None))
        for i, want in zip(whole.tolist(), self.reference.encode([raw[i] for i in whole], num_threads=1), strict=True):
            same[i] = ids[offsets[i]:offsets[i + 1]].tolist() == want
        return ids, offsets, same

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode(docs: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """doc_id, ids, parity of every row of `docs`; null text is empty (no ids). Other columns are left out."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        ids, offsets, same = encoder(path).encode(common.strings(batch.column(1)))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(same)], ["doc_id", "ids", "parity"])

    return common.python_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text")), run,
                              "doc_id long, ids array<int>, parity boolean")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of `doc_id`, `ids`; null ids give a null text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(
            [None if x is None else coder.decode(x) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return common.python_rows(coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit), parity, text_back.

    parity: SentencePiece gives the same ids for every chunk. text_back: the ids decode
    to the text. Rows with null doc_id or text and repeated rows are treated like any other.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        coder, texts = encoder(path), common.strings(batch.column(1))
        ids, offsets, same = coder.encode(texts)
        raw, flat, at = ids.astype("<u4").tobytes(), ids.tolist(), offsets.tolist()
        spans = list(zip(at, at[1:], strict=False))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_tokens": np.diff(offsets),
            "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in spans], "parity": same,
            "text_back": [coder.decode(flat[a:b]) == t for (a, b), t in zip(spans, texts, strict=True)]},
            pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("parity", pa.bool_()), ("text_back", pa.bool_())]))

    return common.python_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text")), run,
                              "doc_id long, n_tokens long, ids_crc32 long, parity boolean, text_back boolean")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded with the 32k SentencePiece model, with parity."""
    return round_trip(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
