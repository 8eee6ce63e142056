"""Batch encoding with the tokenizers library, memoised by chunk.

A text is cut only at places where the tokenizer's own pre-tokenizer cuts too,
so the ids of the chunks in a row are exactly the ids of the text (a property
test holds this against plain `encode`). Text repeats its words, so a worker
encodes each distinct chunk once and gathers the ids of all texts with numpy.
"""

from __future__ import annotations

import functools
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Beyond this many characters a worker forgets the chunks that its texts had longest ago
#: (memory bound, no effect on ids).
CACHE_CHARS = 12_000_000
#: Separates chunks handed to a word vocabulary; white space around it is dropped there.
MARK = "\x01"
#: White space that begins or ends a text, follows itself, or is neither a space nor a line end: where a
#: byte-level pre-tokenizer may split inside white space, texts are cut with SPACED.
RUNS = r"^[ \n]|[ \n]$|  | \n|\n |\n\n|[" + "".join(
    rf"\x{{{ord(c):x}}}" for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n") + "]"
#: Chunks that are handed to the library as one text.
TOGETHER = 64
#: Words that are handed to the model as one.
WORDS = 8
#: White space for Python but not for the tokenizers' patterns: such texts are encoded whole.
ODD = re.compile("[\x1c-\x1f]")
SPACED = re.compile(r"\s*\S+|\s+")


#: ASCII punctuation; a run of it behind letters is a piece of its own for the pre-tokenizers.
TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: ASCII punctuation that stands behind something else.
BEHIND = r"^.*[^!-/:-@\[-`{-~]"
#: Letters and digits for every version of Unicode: punctuation behind one begins a new piece.
WORD_END = r"[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{400}-\x{481}\x{48a}-\x{52f}]$"
#: Letters that lower-case one by one and are their own composed form.
PLAIN_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017e]+")


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


LETTERS = byte_letters()


class ChunkEncoder:
    """`encode(texts)` -> (ids of all texts in a row as uint32, row offsets).

    `spaces` tells whether white space yields ids (byte-level vocabularies) or is
    dropped by the pre-tokenizer (word vocabularies). Special token strings in a
    text are ordinary text.
    """

    def __init__(self, tokenizer: Tokenizer, spaces: bool, cache_chars: int | None = None):
        tokenizer.encode_special_tokens = True
        self.tokenizer, self.spaces, self.tokenize = tokenizer, spaces, tokenizer.model.tokenize
        self.cache_chars = cache_chars or CACHE_CHARS
        self.tails: dict[str, list[int]] = {}
        # words in a row have the merges of each; not so where the model looks up whole words or leaves out merges
        self.merges = not (getattr(tokenizer.model, "ignore_merges", True) or tokenizer.model.dropout)
        if spaces:  # bytes that each id stands for; byte-level tokens have one character per byte
            self.width = np.zeros(tokenizer.get_vocab_size(), np.int64)
            for token, i in tokenizer.get_vocab().items():
                self.width[i] = len(token)
        else:
            self.mark = self._ids([MARK])[0]
        self.clock = 0
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.sizes = np.zeros(1 << 12, np.int64)
        self.seen = np.zeros(1 << 12, np.int64)
        self.used = self.chars = 0

    def _begin(self) -> None:
        """Before a batch of texts: make room if need be."""
        if self.chars > self.cache_chars:
            self._trim()
        self.clock += 1

    def _trim(self) -> None:
        """Forget the chunks that texts had longest ago, down to half the room."""
        names = list(self.place)
        seen = self.seen[:len(names)]
        latest = np.argsort(-seen, kind="stable")
        room = np.cumsum(np.fromiter(map(len, names), np.int64, len(names))[latest])
        at = np.sort(latest[room <= self.cache_chars // 2])
        sizes, extra, seen = self.sizes[at], self._extra(at), seen[at]
        ids = self.pool[ragged(self.starts[at], sizes)]
        self._forget()
        self._remember([names[k] for k in at.tolist()], ids, sizes, extra)
        self.seen[:len(at)] = seen

    def _extra(self, at: np.ndarray) -> np.ndarray | None:
        """What a subclass keeps of chunks besides their ids."""
        return None

    def _remember(self, names: list[str], ids: np.ndarray, sizes: np.ndarray, extra: np.ndarray | None = None) -> None:
        n, m = len(self.place), len(names)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + m > len(self.starts):
            self.starts, self.sizes, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.seen))
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[n:n + m] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:n + m] = sizes
        self.used += len(ids)
        self.chars += sum(map(len, names))
        self.place.update(zip(names, range(n, n + m), strict=True))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and sizes of chunks encoded as a few texts; None if the borders cannot be told."""
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        parts = [chunks[i:i + TOGETHER] for i in range(0, len(chunks), TOGETHER)]
        if self.spaces:
            ids = np.array([i for x in self._ids(["".join(p) for p in parts]) for i in x], np.uint32)
            sizes = self._borders(ids, chunks)
            return None if sizes is None else (ids, sizes)
        # a mark behind each chunk
        ids = np.array([i for x in self._ids([f" {MARK} ".join(p) + f" {MARK}" for p in parts]) for i in x], np.uint32)
        cuts = np.flatnonzero(ids == self.mark[0])
        if len(self.mark) != 1 or len(cuts) != len(chunks):
            return None
        return np.delete(ids, cuts), np.diff(np.concatenate([[-1], cuts])) - 1

    def _form(self, base: str) -> str | None:
        """The letters in which the BPE model knows a word without punctuation behind it; None for other chunks."""
        if self.spaces:
            if not (base[1:] if base[:1] == " " else base).isalpha():
                return None
            return base.encode().decode("latin-1").translate(LETTERS)
        if not (base.isascii() and base.isalpha() or PLAIN_LETTERS.fullmatch(base)):
            return None
        form = base.lower()
        return form if base.isascii() else form.encode().decode("latin-1").translate(LETTERS)

    def _tailed(self, bases: list[int], tails: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of known chunks, each with punctuation behind it."""
        at, own = np.array(bases, np.int64), list(dict.fromkeys(tails))
        coded = [self._tail(t) for t in own]
        lengths = np.array([len(x) for x in coded], np.int64)
        ends = np.cumsum(lengths)
        number = dict(zip(own, range(len(own)), strict=True))
        which = np.array([number[t] for t in tails], np.int64)
        before, behind = self.sizes[at], lengths[which]
        sizes = before + behind
        starts = np.cumsum(sizes) - sizes
        ids = np.empty(int(sizes.sum()), np.uint32)
        ids[ragged(starts, before)] = self.pool[ragged(self.starts[at], before)]
        ids[ragged(starts + before, behind)] = np.array([i for x in coded for i in x], np.uint32)[ragged((ends - lengths)[which], behind)]
        return ids, sizes

    def _tail(self, tail: str) -> list[int]:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[tail] = self._ids([tail])[0]
        return self.tails[tail]

    def _borders(self, ids: np.ndarray, chunks: list[str]) -> np.ndarray | None:
        """How many of the byte-level ids of chunks in a row each chunk has; None where an id belongs to two chunks."""
        ends = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])
        at = np.cumsum(self.width[ids])
        cuts = np.searchsorted(at, ends)
        if cuts[-1] >= len(at) or (at[cuts] != ends).any():
            return None
        return np.diff(cuts, prepend=-1)

    def _words(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
        """Of new chunks those that are letters, behind a space or not, with ids and sizes; the other chunks.

        The model gets a few words behind spaces at a time. Where no id of the result belongs to two of them, it has
        merged nothing across their borders, so each word has the ids that it has alone.
        """
        spaced, bare, others = [], [], []
        for c in chunks:
            if c[:1] == " ":
                (spaced if c[1:].isalpha() else others).append(c)
            else:
                (bare if c.isalpha() else others).append(c)
        spaced.sort(key=str.isascii)
        sizes = None
        if spaced and self.merges:
            joint = ["".join(spaced[i:i + WORDS]) for i in range(0, len(spaced), WORDS)]
            ids = np.array(self._model_ids(joint)[0], np.uint32)
            sizes = self._borders(ids, spaced)
        if sizes is None:
            ids, sizes, spaced, bare = np.zeros(0, np.uint32), np.zeros(0, np.int64), [], spaced + bare
        flat, lengths = self._model_ids(bare)
        return (spaced + bare, np.concatenate([ids, np.array(flat, np.uint32)]),
                np.concatenate([sizes, np.array(lengths, np.int64)]), others)

    def _model_ids(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Ids that the model gives to words in a row, and how many each has."""
        coded = list(map(self.tokenize, [
            w.replace(" ", "\u0120") if w.isascii() else w.encode().decode("latin-1").translate(LETTERS) for w in words]))
        return [t.id for x in coded for t in x], list(map(len, coded))

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks and remember them."""
        names, flat, lengths, rest = [], [], [], []
        if self.spaces:
            words, word_ids, word_sizes, chunks = self._words(chunks)
            self._remember(words, word_ids, word_sizes)
        longer, bases, tails = [], [], []
        find, form_of, tokenize, spaces = self.place.get, self._form, self.tokenize, self.spaces
        for c in chunks:
            base = c.rstrip(TAIL)
            tail = c[len(base):]
            if tail:
                known = find(base)
                if known is not None and base[-1:].isalpha():
                    longer.append(c)
                    bases.append(known)
                    tails.append(tail)
                    continue
            line = spaces and base[:1] == "\n"  # a piece of its own before the word
            # most chunks are a space and ASCII letters
            form = "\u0120" + base[1:] if spaces and base[:1] == " " and base.isascii() and base[1:].isalpha() else form_of(base[line:])
            if form is None or line and form[:1] == "\u0120":
                rest.append(c)
                continue
            own = [t.id for t in tokenize(form)]
            if line:
                own = self._tail("\n") + own
            if tail:
                own += self._tail(tail)
            names.append(c)
            flat += own
            lengths.append(len(own))
        if self.spaces:
            alone = [c for c in rest if not (c[:1].isspace() and not c[-1:].isspace()) or ODD.search(c)]
        else:
            alone = [c for c in rest if MARK in c]
        apart = set(alone)
        joint = [c for c in rest if c not in apart] if apart else rest
        coded = self._together(joint)
        if coded is None:
            joint, alone, coded = [], rest, self._together([])
        single = self._ids(alone)
        behind = self._tailed(bases, tails)
        names += longer + joint + alone
        ids = np.concatenate([np.array(flat, np.uint32), behind[0], coded[0], np.array([i for x in single for i in x], np.uint32)])
        sizes = np.concatenate([np.array(lengths, np.int64), behind[1], coded[1], np.array([len(x) for x in single], np.int64)])
        self._remember(names, ids, sizes)

    def _places(self, chunks: list[str]) -> np.ndarray:
        find = self.place.get
        at = np.fromiter(map(find, chunks, itertools.repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            absent = [chunks[k] for k in missing.tolist()]
            new = list(dict.fromkeys(absent))
            for i in range(0, len(new), 4096):
                self._learn(new[i:i + 4096])
            at[missing] = np.fromiter(map(find, absent), np.int64, len(absent))
        self.seen[at] = self.clock
        return at

    def _at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks in a row, and how many each has."""
        sizes = self.sizes[places]
        return self.pool[ragged(self.starts[places], sizes)], sizes

    def _coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, and how many each has."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ") if self.spaces else pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.intp)
        if not self.spaces:
            ids, sizes = self._at(self._places(values(coded.dictionary))[codes])
        elif len(codes):
            ids, sizes = self._spaced(coded.dictionary, codes, np.cumsum(counts) - counts)
        else:
            ids, sizes = self._at(codes)
        return ids, sums(sizes, counts)

    def _spaced(self, names: pa.Array, codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of `names` in the order of `codes`, where texts are cut at single spaces and before line ends.

        A line end stands between two characters here that are no white space, and is a piece of its own for the
        pre-tokenizer; so is punctuation from the end of a word to the next white space. Both are looked up by
        themselves, so that a word is learnt once, whatever stands around it.
        """
        names = pa.concat_arrays([names, names.take(pa.array(codes[firsts]))])
        codes[firsts] = np.arange(len(names) - len(firsts), len(names))
        bare = pc.or_(pc.starts_with(names, "\n"), pa.array(np.arange(len(names)) >= len(names) - len(firsts)))
        bodies = pc.ascii_ltrim(names, "\n")
        words = pc.ascii_rtrim(bodies, TAIL)
        words = pc.if_else(pc.match_substring_regex(words, WORD_END), words, bodies)
        # the first word of a text or line has no space before it
        keys = pc.binary_join_element_wise(pc.if_else(bare, "", " ").cast(words.type), words, pa.scalar("", words.type)).dictionary_encode()
        tailed = pc.not_equal(pc.binary_length(words), pc.binary_length(bodies))
        tails = pc.replace_substring_regex(bodies.filter(tailed), BEHIND, "").dictionary_encode()
        none, end = self._places(["", "\n"])
        parts = np.full((len(names), 3), none)
        parts[pc.starts_with(names, "\n").to_numpy(zero_copy_only=False), 0] = end
        parts[:, 1] = self._places(values(keys.dictionary))[keys.indices.to_numpy()]
        parts[tailed.to_numpy(zero_copy_only=False), 2] = self._places(values(tails.dictionary))[tails.indices.to_numpy()]
        pool, sizes = self._at(parts.ravel())
        sizes = sizes.reshape(-1, 3).sum(axis=1)
        starts = np.cumsum(sizes) - sizes
        sizes = sizes[codes]
        return pool[ragged(starts[codes], sizes)], sizes

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        self._begin()
        column = pc.fill_null(texts.cast(pa.large_string()), "") if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        slow = pc.indices_nonzero(pc.match_substring_regex(column, RUNS)).to_pylist() if self.spaces else []
        if not slow:
            ids, lengths = self._coded(column)
        else:
            rows = [[t] if ODD.search(t) else SPACED.findall(t) for t in column.take(pa.array(slow)).to_pylist()]
            fast = np.setdiff1d(np.arange(len(column)), slow)
            some, their = self._coded(column.take(pa.array(fast)))
            rest, sizes = self._at(self._places([c for r in rows for c in r]))
            lengths = np.empty(len(column), np.int64)
            lengths[fast], lengths[slow] = their, sums(sizes, np.array([len(r) for r in rows]))
            starts = np.cumsum(lengths) - lengths
            ids = np.empty(int(lengths.sum()), np.uint32)
            ids[ragged(starts[fast], their)] = some
            ids[ragged(starts[slow], lengths[slow])] = rest
        return ids, np.concatenate([[0], np.cumsum(lengths)])


def sums(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the first counts[0] sizes, of the next counts[1] and so on."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return np.diff(ends[np.cumsum(counts)], prepend=0)


def values(column: pa.Array) -> list[str]:
    """Python texts of a column without nulls; by way of numpy, for Arrow makes them one by one far slower."""
    return column.to_numpy(zero_copy_only=False).tolist()


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[0]..starts[0]+sizes[0]-1, starts[1].. in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@functools.lru_cache(maxsize=2)
def encoder(path: str, spaces: bool, cache_chars: int | None = None) -> ChunkEncoder:
    """One encoder for each vocabulary file and worker."""
    return ChunkEncoder(Tokenizer.from_file(path), spaces, cache_chars)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows, each followed by `end_id`."""
    n = len(offsets) - 1
    out, own = np.full(len(ids) + n, end_id, np.uint32), np.ones(len(ids) + n, bool)
    own[offsets[1:] + np.arange(n)] = False
    out[own] = ids
    return out, offsets + np.arange(n + 1)
