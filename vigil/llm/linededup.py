"""Lines of recurring templates dropped (operator 7).

A log-template tree: a line with `MIN_TOKENS` tokens or more goes down by its number of
tokens and its leading tokens to a leaf; tokens with digits count as the wildcard <*>. In a leaf, lines
that agree with a template in at least `SIMILARITY` of the positions join it, and the
positions where they differ become wildcards. A template recurs if its lines' supports
(rows of documents that hold the line; 1 where all are one document's) add up to `MIN_SUPPORT` and more than one document is among
them; all lines of recurring templates are dropped everywhere.

Shorter lines are templates as they stand, numbers included, and recur with a support of their own
(`short_support`; None keeps them all): short phrases and numbers meet by accident. A line's length is its tokens,
where scripts without spaces count each character, so a Chinese line of five characters is no short one.

With `long_support`, lines of more than `LONG_TOKENS` recur with that support, and supports are distinct
documents: of a document's repeated rows one counts, and of its lines of one template too.

Spark does the partitioning. Equal masked lines meet in a partial aggregate, so a line that a
third of all documents share is one row. Leaves are sorted runs inside partitions. A leaf
with more than `LEAF_ROWS` distinct lines gives the same templates without being held: its
lines pass through one task in order, which keeps the templates, found by blocks of
positions; lines meet the supports of their templates by a join. Documents find their lines to drop by joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import common
from vigil.session import scratch_path

WILD = "<*>"
MIN_TOKENS, MIN_SUPPORT, SIMILARITY = 5, 3, 0.8
#: Leading tokens on the way to a leaf.
DEPTHS = (2,)
#: Leaves of more distinct lines are read in order instead of being held.
LEAF_ROWS = 1000
#: Supports of lines shorter than MIN_TOKENS, and longer than LONG_TOKENS, in the registered query.
SHORT_SUPPORT, LONG_SUPPORT = 10, 2
LONG_TOKENS = 50
#: Documents told apart in a template of several lines; support above this needs one line that has it.
TOLD_APART = 3
#: Thai to Khmer, kana, ideographs.
SPACELESS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
DIGIT = re.compile(r"\d")


def mask(line: str) -> list[str]:
    """Tokens of a line, variable fields (tokens with a digit) as wildcards."""
    parts = line.split()
    if DIGIT.search(line):
        parts = [WILD if DIGIT.search(p) else p for p in parts]
    return parts


def _hash(text: str) -> int:
    """Signed 64-bit hash."""
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def masked(line: str, short: bool) -> str | None:
    """The line as the tree takes it, with or without short lines; None for one that always stays."""
    parts = mask(line)
    if len(parts) >= MIN_TOKENS:
        return " ".join(parts)
    return " ".join(line.split()) if short and parts else None


def length(form: str) -> int:
    """Tokens of a masked line, characters where the script has no spaces."""
    parts = form.split(" ")
    return len(parts) if form.isascii() else sum(max(1, len(SPACELESS.findall(p))) for p in parts)


def masked_lines(text: str, short: bool = False) -> dict[str, int]:
    """Distinct masked lines of a text that are long enough (with `short`: all but empty ones), with their hashes."""
    return {m: _hash(m) for line in text.split("\n") if (m := masked(line, short)) is not None}


def templates(lines: list[list[str]], supports: list[int], similarity: float = SIMILARITY) -> list[tuple[list[str], list[int]]]:
    """Templates of a leaf and the lines of each, by position.

    Lines come by falling support, then by text; each joins the template it agrees with
    most (the first of equals), or founds one. A wildcard of the template agrees with a wildcard only.
    """
    n, out = len(lines[0]), []
    codes: dict[str, int] = {WILD: 0}
    grid = np.array([[codes.setdefault(t, len(codes)) for t in x] for x in lines])
    forms = np.empty_like(grid)
    order = sorted(range(len(lines)), key=lambda k: (-supports[k], lines[k]))
    for k in order:
        if out:
            same = (forms[:len(out)] == grid[k]).sum(1)
            best = int(same.argmax())
            if same[best] >= similarity * n:
                forms[best][forms[best] != grid[k]] = 0
                out[best].append(k)
                continue
        forms[len(out)] = grid[k]
        out.append([k])
    names = list(codes)
    return [([names[c] for c in forms[j]], members) for j, members in enumerate(out)]


class Forms:
    """Templates of lines of one length that come one by one, in the order and with the results of `templates`.

    A line that agrees with a template in all but d positions agrees with it in one of d + 1
    blocks of positions, so only templates that share a block with the line are compared.
    """

    def __init__(self, size: int, similarity: float = SIMILARITY):
        self.least = similarity * size
        apart = next((d for d in range(size) if size - d - 1 < self.least), size)
        free = range(min(DEPTHS[0], size), size)  # the path to the leaf tells nothing apart
        if len(free) <= apart:
            self.blocks = [()]
        elif apart == 1:
            self.blocks = [tuple(p for p in free if p != q) for q in free]
        else:
            self.blocks = [tuple(free[k::apart + 1]) for k in range(apart + 1)]
        self.forms: list[list[str]] = []
        self.index: dict[tuple, list[int]] = {}

    def keys(self, parts: list[str]) -> list[tuple]:
        return [(k, *[parts[p] for p in block]) for k, block in enumerate(self.blocks)]

    def place(self, parts: list[str]) -> int:
        """Number of the template that the line joins or founds."""
        keys = self.keys(parts)
        best, most = -1, -1
        for j in sorted({j for key in keys for j in self.index.get(key, ())}):
            same = sum(map(eq, self.forms[j], parts))
            if same > most:
                best, most = j, same
        if best >= 0 and most >= self.least:
            if most < len(parts):
                old = self.keys(self.forms[best])
                self.forms[best] = [a if a == b else WILD for a, b in zip(self.forms[best], parts, strict=True)]
                for was, now in zip(old, self.keys(self.forms[best]), strict=True):
                    if was != now:
                        self.index[was].remove(best)
                        self.index.setdefault(now, []).append(best)
            return best
        for key in keys:
            self.index.setdefault(key, []).append(len(self.forms))
        self.forms.append(list(parts))
        return len(self.forms) - 1


def recurring(docs: DataFrame, min_support: int = MIN_SUPPORT, similarity: float = SIMILARITY, leaf_rows: int = LEAF_ROWS,
              short_support: int | None = None, long_support: int | None = None) -> DataFrame:
    """(line_hash, template, support): masked lines to drop.

    Documents are told apart by doc_id, those without one by their text. With `long_support`, `min_support`
    can be TOLD_APART at most.
    """
    if long_support is not None and max(min_support, long_support) > TOLD_APART:
        raise ValueError(f"templates of several lines tell {TOLD_APART} documents apart")
    spark = docs.sparkSession
    path = scratch_path(spark, "line-templates")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [(m, d) for d, t in zip(batch.column(0).to_pylist(), common.strings(batch.column(1)), strict=True) for m in masked_lines(t, short_support is not None)]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], ["line", "doc"])

    text = common.text_of()
    doc = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text))
    texts = docs.select(doc.alias("doc"), text.alias("text"))
    lines = common.python_rows(texts, cut, "line string, doc long")
    if long_support is not None:
        texts.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc").write.mode("overwrite").parquet(f"{path}/repeated")
        repeated = spark.read.parquet(f"{path}/repeated")
        if not repeated.isEmpty():
            lines = (common.python_rows(texts.join(repeated, "doc", "left_anti"), cut, "line string, doc long")
                     .unionByName(common.python_rows(texts.join(repeated, "doc", "left_semi"), cut, "line string, doc long").distinct()))
    parts = F.split("line", " ")
    (lines.groupBy("line").agg(F.count(F.lit(1)).alias("support"), F.min("doc").alias("a"), F.max("doc").alias("b"))
     .withColumn("support", F.when(F.col("a") == F.col("b"), F.lit(1)).otherwise(F.col("support")))
     .select("line", "support", "a", "b",
             F.xxhash64(F.size(parts), F.slice(parts, 1, DEPTHS[0])).alias("leaf"))
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/lines"))
    held_rows = spark.read.parquet(f"{path}/lines").select("leaf", "line", "support", "a", "b")
    held_rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf_rows).select("leaf").write.mode("overwrite").parquet(f"{path}/crowded")
    crowded = spark.read.parquet(f"{path}/crowded")
    large = None
    if not crowded.isEmpty():
        large = held_rows.join(crowded, "leaf", "left_semi")
        held_rows = held_rows.join(crowded, "leaf", "left_anti")

    def alike(size: int) -> float:
        return similarity if size >= MIN_TOKENS else 1.0

    def needed(form: str) -> int:
        size = length(form)
        if short_support is not None and size < MIN_TOKENS:
            return short_support
        return long_support if long_support is not None and size > LONG_TOKENS else min_support

    def told_apart(seen: set, a: int, b: int) -> set:
        return seen if len(seen) >= TOLD_APART else seen | {a, b}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def of_leaf(rows: list[tuple], out: list) -> None:
            split = [r[1].split(" ") for r in rows] if len(rows) > 1 else []
            # a hash of the path can hold lines of two lengths: they are no leaf
            groups = [[k for k, x in enumerate(split) if len(x) == size] for size in sorted({len(x) for x in split})]
            found = [(" ".join(form), [own[m] for m in members]) for own in groups
                     for form, members in templates([split[k] for k in own], [rows[k][2] for k in own], alike(len(split[own[0]])))]
            for form, at in found or [(rows[0][1], [0])]:
                support = sum(rows[k][2] for k in at)
                if long_support is not None:
                    support = max(max(rows[k][2] for k in at), len(set().union(*(rows[k][3:5] for k in at))))
                if min(rows[k][3] for k in at) != max(rows[k][4] for k in at) and support >= needed(form):
                    out.extend((_hash(rows[k][1]), form, support) for k in at)

        def emit(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string()),
                                               pa.array([x[2] for x in out], pa.int64())], ["line_hash", "template", "support"])

        for batch in batches:
            out: list = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    of_leaf(held, out)
                    held = []
                held.append(row)
            if out:
                yield emit(out)
        if held:
            out = []
            of_leaf(held, out)
            if out:
                yield emit(out)

    def read_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each line (founder and line_hash), and one for each recurring template when its leaf ends."""
        at, forms, sums = None, None, []

        def emit(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["founder", "line_hash", "template", "support"])

        def ended() -> Iterator[pa.RecordBatch]:
            out = []
            for (founder, support, a, b, most, seen), parts in zip(sums, forms.forms if forms else (), strict=True):
                if long_support is not None:
                    support = max(most, len(seen))
                if a != b and support >= needed(form := " ".join(parts)):
                    out.append((founder, None, form, support))
                if len(out) == common.BATCH_ROWS:
                    yield emit(out)
                    out = []
            if out:
                yield emit(out)

        for batch in batches:
            out = []
            for leaf, size, line, support, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (leaf, size):
                    yield from ended()
                    at, forms, sums = (leaf, size), Forms(size, alike(size)), []
                h = _hash(line)
                j = forms.place(line.split(" "))
                if j == len(sums):
                    sums.append([h, 0, a, b, 0, set()])
                own = sums[j]
                own[1:] = own[1] + support, min(own[2], a), max(own[3], b), max(own[4], support), told_apart(own[5], a, b)
                out.append((own[0], h, None, None))
            if out:
                yield emit(out)
        yield from ended()

    found = (held_rows.repartition("leaf").sortWithinPartitions("leaf")
             .mapInArrow(parse, "line_hash long, template string, support long"))
    if large is None:
        return found
    # tokens are compared one by one, as lists are in `templates`
    (large.withColumn("size", F.size(parts)).withColumn("parts", parts).repartition("leaf")
     .sortWithinPartitions("leaf", "size", F.desc("support"), "parts").select("leaf", "size", "line", "support", "a", "b")
     .mapInArrow(read_through, "founder long, line_hash long, template string, support long")
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/read"))
    read = spark.read.parquet(f"{path}/read")
    kept = read.where(F.col("line_hash").isNull()).select("founder", "template", "support")
    members = read.where(F.col("line_hash").isNotNull()).select("founder", "line_hash")
    return found.unionByName(members.join(kept, "founder").select("line_hash", "template", "support"))


def drop_recurring(docs: DataFrame, min_support: int = MIN_SUPPORT, similarity: float = SIMILARITY,
                   leaf_rows: int = LEAF_ROWS, short_support: int | None = None,
                   long_support: int | None = None) -> DataFrame:
    """doc_id, text without the lines of recurring templates, n_lines and n_dropped, one row per row of `docs`.

    Reads `doc_id` and `text`; other columns are left out. Null text is empty: one empty
    line, none dropped. Lines shorter than MIN_TOKENS tokens stay unless `short_support` is given. Rows with a null
    doc_id count as documents by their text. Repeated rows all come back; a line that only they
    hold counts once, and one that other documents hold too counts each of its rows (with `long_support` each document).
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "line-drops")
    recurring(docs, min_support, similarity, leaf_rows, short_support, long_support).select("line_hash").distinct().write.mode("overwrite").parquet(path)
    drops = spark.read.parquet(path)
    short = short_support is not None

    def occur(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [(k, h) for k, t in zip(batch.column(0).to_pylist(), common.strings(batch.column(1)), strict=True) for h in masked_lines(t, short).values()]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["row", "line_hash"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    # rows that share a key by accident share their lists: a line to drop is dropped everywhere anyway
    keyed = slim.withColumn("row", F.xxhash64("doc_id", "text"))
    hits = (common.python_rows(keyed.select("row", "text"), occur, "row long, line_hash long")
            .join(drops, "line_hash", "left_semi").groupBy("row").agg(F.collect_set("line_hash").alias("lines")))

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i, text, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = text.split("\n")
            if not lines:
                out.append((i, text, len(rows), 0))
                continue
            gone = set(lines)
            kept = [r for r in rows if (m := masked(r, short)) is None or _hash(m) not in gone]
            out.append((i, "\n".join(kept), len(rows), len(rows) - len(kept)))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
            pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "text", "n_lines", "n_dropped"])

    return common.python_rows(keyed.join(hits, "row", "left").select("doc_id", "text", "lines"), clean,
                              "doc_id long, text string, n_lines long, n_dropped long")


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines of recurring templates, as digests."""
    out = drop_recurring(common.table(spark, sf_dir, "documents"), short_support=SHORT_SUPPORT, long_support=LONG_SUPPORT)
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
