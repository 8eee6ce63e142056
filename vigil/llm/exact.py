"""Exact duplicates with an extendible-hash index on shared files (operator 2).

Native: DataFrame operations only.

1. Documents are counted by the hash (XXH64) of their normalised text; no text moves.
2. Directory: hashes are counted by their top bits. Starting from one bucket, the
   directory doubles as long as a bucket holds more hashes than its capacity, and only
   overfull buckets split; the others keep a shorter prefix. The directory has at most
   2^MAX_DEPTH cells, whatever the number of documents: the capacity follows from the
   number of hashes. It is broadcast, and gives each document its bucket.
3. Owner tasks take whole buckets. Texts go to the owner of their bucket, where those
   with one hash are a chain: they are compared byte by byte, equal ones become one entry
   and different ones follow each other. Texts that many rows share are combined before
   they travel, in SALTS parts each, which meet in the owner's chain.
4. Documents look up their bucket, hash and digest in the index files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigil.llm import common
from vigil.session import scratch_path

#: The directory has at most 2^MAX_DEPTH cells; buckets hold at least MIN_CAPACITY hashes.
MAX_DEPTH, MIN_CAPACITY = 14, 1024
#: Texts of a hash with more rows or characters than these are combined before they go to their owner, in
#: SALTS parts. The list of such hashes is broadcast: the HOT_HASHES largest at most (any other has less than 1/HOT_HASHES of all characters).
HOT_ROWS, HOT_CHARS, HOT_HASHES, SALTS = 1000, 1 << 24, 10_000, 16
#: The cells and the directory have at most 2^MAX_DEPTH and twice as many rows: files that each is written to, at most.
SMALL_FILES = 4


def hash_of(text):
    """Hash of a normalised text; its top bits are the way through the directory."""
    return F.xxhash64(text)


def _keyed(docs: DataFrame, pointers: DataFrame) -> DataFrame:
    """All columns, with the normalised text's hash, digest and bucket as `_h`, `_sha`, `_bucket`, and `_part`, the task that read the row."""
    text = common.lower_ascii(common.text_of())
    keyed = docs.withColumns({"_h": hash_of(text), "_sha": F.sha2(text.cast("binary"), 256), "_part": F.spark_partition_id()})
    return _placed(keyed, pointers)


def _placed(rows: DataFrame, pointers: DataFrame) -> DataFrame:
    """Rows with the bucket that the directory gives their hash."""
    return rows.withColumn("_cell", _cell()).join(F.broadcast(pointers), "_cell").drop("_cell")


def _cell(depth: int = MAX_DEPTH):
    """Top `depth` bits of the hash."""
    return F.shiftrightunsigned(F.col("_h"), 64 - depth) if depth else F.lit(0).cast("long")


def build_directory(cells: DataFrame, capacity: int) -> DataFrame:
    """Buckets of an extendible hash: `depth` (local depth), `prefix`, `entries`.

    `cells`: entries by cell of the deepest directory. A prefix is a bucket if it is
    not overfull and the prefix it was split from is; at MAX_DEPTH overfull buckets
    stay and chain on.
    """
    # one doubling after another: the load of every prefix at every depth
    loads = (cells.select(F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH))).alias("depth"), "cell", "entries")
             .withColumn("prefix", F.expr(f"shiftright(cell, {MAX_DEPTH} - depth)"))
             .groupBy("depth", "prefix").agg(F.sum("entries").alias("entries")))
    split = (loads.where((F.col("entries") > capacity) & (F.col("depth") < MAX_DEPTH))
             .select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")))
    root = cells.sparkSession.range(1).select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))
    return (loads.join(split.unionByName(root), ["depth", "prefix"], "left_semi")
            .where((F.col("entries") <= capacity) | (F.col("depth") == MAX_DEPTH)))


def _pointers(buckets: DataFrame) -> DataFrame:
    """The directory's cells and the bucket each points to: 2^(MAX_DEPTH - depth) cells share one; 2^MAX_DEPTH rows in all."""
    return buckets.select(F.struct("depth", "prefix").alias("_bucket"), F.explode(F.expr(
        f"sequence(shiftleft(prefix, {MAX_DEPTH} - depth), shiftleft(prefix + 1, {MAX_DEPTH} - depth) - 1)")).alias("_cell"))


def build_index(docs: DataFrame, path: str, min_capacity: int = MIN_CAPACITY, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Write the index under `path` and return its entries.

    `path`/entries: _h, _sha, chain, group_size, keep_id, tied (the hash has rows that share
    their doc_id), prefix and depth of the bucket. `path`/directory: the buckets.
    """
    spark = docs.sparkSession
    norm = common.lower_ascii(common.text_of())
    texts = docs.select(hash_of(norm).alias("_h"), norm.alias("_text"), F.col("doc_id").cast("long").alias("doc_id"))

    (texts.groupBy("_h", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("_text")).alias("chars"))
     .groupBy("_h").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), (F.max("n") > 1).alias("tied"))
     .write.mode("overwrite").parquet(f"{path}/hashes"))
    hashes = spark.read.parquet(f"{path}/hashes")
    # at most 2^MAX_DEPTH rows, stored so that each doubling reads the counts only
    hashes.groupBy(_cell().alias("cell")).agg(F.count(F.lit(1)).alias("entries")).coalesce(SMALL_FILES).write.mode("overwrite").parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells")
    total = cells.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0]
    capacity = max(min_capacity, 2 * (total >> MAX_DEPTH))
    build_directory(cells, capacity).coalesce(SMALL_FILES).write.mode("overwrite").parquet(f"{path}/directory")
    placed = _placed(texts, _pointers(spark.read.parquet(f"{path}/directory")))

    hot = (hashes.where((F.col("n") > hot_rows) | ((F.col("n") > 1) & (F.col("chars") > HOT_CHARS)))
           .orderBy(F.desc("chars")).limit(HOT_HASHES).select("_h"))
    hot.write.mode("overwrite").parquet(f"{path}/hot")
    hot = spark.read.parquet(f"{path}/hot")
    arriving = placed.withColumns({"n": F.lit(1).cast("long"), "tied": F.lit(False)})
    if not hot.isEmpty():
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")
        combined = (placed.join(F.broadcast(hot), "_h", "left_semi").groupBy("_bucket", "_h", "_text", salt)
                    .agg(F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).drop("salt").withColumn("tied", F.lit(False)))
        arriving = arriving.join(F.broadcast(hot), "_h", "left_anti").unionByName(combined)

    # a row without a text marks a hash as tied
    marks = _placed(hashes.where("tied").select("_h", F.lit(None).cast("string").alias("_text"), F.lit(None).cast("long").alias("doc_id"),
                                                F.lit(0).cast("long").alias("n"), "tied"), _pointers(spark.read.parquet(f"{path}/directory")))
    # owners hold whole buckets; what follows needs no other exchange
    chain = Window.partitionBy("_bucket", "_h")
    owned = (arriving.unionByName(marks).repartition("_bucket")
             .withColumn("tied", F.max("tied").over(chain)).where(F.col("_text").isNotNull())
             .withColumn("chain", F.dense_rank().over(chain.orderBy("_text")))
             .withColumn("_sha", F.sha2(F.col("_text").cast("binary"), 256))
             .groupBy("_bucket", "_h", "chain", "_sha").agg(F.sum("n").alias("group_size"), F.max("doc_id").alias("keep_id"), F.max("tied").alias("tied"))
             # two texts with one digest could not be told apart when looking up
             .withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy("_bucket", "_h", "_sha")))
             .withColumn("chain", F.when(F.col("_same") == 1, F.col("chain")).otherwise(
                 F.raise_error(F.lit("different texts share hash and SHA-256")).cast("int"))))
    (owned.select("_h", "_sha", "chain", "group_size", "keep_id", "tied", "_bucket.prefix", "_bucket.depth")
     .write.mode("overwrite").parquet(f"{path}/entries"))
    return spark.read.parquet(f"{path}/entries")


def _indexed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells' pointers and the entries of a new index of `docs`."""
    path = scratch_path(docs.sparkSession, "exact-index")
    entries = build_index(docs, path).select(F.struct("depth", "prefix").alias("_bucket"), "_h", "_sha", "group_size", "keep_id", "tied")
    return _pointers(docs.sparkSession.read.parquet(f"{path}/directory")), entries


def _first_of(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one text and doc_id, with `_first`: true for one row of each text.

    Each task that read such rows names one, by a hash of `columns`, and of these one stays; a hot
    text's rows spread over the tasks that read them.
    """
    order = F.xxhash64(*columns) if columns else F.lit(0)
    own = Window.partitionBy("_h", "_sha", "_part").orderBy(order)
    rows = rows.withColumn("_named", F.row_number().over(own) == 1)
    named = rows.where("_named").withColumn("_first", F.row_number().over(Window.partitionBy("_h", "_sha").orderBy("_part")) == 1)
    return named.unionByName(rows.where("not _named").withColumn("_first", F.lit(False))).drop("_named")


def _hashable(docs: DataFrame) -> list[str]:
    """Columns that order rows which share text and doc_id (maps and variants have no hash)."""
    return [f.name for f in docs.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]


def find_duplicates(docs: DataFrame) -> DataFrame:
    """All columns of `docs` plus keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
    equal texts the row with the largest doc_id stays; null doc_ids are smaller than
    any other. Every row comes back, repeated rows too; among rows that tie for the
    place (same text and doc_id) exactly one is kept. Columns of the input with one
    of the new names, or named tied or like a helper (_h, _sha, _bucket, _cell, _part, _named, _first), give way. An empty table gives an
    empty result.
    """
    new = {"keep_id", "group_size", "kept", "text_sha256", "tied", "_h", "_sha", "_bucket", "_cell", "_part", "_named", "_first"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    pointers, entries = _indexed(docs)
    found = _keyed(docs, pointers).join(entries, ["_bucket", "_h", "_sha"])
    top = F.col("doc_id").cast("long").eqNullSafe(F.col("keep_id"))
    # only rows whose hash has a repeated doc_id can tie for the place
    if entries.where("tied").isEmpty():
        found = found.withColumn("kept", top)
    else:
        tie = top & F.col("tied")
        found = (found.where(~tie).withColumn("kept", top)
                 .unionByName(_first_of(found.where(tie), _hashable(docs)).withColumnRenamed("_first", "kept")))
    return found.withColumnRenamed("_sha", "text_sha256").drop("_bucket", "_h", "_part", "tied")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with its own columns (see `find_duplicates`).

    Rows meet their keeper's entry by doc_id, bucket, hash and digest, so the rows of a large
    group of copies spread over all tasks; whole rows are shuffled once.
    """
    mine = docs.columns
    pointers, entries = _indexed(docs)
    inner = docs.select(F.struct(*mine).alias("_row"), F.col("doc_id").cast("long").alias("_id"), common.text_of().alias("text"),
                        (F.xxhash64(*_hashable(docs))).alias("_order"))
    keyed = _keyed(inner, pointers).drop("text")
    same = F.col("_id").eqNullSafe(F.col("keep_id"))
    for c in ("_bucket", "_h", "_sha"):
        same = same & (keyed[c] == entries[c])
    kept = keyed.join(entries.select("_bucket", "_h", "_sha", "keep_id", "tied"), same).select("_row", "_order", keyed["_h"], keyed["_sha"], "_part", "tied")
    if entries.where("tied").isEmpty():
        return kept.select("_row.*")
    return (kept.where("not tied").select("_row").unionByName(
        _first_of(kept.where("tied"), ["_order"]).where("_first").select("_row")).select("_row.*"))


def op2_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of all documents."""
    found = find_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
           from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from d window w as (partition by t)
"""
