"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Arrow batches handed to Python stay under this many bytes, so one batch of
#: very long documents cannot outgrow a worker.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context (code only, through Spark's file service)."""
    context = spark.sparkContext
    if getattr(context, "_vigil_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="vigil-code-")) / "vigil-code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((root / "vigil").rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(archive))
    context._vigil_shipped = True


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: UTC, bounded Arrow batches, code on the executors."""
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """Whole text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have (inputs may carry any extra columns)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def by_range(df: DataFrame, column: str, parts: int) -> Column:
    """Number of the range, of `parts` nearly equal ones, that a long column falls into; 0 for null.

    The borders are quantiles of all values; equal values stay together.
    """
    cuts = df.select(F.col(column).cast("double").alias("d")).approxQuantile("d", [k / parts for k in range(1, parts)], 0.2 / parts)
    bounds = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]).cast("array<long>")
    return F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(column))), F.lit(0)).cast("int")


def python_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table],
                schema: str) -> DataFrame:
    """Run `fn` on every non-empty Arrow batch of `df` (one batch in memory at a time)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from (out.to_batches() if isinstance(out, pa.Table) else [out])
    return df.mapInArrow(run, schema)


def strings(column: pa.Array) -> list[str]:
    """Python texts of an Arrow column, null as empty."""
    return [x or "" for x in column.to_pylist()]
