"""Loan applications from header CSV read as text.

Every field is read as a string, then numbers are coerced with `try_cast`
(unparsable -> null), the usual missing-value tokens become null, and rows
without a loan id are dropped.  `coerce_loans` also works on CSV lines that
are already in a DataFrame (`from_csv`), so stream and file share it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schemas import LOAN_CSV_COLUMNS

# ---------------------------------------------------------------------------
# Text a pandas CSV reader treats as missing by default.
# ---------------------------------------------------------------------------
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ---------------------------------------------------------------------------

TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in LOAN_CSV_COLUMNS])


def _text(c: str, trim: bool) -> Column:
    v = F.trim(F.col(c)) if trim else F.col(c)
    return F.when(v.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(v)


def coerce_loans(df: DataFrame, trim: bool = False, extra: list[str] | None = None) -> DataFrame:
    """Text columns -> typed loan columns (and `extra` ones as they are); null id rows dropped."""
    t = {c: _text(c, trim) for c in LOAN_CSV_COLUMNS}
    out = df.select(
        t["loan_id"].alias("loan_id"),
        t["person_age"].try_cast("double").try_cast("short").alias("person_age"),
        t["person_income"].try_cast("double").alias("person_income"),
        t["loan_amnt"].try_cast("double").alias("loan_amnt"),
        t["loan_int_rate"].try_cast("double").alias("loan_int_rate"),
        t["loan_grade"].alias("loan_grade"),
        t["loan_intent"].alias("loan_intent"),
        t["loan_status"].try_cast("double").try_cast("short").alias("loan_status"),
        t["cb_person_default_on_file"].alias("cb_person_default_on_file"),
        *(extra or []),
    )
    return out.dropna(subset=["loan_id"])


def read_loans_csv(spark: SparkSession, path: str, trim: bool = False, position: str | None = None) -> DataFrame:
    """Header CSV, every column as text, then `coerce_loans`.

    `position` names a column that orders the rows as their files do: file name, place of the split, row.
    """
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .schema(TEXT_SCHEMA).csv(path))
    if position:
        raw = raw.withColumn(position, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                                F.monotonically_increasing_id().alias("row")))
    return coerce_loans(raw, trim, [position] if position else None)


def parse_loan_lines(lines: DataFrame, col: str = "value", trim: bool = False) -> DataFrame:
    """CSV lines (no header) in a string column -> typed loans."""
    ddl = ", ".join(f"{c} string" for c in LOAN_CSV_COLUMNS)
    parsed = lines.select(F.from_csv(F.col(col), ddl).alias("r")).select("r.*")
    return coerce_loans(parsed, trim)
