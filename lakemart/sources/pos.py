"""Nightly till files: three dialects, the file-name contract, and one normalised line table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalars import MONEY


@dataclass(frozen=True)
class Dialect:
    """One till generation: its stores, separator and columns in file order."""

    name: str
    stores: tuple[str, ...]
    separator: str
    columns: tuple[str, ...]


# The three till generations, the column names that one of them uses, and the file-name patterns.
DIALECTS = (
    Dialect("A", ("S01", "S02", "S03", "S04", "S05"), ",",
            ("bill_no", "line_no", "product_code", "qty", "unit_price", "line_type", "ts")),
    Dialect("B", ("S06", "S07", "S08", "S09"), ";",
            ("bill_no", "line_no", "item_code", "quantity", "rate", "type", "txn_time")),
    Dialect("C", ("S10", "S11", "S12"), ",",
            ("ts", "bill_no", "line_no", "line_type", "product_code", "unit_price", "qty")),
)
#: How a store that is in no list writes.
OTHER_STORES = Dialect("other", (), ",", DIALECTS[0].columns)
RENAMES = {"item_code": "product_code", "quantity": "qty", "rate": "unit_price", "type": "line_type", "txn_time": "ts"}
FILE_NAME = r"^SALES_([A-Z0-9]+)_(\d{4})(\d{2})(\d{2})"
RESEND = r"__R(\d+)"
STAGED = ("bill_no", "line_no", "product_code", "qty", "unit_price", "line_type", "ts")


def local_timestamp(ts: Column) -> Column:
    """ISO text, ``dd-MM-yyyy HH:mm:ss`` text or UTC epoch seconds as local (Indian) wall-clock time.

    Unreadable text gives NULL; the session time zone plays no part.
    """
    turned = F.regexp_replace(ts, r"^(\d{2})-(\d{2})-(\d{4}) ", "$3-$2-$1 ")
    epoch = F.when(ts.rlike(r"^\d+$"), ts.try_cast("decimal(18,6)"))
    from_epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(5), F.lit(30), epoch
    )
    return F.coalesce(F.when(epoch.isNull(), turned.try_cast("timestamp_ntz")), from_epoch)


def file_contract(file_name: Column) -> dict[str, Column]:
    """Store, business date and re-send number from a file name; NULL when the name does not fit."""
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(file_name, FILE_NAME, i), F.lit(""))

    day = F.concat_ws("-", part(2), part(3), part(4)).try_cast("date")
    return {
        "store_id": part(1), "business_date": day,
        "resend_no": F.coalesce(F.nullif(F.regexp_extract(file_name, RESEND, 1), F.lit("")).cast("int"), F.lit(0)),
    }


def short_file_contract(file_name: Column) -> dict[str, Column]:
    """The same from ``<store>_<yyyymmdd>[_resend].<ext>`` names."""
    parts = F.split(F.regexp_replace(file_name, r"\.(csv|parquet)$", ""), "_")
    day = F.regexp_replace(F.get(parts, 1), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return {
        "store_id": F.get(parts, 0), "business_date": day.try_cast("date"),
        "resend_no": F.when(F.get(parts, 2).isNotNull(), 1).otherwise(0),
    }


def _glob(dialect: Dialect, extension: str) -> str:
    stores = f"{{{','.join(dialect.stores)}}}" if dialect.stores else "*"
    return f"SALES_{stores}_*.{extension}"


def _csv(spark: SparkSession, folder: str, dialect: Dialect, arriving: bool = False) -> DataFrame:
    """A till's files, or those that arrive; a header that names other columns, or the same in another order, fails the read."""
    schema = ", ".join(f"{c} string" for c in dialect.columns)
    return (
        (spark.readStream if arriving else spark.read).schema(schema).option("header", True).option("sep", dialect.separator).option("enforceSchema", False)
        .option("pathGlobFilter", _glob(dialect, "csv")).option("recursiveFileLookup", True).csv(folder)
    )


def _parquet(spark: SparkSession, folder: str, dialect: Dialect) -> DataFrame | None:
    try:
        return (
            spark.read.option("pathGlobFilter", _glob(dialect, "parquet")).option("recursiveFileLookup", True)
            .option("mergeSchema", True).parquet(folder)
        )
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no such file
            return None
        raise


def _staged(scan: DataFrame, dialect: Dialect, listed: list[str]) -> DataFrame:
    name = F.col("_metadata.file_name")
    if not dialect.stores:  # files of listed stores are left out before any is opened
        scan = scan.where(~name.rlike(f"^SALES_({'|'.join(listed) or '$.'})_"))
    part = scan.select("*", name.alias("file_name"), *[c.alias(n) for n, c in file_contract(name).items()])
    part = part.withColumnsRenamed(RENAMES)
    return part.select(*[F.col(c).cast("string").alias(c) for c in STAGED], "file_name", "store_id", "business_date", "resend_no")


def read_staging(
    spark: SparkSession, folder: str, dialects: tuple[Dialect, ...] = DIALECTS, default: Dialect = OTHER_STORES
) -> DataFrame:
    """All till files below a folder, CSV and Parquet, as text columns with their file's store, date and re-send.

    Stores that no dialect lists are read in the ``default`` one.
    """
    staged = None
    listed = [store for dialect in dialects for store in dialect.stores]
    for dialect in (*dialects, default):
        for scan in (_csv(spark, folder, dialect), _parquet(spark, folder, dialect)):
            if scan is None:
                continue
            part = _staged(scan, dialect, listed)
            staged = part if staged is None else staged.unionByName(part)
    return staged.where(F.col("business_date").isNotNull())


def _typed(staged: DataFrame) -> DataFrame:
    return staged.select(
        "bill_no", F.col("line_no").cast("int").alias("line_no"), "store_id", "product_code",
        F.col("qty").cast("int").alias("qty"), F.col("unit_price").cast("decimal(12,2)").alias("unit_price"),
        "line_type", "business_date", local_timestamp(F.col("ts")).alias("ts"), "resend_no", "file_name",
    )


def stream_lines(
    spark: SparkSession, folder: str, dialects: tuple[Dialect, ...] = DIALECTS, default: Dialect = OTHER_STORES
) -> DataFrame:
    """Typed lines of the CSV till files that arrive in a folder, in all dialects."""
    staged = None
    listed = [store for dialect in dialects for store in dialect.stores]
    for dialect in (*dialects, default):
        part = _staged(_csv(spark, folder, dialect, arriving=True), dialect, listed)
        staged = part if staged is None else staged.unionByName(part)
    return _typed(staged.where(F.col("business_date").isNotNull()))


def read_lines(spark: SparkSession, folder: str, dialects: tuple[Dialect, ...] = DIALECTS) -> DataFrame:
    """Typed till lines; the business date is the file's, whatever the time stamp says."""
    return _typed(read_staging(spark, folder, dialects))


LINE_KEYS = ("bill_no", "line_no")
# A total order: the original file before its re-sends, then the row's own content.
LINE_ORDER = ("resend_no", "file_name", "product_code", "qty", "unit_price", "line_type", "ts")


def unplaced_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose name does not fit the contract; they are reported, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file_name")).where(file_contract(name)["business_date"].isNull())


# --- the second variant --------------------------------------------------------------------------------

SHORT_SCHEMA = (
    "bill_number string, store_code string, product_code string, quantity int, unit_price decimal(12,2), "
    "line_type string, timestamp timestamp_ntz, sale_date date"
)
SHORT_KEYS = ("bill_number", "product_code", "timestamp")
SHORT_ORDER = ("resend_no", "file_name", "store_code", "quantity", "unit_price", "line_type", "sale_date")


def read_short_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Till lines of the variant with one dialect, CSV and Parquet files together."""
    reader = spark.read.option("recursiveFileLookup", True)
    csv = reader.schema(SHORT_SCHEMA).option("header", True).option("pathGlobFilter", "*.csv").csv(folder)
    parts = [csv]
    try:
        found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(folder)
        parts.append(found)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    lines = None
    for part in parts:
        name = F.col("_metadata.file_name")
        typed = part.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in csv.schema.fields],
            name.alias("file_name"), short_file_contract(name)["resend_no"].alias("resend_no"),
        )
        lines = typed if lines is None else lines.unionByName(typed)
    return lines


# --- finance -------------------------------------------------------------------------------------------

def read_finance(spark: SparkSession, path: str) -> DataFrame:
    """``month, finance_revenue`` (and sign-off columns, if any) from a totals file, with or without a text preamble.

    Data rows are those that begin with a month; a header or preamble line does not.
    """
    fields = F.from_csv("value", "a string, b string, c string, d string", {"mode": "PERMISSIVE"})
    rows = spark.read.text(path).where(F.col("value").rlike(r"^\d{4}-\d{2},")).select(fields.alias("f"))
    rows = rows.select(F.array("f.a", "f.b", "f.c", "f.d").alias("c"))
    wide = F.get("c", 3).isNotNull()
    return rows.select(
        F.get("c", 0).alias("month"),
        F.when(wide, F.get("c", 1)).try_cast("date").alias("closed_on"),
        F.when(wide, F.get("c", 2)).otherwise(F.get("c", 1)).cast(MONEY).alias("finance_revenue"),
        F.when(wide, F.get("c", 3)).alias("signed_off_by"),
    )
