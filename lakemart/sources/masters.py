"""Master tables, from a database over JDBC or from files, and queries over both kinds of source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# The masters' columns.
SCHEMAS = {
    "stores": "store_id string, store_name string, address_line string, city string, state string, region string, "
              "floor_area_sqft int, opened_on date",
    "product_categories": "category_id string, category_name string, department string, gst_rate decimal(4,3)",
    "products": "product_sk bigint, product_code string, product_name string, category_id string, brand string, "
                "pack_size string, uom string, valid_from date, valid_to date, is_current boolean",
    "price_revisions": "revision_id bigint, product_sk bigint, mrp decimal(12,2), selling_price decimal(12,2), "
                       "effective_from date, effective_to date",
}


def read_master(
    spark: SparkSession, name: str, *, url: str | None = None, folder: str | None = None,
    columns: Sequence[str] | None = None, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A master table from ``url`` (JDBC) or, as CSV with a header, from ``folder``.

    Column selection and filters reach the database; ``options`` carries credentials and, for a table that
    is large, ``partitionColumn`` with its bounds so that many tasks read it.
    """
    if url is not None:
        table = spark.read.format("jdbc").options(url=url, dbtable=name, **(options or {})).load()
    else:
        table = spark.read.schema(SCHEMAS[name]).option("header", True).csv(f"{folder}/{name}.csv")
    return table.select(*columns) if columns else table


def register(views: Mapping[str, DataFrame]) -> None:
    """Make frames of any source known by name, for SQL across them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
