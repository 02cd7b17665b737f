"""What the optimiser did with a plan, as rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fields of a formatted plan that show pushed-down work, and the operators that show joins.
FIELDS = ("PushedFilters", "PartitionFilters", "ReadSchema", "Batched", "Location")


def plan_evidence(df: DataFrame) -> DataFrame:
    """One row per operator property of the physical plan: pushed filters, pruned partitions, read columns, joins."""
    view = f"evidence_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    text = df.sparkSession.sql(f"EXPLAIN FORMATTED SELECT * FROM {view}")
    lines = text.select(F.posexplode(F.split("plan", "\n")).alias("line_no", "line"))
    header = F.regexp_extract("line", r"^\((\d+)\) (\S.*?)\s*(\[codegen id.*)?$", 2)
    field = F.regexp_extract("line", r"^(\w[\w ]*?)(?: \[\d+\])?: ?(.*)$", 1)
    value = F.regexp_extract("line", r"^(\w[\w ]*?)(?: \[\d+\])?: ?(.*)$", 2)
    details = lines.select("line_no", header.alias("node"), field.alias("property"), value.alias("value"))
    scans = details.where(F.col("property").isin(*FIELDS)).select("line_no", "property", "value")
    nodes = details.where(F.col("node") != "").select(
        "line_no", F.lit("Operator").alias("property"), F.col("node").alias("value")
    )
    return scans.unionByName(nodes).orderBy("line_no")
