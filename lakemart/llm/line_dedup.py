"""Line dedup over overlapping windows of consecutive lines.

The window at line j stands for its ``width`` lines, as 96 bits of hash. Windows that occur more than once anywhere are
found by a count; of their occurrences the first (lowest id, then lowest position) stays, and the lines that any later
one covers go. Counting and joining move hashes and positions; each text moves once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.workspace import durable

WIDTH = 3
_TRIMMED = " \t\r\f\x0b"


def _solid_lines(text: Column) -> Column:
    """Trimmed lines that are not blank."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(_TRIMMED)))
    return F.filter(lines, lambda x: x != "")


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``(doc_id, text_key, j, h, g)``: a row for each window; texts of fewer lines have none."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), _solid_lines(F.col(text_col)).alias("lines")
    ).where(F.size("lines") >= width)
    keys = F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("g")))
    hashed = lines.select("doc_id", "text_key", keys.alias("keys"))

    def window(i: Column) -> Column:
        own = [F.get("keys", i + k) for k in range(width)]
        return F.struct(F.xxhash64(*(k["h"] for k in own)).alias("h"), F.hash(*(k["g"] for k in own), *(k["h"] for k in own)).alias("g"))

    spots = F.transform(F.sequence(F.lit(0), F.size("keys") - width), window)
    return hashed.select("doc_id", "text_key", F.posexplode(spots).alias("j", "w")).select("doc_id", "text_key", "j", "w.h", "w.g")


def later_occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``(doc_id, text_key, j)``: the windows that occurred before, in an earlier row or higher up in the same text."""
    windows = line_windows(docs, id_col, text_col, width)
    repeated = durable(windows.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g"), "repeated-windows")
    places = durable(windows.join(repeated, ["h", "g"]), "window-places")
    place = F.struct("doc_id", "text_key", "j")
    first = durable(places.groupBy("h", "g").agg(F.min(place).alias("first")), "first-windows")
    return places.join(first, ["h", "g"]).where(place != F.col("first")).select("doc_id", "text_key", "j")


def later_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``(doc_id, text_key, starts)``: the windows of each text that occurred before, each once however often its row is repeated."""
    return later_occurrences(docs, id_col, text_col, width).groupBy("doc_id", "text_key").agg(F.collect_set("j").alias("starts"))


def remove_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
    kept_col: str = "n_lines", removed_col: str = "n_removed",
) -> DataFrame:
    """``docs`` with the text rid of lines that a later occurrence of a window covers, and two line counts added.

    Lines are compared trimmed; blank lines belong to no window and go only between removed lines. Texts of fewer than
    ``width`` lines, empty and null texts stay (counts 1 and 0; null texts 0 and 0). Rows with the same id and text are
    one occurrence and stay alike. A null id counts as the lowest. Other columns pass through.
    """

    @F.pandas_udf("text string, gone int")
    def without(text: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for whole, own in zip(text, starts):
            if whole is None or own is None:
                out.append((None, 0))
                continue
            lines = whole.split("\n")
            solid = [i for i, x in enumerate(lines) if x.strip(_TRIMMED)]
            kept, upto, gone = [], 0, 0
            for j in sorted(own.tolist()):
                begin, end = max(solid[j], upto), solid[j + width - 1] + 1
                kept += lines[upto:begin]
                gone += end - begin
                upto = end
            out.append(("\n".join(kept + lines[upto:]), gone))
        return pd.DataFrame(out, columns=["text", "gone"])

    starts = later_starts(docs, id_col, text_col, width).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("starts").alias("__starts"))
    text = F.col(text_col)
    joined = docs.join(starts, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key")), "left")
    hit = F.col("__starts").isNotNull()
    cleaned = joined.withColumn("__new", without(F.when(hit, text), "__starts"))
    all_lines = F.coalesce(F.size(F.split(text, "\n", -1)) * F.when(text.isNotNull(), 1), F.lit(0))
    return cleaned.withColumn(kept_col, all_lines - F.col("__new.gone")).withColumn(removed_col, F.col("__new.gone")).withColumn(
        text_col, F.when(hit, F.col("__new.text")).otherwise(text)
    ).drop("__new", "__starts", "__id", "__key")


ANSI = """
WITH lines AS (
  SELECT doc_id, i, string_split(text, chr(10))[i] AS line
  FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i) WHERE text IS NOT NULL),
solid AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) <> ''),
windows AS (
  SELECT a.doc_id, a.j, a.i AS first_i, c.i AS last_i, a.line || chr(10) || b.line || chr(10) || c.line AS w
  FROM solid a JOIN solid b ON b.doc_id = a.doc_id AND b.j = a.j + 1 JOIN solid c ON c.doc_id = a.doc_id AND c.j = a.j + 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, j) AS k FROM windows),
gone AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(first_i, last_i + 1)) AS i FROM ranked WHERE k > 1)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text, count(*) AS n
  FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST(coalesce(k.n, 0) AS INTEGER) AS n_lines, CAST(coalesce(g.n, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN lost g ON g.doc_id = d.doc_id"""
