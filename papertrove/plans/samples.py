"""Inputs derived from the given tables, row by row, with the same derivation in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.sources.tables import load, load_spread

# Width and height that a document's image header declares.
WIDTH = "(n_chars * 7 + doc_id) % 3000 + 1"
HEIGHT = "(n_chars * 3 + doc_id * 11) % 2000 + 1"


def file_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a file: a header of one of five types, then the whole text.

    PNG, GIF and JPEG headers declare a width and a height; PDF has a magic number only and the fifth type has none.
    """

    def digits(name: str, n: int):
        return F.lpad(F.hex(F.col(name)), n, "0")

    def little(name: str):
        return F.concat(F.substring(digits(name, 4), 3, 2), F.substring(digits(name, 4), 1, 2))

    comment = F.concat(F.lpad(F.hex(F.length("source") + 2), 4, "0"), F.hex("source"))
    header = (
        F.when(F.col("kind") == 0, F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), digits("w", 8), digits("h", 8)))
        .when(F.col("kind") == 1, F.concat(F.lit("474946383961"), little("w"), little("h")))
        .when(
            F.col("kind") == 2,
            F.concat(F.lit("FFD8FFE000104A46494600010100000100010000FFFE"), comment,
                     F.lit("FFC0001108"), digits("h", 4), digits("w", 4)),
        )
        .when(F.col("kind") == 3, F.lit("255044462D312E37"))
        .otherwise("")
    )
    texts = load_spread(spark, folder, "documents", "doc_id", "text", "source", "n_chars")
    sized = texts.select(
        "doc_id", "text", "source",
        F.format_string("/files/%s/doc.%d.bin", "source", "doc_id").alias("source_path"),
        F.expr("cast(doc_id % 5 as int)").alias("kind"),
        F.expr(WIDTH).alias("w"), F.expr(HEIGHT).alias("h"),
    )
    return sized.select(
        "doc_id", "source_path", F.concat(F.unhex(header), F.encode("text", "utf-8")).alias("source_content")
    )


FILE_BYTES_SQL = f"""
sized AS (
  SELECT doc_id, text, source, doc_id % 5 AS kind, {WIDTH} AS w, {HEIGHT} AS h,
         '/files/' || source || '/doc.' || doc_id || '.bin' AS source_path
  FROM documents
),
files AS (
  SELECT doc_id, source_path, kind, w, h,
    unhex(CASE kind
      WHEN 0 THEN '89504E470D0A1A0A0000000D49484452' || printf('%08X', w) || printf('%08X', h)
      WHEN 1 THEN '474946383961' || printf('%02X%02X', w % 256, w // 256) || printf('%02X%02X', h % 256, h // 256)
      WHEN 2 THEN 'FFD8FFE000104A46494600010100000100010000FFFE' || printf('%04X', length(source) + 2)
                  || hex(source) || 'FFC0001108' || printf('%04X', h) || printf('%04X', w)
      WHEN 3 THEN '255044462D312E37'
      ELSE '' END) || encode(text) AS content
  FROM sized
),
typed AS (
  SELECT *, CASE WHEN hex(content) LIKE '89504E470D0A1A0A%' THEN 'image/png'
                 WHEN hex(content) LIKE '47494638%' THEN 'image/gif'
                 WHEN hex(content) LIKE 'FFD8FF%' THEN 'image/jpeg'
                 WHEN hex(content) LIKE '424D%' THEN 'image/bmp'
                 WHEN hex(content) LIKE '49492A00%' OR hex(content) LIKE '4D4D002A%' THEN 'image/tiff'
                 WHEN hex(content) LIKE '25504446%' THEN 'application/pdf'
                 WHEN hex(content) LIKE '504B0304%' THEN 'application/zip'
                 WHEN hex(content) LIKE '1F8B08%' THEN 'application/gzip'
                 WHEN hex(content) LIKE '50415231%' THEN 'application/vnd.apache.parquet' END AS mime
  FROM files
)
"""


def snapshot(spark: SparkSession, folder: str, until: str | None = None) -> DataFrame:
    """Newest event of every (user, ``k`` of props) up to a moment; an ``error`` event removes its key."""
    from papertrove.operators.tables import latest_rows

    events = load(spark, folder, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"), "ts", "event_id", "event_type", "value"
    )
    if until:
        events = events.where(F.col("ts") <= F.lit(until).cast("timestamp_ntz"))
    newest = latest_rows(events, ["user_id", "k"], ["ts", "event_id"])
    return newest.where(F.col("event_type") != "error").select("user_id", "k", "event_id", "event_type", "value")


def snapshot_sql(until: str | None = None) -> str:
    where = f"WHERE ts <= TIMESTAMP '{until}'" if until else ""
    return f"""
  SELECT user_id, k, event_id, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY ts DESC, event_id DESC) AS rn
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events {where}))
  WHERE rn = 1 AND event_type <> 'error'"""
