"""Registered queries over images and embedded assets."""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.config import CLASS_NAMES
from papertrove.functions import media
from papertrove.operators import assets, scoring
from papertrove.operators.documents import explode_structs
from papertrove.plans import jobs, samples
from papertrove.plans.oracle_parts import path_sql, stem_sql
from papertrove.plans.registry import registered
from papertrove.sources.files import source_path
from papertrove.sources.storage import work_folder
from papertrove.sources.tables import load, load_spread

WITH_FILES = f"WITH {samples.FILE_BYTES_SQL}"

# Size of the header where its format declares one, and the size after fitting into 1120 pixels.
WITH_SIZES = f"""{WITH_FILES},
sizes AS (
  SELECT doc_id, mime, CAST(w AS INTEGER) AS width, CAST(h AS INTEGER) AS height,
         CASE WHEN w > h THEN 1120::DOUBLE / w ELSE 1120::DOUBLE / h END AS f
  FROM typed WHERE mime IN ('image/png', 'image/gif', 'image/jpeg')),
fitted AS (
  SELECT doc_id, mime, width, height,
         CASE WHEN width < 1120 AND height < 1120 THEN width ELSE CAST(floor(width * f) AS INTEGER) END AS fit_width,
         CASE WHEN width < 1120 AND height < 1120 THEN height ELSE CAST(floor(height * f) AS INTEGER) END AS fit_height
  FROM sizes)"""

EXTENSION_SQL = """CASE mime WHEN 'image/jpeg' THEN '.jpg' WHEN 'image/png' THEN '.png' WHEN 'image/gif' THEN '.gif'
       WHEN 'image/bmp' THEN '.bmp' WHEN 'image/tiff' THEN '.tiff' WHEN 'application/pdf' THEN '.pdf'
       WHEN 'application/zip' THEN '.zip' WHEN 'application/gzip' THEN '.gz'
       WHEN 'application/vnd.apache.parquet' THEN '.parquet' END"""


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    files = samples.file_bytes(spark, folder)
    return files.withColumn("mime_type", media.sniff_mime(F.col("source_content")))


def _inventory(spark: SparkSession, folder: str) -> DataFrame:
    found = assets.image_inventory(samples.file_bytes(spark, folder).select("doc_id", "source_content"))
    size, fit = F.col("original_image_size"), F.col("resized_image_size")
    return found.select(
        "doc_id", "mime_type", size[0].alias("width"), size[1].alias("height"),
        fit[0].alias("fit_width"), fit[1].alias("fit_height"),
    )


@registered(f"{WITH_FILES} SELECT doc_id, mime AS mime_type FROM typed")
def sniff_mime(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark, folder).select("doc_id", "mime_type")


@registered(f"{WITH_FILES} SELECT doc_id, mime AS mime_type, {EXTENSION_SQL} AS extension FROM typed")
def mime_extension(spark: SparkSession, folder: str) -> DataFrame:
    typed = _typed(spark, folder).select("doc_id", "mime_type")
    return typed.withColumn("extension", media.mime_extension(F.col("mime_type")))


@registered(f"{WITH_FILES} SELECT doc_id, mime AS mime_type FROM typed WHERE mime LIKE 'image/%'")
def image_only(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark, folder).where(media.is_image(F.col("mime_type"))).select("doc_id", "mime_type")


@registered(f"""{WITH_SIZES}
SELECT t.doc_id, t.mime AS mime_type, width, height, fit_width, fit_height
FROM typed t LEFT JOIN fitted USING (doc_id)""")
def image_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return _inventory(spark, folder)


@registered(f"""{WITH_SIZES}
SELECT doc_id, width, height FROM fitted
WHERE width BETWEEN 500 AND 2000 AND height BETWEEN 375 AND 1500""")
def size_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = assets.image_inventory(samples.file_bytes(spark, folder).select("doc_id", "source_content"))
    return assets.diagrams_only(found).select("doc_id", "width", "height")


@registered(f"""
WITH sized AS (SELECT doc_id, {samples.WIDTH} AS w, {samples.HEIGHT} AS h FROM documents),
scaled AS (SELECT *, CASE WHEN w > h THEN 1120::DOUBLE / w ELSE 1120::DOUBLE / h END AS f FROM sized)
SELECT doc_id, CAST(w AS INTEGER) AS width, CAST(h AS INTEGER) AS height,
       CAST(CASE WHEN w < 1120 AND h < 1120 THEN w ELSE floor(w * f) END AS INTEGER) AS fit_width,
       CAST(CASE WHEN w < 1120 AND h < 1120 THEN h ELSE floor(h * f) END AS INTEGER) AS fit_height FROM scaled""")
def fit_within(spark: SparkSession, folder: str) -> DataFrame:
    sized = load(spark, folder, "documents").select(
        "doc_id", F.expr(f"int({samples.WIDTH})").alias("width"), F.expr(f"int({samples.HEIGHT})").alias("height")
    )
    fitted = media.fit_within(F.col("width"), F.col("height"))
    return sized.withColumn("_fit", fitted).select(
        "doc_id", "width", "height", F.col("_fit")[0].alias("fit_width"), F.col("_fit")[1].alias("fit_height")
    )


@registered(f"{WITH_FILES} SELECT doc_id, base64(content) AS encoded FROM files")
def base64_encode(spark: SparkSession, folder: str) -> DataFrame:
    return samples.file_bytes(spark, folder).select("doc_id", media.to_base64(F.col("source_content")).alias("encoded"))


@registered(f"{WITH_FILES} SELECT doc_id, octet_length(content) AS n_bytes, md5(content) AS digest FROM files")
def base64_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    files = samples.file_bytes(spark, folder)
    back = files.select("doc_id", media.from_base64(media.to_base64(F.col("source_content"))).alias("back"))
    return back.select("doc_id", F.octet_length("back").cast("long").alias("n_bytes"), F.md5("back").alias("digest"))


@registered(f"""{WITH_FILES}
SELECT doc_id, 'data:' || mime || ';base64,' || base64(content) AS url FROM typed WHERE mime LIKE 'image/%'""")
def data_url(spark: SparkSession, folder: str) -> DataFrame:
    images = _typed(spark, folder).where(media.is_image(F.col("mime_type")))
    return images.select("doc_id", media.data_url(F.col("mime_type"), media.to_base64(F.col("source_content"))).alias("url"))


LINKS_SQL = """
links AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '(?:href|src)="([^"]*)"', 1)) AS asset,
         generate_subscripts(regexp_extract_all(html, '(?:href|src)="([^"]*)"', 1), 1) AS ordinal FROM pages)"""


@registered(f"""WITH {LINKS_SQL}
SELECT page_id, asset, 1 AS page_number, CAST(ordinal AS INTEGER) AS ordinal FROM links""")
def asset_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = load_spread(spark, folder, "pages").select("page_id", "html")
    return explode_structs(pages, assets.linked_assets(F.col("html")), drop=["html"])


@registered(f"""WITH {LINKS_SQL}, named AS (
  SELECT {path_sql('url')} AS source_path, asset, ordinal,
         regexp_extract(asset, '(\\.[A-Za-z0-9]+)(?:[?#].*)?$', 1) AS ext FROM links)
SELECT source_path, asset, 1 AS page_number, CAST(ordinal AS INTEGER) AS ordinal, ext AS image_ext,
       '/assets/' || {stem_sql("regexp_replace(source_path, '[?#].*$', '')")} || '-' || left(md5(source_path), 8)
       || '-page1-index' || ordinal || ext AS image_path
FROM named""")
def asset_path(spark: SparkSession, folder: str) -> DataFrame:
    pages = load(spark, folder, "pages").select(source_path("url").alias("source_path"), "html")
    return assets.asset_table(pages, "/assets")


@registered(f"""{WITH_FILES}
SELECT regexp_extract(source_path, '([^/]*)$', 1) AS file_name, 'success' AS status,
       octet_length(content) AS n_bytes, md5(content) AS digest FROM files""")
def save_assets(spark: SparkSession, folder: str) -> DataFrame:
    """Every file written to the shared folder, with its report, and read back as bytes."""
    target = work_folder(spark, "saved-assets")
    files = samples.file_bytes(spark, folder).select(
        F.concat(F.lit(target), "source_path").alias("path"), "source_content"
    )
    name = F.regexp_extract("path", "([^/]*)$", 1).alias("file_name")
    report = assets.save_assets(files, "path", "source_content", shared=True).select(name, "status")
    written = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target)
    written = written.select(name, F.col("length").alias("n_bytes"), F.md5("content").alias("digest"))
    return report.join(written, "file_name", "left")


@registered(f"""{WITH_SIZES},
images AS (
  SELECT t.source_path, t.mime, width, height, fit_width, fit_height, content, octet_length(content) AS n,
         {EXTENSION_SQL.replace('CASE mime', 'CASE t.mime')} AS ext
  FROM typed t LEFT JOIN fitted f USING (doc_id) WHERE t.mime LIKE 'image/%'),
scored AS (
  SELECT *, list_value({', '.join(f"'{c}'" for c in CLASS_NAMES)})[CAST(n % {len(CLASS_NAMES)} AS INTEGER) + 1] AS class
  FROM images)
SELECT source_path, mime AS image_mime_type, 1 AS page_number, 1 AS ordinal, width, height, fit_width, fit_height,
       '/images/' || {stem_sql('source_path')} || '-' || left(md5(source_path), 8) || '-page1-index1' || ext AS image_path,
       n || ' bytes' AS image_caption, class AS image_classification,
       md5(base64(content)) AS encoded_digest,
       'Summarize this image of a ' || class || ' using the provided tools.'
       || CASE WHEN class = 'map' THEN ' Instructions: Name the places.' ELSE ' Instructions: Be brief.' END AS summary_prompt
FROM scored""")
def process_assets(spark: SparkSession, folder: str) -> DataFrame:
    """The image job on files of mixed types: extract, size, encode, name, caption, classify, prompt."""
    files = samples.file_bytes(spark, folder).select("source_path", "source_content")
    typed = files.withColumn("source_mime_type", media.sniff_mime(F.col("source_content")))
    images = explode_structs(
        typed, assets.extract_images(F.col("source_content"), F.col("source_mime_type")), drop=["source_content"]
    )
    images = assets.describe_images(images, "/images")
    names = list(CLASS_NAMES)
    images = scoring.score_batches(
        images, ["extracted_image"], "_caption", T.StringType(), lambda: lambda content: f"{len(content)} bytes"
    )
    images = scoring.score_batches(
        images, ["extracted_image"], "_class", T.StringType(), lambda: lambda content: names[len(content) % len(names)]
    )
    images = images.withColumns(
        {"image_caption": F.col("_caption.value"), "image_classification": F.col("_class.value")}
    )
    prompts = {"default": "Be brief.", "map": "Name the places."}
    classes = [(name, prompts.get(name)) for name in names]
    images = scoring.build_prompt(images, "image_classification", classes)
    size, fit = F.col("original_image_size"), F.col("resized_image_size")
    return images.select(
        "source_path", "image_mime_type", "page_number", "ordinal",
        size[0].alias("width"), size[1].alias("height"), fit[0].alias("fit_width"), fit[1].alias("fit_height"),
        "image_path", "image_caption", "image_classification",
        F.md5(media.to_base64(F.col("extracted_image")).cast("binary")).alias("encoded_digest"), "summary_prompt",
    )


@registered(f"""{WITH_SIZES}
SELECT t.doc_id, t.mime AS image_mime_type, CAST(n AS INTEGER) AS ordinal, {EXTENSION_SQL} AS image_ext,
       octet_length(content) AS n_bytes, md5(content) AS digest,
       width BETWEEN 500 AND 2000 AND height BETWEEN 375 AND 1500 AS is_diagram
FROM typed t JOIN fitted f USING (doc_id, mime), (VALUES (1), (2)) AS twice(n)""")
def inline_images(spark: SparkSession, folder: str) -> DataFrame:
    """Images inside the pages themselves, with attributes in several forms, decoded and measured."""
    typed = _typed(spark, folder).where(media.is_image(F.col("mime_type")))
    url = media.data_url(F.col("mime_type"), media.to_base64(F.col("source_content")))
    html = F.concat(F.lit("<p><img alt='a' src=\""), url, F.lit('"></p><IMG SRC = \''), url, F.lit("'><img src=/other.png>"))
    images = explode_structs(typed.select("doc_id", html.alias("html")), assets.inline_images(F.col("html")), drop=["html"])
    size = media.image_size(F.col("extracted_image"), F.col("image_mime_type"))
    sized = images.withColumn("size", size)
    return sized.select(
        "doc_id", "image_mime_type", "ordinal", "image_ext",
        F.octet_length("extracted_image").cast("long").alias("n_bytes"), F.md5("extracted_image").alias("digest"),
        media.is_diagram(F.col("size")[0], F.col("size")[1]).alias("is_diagram"),
    )


@registered(f"""{WITH_SIZES},
images AS (
  SELECT t.source_path, t.mime, content, octet_length(content) AS n, {EXTENSION_SQL.replace('CASE mime', 'CASE t.mime')} AS ext,
         list_value({', '.join(f"'{c}'" for c in CLASS_NAMES)})[CAST(octet_length(content) % {len(CLASS_NAMES)} AS INTEGER) + 1] AS class
  FROM typed t WHERE t.mime LIKE 'image/%')
SELECT source_path, mime AS source_mime_type, n AS source_length,
       '/images/' || {stem_sql('source_path')} || '-' || left(md5(source_path), 8) || '-page1-index1' || ext AS image_path,
       mime AS image_mime_type, class AS image_classification, n || ' bytes' AS image_caption, 1 AS page_number, 1 AS ordinal,
       md5('Summarize this image of a ' || class || ' using the provided tools.'
       || CASE WHEN class = 'map' THEN ' Instructions: Name the places.' ELSE ' Instructions: Be brief.' END
       || 'data:' || mime || ';base64,' || base64(content)) AS content
FROM images""")
def image_index(spark: SparkSession, folder: str) -> DataFrame:
    """The image job's own functions, with models that answer by what they are given: describe, score, project."""
    files = samples.file_bytes(spark, folder).select(
        "source_path",
        media.sniff_mime(F.col("source_content")).alias("source_mime_type"),
        F.lit(None).cast("timestamp").alias("source_modification_time"),
        F.octet_length("source_content").cast("long").alias("source_length"),
        "source_content",
    )
    images = explode_structs(
        files, assets.extract_images(F.col("source_content"), F.col("source_mime_type")), drop=["source_content"]
    )
    prompts = {"default": "Be brief.", "map": "Name the places."}
    scored = jobs.score_images(
        assets.describe_images(images, "/images"),
        [(name, prompts.get(name)) for name in CLASS_NAMES],
        lambda: lambda content: f"{len(content)} bytes",
        lambda: lambda url, names: names[len(base64.b64decode(url.partition(",")[2])) % len(names)],
        lambda: lambda prompt, url: hashlib.md5((prompt + url).encode()).hexdigest(),
    )
    return assets.image_index_projection(scored).drop(
        "source_modification_time", "original_image_size", "resized_image_size"
    )
