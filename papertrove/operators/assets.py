"""Images and embedded assets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papertrove.config import IMAGE_BATCH_ROWS, MAX_IMAGE_SIDE
from papertrove.functions import media
from papertrove.operators.documents import explode_structs
from papertrove.session import arrow_batch
from papertrove.sources.files import binary_source
from papertrove.sources.storage import default_file_system, open_folder, work_folder

# The columns of an image index before its text.
IMAGE_INDEX_COLUMNS = (
    "source_path",
    "source_mime_type",
    "source_modification_time",
    "source_length",
    "image_path",
    "image_mime_type",
    "image_classification",
    "image_caption",
    "page_number",
    "ordinal",
    "original_image_size",
    "resized_image_size",
)
# An attribute with a value in double quotes, single quotes or none, in either case; and what surrounds its value.
LINKED_ASSET = r"""(?i)\b(?:href|src)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
AROUND_ASSET = r"""(?i)^(?:href|src)\s*=\s*["']?|["']$"""
INLINE_IMAGE = r"""(?i)\bsrc\s*=\s*["']?data:(image/[a-z0-9.+-]+);base64,([A-Za-z0-9+/=\s]+)"""


def linked_assets(html: Column) -> Column:
    """Assets a web page refers to, as ``array<struct<asset, page_number, ordinal>>`` in order of appearance."""
    return F.transform(
        F.regexp_extract_all(html, F.lit(LINKED_ASSET), F.lit(0)),
        lambda asset, i: F.struct(
            F.regexp_replace(asset, AROUND_ASSET, "").alias("asset"), F.lit(1).alias("page_number"), (i + 1).cast("int").alias("ordinal")
        ),
    )


def inline_images(html: Column) -> Column:
    """Images that a web page holds itself, in the form of ``extract_images``; malformed base64 gives null bytes."""
    kinds, encoded = (F.regexp_extract_all(html, F.lit(INLINE_IMAGE), F.lit(group)) for group in (1, 2))
    return F.transform(
        F.arrays_zip(F.transform(kinds, F.lower).alias("kind"), encoded.alias("encoded")),
        lambda image, i: F.struct(
            media.from_base64(image["encoded"]).alias("extracted_image"),
            F.lit(1).alias("page_number"),
            (i + 1).cast("int").alias("ordinal"),
            image["kind"].alias("image_mime_type"),
            media.mime_extension(image["kind"]).alias("image_ext"),
        ),
    )


def extract_images(content: Column, mime_type: Column) -> Column:
    """An image file as its own only image, (page 1, ordinal 1); other types give no image."""
    image = F.struct(
        content.alias("extracted_image"),
        F.lit(1).alias("page_number"),
        F.lit(1).alias("ordinal"),
        mime_type.alias("image_mime_type"),
        media.mime_extension(mime_type).alias("image_ext"),
    )
    return F.when(media.is_image(mime_type), F.array(image))


def image_inventory(images: DataFrame, content: str = "source_content", max_side: int = MAX_IMAGE_SIDE) -> DataFrame:
    """Type, size and fitted size of image bytes; the bytes themselves are dropped."""
    bytes_ = F.col(content)
    keep = [c for c in images.columns if c != content]
    typed = images.select(*keep, content, media.sniff_mime(bytes_).alias("mime_type"))
    sized = typed.select(*keep, "mime_type", media.image_size(bytes_, F.col("mime_type")).alias("original_image_size"))
    size = F.col("original_image_size")
    return sized.withColumn("resized_image_size", media.fit_within(size[0], size[1], max_side))


def diagrams_only(images: DataFrame, size: str = "original_image_size") -> DataFrame:
    """Images within the diagram bounds, with ``width`` and ``height``; images without a size are left out.

    The test sits inside a generator. As a plain filter on the size it would be pushed below the projection that reads
    the headers and read them again for every comparison.
    """
    sides = F.array(F.struct(F.col(size)[0].alias("width"), F.col(size)[1].alias("height")))
    kept = F.filter(sides, lambda s: media.is_diagram(s["width"], s["height"]))
    return explode_structs(images, kept)


def image_files(files: DataFrame) -> DataFrame:
    """Binary file rows to one row per image. Bytes stay in the scan's own partition: there is no shuffle here."""
    source = binary_source(files).withColumn("source_mime_type", media.sniff_mime(F.col("source_content")))
    return explode_structs(
        source, extract_images(F.col("source_content"), F.col("source_mime_type")), drop=["source_content"]
    )


def describe_images(images: DataFrame, base: str, max_side: int = MAX_IMAGE_SIDE) -> DataFrame:
    """Sizes and target path of each image."""
    size = media.image_size(F.col("extracted_image"), F.col("image_mime_type"))
    return (
        images.withColumn("original_image_size", size)
        .withColumns(
            {
                "resized_image_size": media.fit_within(
                    F.col("original_image_size")[0], F.col("original_image_size")[1], max_side
                ),
                "image_path": media.asset_path(
                    F.col("source_path"), F.col("page_number"), F.col("ordinal"), F.col("image_ext"), base
                ),
            }
        )
    )


def image_index_projection(images: DataFrame, text_column: str = "image_summary") -> DataFrame:
    return images.select(*IMAGE_INDEX_COLUMNS, F.col(text_column).alias("content"))


def _save(path: str, content: bytes | None, default: str, made: set[str]) -> str | None:
    """Write one file; the error text when that fails, else none. A retried task overwrites its own earlier file.

    ``made`` remembers the folders this task has made sure of.
    """
    try:
        if content is None:
            return "no bytes"
        files, target = open_folder(path, default)
        folder = target.rpartition("/")[0]
        if folder not in made:
            files.create_dir(folder, recursive=True)
            made.add(folder)
        part = f"{target}.{uuid.uuid4().hex}.part"
        with files.open_output_stream(part) as out:
            out.write(content)
        files.move(part, target)
        return None
    except Exception as error:
        return str(error)


def save_assets(
    df: DataFrame, path_column: str, bytes_column: str, batch_rows: int = IMAGE_BATCH_ROWS, shared: bool = False
) -> DataFrame:
    """Write every row's bytes to its path now and return the report ``(path, status, error)``.

    This is an action: the files are written exactly when it is called, by the executors, and the report is read from
    the table the same job wrote, so that looking at it does not write the files again. A file is written under another
    name and moved, so a reader never sees half of it; one that fails is reported and does not stop the job.
    On a cluster, paths on the machines' own disks are refused unless ``shared`` says that all machines mount them.
    """
    spark = df.sparkSession
    default = default_file_system(spark)
    if default.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        local = df.where(~F.col(path_column).rlike("^[A-Za-z][A-Za-z0-9+.-]+:") | F.col(path_column).startswith("file:"))
        if not shared and not local.isEmpty():
            raise ValueError("paths on the machines' own disks: give paths with a scheme, or say that they are shared")

    def write_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: set[str] = set()
        for batch in batches:
            errors = [_save(p, b, default, made) for p, b in zip(batch[path_column], batch[bytes_column])]
            yield pd.DataFrame(
                {
                    "path": batch[path_column],
                    "status": ["success" if error is None else "error" for error in errors],
                    "error": pd.Series(errors, index=batch.index, dtype=object),
                }
            )

    report = work_folder(spark, "save-report")
    schema = "path string, status string, error string"
    with arrow_batch(spark, batch_rows):
        df.select(path_column, bytes_column).mapInPandas(write_files, schema).write.parquet(report)
    return spark.read.schema(schema).parquet(report)


def asset_table(pages: DataFrame, base: str, columns: Sequence[str] = ()) -> DataFrame:
    """``(source_path, html)`` rows to one row per linked asset with its type by name and its target path."""
    assets = explode_structs(pages, linked_assets(F.col("html")), drop=["html"])
    named = assets.withColumn("image_ext", F.regexp_extract("asset", r"(\.[A-Za-z0-9]+)(?:[?#].*)?$", 1))
    return named.withColumn(
        "image_path",
        media.asset_path(
            F.col("source_path"), F.col("page_number"), F.col("ordinal"), F.col("image_ext"), base, is_url=True
        ),
    ).select("source_path", "asset", "page_number", "ordinal", "image_ext", "image_path", *columns)
