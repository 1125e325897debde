"""File types, image headers and image names."""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.config import DIAGRAM_HEIGHT, DIAGRAM_WIDTH, MAX_IMAGE_SIDE

# Leading bytes (hex) of each file type, in the order they are tried; dots stand for any digit.
SIGNATURES = (
    ("FFD8FF", "image/jpeg"),
    ("89504E470D0A1A0A", "image/png"),
    ("474946383761", "image/gif"),
    ("474946383961", "image/gif"),
    ("424D........00000000....0000", "image/bmp"),
    ("49492A00", "image/tiff"),
    ("4D4D002A", "image/tiff"),
    ("25504446", "application/pdf"),
    ("504B0304", "application/zip"),
    ("1F8B08", "application/gzip"),
    ("50415231", "application/vnd.apache.parquet"),
)
EXTENSIONS = (
    ("image/jpeg", ".jpg"),
    ("image/png", ".png"),
    ("image/gif", ".gif"),
    ("image/bmp", ".bmp"),
    ("image/tiff", ".tiff"),
    ("application/pdf", ".pdf"),
    ("application/zip", ".zip"),
    ("application/gzip", ".gz"),
    ("application/vnd.apache.parquet", ".parquet"),
)


def sniff_mime(content: Column) -> Column:
    """Type from the leading bytes; null when unknown."""
    kind = F.lit(None).cast("string")
    for pattern, mime in reversed(SIGNATURES):
        # Fixed parts with their places: a type whose mark is short is also known by bytes further on.
        parts = [(m.start() // 2, bytes.fromhex(m[0])) for m in re.finditer("[0-9A-F]+", pattern)]
        tests = [F.substring(content, at + 1, len(part)) == F.lit(part) for at, part in parts]
        kind = F.when(functools.reduce(Column.__and__, tests), mime).otherwise(kind)
    return kind


def mime_extension(mime_type: Column) -> Column:
    """Dotted extension of a type; null when unknown."""
    extension = F.lit(None).cast("string")
    for mime, dotted in EXTENSIONS:
        extension = F.when(mime_type == mime, dotted).otherwise(extension)
    return extension


def is_image(content_type: Column) -> Column:
    return F.startswith(content_type, F.lit("image/"))


def is_diagram(
    width: Column,
    height: Column,
    widths: tuple[int, int] = DIAGRAM_WIDTH,
    heights: tuple[int, int] = DIAGRAM_HEIGHT,
) -> Column:
    """Both sides within their bounds, ends included."""
    return width.between(*widths) & height.between(*heights)


def _number(content: Column, first: int, length: int, little_endian: bool = False) -> Column:
    """Unsigned integer in ``length`` bytes from byte ``first`` (counted from 1)."""
    order = reversed(range(length)) if little_endian else range(length)
    digits = F.concat(*[F.lpad(F.hex(F.substring(content, first + i, 1)), 2, "0") for i in order])
    return F.conv(digits, 16, 10).try_cast("int")


def _jpeg_size(content: bytes | None) -> list[int] | None:
    """Walk the marker segments of a JPEG up to its frame header."""
    at = 2
    while content and at + 9 <= len(content) and content[at] == 0xFF:
        marker = content[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker == 0x01 or 0xD0 <= marker <= 0xD8:
            at += 2
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", content[at + 5 : at + 9])
            return [width, height]
        elif marker in (0xD9, 0xDA):
            return None
        else:
            at += 2 + int.from_bytes(content[at + 2 : at + 4], "big")
    return None


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def jpeg_size(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``[width, height]`` of JPEG bytes; null when there is no readable frame header."""
    for contents in batches:
        yield contents.map(_jpeg_size)


def image_size(content: Column, mime_type: Column) -> Column:
    """``[width, height]`` from the header bytes, null for other types or broken headers.

    PNG and GIF are read in the JVM; only JPEG bytes are sent to Python, because their frame header has no fixed place.
    """
    png = F.array(_number(content, 17, 4), _number(content, 21, 4))
    gif = F.array(_number(content, 7, 2, little_endian=True), _number(content, 9, 2, little_endian=True))
    size = (
        F.when((mime_type == "image/png") & (F.length(content) >= 24), png)
        .when((mime_type == "image/gif") & (F.length(content) >= 10), gif)
        .when(mime_type == "image/jpeg", jpeg_size(F.when(mime_type == "image/jpeg", content)))
    )
    # transform(array(x), f) binds x once.
    return F.transform(F.array(size), lambda s: F.when(~F.exists(s, lambda side: side.isNull()), s))[0]


def fit_within(width: Column, height: Column, max_side: int = MAX_IMAGE_SIDE) -> Column:
    """``[width, height]`` scaled so that the longer side becomes ``max_side``; smaller images keep their size.

    Sides are truncated after a floating-point product, so some come out one short of ``max_side``; that is intended.
    """
    factor = F.when(width > height, F.lit(float(max_side)) / width).otherwise(F.lit(float(max_side)) / height)
    scaled = F.array(F.floor(width * factor).cast("int"), F.floor(height * factor).cast("int"))
    fits = (width < max_side) & (height < max_side)
    return F.when(fits, F.array(width.cast("int"), height.cast("int"))).when((width > 0) & (height > 0), scaled)


def to_base64(content: Column) -> Column:
    """Base64 on one line."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def from_base64(text: Column) -> Column:
    """Bytes of base64 text; null when the text is malformed."""
    return F.try_to_binary(text, F.lit("base64"))


def data_url(mime_type: Column, encoded: Column) -> Column:
    return F.concat(F.lit("data:"), mime_type, F.lit(";base64,"), encoded)


def path_stem(path: Column) -> Column:
    """Last part of a path without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)/*$", 1), r"^(.+)\.[^.]+$", "$1")


def asset_path(
    source: Column, page_number: Column, ordinal: Column, extension: Column, base: Column | str, is_url: bool = False
) -> Column:
    """``{base}/{stem}-{first 8 of md5(source)}-page{page}-index{ordinal}{extension}``.

    With ``is_url`` the query and fragment of the source do not count towards the stem.
    """
    named = F.regexp_replace(source, r"[?#].*$", "") if is_url else source
    return F.concat(
        F.lit(base) if isinstance(base, str) else base,
        F.lit("/"),
        path_stem(named),
        F.lit("-"),
        F.left(F.md5(source.cast("binary")), F.lit(8)),
        F.lit("-page"),
        page_number.cast("string"),
        F.lit("-index"),
        ordinal.cast("string"),
        F.coalesce(extension, F.lit("")),
    )
