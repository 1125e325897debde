from __future__ import annotations

import base64
import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from papertrove.functions import media
from papertrove.operators import assets


def png(w, h):
    return b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + struct.pack(">II", w, h) + b"\x08\x02"


def gif(w, h):
    return b"GIF89a" + struct.pack("<HH", w, h) + b"\xf7"


def jpeg(w, h, before=b"", marker=0xC0):
    app = b"\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00"
    return b"\xff\xd8" + app + before + bytes([0xFF, marker, 0, 17, 8]) + struct.pack(">HH", h, w) + b"\x03" * 10


HUFFMAN = b"\xff\xc4\x00\x05abc"
FILES = {
    "png": (png(640, 480), "image/png", [640, 480]),
    "big png": (png(70_000, 3), "image/png", [70_000, 3]),
    "impossible png": (png(2**32 - 1, 3), "image/png", None),
    "short png": (png(1, 1)[:20], "image/png", None),
    "gif": (gif(258, 513), "image/gif", [258, 513]),
    "jpeg": (jpeg(800, 600), "image/jpeg", [800, 600]),
    "progressive jpeg": (jpeg(5, 7, marker=0xC2), "image/jpeg", [5, 7]),
    "jpeg, table and fill bytes first": (jpeg(9, 8, HUFFMAN + b"\xff\xff"), "image/jpeg", [9, 8]),
    "jpeg, two large segments first": (jpeg(9, 8, 2 * (b"\xff\xe1\xff\xff" + b"\xff\xc0" * 32766 + b"x")), "image/jpeg", [9, 8]),
    "jpeg without frame": (b"\xff\xd8\xff\xd9", "image/jpeg", None),
    "cut jpeg": (jpeg(800, 600)[:24], "image/jpeg", None),
    "pdf": (b"%PDF-1.7", "application/pdf", None),
    "unknown": (b"hello", None, None),
    "empty": (b"", None, None),
}


@pytest.fixture(scope="module")
def inventory(spark):
    rows = spark.createDataFrame([(n, f[0]) for n, f in FILES.items()], "name string, source_content binary")
    return {r.name: r for r in assets.image_inventory(rows).collect()}


@pytest.mark.parametrize("name", FILES)
def test_type_and_size(inventory, name):
    assert (inventory[name].mime_type, inventory[name].original_image_size) == FILES[name][1:]


SIDES = [(w, h) for w in (1, 1119, 1120, 1121, 2146, 5000) for h in (1, 1119, 1120, 1121, 2146)]


def test_fit_within(spark):
    def fit(w, h):
        if w < 1120 and h < 1120:
            return [w, h]
        factor = 1120 / w if w > h else 1120 / h
        return [int(w * factor), int(h * factor)]

    rows = spark.createDataFrame(SIDES, "w int, h int")
    for row in rows.withColumn("fit", media.fit_within(F.col("w"), F.col("h"))).collect():
        assert row.fit == fit(row.w, row.h)
    assert fit(2146, 10)[0] == 1119


def test_diagram_bounds(spark):
    sides = [(w, h) for w in (499, 500, 2000, 2001) for h in (374, 375, 1500, 1501)]
    rows = spark.createDataFrame([(list(s),) for s in sides] + [(None,)], "original_image_size array<int>")
    kept = {(r.width, r.height) for r in assets.diagrams_only(rows).collect()}
    assert kept == {(500, 375), (500, 1500), (2000, 375), (2000, 1500)}


def test_base64(spark):
    data = [bytes(range(256)) * n for n in (0, 1, 3)]
    row = spark.createDataFrame([(d,) for d in data], "b binary")
    found = row.select(media.to_base64(F.col("b")).alias("e")).collect()
    assert [r.e for r in found] == [base64.b64encode(d).decode() for d in data]
    back = row.select(media.from_base64(media.to_base64(F.col("b"))).alias("b")).collect()
    assert [bytes(r.b) for r in back] == data
    assert spark.range(1).select(media.from_base64(F.lit("%%%"))).first()[0] is None


@pytest.mark.parametrize(
    "source,stem", [("/a/b.tar.gz", "b.tar"), ("/a/.hidden", ".hidden"), ("/a/b#1.jpg", "b#1"), ("/a/b", "b"), ("/a/b/", "b")]
)
def test_asset_path(spark, source, stem):
    path = media.asset_path(F.lit(source), F.lit(2), F.lit(3), F.lit(".jpg"), "/out")
    digest = hashlib.md5(source.encode()).hexdigest()[:8]
    assert spark.range(1).select(path).first()[0] == f"/out/{stem}-{digest}-page2-index3.jpg"


def test_extension(spark):
    kinds = ["image/jpeg", "application/pdf", "text/odd", None]
    rows = spark.createDataFrame([(k,) for k in kinds], "m string").select(media.mime_extension(F.col("m")))
    assert [r[0] for r in rows.collect()] == [".jpg", ".pdf", None, None]


def test_save_assets_reports_and_repeats(spark, tmp_path):
    rows = [(f"{tmp_path}/out/{i}.bin", bytes([i]) * 5) for i in range(20)]
    rows += [(f"{tmp_path}/out/none.bin", None), (f"{tmp_path}/out/0.bin/below", b"x")]
    # The last path lies below a file, so its folder cannot be made.
    frame = spark.createDataFrame(rows, "p string, b binary").coalesce(1)
    for _ in range(2):
        report = {r.path.rpartition("/out/")[2]: r for r in assets.save_assets(frame, "p", "b").coalesce(1).collect()}
        assert sum(r.status == "success" for r in report.values()) == 20
        assert report["0.bin/below"].status == "error"
        assert report["none.bin"].status == "error" and report["none.bin"].error == "no bytes"
        assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(f"{i}.bin" for i in range(20))
    assert (tmp_path / "out" / "7.bin").read_bytes() == bytes([7]) * 5
