"""Digests of files that are read in pieces, whatever bytes they hold and wherever they are split."""

from __future__ import annotations

import gzip
import hashlib
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from papertrove.functions import md5
from papertrove.plans.document_queries import scan_binary_all, scan_binary_glob
from papertrove.sources import file_digests


@contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('_', '.')}": str(v) for k, v in values.items()}
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hashed(folder):
    """What the queries must give; a scan has no row for an empty file."""
    files = {f.name: f.read_bytes() for f in folder.rglob("*") if f.is_file()}
    return {(name, len(data), hashlib.md5(data).hexdigest()) for name, data in files.items() if data}


def some_bytes(rng, length):
    return bytes(rng.choice((10, 10, 13, 0, 65, 0xEF, 0xBB, 0xBF, 0xFF, rng.randrange(256))) for _ in range(length))


@pytest.mark.parametrize("chain", [md5.chain_by_steps, md5.chain_by_openssl])
def test_chain_goes_on_from_any_byte(chain, monkeypatch):
    if chain is md5.chain_by_openssl and md5._chain() is not chain:
        pytest.skip("hashlib is not linked with a library that shows MD5_Update")
    monkeypatch.setattr(md5, "_chain", lambda: chain)
    rng = random.Random(1)
    for length in [*range(0, 140), 1000, 5000]:
        data, state, at = rng.randbytes(length), (md5.START, b""), 0
        while at < length:
            step = rng.randint(0, 200)
            state = md5.go_on(*state, data[at : at + step])
            at += step
        assert md5.digest(*state, length) == hashlib.md5(data).hexdigest()


@pytest.mark.parametrize("split", [370, 1 << 20])
def test_long_files_of_any_bytes(spark, tmp_path, monkeypatch, split):
    rng = random.Random(split)
    (tmp_path / "below").mkdir()
    mark = b"\xef\xbb\xbf"
    odd = {
        "feeds": b"\n" * 900, "no_feed": b"x" * 1100, "dos": b"a\r\nb\r" * 300, "marked": mark + b"a\nb" * 200,
        "marked_fed": mark * 2 + b"a\n" * 300, "empty": b"", "short": b"one\ntwo", "at_the_limit": b"\n" * 400, "one_more": b"\n" * 401,
        "a b%20ü+.parquet": some_bytes(rng, 1150), "below/deep": some_bytes(rng, 1200), "packed.gz": gzip.compress(rng.randbytes(1000)),
        "not.gz": b"\n\n" * 600,
    }
    odd |= {f"any{i}s.parquet": some_bytes(rng, rng.randint(410, 1200)) for i in range(6)}
    for name, data in odd.items():
        (tmp_path / name).write_bytes(data)
    monkeypatch.setattr(file_digests, "PIECE", 400)
    with settings(spark, files_maxPartitionBytes=split):
        rows = scan_binary_all(spark, str(tmp_path)).collect()
        globbed = scan_binary_glob(spark, str(tmp_path)).collect()
    assert len(rows) == len(odd) - 1 and {tuple(r) for r in rows} == hashed(tmp_path)
    assert {tuple(r) for r in globbed} == {r for r in hashed(tmp_path) if r[0].endswith("s.parquet")}


def test_no_task_gets_a_long_file_whole(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    (tmp_path / "long").write_bytes(some_bytes(rng, 400_000))
    (tmp_path / "small").write_bytes(some_bytes(rng, 50_000))
    staged, write = [], file_digests._staged_blocks
    monkeypatch.setattr(file_digests, "_staged_blocks", lambda *frames: staged.append(write(*frames)) or staged[0])
    monkeypatch.setattr(file_digests, "_BLOCK", 1000)
    monkeypatch.setattr(file_digests, "PIECE", 100_000)
    # A file over this length cannot be read as one row, as one over 2 GB cannot by default.
    with settings(spark, sources_binaryFile_maxLength=100_000, files_maxPartitionBytes=30_000):
        rows = scan_binary_all(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == hashed(tmp_path)
    pieces = staged[0].groupBy("file", "round").agg(F.sum("n_bytes").alias("n")).collect()
    assert len(pieces) == 4 and max(r["n"] for r in pieces) < 100_000 + 31_000


def test_bytes_that_do_not_add_up_are_refused(spark, tmp_path, monkeypatch):
    (tmp_path / "long").write_bytes(b"a\n" * 100)
    monkeypatch.setattr(file_digests, "PIECE", 50)
    lines = file_digests.scan_lines(spark, str(tmp_path))
    files = file_digests.scan_binary(spark, str(tmp_path)).select(F.col("_metadata.file_path").alias("file"), "path", "length")
    with pytest.raises(Exception, match="bytes listed"):
        file_digests._digests_by_pieces(lines, files.withColumn("length", F.col("length") + 7), 200)
