"""Files followed without opening what is known, and scores that survive a job that dies."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.operators.score_ledger import ScoreLedger, score_once
from papertrove.plans.jobs import follow_files
from papertrove.sources.files import binary_source
from papertrove.sources.ledger import FileLedger
from papertrove.streaming.buckets import open_buckets


def chunks(files):
    """One chunk per line."""
    texts = binary_source(files).select("source_path", F.decode("source_content", "UTF-8").alias("text"))
    return texts.select("source_path", F.posexplode(F.split("text", "\n")).alias("chunk_index", "content")).where("content <> ''")


class Folder:
    def __init__(self, spark, root):
        self.spark, self.root, self.ledger = spark, root, FileLedger(str(root / "ledger"))
        self.index = open_buckets(str(root / "index"), ["source_path", "chunk_index"], "version", buckets=2, parts=2)
        (root / "files").mkdir()

    def write(self, name, text, time=None):
        path = self.root / "files" / name
        path.write_text(text)
        if time:
            os.utime(path, (time, time))

    def run(self, index=None):
        found = follow_files(self.spark, str(self.root / "files"), self.ledger, index or self.index, str(self.root / "feed"), "*.txt", chunks)
        return tuple(found.first())

    def live(self):
        rows = self.index.read(self.spark).collect()
        return sorted((r.source_path.rsplit("/", 1)[1], r.chunk_index, r.content) for r in rows)


def test_files_are_opened_when_they_are_new_or_changed(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    assert folder.run() == (0, 0, 0, 0, 0)
    folder.write("a.txt", "one\ntwo\nthree")
    folder.write("b.txt", "four")
    folder.write("c.txt", "")
    folder.write("other.bin", "never read")
    assert folder.run() == (2, 0, 0, 0, 2)  # an empty file has no row
    assert folder.live() == [("a.txt", 0, "one"), ("a.txt", 1, "two"), ("a.txt", 2, "three"), ("b.txt", 0, "four")]
    commits = folder.index.commits()
    assert folder.run() == (0, 0, 0, 2, 0)
    assert folder.index.commits() == commits

    folder.write("a.txt", "ONE", 2_000_000_000)
    (tmp_path / "files" / "b.txt").unlink()
    folder.write("d.txt", "five")

    class Broken:
        def sync(self, *args, **kwargs):
            raise RuntimeError("died")

    with pytest.raises(RuntimeError):
        folder.run(Broken())
    # Nothing was committed, so the next run does the work; what it reads is newer than what the dead one fed.
    folder.write("a.txt", "ONE\nTWO", 2_000_000_001)
    assert folder.run() == (1, 1, 1, 0, 2)
    assert folder.live() == [("a.txt", 0, "ONE"), ("a.txt", 1, "TWO"), ("d.txt", 0, "five")]


def test_comparing_opens_no_file(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    folder.write("a.txt", "x")
    plan = folder.ledger.compare(spark, str(tmp_path / "files"))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "binaryFile" in line)
    assert "content" not in scan[scan.index("ReadSchema") :]


def inputs(spark, values):
    return spark.createDataFrame([(i, v, "clash", "x") for i, v in enumerate(values)], "id long, text string, value string, `a.b` string")


def counting(folder, broken="-", dies="-"):
    """A scorer that notes what it is asked in files, fails on one text and dies on another."""

    def make():
        def score(texts, *more):
            if broken in texts:
                raise ValueError("no such text")
            if dies in texts:
                raise SystemExit("the machine is gone")
            for text in texts:
                with open(f"{folder}/calls", "a") as out:
                    out.write(f"{text}\n")
            return [len(text or "") for text in texts]

        return score

    return make


def calls(folder):
    path = folder / "calls"
    return Counter(path.read_text().split("\n")[:-1]) if path.exists() else Counter()


def test_a_job_that_died_scores_each_input_once_in_total(spark, tmp_path):
    ledger = ScoreLedger(str(tmp_path / "scores"), "length-1", T.LongType())
    texts = [f"text {i % 30}" for i in range(90)] + [None, "", ""]
    df = inputs(spark, texts).repartition(1)
    with pytest.raises(Exception, match="gone|Python worker|SystemExit|exited|crashed|connection"):
        score_once(df, ["text"], "scored", ledger, counting(tmp_path, dies="text 7"), batch_rows=1)
    first = calls(tmp_path)
    assert 0 < sum(first.values()) and "text 7" not in first
    found = score_once(df, ["text"], "scored", ledger, counting(tmp_path), batch_rows=1).collect()
    assert {r["id"]: r["scored"]["value"] for r in found} == {i: len(t or "") for i, t in enumerate(texts)}
    assert calls(tmp_path) == Counter({f"text {i}": 1 for i in range(30)}) + Counter({"None": 1, "": 1})


def test_failed_rows_are_kept_and_tried_again(spark, tmp_path):
    ledger = ScoreLedger(str(tmp_path / "scores"), "length-1", T.LongType())
    df = inputs(spark, ["a", "bb", "ccc", "bb"]).repartition(1)
    found = score_once(df, ["text", "a.b"], "value", ledger, counting(tmp_path, broken="bb")).collect()
    assert {(r["text"], r["value"]["value"], r["value"]["error"]) for r in found} == {
        ("a", 1, None), ("ccc", 3, None), ("bb", None, "no such text")}
    before = calls(tmp_path)
    again = score_once(df, ["text", "a.b"], "value", ledger, counting(tmp_path)).collect()
    assert {(r["text"], r["value"]["value"]) for r in again} == {("a", 1), ("ccc", 3), ("bb", 2)}
    assert calls(tmp_path) - before == Counter({"bb": 1})
    other = ScoreLedger(str(tmp_path / "scores"), "length-2", T.LongType())
    assert other.results(spark).count() == 3
    assert score_once(inputs(spark, []), ["text"], "scored", other, counting(tmp_path)).collect() == []


def test_a_listing_is_read_in_few_tasks(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    for i in range(40):
        folder.write(f"{i}.txt", "x")
    tasks = 2 * spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        found = folder.ledger.compare(spark, str(tmp_path / "files"), "*.txt")
        assert f"Coalesce {tasks}" in found._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in found.select("change", "length").collect()} == {("new", 1)} and found.count() == 40
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
