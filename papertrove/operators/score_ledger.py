"""Model scores that survive a failure: every input is scored once per model, however often a job is started.

A row's digest covers its inputs and the model's name. Tasks write their results in small files while they run, under
``results/run=<id>/part=<task>/``, so a job that dies keeps all but the batches it was working on, and a task that is run
again skips what its first attempt wrote. Rows that failed are kept with their error and tried again by the next job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from papertrove.sources.storage import child_names, default_file_system, open_folder

_DIGEST, _RESULT = "_digest", "_result"
# Rows that one call of the model gets, and that one file of results holds.
BATCH_ROWS = 64

#: Takes one list per input column and gives one value per row.
BatchScorer = Callable[..., Sequence[Any]]


@dataclass(frozen=True)
class ScoreLedger:
    """Where the results of a model live. Another ``model`` name (a new version, other settings) is another model."""

    path: str
    model: str
    value_type: T.DataType

    def _schema(self) -> T.StructType:
        return T.StructType().add("digest", T.StringType()).add("value", self.value_type).add("error", T.StringType())

    def results(self, spark: SparkSession) -> DataFrame:
        """``(digest, value, error)``, one row per input that was ever tried; a value stands before any error."""
        if not child_names(f"{self.path}/results"):
            return spark.createDataFrame([], self._schema())
        stored = spark.read.schema(self._schema()).option("recursiveFileLookup", "true").parquet(f"{self.path}/results")
        best = F.max_by(F.struct("value", "error"), F.col("error").isNull()).alias("best")
        return stored.groupBy("digest").agg(best).select("digest", "best.value", "best.error")

    def digest(self, in_columns: Sequence[str]) -> Column:
        """The digest of a row's inputs; bytes count as they are, other types as text, null as nothing else does."""
        parts = [F.coalesce(F.sha2(F.col(f"`{c}`").cast("string").cast("binary"), 256), F.lit("-")) for c in in_columns]
        return F.sha2(F.concat_ws("|", F.lit(self.model), *parts), 256)


def _answers(score: BatchScorer, columns: list[list]) -> list[tuple[Any, str | None]]:
    """Value and error of every row; after a failed call the rows are tried one by one, so one row fails alone."""
    rows = len(columns[0]) if columns else 0
    try:
        values = list(score(*columns))
        if len(values) == rows:
            return [(value, None) for value in values]
        error = f"{len(values)} values for {rows} rows"
    except Exception as failure:
        error = str(failure) or type(failure).__name__
    if rows == 1:
        return [(None, error)]
    return [answer for i in range(rows) for answer in _answers(score, [[column[i]] for column in columns])]


def score_once(
    df: DataFrame,
    in_columns: Sequence[str],
    out: str,
    ledger: ScoreLedger,
    make_scorer: Callable[[], BatchScorer],
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Add ``out`` as ``struct<value, error>``: results the ledger has, and those of the model for all other inputs.

    This is an action: what is missing is scored now, each distinct input once, in batches of ``batch_rows``. The model is
    loaded once per task and only where there is something to score. Looking at the result calls no model.
    """
    spark = df.sparkSession
    done = ledger.results(spark).where(F.col("error").isNull()).select(F.col("digest").alias(_DIGEST))
    inputs = df.select(ledger.digest(in_columns).alias(_DIGEST), *[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(in_columns)])
    missing = inputs.join(done, _DIGEST, "left_anti").dropDuplicates([_DIGEST])
    folder, default = f"{ledger.path}/results/run={uuid.uuid4().hex}", default_file_system(spark)
    kinds = pa.schema([("digest", pa.string()), ("value", to_arrow_type(ledger.value_type)), ("error", pa.string())])
    width = len(in_columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, target = open_folder(f"{folder}/part={context.partitionId()}", default)
        before: set[str] = set()
        if context.attemptNumber():
            for entry in files.get_file_info(pa.fs.FileSelector(target, allow_not_found=True)):
                if entry.base_name.endswith(".parquet") and not entry.base_name.startswith("_"):
                    before |= set(pq.read_table(entry.path, filesystem=files, columns=["digest"]).column(0).to_pylist())
        score, count = None, 0
        for batch in batches:
            rows = [row for row in zip(*(column.to_pylist() for column in batch.columns), strict=True) if row[0] not in before]
            for at in range(0, len(rows), batch_rows):
                part = rows[at : at + batch_rows]
                score = make_scorer() if score is None else score
                answers = _answers(score, [[row[i + 1] for row in part] for i in range(width)])
                table = pa.table([[row[0] for row in part], [v for v, _ in answers], [e for _, e in answers]], schema=kinds)
                files.create_dir(target, recursive=True)
                name = f"{uuid.uuid4().hex}.parquet"
                with files.open_output_stream(f"{target}/_{name}") as sink:
                    pq.write_table(table, sink)
                files.move(f"{target}/_{name}", f"{target}/{name}")
                count += len(part)
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["n"])

    missing.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    results = ledger.results(spark).select(F.col("digest").alias(_DIGEST), F.struct("value", "error").alias(_RESULT))
    keyed = df.withColumn(_DIGEST, ledger.digest(in_columns)).join(results, _DIGEST, "left")
    return keyed.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.col(_RESULT).alias(out))
