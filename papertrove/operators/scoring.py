"""Model scoring, closed-list classification and prompts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.functions import prompts, vectors
from papertrove.operators.names import private
from papertrove.sources.tables import class_prompts

Scorer = Callable[..., Any]


def score_batches(
    df: DataFrame,
    in_columns: Sequence[str],
    out: str,
    value_type: T.DataType,
    make_scorer: Callable[[], Scorer],
    on_error: str = "capture",
) -> DataFrame:
    """Add ``out`` as ``struct<value, error>`` by calling a model on every row.

    ``make_scorer`` loads the model once per task. With ``on_error="capture"`` a failing row gets a null value and the
    error text; with ``"fail"`` it stops the job. Write the result once (``sources.stage``) before filtering on it or
    using it twice, or the model runs again.
    """
    if on_error not in ("capture", "fail"):
        raise ValueError("on_error must be 'capture' or 'fail'")
    result = T.StructType([T.StructField("value", value_type), T.StructField("error", T.StringType())])

    def score(scorer: Scorer, row: tuple) -> tuple[Any, str | None]:
        try:
            return scorer(*row), None
        except Exception as error:
            if on_error == "fail":
                raise
            return None, str(error)

    @F.pandas_udf(result)
    def score_udf(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for columns in batches:
            # A single input column arrives as a bare Series.
            columns = columns if isinstance(columns, tuple) else (columns,)
            scored = [score(scorer, row) for row in zip(*columns)]
            yield pd.DataFrame({"value": [v for v, _ in scored], "error": [e for _, e in scored]}, dtype=object)

    return df.withColumn(out, score_udf(*in_columns))


def centroids(vectors_: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label. Partial means are made before the shuffle, so each task sends one row per label."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return vectors_.groupBy(label).agg(vector_to_array(mean).alias("centroid"))


def nearest_centroid(
    rows: DataFrame, vector: str, centers: DataFrame, allowed: Iterable[Any], label: str = "label"
) -> DataFrame:
    """Add ``class_label`` and ``class_score``: the allowed label with the most similar centroid.

    The centroids kept are at most one per entry of the closed list, so they travel as one scalar value and the rows
    are neither joined nor shuffled. Equal scores go to the smaller label.
    """
    allowed = list(allowed)
    center = F.struct(F.col(label).alias("label"), vectors.unit(F.col("centroid")).alias("unit"))
    packed = (
        centers.where(F.col(label).isin(allowed)).agg(F.array_sort(F.collect_list(center)).alias("centers")).scalar()
    )
    beside, own, best = private("centers"), private("unit"), private("best")
    scored = F.transform(
        F.col(beside),
        lambda c, i: F.struct(
            F.round(vectors.dot(F.col(own), c["unit"]), 6).alias("score"),
            (-i).alias("rank"),
            c["label"].alias("label"),
        ),
    )
    return (
        rows.withColumns({beside: packed, own: vectors.unit(F.col(vector))})
        .withColumn(best, F.array_max(scored))
        .withColumns({"class_label": F.col(f"{best}.label"), "class_score": F.col(f"{best}.score")})
        .drop(best, beside, own)
    )


def prompt_fallback(rows: DataFrame, class_column: str, classes: Iterable[tuple[str, str | None]]) -> DataFrame:
    """Add ``prompt``: that of the row's class, else that of ``default``, else empty."""
    classes = list(classes)
    default = next((prompt for name, prompt in classes if name == "default"), None)
    name, found = private("class"), private("prompt")
    table = class_prompts(rows.sparkSession, classes).toDF(name, found)
    joined = rows.join(table, F.col(class_column) == F.col(name), "left")
    return joined.withColumn("prompt", F.coalesce(F.nullif(F.col(found), F.lit("")), F.lit(default), F.lit(""))).drop(name, found)


def build_prompt(rows: DataFrame, class_column: str, classes: Iterable[tuple[str, str | None]]) -> DataFrame:
    """Add ``summary_prompt``, the full request for the row's class."""
    found = prompt_fallback(rows, class_column, classes)
    return found.withColumn("summary_prompt", prompts.summary_prompt(F.col(class_column), F.col("prompt")))


def deck_prompt(images: DataFrame, deck: str) -> DataFrame:
    """One request per deck of images; only the count of each deck is shuffled."""
    return images.groupBy(deck).agg(F.count("*").alias("n_images")).withColumn(
        "deck_prompt", prompts.deck_text(F.col("n_images"))
    )


def latest_version(requested: DataFrame, versions: DataFrame, name: str, version: str) -> DataFrame:
    """Highest numeric version per requested name, never below 1, and 1 for names without any.

    Both sides are reduced to one row per name before they meet.
    """
    number = F.col(version).cast("string").try_cast("int")
    best = versions.groupBy(name).agg(F.max(number).alias("_best"))
    return (
        requested.select(name)
        .distinct()
        .join(best, name, "left")
        .select(name, F.greatest(F.lit(1), F.col("_best")).alias("latest_version"))
    )


def with_message(rows: DataFrame, text: Column, url: Column, name: str = "message") -> DataFrame:
    return rows.withColumn(name, prompts.message(text, url))
