"""Prompt texts for the image models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording the models are asked with.
CLASSIFY_REQUEST = "Classify this image using provided tools"
SUMMARY_REQUEST = "Summarize this image of a %s using the provided tools."
INSTRUCTIONS = "%s Instructions: %s"
IMAGE_MARK = "<|image_%d|>\n"
DECK_REQUEST = "Summarize the deck of slides."


def summary_prompt(class_name: Column, prompt: Column) -> Column:
    """The summary request for a class; instructions are added only when there are any."""
    request = F.when(class_name.isNotNull(), F.format_string(SUMMARY_REQUEST, class_name))
    return F.when(F.length(prompt) > 0, request_with(request, prompt)).otherwise(request)


def request_with(request: Column, instructions: Column) -> Column:
    return F.when(request.isNotNull() & instructions.isNotNull(), F.format_string(INSTRUCTIONS, request, instructions))


def message(text: Column, url: Column) -> Column:
    """The two parts of one request: its text and its image."""
    none = F.lit(None).cast("string")
    return F.array(
        F.struct(F.lit("text").alias("type"), text.alias("text"), none.alias("url")),
        F.struct(F.lit("image_url").alias("type"), none.alias("text"), url.alias("url")),
    )


def deck_text(images: Column) -> Column:
    """One mark a line for each of the images, counted from 1, then the request."""
    marks = F.transform(F.sequence(F.lit(1), images.cast("int")), lambda i: F.format_string(IMAGE_MARK, i))
    return F.concat(F.array_join(marks, ""), F.lit(DECK_REQUEST))
