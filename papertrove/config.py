"""Settings of a document collection, checked when they are read."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# The class list, the result columns and the tuning constants.
CLASS_NAMES = (
    "default",
    "scenary",
    "chart",
    "diagram",
    "infographic",
    "technical_drawing",
    "organizational_chart",
    "flowchart",
    "data_visualization",
    "instructional",
    "scientific_illustration",
    "map",
)
RESULT_COLUMNS = (
    "id",
    "content",
    "source_path",
    "source_mime_type",
    "image_path",
    "image_mime_type",
    "image_classification",
    "image_caption",
    "original_image_size",
    "resized_image_size",
    "page_number",
    "ordinal",
)
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
MAX_IMAGE_SIDE = 1120
DIAGRAM_WIDTH = (500, 2000)
DIAGRAM_HEIGHT = (375, 1500)
TOP_K = 5
FALLBACK_TOP_K = 3
DOCUMENT_BATCH_ROWS = 100
IMAGE_BATCH_ROWS = 10


@dataclass(frozen=True)
class Settings:
    document_path: str
    image_path: str
    source_table: str
    primary_key: str
    text_column: str
    result_columns: tuple[str, ...]
    top_k: int
    classes: tuple[tuple[str, str | None], ...] = field(default_factory=tuple)


def _need(section: dict[str, Any], where: str, name: str) -> Any:
    if section.get(name) in (None, ""):
        raise ValueError(f"setting {where}.{name} is missing")
    return section[name]


def read_settings(tree: dict[str, Any]) -> Settings:
    """Settings from a parsed YAML tree; a missing name fails here rather than inside a task."""
    data, retriever = tree.get("data") or {}, tree.get("retriever") or {}
    key = _need(data, "data", "primary_key")
    if retriever.get("primary_key", key) != key:
        raise ValueError("data.primary_key and retriever.primary_key differ")
    classes = tuple((_need(c, "classifications", "name"), c.get("prompt")) for c in tree.get("classifications") or [])
    top_k = (retriever.get("search_parameters") or {}).get("k", FALLBACK_TOP_K)
    if not isinstance(top_k, int) or top_k < 1:
        raise ValueError("retriever.search_parameters.k must be a positive integer")
    return Settings(
        document_path=_need(data, "data", "document_path"),
        image_path=_need(data, "data", "image_path"),
        source_table=_need(data, "data", "source_table_name"),
        primary_key=key,
        text_column=_need(retriever, "retriever", "embedding_source_column"),
        result_columns=tuple(retriever.get("columns") or ()),
        top_k=top_k,
        classes=classes,
    )


def load_settings(path: str) -> Settings:
    import yaml

    with open(path, encoding="utf-8") as handle:
        return read_settings(yaml.safe_load(handle) or {})
