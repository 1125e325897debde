from papertrove.sources.files import binary_source, scan_binary, source_path
from papertrove.sources.storage import stage, work_folder
from papertrove.sources.tables import class_prompts, load, scan_table

__all__ = ["binary_source", "class_prompts", "load", "scan_binary", "scan_table", "source_path", "stage", "work_folder"]
