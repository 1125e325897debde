"""Registered queries over files, documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.functions import media, text
from papertrove.operators import documents as docs
from papertrove.operators.assets import extract_images
from papertrove.plans import samples
from papertrove.plans.oracle_parts import (
    fixed_chunks_sql,
    markdown_sql,
    path_sql,
    recursive_chunks_sql,
    text_sql,
)
from papertrove.plans.registry import registered
from papertrove.sources.file_digests import file_digests
from papertrove.sources.files import source_path
from papertrove.sources.tables import load, load_spread

def _file_digests(files: DataFrame) -> DataFrame:
    return files.select(
        F.regexp_extract("path", "([^/]*)$", 1).alias("file_name"), F.col("length").alias("n_bytes"), "digest"
    )


def _file_digests_sql(pattern: str) -> str:
    return f"""SELECT regexp_extract(filename, '([^/]*)$', 1) AS file_name, CAST(size AS BIGINT) AS n_bytes,
       md5(content) AS digest FROM read_blob('/root/testdata/sf0.01/{pattern}')"""


@registered(_file_digests_sql("*"), name="scan_binary")
def scan_binary_all(spark: SparkSession, folder: str) -> DataFrame:
    return _file_digests(file_digests(spark, folder))


@registered(_file_digests_sql("*s.parquet"))
def scan_binary_glob(spark: SparkSession, folder: str) -> DataFrame:
    return _file_digests(file_digests(spark, folder, "*s.parquet"))


@registered(f"SELECT page_id, {path_sql('url')} AS source_path FROM pages")
def normalize_path(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "pages").select("page_id", source_path("url").alias("source_path"))


@registered(f"SELECT page_id, {text_sql()} AS content FROM pages")
def html_to_text(spark: SparkSession, folder: str) -> DataFrame:
    return load_spread(spark, folder, "pages").select("page_id", text.html_to_text("html").alias("content"))


@registered(f"SELECT page_id, {markdown_sql()} AS content FROM pages")
def html_to_markdown(spark: SparkSession, folder: str) -> DataFrame:
    return load_spread(spark, folder, "pages").select("page_id", text.html_to_markdown("html").alias("content"))


@registered("""
SELECT doc_id, CAST(i AS INTEGER) AS page_number, page_content FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS page_content,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
WHERE regexp_matches(page_content, '\\S')""")
def page_export(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    return docs.explode_structs(rows, text.split_pages("text", "\n"), drop=["text"]).select(
        "doc_id", "page_number", "page_content"
    )


@registered(fixed_chunks_sql("documents", "doc_id"))
def chunk_fixed(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    return docs.explode_chunks(rows, text.chunk_fixed(F.col("text")), name="chunk").drop("text")


@registered(f"""
WITH RECURSIVE src AS (SELECT doc_id AS id, text FROM documents),
{recursive_chunks_sql('src')}
SELECT id AS doc_id, chunk_index, chunk FROM chunked""")
def chunk_recursive(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_spread(spark, folder, "documents", "doc_id", "text")
    return docs.explode_chunks(rows, text.chunk_recursive(F.col("text")), name="chunk").drop("text")


@registered(f"""
WITH {samples.FILE_BYTES_SQL}
SELECT doc_id, mime AS source_mime_type FROM typed WHERE mime IS NULL OR mime NOT LIKE 'image/%'""")
def chunk_loss(spark: SparkSession, folder: str) -> DataFrame:
    """Files the image generator dropped: types it does not support."""
    files = samples.file_bytes(spark, folder).select(
        "doc_id", "source_content", media.sniff_mime(F.col("source_content")).alias("source_mime_type")
    )
    # Which files give images does not depend on their bytes, so none are carried along.
    no_bytes = F.lit(None).cast("binary")
    images = files.select("doc_id", F.explode(extract_images(no_bytes, F.col("source_mime_type"))))
    return docs.lost_rows(files.drop("source_content"), images, "doc_id")


@registered(f"""
WITH RECURSIVE src AS (SELECT page_id AS id, {markdown_sql()} AS text FROM pages),
{recursive_chunks_sql('src')}
SELECT {path_sql('url')} AS source_path, chunk_index, chunk AS chunks FROM chunked JOIN pages ON id = page_id""")
def process_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages to markdown to chunks, the document job."""
    pages = load_spread(spark, folder, "pages", "url", "html").select(
        source_path("url").alias("source_path"), text.html_to_markdown("html").alias("content")
    )
    return docs.process_documents(pages)


@registered(f"""
WITH RECURSIVE src AS (SELECT conv_id || '/' || (turn + 1) AS id, text FROM conversations),
{recursive_chunks_sql('src')}
SELECT split_part(id, '/', 1) AS source_path, CAST(split_part(id, '/', 2) AS INTEGER) AS page_number,
       chunk_index, chunk AS chunks FROM chunked""")
def process_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as a document whose turns are its pages; chunks never span two pages."""
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda one: one["text"])
    documents = load(spark, folder, "conversations").groupBy(F.col("conv_id").cast("string").alias("source_path")).agg(
        F.array_join(turns, "\f").alias("content")
    )
    return docs.process_pages(documents)


BLOCKS_SQL = """
blocks AS (
  SELECT doc_id, '<?xml version="1.0"?><!-- page --><html><body><h2>' || source || '</h2><h3 class="x">&#169;&nbsp;'
    || lang || '</h3><ol><li>' || doc_id || '<li class=a>two</ol><table><tr><th>n</th><td>' || n_chars
    || '</td></tr></table><p>' || text || '<br/>&#8212;</p><a class="l" href="/d/' || doc_id
    || '">more &#38; more</a><pre><code>x = 1</code></pre><code>y</code></body></html>' AS html
  FROM documents)"""


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    """A page with every kind of block around each document's text."""
    html = F.concat(
        F.lit('<?xml version="1.0"?><!-- page --><html><body><h2>'), "source", F.lit('</h2><h3 class="x">&#169;&nbsp;'),
        "lang", F.lit("</h3><ol><li>"), "doc_id", F.lit("<li class=a>two</ol><table><tr><th>n</th><td>"), "n_chars",
        F.lit("</td></tr></table><p>"), "text", F.lit('<br/>&#8212;</p><a class="l" href="/d/'), "doc_id",
        F.lit('">more &#38; more</a><pre><code>x = 1</code></pre><code>y</code></body></html>'),
    )
    return load_spread(spark, folder, "documents").select("doc_id", html.alias("html"))


@registered(f"WITH {BLOCKS_SQL} SELECT doc_id, {markdown_sql()} AS content FROM blocks")
def html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Headings, lists, tables, links, breaks, code and character references as markdown."""
    return _blocks(spark, folder).select("doc_id", text.html_to_markdown("html").alias("content"))


@registered(f"""
WITH {samples.FILE_BYTES_SQL}, {BLOCKS_SQL}
SELECT doc_id, 'file' AS kind, CASE WHEN mime IS NULL THEN md5(text) END AS digest
FROM typed JOIN (SELECT doc_id, text FROM documents) USING (doc_id)
UNION ALL SELECT doc_id, 'page', md5({markdown_sql()}) FROM blocks""")
def export_document(spark: SparkSession, folder: str) -> DataFrame:
    """Files of all types: typed binary gives null, text stays as it is, and pages with a byte order mark, a prolog and a
    comment are converted."""
    files = samples.file_bytes(spark, folder).select("doc_id", F.lit("file").alias("kind"), "source_content")
    marked = F.concat(F.unhex(F.lit("EFBBBF")), F.encode("html", "utf-8"))
    pages = _blocks(spark, folder).select("doc_id", F.lit("page").alias("kind"), marked.alias("source_content"))
    content = F.col("source_content")
    exported = text.export_document(content, media.sniff_mime(content))
    return files.unionByName(pages).select("doc_id", "kind", F.md5(exported.cast("binary")).alias("digest"))


@registered(f"""
SELECT source AS source_path, doc_id, chunk_index, chunk AS content FROM documents
JOIN ({fixed_chunks_sql('documents', 'doc_id')}) USING (doc_id)""")
def index_projection(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "documents").select(F.col("source").alias("source_path"), "doc_id", "text")
    chunks = docs.explode_chunks(rows, text.chunk_fixed(F.col("text")))
    return docs.index_projection(chunks, columns=["source_path", "doc_id", "chunk_index"])
