"""Text export, page splitting and chunking."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papertrove.config import CHUNK_OVERLAP, CHUNK_SIZE

# Separators in the order they are tried, and the decoded named entities (ampersand last).
SEPARATORS = ("\n\n", "\n", " ", "")
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&bull;", "•"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&lsquo;", "‘"),
    ("&rsquo;", "’"),
    ("&ldquo;", "“"),
    ("&rdquo;", "”"),
    ("&amp;", "&"),
)

# Every character that Python's str.strip() removes.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<nav[^>]*>.*?</nav>|<!--.*?-->"
#: What a tag becomes in markdown, in the order in which tags are replaced.
MARKDOWN = (
    *((rf"(?i)<h{level}(?:\s[^>]*)?>", "\n" + "#" * level + " ") for level in range(1, 7)),
    (r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>', "[$2]($1)"),
    (r"(?i)<pre(?:\s[^>]*)?>(?:\s*<code(?:\s[^>]*)?>)?|(?:</code>\s*)?</pre>", "\n```\n"),
    (r"(?i)</?code(?:\s[^>]*)?>", "`"),
    (r"(?i)<li(?:\s[^>]*)?>", "\n- "),
    (r"(?i)<t[dh](?:\s[^>]*)?>", " | "),
    (r"(?i)</tr>", " |\n"),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)<p(?:\s[^>]*)?>|</p>|</h[1-6]>|</?ul(?:\s[^>]*)?>|</?ol(?:\s[^>]*)?>|</?table(?:\s[^>]*)?>", "\n\n"),
)
TITLE = r"(?is)<title[^>]*>.*?</title>"


def _decode_entities(col: Column) -> Column:
    """Decimal and named character references as characters; surrogates and numbers beyond six digits stay as they are."""

    def decimal(text: Column) -> Column:
        numbers = F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{1,6});"), F.lit(1)))
        return F.aggregate(
            F.filter(numbers, lambda n: ~n.cast("int").between(0xD800, 0xDFFF)),
            text,
            lambda done, n: F.replace(
                done,
                F.concat(F.lit("&#"), n, F.lit(";")),
                F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32"),
            ),
        )

    # transform(array(x), f) binds x once.
    col = F.transform(F.array(col), decimal)[0]
    for entity, char in ENTITIES:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def html_to_text(html: Column | str) -> Column:
    """Visible text of a web page on one line; main headings keep a leading ``#``."""
    out = F.regexp_replace(html, HIDDEN, " ")
    out = F.regexp_replace(out, r"(?i)<h1[^>]*>", "\n# ")
    out = F.regexp_replace(out, r"(?i)<p[^>]*>|</p>", "\n\n")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    out = F.regexp_replace(out, r"[ \t\n]+", " ")
    return F.trim(_decode_entities(out))


def html_to_markdown(html: Column | str) -> Column:
    """Markdown of a web page: headings, paragraphs, lists, tables, links, line breaks and code.

    Blocks are divided by blank lines, and so are the items of a list and the rows of a table.
    """
    out = F.regexp_replace(html, f"{HIDDEN}|{TITLE.removeprefix('(?is)')}", " ")
    for pattern, markdown in MARKDOWN:
        out = F.regexp_replace(out, pattern, markdown)
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r" ?\n[ \n]*", "\n\n")
    return F.regexp_replace(_decode_entities(out), r"^[ \n]+|[ \n]+$", "")


def bytes_to_text(content: Column) -> Column:
    """File bytes as text without a byte order mark; malformed sequences become replacement characters."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^\ufeff", "")


def is_html(text: Column) -> Column:
    """True for a page: its first tag, after any prolog and comments, is one that only pages begin with."""
    begin = r"(?is)^\s*(?:<\?xml.*?\?>\s*)?(?:<!--.*?-->\s*)*<(?:!doctype\s+html|html|head|body)[\s>]"
    return F.regexp_like(text, F.lit(begin))


def export_document(content: Column, mime_type: Column, format: str = "markdown") -> Column:
    """Text of one file: web pages are converted, plain text is kept, typed binary formats give null."""
    text = bytes_to_text(content)
    page = html_to_markdown(text) if format == "markdown" else html_to_text(text)
    return F.when(mime_type.isNull(), F.when(is_html(text), page).otherwise(text))


def split_pages(text: Column | str, delimiter: str = "\f") -> Column:
    """Pages of a text as ``array<struct<page_content, page_number>>``.

    Numbers count from 1 over all pages; blank pages are left out without renumbering the rest.
    """
    pages = F.transform(
        F.split(text, re.escape(delimiter)),
        lambda page, i: F.struct(page.alias("page_content"), (i + 1).cast("int").alias("page_number")),
    )
    return F.filter(pages, lambda page: F.length(F.trim(page["page_content"], F.lit(BLANKS))) > 0)


def chunk_fixed(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Overlapping windows of ``size`` characters every ``size - overlap`` characters, as an array.

    ``substring`` counts from the start of the text every time, which is quadratic in its length, so the text is cut into
    strides once by a regular expression and each window is put together from neighbouring strides.
    """
    stride = size - overlap
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the chunk size")
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / F.lit(float(stride))).cast("int"))
    windows = F.sequence(F.lit(0), last)
    strides = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    per_window = -(-size // stride)
    # transform(array(x), f) binds x once, so the strides are not cut again for every window.
    chunks = F.transform(
        F.array(strides),
        lambda cut: F.transform(
            windows, lambda k: F.left(F.array_join(F.slice(cut, k + 1, F.lit(per_window)), ""), F.lit(size))
        ),
    )[0]
    return F.when(F.length(text) > 0, chunks)


def _pieces(text: str, lo: int, hi: int, separator: str) -> Sequence[int]:
    """Start offsets of the pieces of ``text[lo:hi]``; a separator stays at the head of the piece it opens."""
    if not separator:
        return range(lo, hi)
    starts = [m.start() for m in re.compile(re.escape(separator)).finditer(text, lo, hi)]
    return starts if starts[0] == lo else [lo, *starts]


def chunk_spans(text: str, size: int, overlap: int, lo: int = 0, hi: int | None = None, level: int = 0):
    """Offsets ``(start, end)`` of the chunks of ``text[lo:hi]``, before blanks are stripped.

    The first separator that occurs cuts the text into pieces. A run of pieces shorter than ``size`` is packed
    greedily; each next chunk starts at the earliest piece that keeps the overlap within bounds and leaves room for
    the piece that did not fit. A piece of ``size`` or more is cut again by the later separators.
    """
    hi = len(text) if hi is None else hi
    if lo >= hi:
        return
    while SEPARATORS[level] and text.find(SEPARATORS[level], lo, hi) < 0:
        level += 1
    starts = _pieces(text, lo, hi, SEPARATORS[level])
    ends = range(lo + 1, hi + 1) if isinstance(starts, range) else [*starts[1:], hi]
    last_level = level == len(SEPARATORS) - 1
    long = [] if last_level and size > 1 else [i for i in range(len(starts)) if ends[i] - starts[i] >= size]
    first = 0
    for stop in [*long, len(starts)]:
        begin = starts[first] if first < stop else None
        while begin is not None:
            j = bisect_right(ends, begin + size, first, stop) - 1
            yield begin, ends[j]
            if j + 1 == stop:
                break
            begin = starts[bisect_left(starts, max(ends[j] - overlap, ends[j + 1] - size), first, stop)]
        if stop < len(starts):
            if last_level:
                yield starts[stop], ends[stop]
            else:
                yield from chunk_spans(text, size, overlap, starts[stop], ends[stop], level + 1)
        first = stop + 1


def recursive_chunker(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP):
    """An Arrow-batched function from text to its chunks; null and blank texts give no chunks."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the chunk size")

    def chunks_of(text: str | None) -> list[str]:
        stripped = (text[a:b].strip() for a, b in chunk_spans(text or "", size, overlap))
        return [chunk for chunk in stripped if chunk]

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(chunks_of)

    return split_batches


def chunk_recursive(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Chunks of ``text`` cut at blank lines, lines, words and then characters, as an array.

    Texts of at most ``size`` characters are one chunk and never leave the JVM.
    """
    trimmed = F.trim(text, F.lit(BLANKS))
    one = F.when(F.length(trimmed) > 0, F.array(trimmed))
    to_python = F.when(F.length(text) > size, text)
    return F.when(F.length(text) <= size, one).otherwise(recursive_chunker(size, overlap)(to_python))
