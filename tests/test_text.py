from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from papertrove.functions import media, text
from papertrove.operators import documents as docs


def pack(pieces, size, overlap):
    """Greedy packing written the long way: add pieces, emit when full, drop from the front."""
    chunks, held = [], []
    for piece in pieces:
        if held and sum(map(len, held)) + len(piece) > size:
            chunks.append("".join(held))
            while held and (sum(map(len, held)) > overlap or sum(map(len, held)) + len(piece) > size):
                held.pop(0)
        held.append(piece)
    return chunks + (["".join(held)] if held else [])


def slow_chunks(value, size, overlap, separators=text.SEPARATORS):
    """The contract of the recursive chunker, piece by piece."""
    at = next(i for i, s in enumerate(separators) if s in value)
    if separators[at] == "":
        pieces = list(value)
    else:
        parts = re.split(re.escape(separators[at]), value)
        pieces = [p for p in [parts[0], *(separators[at] + p for p in parts[1:])] if p]
    out, short = [], []
    for piece in pieces:
        if len(piece) < size:
            short.append(piece)
            continue
        out += pack(short, size, overlap)
        short = []
        out += slow_chunks(piece, size, overlap, separators[at + 1 :]) if separators[at] else [piece]
    return out + pack(short, size, overlap)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab \nü", max_size=200), st.integers(2, 30), st.data())
def test_spans_follow_the_contract(value, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    spans = list(text.chunk_spans(value, size, overlap))
    assert [value[a:b] for a, b in spans] == (slow_chunks(value, size, overlap) if value else [])
    covered = set()
    for a, b in spans:
        assert b - a <= size
        covered.update(range(a, b))
    assert covered == set(range(len(value)))
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c and b < d and b - c <= overlap


def test_spans_of_long_text_stay_linear():
    value = "word " * 400_000
    spans = list(text.chunk_spans(value, 1000, 200))
    assert spans[0] == (0, 999) and spans[-1][1] == len(value)


EDGES = ["", " \n\t ", None, "x" * 1000, "x" * 1001, "ü" * 2500, "a b", "x" * 999 + "\n" + "y" * 999, "  lead and trail  "]


def test_recursive_edges(spark):
    rows = spark.createDataFrame(list(enumerate(EDGES)), "id int, t string")
    found = docs.explode_chunks(rows, text.chunk_recursive(F.col("t")), name="chunk").drop("t").collect()
    by_id = {}
    for row in sorted(found):
        by_id.setdefault(row.id, []).append(row.chunk)
    expected = {}
    for i, value in enumerate(EDGES):
        chunks = [c.strip() for c in slow_chunks(value, 1000, 200)] if value else []
        if [c for c in chunks if c]:
            expected[i] = [c for c in chunks if c]
    assert by_id == expected
    assert {0, 1, 2}.isdisjoint(by_id)


def test_lost_rows(spark):
    rows = spark.createDataFrame(list(enumerate(EDGES)), "id int, t string")
    chunks = docs.explode_chunks(rows, text.chunk_recursive(F.col("t")))
    assert {r.id for r in docs.lost_rows(rows, chunks, "id").collect()} == {0, 1, 2}


@pytest.mark.parametrize("size,overlap", [(10, 3), (10, 6), (7, 0)])
def test_fixed_windows_of_short_and_long_texts(spark, size, overlap):
    values = ["ab𝒳ü" * n + "z" * m for n in (1, 2, 5, 170, 400) for m in range(4)]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    found = rows.select("id", text.chunk_fixed(F.col("t"), size, overlap).alias("c")).collect()
    step = size - overlap
    for row in found:
        value = values[row.id]
        n = max(0, -(-(len(value) - size) // step)) + 1
        assert row.c == [value[k * step : k * step + size] for k in range(n)]


def test_bad_overlap():
    with pytest.raises(ValueError):
        text.chunk_fixed(F.lit("x"), 10, 10)
    with pytest.raises(ValueError):
        text.recursive_chunker(10, 11)


def test_pages_keep_their_numbers(spark):
    rows = spark.createDataFrame([(1, "one\f\f three \f "), (2, None)], "id int, t string")
    pages = docs.explode_structs(rows, text.split_pages("t"), drop=["t"]).collect()
    assert [(p.id, p.page_number, p.page_content) for p in pages] == [(1, 1, "one"), (1, 3, " three ")]


def test_page_chunks_do_not_span_pages(spark):
    rows = spark.createDataFrame([("a", "x " * 700 + "\f" + "y " * 700)], "source_path string, content string")
    chunks = docs.process_pages(rows).collect()
    assert {c.page_number for c in chunks} == {1, 2}
    assert all(("x" in c.chunks) != ("y" in c.chunks) for c in chunks)


def test_html(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><STYLE>p{}</STYLE></head><body><nav><a>n</a></nav><!-- c -->"
        "<h1>Head &amp;lt;</h1><p>one <b>two</b></p><p>three &lt;&gt; &quot;q&quot;</p></body></html>"
    )
    row = spark.createDataFrame([(page,)], "h string").select(
        text.html_to_markdown("h").alias("md"), text.html_to_text("h").alias("txt")
    ).first()
    assert row.md == '# Head &lt;\n\none two\n\nthree <> "q"'
    assert row.txt == 'T # Head &lt; one two three <> "q"'


def test_export_by_type(spark):
    from papertrove.functions.media import sniff_mime

    files = [(1, b"<html><p>a</p></html>"), (2, b"plain <p>"), (3, b"%PDF-1.7 x"), (4, b"bad \xff bytes")]
    rows = spark.createDataFrame(files, "id int, b binary")
    found = {r.id: r.t for r in rows.select("id", text.export_document(F.col("b"), sniff_mime(F.col("b"))).alias("t")).collect()}
    assert found == {1: "a", 2: "plain <p>", 3: None, 4: "bad � bytes"}


def exported(spark, contents):
    rows = spark.createDataFrame(list(enumerate(contents)), "id int, content binary")
    found = rows.select("id", text.export_document(F.col("content"), media.sniff_mime(F.col("content"))).alias("out"))
    return {r.id: r.out for r in found.collect()}


def test_texts_that_begin_like_a_file_type_stay(spark):
    found = exported(spark, [b"BMW annual report", b"GIF89 is a format", b"BM\x36\0\0\0\0\0\0\0\x36\0\0\0\x28\0\0\0", b"%PDF-1.7"])
    assert found == {0: "BMW annual report", 1: "GIF89 is a format", 2: None, 3: None}


def test_pages_behind_marks_prologs_and_comments(spark):
    page = b"<html><p>a</p></html>"
    heads = [b"\xef\xbb\xbf", b"<?xml version='1.0'?>\n", b"<!-- x -->\n<!-- y -->", b" <!DOCTYPE html>\n"]
    assert set(exported(spark, [head + page for head in heads]).values()) == {"a"}
    assert exported(spark, [b"\xef\xbb\xbfplain <html> text", b"<p>a</p>"]) == {0: "plain <html> text", 1: "<p>a</p>"}


def test_fixed_chunks_do_not_depend_on_the_length(spark):
    rows = spark.createDataFrame([(b"ab\xc3" + b"c" * n,) for n in (5, 5000)], "content binary")
    firsts = [r[0] for r in rows.select(text.chunk_fixed(F.col("content").cast("string"), 10, 2)[0]).collect()]
    assert firsts[0][:6] == firsts[1][:6]


def test_blocks_of_a_page(spark):
    html = (
        "<h2>Sub</h2><ul><li>one</li><LI class=x>two</ul>x&nbsp;&#39;&#8212;&#55296;&amp;#38;"
        '<a class="k" href="/l">t</a><br>z<table><tr><td>1</td><td>2</td></tr></table><pre><code>c</code></pre>'
    )
    found = spark.range(1).select(text.html_to_markdown(F.lit(html)).alias("m")).first().m
    lines = [line.strip() for line in found.split("\n") if line.strip()]
    assert lines == [
        "## Sub", "- one", "- two", "x '—&#55296;&#38;[t](/l)", "z", "| 1 | 2 |", "```", "c", "```",
    ]
