"""Pieces of DuckDB SQL that several checks share."""

from __future__ import annotations

from papertrove.functions.text import BLANKS, ENTITIES, MARKDOWN

_BLANK_CODES = " || ".join(f"chr({ord(c)})" for c in BLANKS)


def fixed_chunks_sql(source: str, key: str, text: str = "text", size: int = 1000, overlap: int = 200) -> str:
    """SELECT of ``(key, chunk_index, chunk)`` with overlapping windows over ``source``."""
    stride = size - overlap
    return f"""
  SELECT {key}, CAST(k AS INTEGER) AS chunk_index, substring({text}, CAST(k * {stride} + 1 AS INTEGER), {size}) AS chunk
  FROM (SELECT {key}, {text},
          unnest(range(0, CAST(greatest(0, ceil((length({text}) - {size}) / {stride}.0)) AS BIGINT) + 1)) AS k
        FROM {source} WHERE length({text}) > 0)"""


def recursive_chunks_sql(source: str, size: int = 1000, overlap: int = 200) -> str:
    """CTEs ending in ``chunked(id, chunk_index, chunk)`` for ``source(id, text)``; needs WITH RECURSIVE.

    Level by level, texts holding a separator fall into pieces and long pieces go on to the next level. The chunks of a
    run of short pieces are then walked with list functions: the end is the last piece end in reach, the next start the
    first piece start that keeps overlap and size.
    """
    parts = [f"seg0 AS (SELECT id, 0::BIGINT AS lo, text AS txt FROM {source} WHERE length(text) > 0)"]
    runs = []
    for level, separator in enumerate(("chr(10) || chr(10)", "chr(10)", "' '", None)):
        here = f"seg{level}"
        if separator is None:
            runs.append(
                f"SELECT id, lo AS run, range(lo, lo + length(txt)) AS starts, "
                f"range(lo + 1, lo + length(txt) + 1) AS ends FROM {here}"
            )
            continue
        parts.append(
            f"""pieces{level} AS (
  SELECT id, seg, piece, lo + coalesce(sum(length(piece)) OVER (PARTITION BY id, seg ORDER BY i
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo
  FROM (SELECT id, lo AS seg, lo, i, CASE WHEN i = 1 THEN p ELSE {separator} || p END AS piece
        FROM (SELECT id, lo, unnest(string_split(txt, {separator})) AS p,
                     generate_subscripts(string_split(txt, {separator}), 1) AS i
              FROM {here} WHERE contains(txt, {separator})))
  WHERE length(piece) > 0),
grouped{level} AS (
  SELECT *, sum(CASE WHEN length(piece) >= {size} THEN 1 ELSE 0 END) OVER (PARTITION BY id, seg ORDER BY lo) AS g
  FROM pieces{level})"""
        )
        runs.append(
            f"""SELECT id, CAST(min(lo) AS BIGINT) AS run, list(CAST(lo AS BIGINT) ORDER BY lo) AS starts,
       list(CAST(lo + length(piece) AS BIGINT) ORDER BY lo) AS ends
FROM grouped{level} WHERE length(piece) < {size} GROUP BY id, seg, g"""
        )
        parts.append(
            f"""seg{level + 1} AS (
  SELECT id, lo, txt FROM {here} WHERE NOT contains(txt, {separator})
  UNION ALL SELECT id, CAST(lo AS BIGINT), piece FROM pieces{level} WHERE length(piece) >= {size})"""
        )
    parts.append("runs AS (" + "\nUNION ALL ".join(runs) + ")")
    parts.append(
        f"""walk(id, run, cs, ce) AS (
  SELECT id, run, starts[1], list_max(list_filter(ends, lambda e: e <= starts[1] + {size})) FROM runs
  UNION ALL
  SELECT id, run, ns, list_max(list_filter(ends, lambda e: e <= ns + {size})) FROM (
    SELECT id, run, ends, list_min(list_filter(starts, lambda s: s >= greatest(ce - {overlap}, ne - {size}))) AS ns FROM (
      SELECT w.id, w.run, w.ce, r.starts, r.ends, list_min(list_filter(r.ends, lambda e: e > w.ce)) AS ne
      FROM walk w JOIN runs r ON w.id = r.id AND w.run = r.run
      WHERE w.ce < r.ends[len(r.ends)])))"""
    )
    parts.append(
        f"""cut AS (
  SELECT w.id, w.cs, trim(substring(s.text, CAST(w.cs + 1 AS INTEGER), CAST(w.ce - w.cs AS INTEGER)), {_BLANK_CODES}) AS chunk
  FROM walk w JOIN {source} s ON w.id = s.id),
chunked AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY cs) - 1 AS INTEGER) AS chunk_index, chunk
  FROM cut WHERE length(chunk) > 0)"""
    )
    return ",\n".join(parts)


def markdown_sql(html: str = "html") -> str:
    hidden = (
        r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<nav[^>]*>.*?</nav>|<!--.*?-->|<title[^>]*>.*?</title>"
    )
    out = f"regexp_replace({html}, '{hidden}', ' ', 'g')"
    for pattern, markdown in MARKDOWN:
        markdown = markdown.replace("$", "\\").replace("\n", "' || chr(10) || '")
        out = f"regexp_replace({out}, '{pattern}', '{markdown}', 'g')"
    out = f"regexp_replace({out}, '<[^>]+>', ' ', 'g')"
    out = f"regexp_replace({out}, '[ \\t]+', ' ', 'g')"
    out = f"regexp_replace({out}, ' ?\\n[ \\n]*', chr(10) || chr(10), 'g')"
    return f"regexp_replace({entities_sql(out)}, '^[ \\n]+|[ \\n]+$', '', 'g')"


def text_sql(html: str = "html") -> str:
    hidden = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<nav[^>]*>.*?</nav>|<!--.*?-->"
    out = f"regexp_replace({html}, '{hidden}', ' ', 'g')"
    out = f"regexp_replace({out}, '(?i)<h1[^>]*>', chr(10) || '# ', 'g')"
    out = f"regexp_replace({out}, '(?i)<p[^>]*>|</p>', chr(10) || chr(10), 'g')"
    out = f"regexp_replace({out}, '<[^>]+>', ' ', 'g')"
    out = f"regexp_replace({out}, '[ \\t\\n]+', ' ', 'g')"
    return f"trim({entities_sql(out)})"


def entities_sql(value: str) -> str:
    value = (
        f"list_reduce(list_transform([{value}], lambda t: list_prepend(t, list_distinct(regexp_extract_all(t, "
        "'&#([0-9]{1,6});', 1))))[1], lambda t, n: replace(t, '&#' || n || ';', chr(CAST(n AS INTEGER))))"
    )
    for entity, char in ENTITIES:
        char = char.replace("'", "''")
        value = f"replace({value}, '{entity}', '{char}')"
    return value


def path_sql(url: str) -> str:
    return f"regexp_replace({url}, '^[A-Za-z][A-Za-z0-9+.-]*:/+', '/')"


def stem_sql(path: str) -> str:
    return f"regexp_replace(regexp_extract({path}, '([^/]*)/*$', 1), '^(.+)\\.[^.]+$', '\\1')"


def vectors_sql(source: str, keys: str, text: str, dimensions: int = 4096) -> str:
    """SELECT of ``(keys, dim, n, weight)``: hashed bag of words with unit length."""
    return f"""
  SELECT {keys}, dim, n, n / sqrt(CAST(sum(n * n) OVER (PARTITION BY {keys}) AS DOUBLE)) AS weight FROM (
    SELECT {keys}, dim, CAST(count(*) AS DOUBLE) AS n FROM (
      SELECT {keys}, CAST(CAST('0x' || left(md5(token), 4) AS INTEGER) % {dimensions} AS INTEGER) AS dim FROM (
        SELECT {keys}, unnest(regexp_split_to_array(lower({text}), '[^a-z]+')) AS token FROM {source})
      WHERE token <> '') GROUP BY ALL)"""
