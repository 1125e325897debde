"""DuckDB SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from papertrove.llm import chat, decontaminate, merkle, quality_rules, repair, substrings

_SPACE = r"[\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return f"[x FOR x IN regexp_split_to_array({text}, {_quoted(_SPACE)}) IF x <> '']"


def _escaped(text: str) -> str:
    """Code points of a text after the template's escapes."""
    controls = "|".join("".join(f"\\{c}" if c in "[]/" else c for c in control) for control in chat.CONTROLS)
    doubled = rf"replace({text}, '\', '\\')"
    return f"(length({doubled}) + len(regexp_extract_all({doubled}, {_quoted(controls)})))"


def _marks() -> str:
    cases = [f"WHEN {_quoted(role)} THEN {sum(map(len, marks))}" for role, marks in chat.MARKS.items()]
    return f"CASE role {' '.join(cases)} ELSE {sum(map(len, chat.OTHER))} + {_escaped('role')} END"


CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum({_marks()} + {_escaped("text")})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_SEPARATORS = ", ".join(map(_quoted, quality_rules.SEPARATORS))
_PHRASES = " OR ".join(f"contains(lower(line), {_quoted(phrase)})" for phrase in quality_rules.BOILERPLATE)
_SYMBOLS = "(length({0}) - length(regexp_replace({0}, " + _quoted(quality_rules.SYMBOLS) + ", '', 'g')))"

QUALITY = f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, {_words("coalesce(text, '')")} AS words FROM documents
), placed AS (
    SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs
), windows AS (
    SELECT doc_id, i, w AS a, lead(w, 1) OVER own AS b, lead(w, 2) OVER own AS c FROM placed
    WINDOW own AS (PARTITION BY doc_id ORDER BY i)
), repeats AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM repeats, (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 GROUP BY doc_id
), lines AS (
    SELECT doc_id, line, {_words("line")} AS words FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
), judged AS (
    SELECT doc_id, line, len(words) AS n, len(words) > 0 AND (
        NOT regexp_matches(right(rtrim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)), 8),
            {_quoted(quality_rules.SENTENCE_END)})
        OR (len(words) >= 4 AND len([x FOR x IN words IF x IN ({_SEPARATORS})]) * 5 >= len(words))
        OR {_SYMBOLS.format("line")} * 100 > {quality_rules.MAX_SYMBOL_PERCENT} * length(line)
        OR (len(words) >= {quality_rules.MIN_RULE_WORDS} AND line = upper(line) AND line <> lower(line))
        OR (len(words) >= {quality_rules.MIN_RULE_WORDS}
            AND len(list_distinct(words)) * 100 < {quality_rules.MIN_DISTINCT_PERCENT} * len(words))
        OR {_PHRASES}
    ) AS failed FROM lines
), by_lines AS (
    SELECT doc_id, (count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0))::BIGINT AS n_dup_lines,
        coalesce(sum(n) FILTER (failed), 0)::BIGINT AS n_lost_words
    FROM judged GROUP BY doc_id
), counted AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars,
        {_SYMBOLS.format("text")}::BIGINT AS n_symbols, n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lost_words
    FROM docs JOIN by_lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), decided AS (
    SELECT *, n_words < {quality_rules.MIN_WORDS}
        OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND 100 * n_lost_words <= {quality_rules.MAX_LOST_PERCENT} * n_words AS kept FROM decided
"""

REPEATS = f"""
WITH docs AS (
    SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents
), placed AS (
    SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs
), windows AS (
    SELECT doc_id, i, array_to_string(list_slice(words, i, i + {substrings.WINDOW - 1}), ' ') AS key
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {substrings.WINDOW - 2})) AS i FROM docs)
), again AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + k AS i FROM again, range({substrings.WINDOW}) AS t(k)
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

_UPPER = "".join(map(chr, range(65, 91)))
_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _bench_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), {_quoted(_BENCH_WORD)})"


DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, {_bench_words("text")} AS words FROM documents
), items AS (
    SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_bench_words("text")} AS words FROM benchmark
), item_windows AS (
    SELECT DISTINCT item, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS key
    FROM (
        SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM (SELECT *, least(len(words), {decontaminate.WINDOW}) AS size FROM items WHERE len(words) > 0)
    )
), doc_windows AS (
    SELECT doc_id, size, i, array_to_string(list_slice(words, i, i + size - 1), ' ') AS key
    FROM (
        SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM item_windows)
    )
), found AS (
    SELECT doc_id, item, i, size FROM doc_windows JOIN item_windows USING (size, key)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _crc32(text: str) -> str:
    """The checksum of an ASCII string, bit by bit."""
    bits = f"flatten([[(ascii(x) >> k) & 1 FOR k IN range(8)] FOR x IN string_split({text}, '')])"
    step = "xor(c >> 1, (xor(c, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295, [x::BIGINT FOR x IN {bits}]), lambda c, b: {step}), 4294967295)"


def _step(state: str, letters: str, cost: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}'}} END"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _when(condition: str, option: str) -> str:
    return f"CASE WHEN {condition} THEN {option} END"


def _inserted(state: str, count: int) -> str:
    return _step(state, repair.INSERT * count, str(repair.INSERT_COST * count))


_KEPT, _REROLED = "stays", f"stays + {repair.REROLE_COST}"
_AFTER_INSERTS = f"""
    s0 AS x0, s1 AS x1, {_least("s2", *(_inserted(s, 1) for s in ("s0", "s1", "s3")))} AS x2,
    {_least("s3", _inserted("s2", 1), _inserted("s0", 2), _inserted("s1", 2))} AS x3
"""


def _moved(state: int) -> str:
    """The least of all edits of a row that lead to a state."""
    options = [_step(f"x{state}", repair.DELETE, str(repair.DELETE_COST))]
    if state == repair.SYSTEM:
        options.append(_when("NOT doomed AND initial = 's'", _step("x0", repair.KEEP, _KEPT)))
    for before in {repair.ASKED: (0, 1, 3), repair.ANSWERED: (2,)}.get(state, ()):
        initial = "u" if state == repair.ASKED else "a"
        options.append(_when(f"NOT doomed AND initial = '{initial}'", _step(f"x{before}", repair.KEEP, _KEPT)))
        options.append(_when("NOT doomed", _step(f"x{before}", repair.REROLE, _REROLED)))
    return _least(*options)


REPAIR = f"""
WITH RECURSIVE marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM marked
), placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
    FROM damaged
), judged AS (
    SELECT *, CASE
        WHEN shown = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM placed
), rows AS (
    SELECT *, fault IS NOT NULL AND fault <> 'truncated' AS doomed,
        CASE WHEN fault = 'truncated' THEN {repair.TRUNCATED_COST} ELSE 0 END AS stays
    FROM judged
), walked AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1,
        NULL::STRUCT(c BIGINT, a VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR) AS s3
    FROM rows
    UNION ALL
    SELECT conv_id, i, {", ".join(f"{_moved(s)} AS s{s}" for s in repair.STATES)}
    FROM (
        SELECT r.conv_id, r.i, doomed, initial, stays::BIGINT AS stays, {_AFTER_INSERTS}
        FROM walked w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    )
), ended AS (
    SELECT conv_id, {_least("s0", "s3", _inserted("s2", 1), _inserted("s1", 2))} AS best
    FROM walked QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), letters AS (
    SELECT conv_id, unnest(string_split(best.a, '')) AS letter, generate_subscripts(string_split(best.a, ''), 1) AS p
    FROM ended WHERE best.a <> ''
), numbered AS (
    SELECT *, count(*) FILTER (letter <> 'I') OVER own AS i, count(*) FILTER (letter <> 'D') OVER own AS w
    FROM letters WINDOW own AS (PARTITION BY conv_id ORDER BY p)
), turns AS (
    SELECT n.conv_id, n.p, letter, role, text, w - max(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS w
    FROM numbered n LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.i = n.i AND letter <> 'I'
    WHERE letter <> 'D'
), repaired AS (
    SELECT conv_id, sha256(string_agg(
        CASE WHEN letter = 'K' THEN role WHEN w % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p)) AS digest
    FROM turns GROUP BY conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
    coalesce(best.a, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(text if name == 'text' else name) for name in merkle.FIELDS)})"


def _levels(name: str, base: str) -> str:
    """All nodes of some trees, level by level; the nodes of one run have the same parent ``i // 3``."""
    return f"""{name} AS (
    {base}
    UNION ALL
    SELECT tree, level + 1, i // {merkle.RUN}, sha256(string_agg(digest, '' ORDER BY i)), (n + {merkle.RUN - 1}) // {merkle.RUN}
    FROM {name} WHERE n > 1 GROUP BY tree, level, i // {merkle.RUN}, n
)"""


MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce('s' || source, '') AS tree, {_leaf("text")} AS leaf,
        CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS changed
    FROM documents
), placed AS (
    SELECT *, row_number() OVER own - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves
    WINDOW own AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)
), {_levels("nodes", "SELECT tree, 0 AS level, i, leaf AS digest, n FROM placed")}, subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), {_levels("tops", "SELECT '' AS tree, 0 AS level, i, digest, n FROM subroots")}, root AS (
    SELECT digest FROM tops WHERE n = 1
), steps AS (
    SELECT row_id, level, i // power({merkle.RUN}, level)::BIGINT AS own, tree FROM placed, range(64) AS t(level)
    WHERE power({merkle.RUN}, level) < n OR level = 0
), siblings AS (
    SELECT row_id, 0 AS part, s.level, x.digest, x.i, x.i < own AS before
    FROM steps s JOIN nodes x ON x.tree = s.tree AND x.level = s.level AND x.i // {merkle.RUN} = own // {merkle.RUN} AND x.i <> own AND x.n > 1
    UNION ALL
    SELECT row_id, 1, s.level, x.digest, x.i, x.i < own
    FROM (
        SELECT row_id, t.level, s.i // power({merkle.RUN}, t.level)::BIGINT AS own
        FROM placed p JOIN subroots s USING (tree), range(64) AS t(level) WHERE power({merkle.RUN}, t.level) < s.n
    ) s JOIN tops x ON x.level = s.level AND x.i // {merkle.RUN} = own // {merkle.RUN} AND x.i <> own
), runs AS (
    SELECT row_id, part, level FROM (
        SELECT row_id, 0 AS part, level, tree FROM placed, range(64) AS t(level) WHERE power({merkle.RUN}, level) < n
        UNION ALL
        SELECT row_id, 1, level, tree FROM placed JOIN (SELECT DISTINCT n AS sources FROM subroots) ON true, range(64) AS t(level)
        WHERE power({merkle.RUN}, level) < sources
    )
), ways AS (
    SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY part, level) AS step,
        coalesce(string_agg(digest, '' ORDER BY x.i) FILTER (before), '') AS lefts,
        coalesce(string_agg(digest, '' ORDER BY x.i) FILTER (NOT before), '') AS rights
    FROM runs LEFT JOIN siblings x USING (row_id, part, level) GROUP BY row_id, part, level
), proofs AS (
    SELECT row_id, sha256(coalesce(string_agg(lefts || rights, '' ORDER BY step), '')) AS proof_sha256, count(*) AS steps FROM ways GROUP BY row_id
), folding AS (
    SELECT row_id, 0::BIGINT AS step, coalesce(changed, leaf) AS digest FROM placed
    UNION ALL
    SELECT f.row_id, w.step, sha256(lefts || f.digest || rights) FROM folding f JOIN ways w ON w.row_id = f.row_id AND w.step = f.step + 1
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, root.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
    f.digest AS folded_root, f.digest = root.digest AS verified
FROM placed p JOIN subroots s USING (tree) CROSS JOIN root LEFT JOIN proofs o USING (row_id)
    JOIN folding f ON f.row_id = p.row_id AND f.step = coalesce(o.steps, 0)
"""
