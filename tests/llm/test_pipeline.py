"""The whole pipeline on a small folder, against a plain version of every stage."""

from __future__ import annotations

import random
import re
import zlib

import corpus_pipeline
import numpy as np

import __spark_entry__ as contract
from papertrove.llm import decontaminate, quality_rules, secret_scan, simhash
from papertrove.llm.tokens import word_encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def line_fails(line: str) -> bool:
    words = WORD.findall(line)
    if not words:
        return False
    symbols = len(re.findall(quality_rules.SYMBOLS, line))
    return bool(
        not re.search(quality_rules.SENTENCE_END, line.rstrip(" \t\x0b\f\r")[-8:])
        or (len(words) >= 4 and 5 * sum(w in quality_rules.SEPARATORS for w in words) >= len(words))
        or symbols * 100 > quality_rules.MAX_SYMBOL_PERCENT * len(line)
        or (len(words) >= 10 and line == line.upper() and line != line.lower())
        or (len(words) >= 10 and len(set(words)) * 100 < quality_rules.MIN_DISTINCT_PERCENT * len(words))
        or any(phrase in line.lower() for phrase in quality_rules.BOILERPLATE)
    )


def cleaned(text: str | None) -> str | None:
    """The text without failing lines, or none if the document is rejected."""
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
        return None
    lines = text.split("\n")
    lost = sum(len(WORD.findall(line)) for line in lines if line_fails(line))
    return None if 100 * lost > 50 * len(words) else "\n".join(line for line in lines if not line_fails(line))


def brute(rows, items):
    kept = [(i, text) for i, text in ((i, cleaned(text)) for i, text in rows) if text is not None]
    codes = {i: simhash.fingerprint(text) for i, text in kept}
    root = {i: i for i in codes}
    for a in sorted(codes):
        for b in sorted(codes):
            if a < b and (codes[a] ^ codes[b]).bit_count() <= 2 and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    kept = [(i, text) for i, text in kept if root[i] == i]
    windows = {w for body in items for w in decontaminate.windows_of(body)}
    out = {}
    for i, text in kept:
        words = decontaminate.words_of(text)
        hit = {
            at + k
            for w in windows
            for at in range(len(words) - len(w) + 1)
            if tuple(words[at : at + len(w)]) == w
            for k in range(len(w))
        }
        if not (hit and 20 * len(hit) >= len(words)):
            masked = secret_scan.masked(text)
            out[i] = [*word_encoder().tokenizer.encode(masked, add_special_tokens=False).ids, 2]
    return out


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    rng = random.Random(11)
    names = [a + b for a in ("ro", "la", "mi", "tu", "ne") for b in ("ka", "so", "vi", "pe")]
    sentence = lambda n: " ".join(rng.choices(names, k=n)).capitalize() + "."
    texts = ["\n".join(" ".join(f"{w}{rng.randrange(400)}" for w in sentence(20)[:-1].split()) + "." for _ in range(9)) for _ in range(24)]
    items = [" ".join(f"bench{i}w{k}" for k in range(20)) for i in range(3)] + ["short item"]
    texts[3] = texts[2] + f"\nIt says {items[0]} here."
    texts[4], texts[5] = texts[6], texts[7].upper()
    texts[8] += "\nThe password=abcdef0123456789abcdef0123 is here."
    texts[9] = "\n".join(line[:-1] for line in texts[9].split("\n"))
    texts[10] += "\nno end here\nAll rights reserved."
    texts += [None, "", "short.", "same word again " * 40]
    order = list(enumerate(texts))
    rng.shuffle(order)
    documents = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in order], "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    expected = brute(order, items)
    assert 10 < len(expected) < 22 and 3 not in expected and 6 not in expected and 9 not in expected and 8 in expected
    rows = contract.queries()["pipeline"](spark, str(tmp_path)).collect()
    assert {row["doc_id"] for row in rows} == set(expected)
    place = 0
    for row in sorted(rows, key=lambda row: (row["sequence_id"], row["offset"])):
        ids = expected[row["doc_id"]]
        assert row["sequence_id"] * 4096 + row["offset"] == place and row["doc_tokens"] == len(ids)
        piece = np.array(ids[row["start"] : row["start"] + row["length"]], "<u4")
        assert row["ids_crc32"] == zlib.crc32(piece.tobytes())
        place += row["length"]
    assert place == sum(map(len, expected.values()))

    # All stages but the last keep the columns of documents.
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == documents.columns
