"""The manifest against a plain tree, over few and many blocks, and the sharing of versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from papertrove.llm import merkle

SCHEMA = (
    "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, digest string, block int, "
    "path string, size int, changed string"
)


def documents(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", 2, "z", 3, "w") for row in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], row[4])))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, i):
    steps = []
    for nodes in levels[:-1]:
        start = i // 3 * 3
        steps.append((nodes[start:i], nodes[i + 1 : start + 3]))
        i //= 3
    return steps


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = levels_of([leaf(r) for r in groups[name]])
    over = levels_of([trees[name][-1][0] for name in names])
    out = []
    for s, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            steps = way(trees[name], i) + way(over, s)
            text = row[4]
            tampered = row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            digest = leaf((*row[:4], text.replace("\n", "") if tampered else text))
            for left, right in steps:
                digest = sha("".join([*left, digest, *right]))
            proof = sha("".join("".join(left + right) for left, right in steps))
            root = over[-1][0]
            out.append((row[0], leaf(row), trees[name][-1][0], root, proof, digest, digest == root))
    return Counter(out)


def random_rows(seed, count, sources):
    rng = random.Random(seed)
    texts = ["a\nb", "", None, "plain", "é\n\n", "x" * 40_000 + "\n"]
    return [
        (i, rng.choice(sources), rng.choice(["en", None, ""]), rng.choice([3, None]), rng.choice(texts)) for i in range(count)
    ]


@pytest.mark.parametrize("height", [merkle.HEIGHT, 1, 2])
def test_manifest_equals_a_plain_tree(spark, height):
    rows = random_rows(1, 130, ["hot"] * 6 + ["b", "é", "", None, "Z", "z"])
    rows += [(None, "b", "en", 1, "a\nb"), (None, "b", "en", 1, "a\nb"), (7, "b", None, None, "again"), (7, "b", None, None, "again")]
    rows += [(900 + i, f"one{i}", "en", 1, "a\nb") for i in range(12)]
    found = merkle.manifest(documents(spark, rows), merkle.tampered_text(), height)
    assert Counter(tuple(r)[:7] for r in found.collect()) == expected(rows)


@pytest.mark.parametrize("count", [0, 1, 2, 4])
def test_small_tables(spark, count):
    rows = random_rows(2, count, ["only"])
    found = merkle.manifest(documents(spark, rows), merkle.tampered_text(), 1).collect()
    assert Counter(tuple(r)[:7] for r in found) == expected(rows)


def test_untouched_rows_are_verified(spark):
    found = merkle.manifest(documents(spark, random_rows(3, 20, ["a", "b"]))).collect()
    assert all(r["verified"] and r["n_copied"] == 0 for r in found)


def test_versions_share_what_they_do_not_copy():
    rng = random.Random(4)
    for count in (1, 2, 3, 4, 27, 28, 100):
        leaves = [rng.randbytes(32) for _ in range(count)]
        tree = merkle.Versions(leaves)
        before = list(zip(tree.digests, tree.children, strict=True))
        for i in {0, count // 2, count - 1}:
            size = len(tree.digests)
            version = tree.changed(i, bytes(32))
            plain = merkle.Versions([*leaves[:i], bytes(32), *leaves[i + 1 :]])
            assert tree.digests[version] == plain.digests[plain.first]
            assert len(tree.digests) - size == len(tree.levels)  # one copy a level, the leaf included
            assert merkle.folded(bytes(32), tree.siblings(i)) == tree.digests[version]
            assert merkle.from_path(merkle.to_path(tree.siblings(i))) == tree.siblings(i)
        assert list(zip(tree.digests, tree.children, strict=True))[: len(before)] == before
