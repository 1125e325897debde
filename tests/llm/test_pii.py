"""Personal data: base patterns, shapes, the field's training and its decoding against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from papertrove.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string, spans string, n_email int, sentence int, label string, base_sha256 int"


def passes(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        twice = [sum(divmod(d * 2, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return True


def brute_base(text):
    return [(kind, *m.span()) for kind, p in PLAIN.items() for m in re.finditer(p, text) if passes(kind, m[0])]


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii.labelled_sentences())


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choices("a.@%-1234567890 +()Zé\n", k=rng.randrange(60)))
        assert pii.base_spans(text) == brute_base(text), text
    for size in (14, 15, 16, 17, 19, 20):
        for _ in range(30):
            digits = "".join(rng.choices("0123456789", k=size - 1))
            text = "x" + rng.choice(["", " ", "-"]).join(digits + pii._check_digit(digits)) + " 5"
            assert pii.base_spans(text) == brute_base(text), text
    assert pii.base_spans("") == []


def test_long_runs_are_scanned_in_linear_time():
    for text in ("1" * 2_000_000, "a" * 2_000_000, "a@" * 500_000, "1." * 1_000_000, "+1 " + " " * 1_000_000):
        assert len(pii.base_spans(text)) in (0, len(text) // 8, len(text) // 8 - 1)


def plain_shape(word):
    core = word.strip(pii.EDGES.decode())
    kinds = "".join(
        "d" if c in "0123456789" else "x" * len(c.encode()) if c > "\x7f" or c in "abcdefghijklmnopqrstuvwxyz" else "X" if "A" <= c <= "Z" else c
        for c in core
    )
    exact = re.sub(r"(x|X)\1{3,}", r"\1\1\1\1", kinds)
    return exact, re.sub(r"(x|X|d)\1+", r"\1", kinds), min(kinds.count("d"), pii.MOST_DIGITS), core


def test_shapes_equal_plain_ones():
    rng = random.Random(2)
    texts = ["".join(rng.choices("aB1.,(é!- \n", k=rng.randrange(40))) for _ in range(300)] + ["", "!!", "?? a", "!", None]
    shapes = pii.Shapes(pa.array(texts, pa.string()))
    words = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    plain = [plain_shape(w) for w in words]
    for codes, of in ((shapes.exact, 0), (shapes.rough, 1)):
        seen = dict(zip([p[of] for p in plain], codes.tolist(), strict=True))
        assert [seen[p[of]] for p in plain] == codes.tolist()
        assert len(set(seen.values())) == len(seen)
    assert [p[2] for p in plain] == shapes.digits.tolist()
    cores = [shapes.words.data[a:b].tobytes().decode() for a, b in zip(shapes.starts, shapes.ends, strict=True)]
    assert cores == [p[3] for p in plain]


def plain_viterbi(scores, moves):
    best, back = scores[0].astype(float), []
    for row in scores[1:]:
        reached = best[:, None] + moves
        back.append(reached.argmax(axis=0))
        best = reached.max(axis=0) + row
    labels = [int(best.argmax())]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return best.max(), labels[::-1]


def path_score(scores, moves, labels):
    return sum(scores[i, x] for i, x in enumerate(labels)) + sum(moves[a, b] for a, b in itertools.pairwise(labels))


def test_decoding_is_a_best_path():
    rng = np.random.default_rng(3)
    count = len(pii.LABELS)
    for trial in range(60):
        sizes = rng.integers(0, 25, 12)
        scores = rng.normal(0, 2, (int(sizes.sum()), count)).astype(np.float32)
        scores[:, 0] += rng.choice([0, 3, 12], len(scores))
        model = pii.Field([], [], rng.normal(0, trial % 4, (count, count)).astype(np.float32))
        bounds = np.append(0, np.cumsum(sizes))
        labels = model.decode(scores, bounds)
        for a, b in itertools.pairwise(bounds):
            if a < b:
                best, _ = plain_viterbi(scores[a:b], model.moves)
                assert abs(path_score(scores[a:b], model.moves, labels[a:b]) - best) < 1e-3


def test_likelihood_and_gradients():
    rng = np.random.default_rng(4)
    count = len(pii.LABELS)
    sizes = np.array([1, 3, 2])
    scores, moves = rng.normal(size=(3, 3, count)), rng.normal(size=(count, count))
    labels = rng.integers(0, count, (3, 3))
    value, by_scores, by_moves = pii.likelihood(scores, moves, sizes, labels)
    plain = 0.0
    for i, size in enumerate(sizes):
        paths = [path_score(scores[i, :size], moves, p) for p in itertools.product(range(count), repeat=int(size))]
        plain += path_score(scores[i, :size], moves, labels[i, :size]) - np.log(np.exp(paths).sum())
    assert abs(value - plain) < 1e-8
    for target, gradient in ((scores, by_scores), (moves, by_moves)):
        for at in list(np.ndindex(target.shape))[::5]:
            target[at] += 1e-5
            more = pii.likelihood(scores, moves, sizes, labels)[0]
            target[at] -= 1e-5
            assert abs((more - value) / 1e-5 - gradient[at]) < 1e-3


def test_held_out_sentences(field):
    held = pii.labelled_sentences(400, 99)
    shapes = pii.Shapes(pa.array([" ".join(word for word, _ in s) for s in held]))
    got = field.decode(field.scores(shapes.features()), shapes.words.bounds)
    want = np.array([pii.LABELS.index(label) for s in held for _, label in s])
    personal = want > 0
    assert (got[personal] == want[personal]).mean() > 0.94
    assert (got[~personal] == 0).mean() > 0.99


def test_added_spans(field):
    texts = [
        "please call (743) 555-3824, or write to joe.b [at] mail.com, thanks",
        "é his number is 123-45-6789!!! and the account DE89 3704 0044 0532 0130 00.",
        "plain words of 12 items, version 1.2.3, 2019-10-12 and 30% of $120.50",
        "call +1 (743) 555-3824 or a.b@c.de",
        None,
    ]
    found = pii.personal_spans(field, pa.array(texts, pa.string()))
    bodies = [[(kind, text[a:b]) for kind, a, b in spans] for text, spans in zip(texts, found, strict=True) if text]
    assert bodies[0] == [("crf_email", "joe.b [at] mail.com"), ("crf_phone", "(743) 555-3824")]
    assert bodies[1] == [("crf_id", "123-45-6789"), ("crf_iban", "DE89 3704 0044 0532 0130 00")]
    assert bodies[2] == []
    assert bodies[3] == [("email", "a.b@c.de"), ("phone", "+1 (743) 555-3824")]
    assert found[4] == []


def test_query_rows(spark):
    texts = ["mail a@b.co", None, "", "call (743) 555-3824 now", "x " * 300_000 + "1.2.3.4", "mail a@b.co"]
    rows = [(i, t, "clash", 1, 2, "clash", 3) for i, t in zip([0, 1, 2, None, 4, 0], texts, strict=True)]
    got = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA), pii.labelled_table(spark)).collect()
    assert len(got) == len(texts)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["spans"] == "email:5:11" and by_id[0]["n_email"] == 1
    assert by_id[0]["base_sha256"] == hashlib.sha256(b"email:5:11").hexdigest()
    assert by_id[1]["spans"] == by_id[2]["spans"] == ""
    assert by_id[None]["spans"] == "crf_phone:5:19" and by_id[None]["n_phone"] == 0 and by_id[None]["n_crf_phone"] == 1
    assert by_id[4]["spans"] == "ip:600000:600007"
    empty = spark.createDataFrame([], "sentence long, place int, word string, label string")
    none = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA), empty).collect()
    assert sorted(r["spans"] for r in none) == ["", "", "", "email:5:11", "email:5:11", "ip:600000:600007"]
    assert pii.find_personal_data(spark.createDataFrame([], SCHEMA), empty).collect() == []
