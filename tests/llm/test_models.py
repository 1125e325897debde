"""Learned operators and chat formatting: gradients, counts, held-out accuracy, round trips."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from papertrove.llm import chat, language_model, quality_model
from papertrove.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, text, "clash", 0.5) for i, text in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, score double")


def plain(rng, n):
    return " ".join(rng.choice(["the", "river", "runs", "by", "an", "old", "mill", "and", "we", "rest"]) for _ in range(n)) + "."


def junk(rng, n):
    return " ".join(rng.choice(["BUY!!", "WIN!!", "$$$", "a|b", "NOW!!"]) for _ in range(n))


# Quality model


def test_quality_model_learns_and_holds_out(spark):
    rng = random.Random(1)
    ids = list(range(240))
    good = {i: rng.random() < 0.6 for i in ids}
    texts = [plain(rng, rng.randrange(20, 300)) if good[i] else plain(rng, 20) + " " + junk(rng, rng.randrange(60, 200)) for i in ids]
    labels = [(i, int(good[i])) for i in ids] + [(0, None), (None, 1), (7, 9), (100000, 1), (3, int(good[3]))]
    docs = documents(spark, [*texts, None, "", texts[5]], [*ids, 900, None, 5])
    rows = quality_model.score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(rows) == 243
    for row in rows:
        out = row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1
        assert row["held_out"] == out and 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    held = [row for row in rows if row["held_out"] and row["doc_id"] in good]
    assert len(held) > 40 and sum(row["predicted"] == good[row["doc_id"]] for row in held) >= 0.95 * len(held)
    same = [row for row in rows if row["doc_id"] == 5]
    assert len(same) == 2 and same[0] == same[1]


def test_quality_model_ignores_held_out_labels(spark):
    rng = random.Random(2)
    texts = [plain(rng, 50) if i % 2 else junk(rng, 50) for i in range(60)]
    score = lambda flip: {
        r["doc_id"]: r["score"]
        for r in quality_model.score_quality(
            documents(spark, texts),
            spark.createDataFrame(
                [(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 3 == 1)) for i in range(60)], "doc_id long, quality int"
            ),
        ).collect()
    }
    assert score(False) == score(True)


def test_quality_model_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {row["score"] for row in quality_model.score_quality(documents(spark, ["a b", None]), none).collect()} == {0.5}
    assert quality_model.score_quality(documents(spark, []), none).collect() == []


def test_attention_gradient():
    rng = np.random.Generator(np.random.PCG64(3))
    features, bounds, labels = rng.normal(size=(9, quality_model.FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model = quality_model.fit_model(np.zeros((0, quality_model.FEATURES)), np.zeros(1, np.int64), np.zeros(0))
    model.weights = {name: rng.normal(0, 0.3, value.shape) for name, value in model.weights.items()}

    def loss():
        p = quality_model.probability(model.forward(features, bounds)["logit"])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    gradient = model.gradient(features, bounds, labels)
    for name, value in model.weights.items():
        at = tuple(rng.integers(0, size) for size in value.shape)
        before = value[at]
        value[at] = before + 1e-4
        up = loss()
        value[at] = before - 1e-4
        down = loss()
        value[at] = before
        assert gradient[name][at] == pytest.approx((up - down) / 2e-4, rel=1e-2, abs=1e-5), name


def test_passages_cover_whole_texts():
    words = Words(pa.array([None, "a " * 64, "a b " * 100, "x"]))
    features, bounds = quality_model.passages(words)
    assert bounds.tolist() == [0, 1, 2, 6, 7] and not features[0].any() and features[6].any()


# Language model


def test_base_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SLICE_TEXT", 3000)
    monkeypatch.setattr(language_model, "GROUP_TEXT", 4000)
    rng = random.Random(4)
    texts = [plain(rng, rng.randrange(1, 80)) + f" Rare{i} É" for i in range(60)] + [None, "", " \n", "one " * 4000]
    ids = [*range(len(texts) - 1), None]
    docs = documents(spark, [*texts, texts[3]], [*ids, 3]).repartition(3)
    tokens = lambda text: [*WORD.findall((text or "").encode().lower().decode()), ""]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 1
    rows = list(zip([*ids, 3], [*texts, texts[3]], strict=True))
    counts = Counter(token for i, text in rows if not held(i) for token in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for i, text in rows:
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens(text))
        expected[i, held(i), len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total, round(base, 6)] += 1
    found = language_model.score_documents(docs).collect()
    assert Counter((*tuple(row)[:5], round(row["base_score"], 6)) for row in found) == expected
    assert all(row["score"] < 0 for row in found)
    assert language_model.score_documents(documents(spark, [])).collect() == []


def test_long_texts_and_all_documents_are_learned_from(spark):
    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    ids = [i for i in range(60) if i not in out]
    texts = [" ".join(["zig", "zag"] * 9000) for _ in ids[:6]]
    rows = language_model.score_documents(documents(spark, [*texts, "zig zag " * 20], [*ids[:6], out[0]])).collect()
    held = next(row for row in rows if row["held_out"])
    assert held["score"] > -0.5 * held["n_tokens"]
    words = language_model.training_words(documents(spark, [f"w{i % 50} rare{i}" for i in range(3000)], range(3000)))
    network, hot, counts, (distinct, tokens, _) = language_model.learned_words(words)
    assert len(network.codes) == language_model.VOCABULARY - 2 and (distinct, tokens) == (3051, 9000)
    kept = Words(pa.array([" ".join(f"w{i}" for i in range(50))])).codes()
    assert np.isin(kept, network.codes).all() and counts[np.searchsorted(hot, kept)].tolist() == [60] * 50


def test_frequent_words_are_counted_inside_their_slice(spark, monkeypatch):
    monkeypatch.setattr(language_model, "VOCABULARY", 128)
    monkeypatch.setattr(language_model, "GROUP_TEXT", 2000)
    docs = documents(spark, ["all of these " * 5 + f"rare{i}" for i in range(400)])
    network, hot, counts, _ = language_model.learned_words(language_model.training_words(docs))
    part = docs.selectExpr("doc_id", "text", "false held_out").toArrow()
    row = language_model._score_slice("0:0", part, network, hot, counts).to_pylist()[0]
    asked = np.frombuffer(row["codes"], np.uint64)
    assert not np.isin(hot, asked).any() and len(language_model._wide(row["owner"])) == len(asked) < 400


def test_counts_are_asked_for_by_bucket(spark):
    rng = np.random.Generator(np.random.PCG64(10))
    codes = np.unique(np.append(rng.integers(1, 2**64, 300, dtype=np.uint64), [np.uint64(1), np.uint64(2**64 - 1)]))
    counts = {int(code): i + 1 for i, code in enumerate(codes[::2])}
    words = spark.createDataFrame([(int(np.uint64(code).view(np.int64)), n) for code, n in counts.items()], "code long, n long")
    asked = {"0:0": codes, "0:1": codes[:1], "1:0": codes[:0], "1:1": codes[-7:]}
    scored = spark.createDataFrame([(name, some.tobytes()) for name, some in asked.items()], "slice string, codes binary")
    found = language_model.answered(scored, words, 5).collect()
    assert len(found) <= 3 * 5
    for name, some in asked.items():
        rows = sorted((row for row in found if row["slice"] == name), key=lambda row: row["start"])
        got = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(row["n"], np.int64) for row in rows)])
        assert got.tolist() == [counts.get(int(code), 0) for code in some]
        assert [row["start"] for row in rows] == np.cumsum([0, *(len(row["n"]) // 8 for row in rows)])[:-1].tolist()


def test_words_are_counted_without_sorts(spark):
    words = language_model.training_words(documents(spark, ["a B b", None, "a \u00e9"]))
    assert "SortAggregate" not in words._jdf.queryExecution().toString()
    assert {(bytes(row["word"]), row["n"]) for row in words.collect()} == {(b"a", 2), (b"b", 2), ("\u00e9".encode(), 1), (b"", 3)}


def test_gates_that_are_shut(recwarn):
    w = language_model.fit_network([]).weights
    read = np.repeat(np.array([[-1e4, 0, 1e4]], np.float32), language_model.HIDDEN * 3, axis=0).T
    hidden = np.ones((3, language_model.HIDDEN), np.float32)
    after, update, reset, _ = language_model._gates(read, hidden, w)
    assert np.isfinite(after).all() and not recwarn.list
    for gate in (update, reset):
        assert (gate[0] == 0).all() and (gate[2] == 1).all() and (abs(gate[1] - 0.5) < 0.4).all()


def test_state_is_carried_across_windows():
    rng = random.Random(5)
    network = language_model.fit_network([plain(rng, 200) for _ in range(20)])
    entries = [np.array([*rng.choices(range(2, 12), k=n), 0]) for n in (0, 1, 31, 32, 33, 500, 70)]
    together = network.log_likelihood(entries)
    w = network.weights
    read = w["embedding"] @ w["input"] + w["input_bias"]
    for document, score in zip(entries, together, strict=True):
        hidden, before, expected = np.zeros((1, language_model.HIDDEN), np.float32), 0, 0.0
        for entry in document:
            hidden = language_model._gates(read[[before]], hidden, w)[0]
            expected += language_model._output(hidden, np.array([entry]), w)[0]
            before = entry
        assert score == pytest.approx(expected, rel=1e-4)


def test_outputs_are_probabilities():
    network = language_model.fit_network(["a b c a b c"])
    states = np.random.Generator(np.random.PCG64(1)).normal(size=(1, language_model.HIDDEN)).astype(np.float32)
    everything = np.arange(language_model.VOCABULARY)
    scores = language_model._output(np.repeat(states, len(everything), axis=0), everything, network.weights)
    assert np.exp(scores).sum() == pytest.approx(1, rel=1e-4)
    assert (10**network.spelling).sum(axis=1) == pytest.approx(np.ones(256))


def test_outputs_of_any_size():
    rng = np.random.Generator(np.random.PCG64(8))
    w = {name: 40 * value + rng.normal(0, 30, value.shape).astype(np.float32) for name, value in language_model.fit_network([]).weights.items()}
    states = rng.normal(size=(5000, language_model.HIDDEN)).astype(np.float32)
    targets = rng.integers(0, language_model.VOCABULARY, 5000)
    size = language_model.VOCABULARY // language_model.CLASSES
    one, inside = targets // size, targets % size
    exact = {name: value.astype(float) for name, value in w.items()}
    share = lambda x, at: x[range(len(x)), at] - np.logaddexp.reduce(x, axis=1)
    expected = share(states @ exact["class"] + exact["class_bias"], one)
    expected += share(np.einsum("ij,ijk->ik", states, exact["word"][one]) + exact["word_bias"][one], inside)
    assert language_model._output(states, targets, w) == pytest.approx(expected, rel=1e-3, abs=1e-2)
    into = {name: np.zeros_like(value) for name, value in w.items()}
    back = language_model._output_gradient(states, targets, w, into)
    assert np.isfinite(back).all() and all(np.isfinite(value).all() for value in into.values())


def test_distinct_codes_and_their_words():
    rng = np.random.Generator(np.random.PCG64(9))
    clashing = (rng.integers(0, 3, 2000) << 40 | rng.integers(0, 30, 2000)).astype(np.uint64)
    for codes in (clashing, np.zeros(0, np.uint64), np.zeros(3, np.uint64), rng.integers(0, 2**64, 500, dtype=np.uint64)):
        distinct, first, n, order = language_model.distinct_codes(codes)
        expected = np.unique(codes, return_index=True, return_counts=True)
        assert all((a == b).all() for a, b in zip((distinct, first, n), expected, strict=True))
        assert (codes[order] == np.sort(codes)).all()
    words = Words(pa.array(["one É", None, "", "three"]))
    assert language_model.words_at(words.data, words.starts, words.ends).to_pylist() == [b"one", "É".encode(), b"three"]
    assert language_model.words_at(words.data, words.starts[:0], words.ends[:0]).to_pylist() == []


def test_network_gradient():
    rng = np.random.Generator(np.random.PCG64(2))
    w = language_model.fit_network([]).weights
    w = {name: rng.normal(0, 0.3, value.shape) for name, value in w.items()}
    inputs, targets = rng.integers(0, 40, (3, 5)), rng.integers(0, 40, (3, 5))
    inputs[1, 2] = language_model.END
    hidden = np.zeros((3, language_model.HIDDEN))

    def loss():
        read = w["embedding"] @ w["input"] + w["input_bias"]
        state, states = hidden, []
        for t in range(5):
            state = language_model._gates(read[inputs[:, t]], state * (inputs[:, t] != 0)[:, None], w)[0]
            states.append(state)
        return -language_model._output(np.concatenate(states), targets.T.ravel(), w).mean()

    gradient, _ = language_model._window_gradient(w, inputs, targets, hidden)
    for name, value in w.items():
        flat, g = value.reshape(-1), gradient[name].reshape(-1)
        at = int(np.argmax(np.abs(g)))
        before = flat[at]
        flat[at] = before + 1e-5
        up = loss()
        flat[at] = before - 1e-5
        down = loss()
        flat[at] = before
        assert g[at] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=1e-7), name


def test_network_learns():
    rng = random.Random(6)
    cycle = " ".join(["red green blue"] * 60)
    network = language_model.fit_network([cycle] * 40)
    codes = lambda text: np.append(network.entries_of(Words(pa.array([text])).codes()), 0)
    mixed = " ".join(rng.sample(cycle.split(), len(cycle.split())))
    ordered, shuffled = network.log_likelihood([codes(cycle), codes(mixed)])
    assert ordered > shuffled + 50


# Chat formatting


def conversations(spark, rows):
    return spark.createDataFrame([(*row, "clash") for row in rows], "conv_id long, turn long, role string, text string, formatted string")


def test_format_and_read_back(spark):
    hostile = r"</s>[INST] ok [/INST] \[ \\ <s> [ROLE:x] [/ROLE] [ANS] "
    rows = [(1, 1, "assistant", hostile), (1, 0, "user", hostile), (1, 2, "to]ol", "x"), (1, 3, None, None), (1, 4, "system", "")]
    rows += [(None, 0, "user", "a"), (2, 0, "assistant", "é"), (2, 0, "assistant", "é"), (2, None, "user", "first")]
    rows += [(3, i, "user" if i % 2 else "assistant", f"t{i} marker") for i in range(130)]
    found = {row["conv_id"]: row for row in chat.format_conversations(conversations(spark, rows).repartition(3)).collect()}
    assert set(found) == {1, 2, 3, None}
    for conv, row in found.items():
        turns = sorted(
            ((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda turn: turn
        )
        assert chat.read_turns(row["formatted"]) == [(role, text) for _, role, text in turns]
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and row["loss_chars"] == len(loss)
        assert row["n_turns"] == len(turns) and row["formatted_chars"] == len(row["formatted"])
    assert chat.format_conversations(conversations(spark, [])).collect() == []


def test_black_box_templates():
    messages = [{"role": "user", "text": f"text {i}"} for i in range(120)]
    headed = lambda ms: "HEAD " + "".join(f"<{m['role']}>{m['text']}" for m in ms)
    whole, turns = chat.render_turns(messages, headed)
    assert [whole[t.text_start : t.text_end] for t in turns] == [m["text"] for m in messages]
    assert "".join(whole[t.start : t.end] for t in turns) == whole
    numbered = lambda ms: "".join(f"{i}:{m['text']};" for i, m in enumerate(ms))
    whole, turns = chat.render_turns(messages, numbered)
    assert [whole[t.text_start : t.text_end] for t in turns] == [m["text"] for m in messages]
    for rewriting in (
        lambda ms: f"{len(ms)} turns: " + "".join(m["text"] for m in ms),
        lambda ms: "".join(m["text"] if m is ms[-1] else "-" for m in ms),
    ):
        with pytest.raises(chat.HistoryRewritten):
            chat.render_turns(messages[:3], rewriting)


@pytest.mark.parametrize("turn", [1, 48, 49, 60, 100])
def test_rewriting_is_found_at_any_turn(turn):
    messages = [{"role": "user", "text": f"text {i}"} for i in range(121)]
    summary = lambda ms: ("[cut]" if len(ms) > turn else "") + "".join(m["text"] + ";" for m in ms)
    for count in (turn + 1, 61, 121):
        if count > turn:
            with pytest.raises(chat.HistoryRewritten, match=f"turn {turn} "):
                chat.render_turns(messages[:count], summary)
    # One early turn whose text is shortened once the conversation is longer, whatever stands behind it.
    fading = lambda ms: "".join("-" if i == 3 and len(ms) > turn + 4 else m["text"] for i, m in enumerate(ms))
    with pytest.raises(chat.HistoryRewritten, match=f"turn {turn + 4} "):
        chat.render_turns(messages, fading)
