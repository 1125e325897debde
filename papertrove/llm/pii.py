"""Personal data by patterns and by a linear-chain conditional random field over word shapes.

Patterns give the base spans. The field labels every white-space word of a text as one of ``LABELS``; it sees shapes
only (letters and digits by class, punctuation as it is), of the word and its neighbours, and learns its weights from a
small labelled table. A word whose plain label leads by more than any two transitions can give back is plain on every
best path, so Viterbi runs, exactly, over the stretches between such words, many at a time.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papertrove.llm.words import Words, slices, table
from papertrove.operators.sampling import bounded_sample

BASE_KINDS = ("email", "ip", "card", "phone")
#: Label of plain words first. A span that the field adds has the kind of its label with this prefix.
LABELS = ("plain", "email", "ip", "card", "phone", "id", "iban")
ADDED = "crf_"
KINDS = (*BASE_KINDS, *(ADDED + label for label in LABELS[1:]))
#: Bound of the labelled table in sentences: more are thinned by their hash.
FIT_SENTENCES = 5000
ROUNDS = 100
RATE = 0.15
#: Penalties per sentence on weights and on transitions; small transitions settle more words at once.
DECAY = 1e-3
MOVE_DECAY = 6e-3
SLICE = 2 << 20

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can begin inside a run of digits only after a match that ended there, and none does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
# The pattern takes whole runs, so asking for 16 digits at once only skips failing matches.
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low = 0
    for m in _AT_DOMAIN.finditer(text):
        # What stands before the sign, back to the last match or sign.
        low = max(low, text.rfind("@", low, m.start()) + 1)
        before = text[low : m.start()]
        size = len(before) - len(before.rstrip(_LOCAL))
        if size:
            yield m.start() - size, m.end()
            low = m.end()


def base_spans(text: str) -> list[Span]:
    """Matches of the four base patterns, leftmost and non-overlapping per kind; code points, end exclusive."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") for part in m[0].split(".")]
        if all(len(part) < 4 and int(part or 0) <= 255 for part in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


# Shapes of words

#: Punctuation that a word sheds at its ends before its shape is taken.
EDGES = b"!?,.;:\"'#*%&$<>|`~_="
_LETTER, _UPPER, _DIGIT, _NOTHING = ord("x"), ord("X"), ord("d"), 1
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[128:] = _LETTER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_IS_EDGE = np.zeros(256, bool)
_IS_EDGE[np.frombuffer(EDGES, np.uint8)] = True
#: Stands for the neighbour that the first and the last word of a text lack.
_BORDER = np.uint64(0)
MOST_DIGITS = 20
#: Letters of a run that an exact shape keeps.
LETTERS = 4


class Shapes:
    """Shapes of all words of some texts.

    ``exact`` codes a shape with every digit and the first ``LETTERS`` of a run of letters, ``rough`` one with every run
    as one, ``digits`` counts digits. ``starts`` and ``ends`` are the bytes of a word without punctuation at its ends.
    """

    def __init__(self, texts: pa.ChunkedArray | pa.Array):
        self.words = words = Words(texts)
        kinds = _CLASS[words.data]
        core = ~_IS_EDGE[words.data]
        at = np.flatnonzero(core)
        first, last = np.searchsorted(at, words.starts), np.searchsorted(at, words.ends) - 1
        empty = last < first
        clipped = np.append(at, 0)
        self.starts = np.where(empty, words.starts, clipped[np.minimum(first, len(at))])
        self.ends = np.where(empty, words.starts, clipped[np.maximum(last, 0)] + 1)
        inside = np.zeros(len(kinds) + 1, np.int8)
        np.add.at(inside, self.starts[~empty], 1)
        np.subtract.at(inside, self.ends[~empty], 1)
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        kinds[words.starts[empty]] = _NOTHING
        inside[words.starts[empty]] = True
        again = np.zeros(len(kinds), bool)
        again[1:] = (kinds[1:] == kinds[:-1]) & inside[:-1]
        again[words.starts] = False
        letter = (kinds == _LETTER) | (kinds == _UPPER)
        digit = inside & (kinds == _DIGIT)
        place = np.arange(len(kinds))
        place -= np.maximum.accumulate(np.where(again, 0, place))
        self.exact = self._codes(kinds, inside & ~(letter & (place >= LETTERS)))
        self.rough = self._codes(kinds, inside & ~(again & (letter | (kinds == _DIGIT))))
        seen = np.append(0, np.cumsum(digit))
        self.digits = np.minimum(seen[words.ends] - seen[words.starts], MOST_DIGITS)

    def _codes(self, kinds: np.ndarray, kept: np.ndarray) -> np.ndarray:
        places = np.append(0, np.cumsum(kept))
        shape = object.__new__(Words)
        shape.starts, shape.ends = places[self.words.starts], places[self.words.ends]
        return shape.codes(kinds[kept]) | np.uint64(1)

    def neighbours(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes before and after every word in its text."""
        bounds = self.words.bounds
        before, after = np.full(len(codes), _BORDER), np.full(len(codes), _BORDER)
        before[1:], after[:-1] = codes[:-1], codes[1:]
        filled = np.diff(bounds) > 0
        before[bounds[:-1][filled]] = _BORDER
        after[bounds[1:][filled] - 1] = _BORDER
        return before, after

    def features(self) -> list[np.ndarray]:
        """The values of all features, one array each."""
        before, after = self.neighbours(self.rough)
        near = [*self.neighbours(self.exact), before, after, self.neighbours(before)[0], self.neighbours(after)[1]]
        return [self.exact, self.rough, self.digits.astype(np.uint64), *near]


# The field


def _spans_of(stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], stretches, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


@dataclass
class Field:
    """``values[f]`` are the known values of feature ``f``, sorted; ``weights[f]`` their scores by label, after one row
    for unknown values. ``moves[a, b]`` scores label ``b`` behind label ``a``."""

    values: list[np.ndarray]
    weights: list[np.ndarray]
    moves: np.ndarray

    def rows_of(self, features: list[np.ndarray]) -> list[np.ndarray]:
        return [_rows(known, found) for known, found in zip(self.values, features, strict=True)]

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        """The score of every label of every word, without its neighbours' labels."""
        out = np.zeros((len(features[0]), len(LABELS)), np.float32)
        for rows, weights in zip(self.rows_of(features), self.weights, strict=True):
            out += weights[rows]
        return out

    def settled_margin(self) -> float:
        """What a label can win over the plain one by its transitions, at most; a missing neighbour gives nothing."""
        into = np.vstack([self.moves, np.zeros(len(LABELS))])
        out = np.vstack([self.moves.T, np.zeros(len(LABELS))])
        return float(((into - into[:, :1]).max(axis=0) + (out - out[:, :1]).max(axis=0)).max())

    def decode(self, scores: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The label of every word on the best path of its text (``bounds``: texts as ranges of words)."""
        labels = np.zeros(len(scores), np.int8)
        if not len(scores):
            return labels
        doubtful = scores[:, 0] - scores[:, 1:].max(axis=1) <= self.settled_margin() + 1e-3
        first = np.zeros(len(scores) + 1, bool)
        first[bounds] = True
        cut = doubtful.copy()
        starts, ends = _spans_of(cut)
        # A stretch that runs on into the next text is cut there.
        inner = np.flatnonzero(first[:-1] & doubtful & np.append(False, doubtful[:-1]))
        starts, ends = np.sort(np.append(starts, inner)), np.sort(np.append(ends, inner))
        order = np.argsort(starts - ends, kind="stable")
        starts, sizes = starts[order], (ends - starts)[order]
        plain_before, plain_after = ~first[starts], ~first[starts + sizes]
        best = scores[starts] + np.where(plain_before[:, None], self.moves[0], np.float32(0))
        back = np.zeros((len(scores), len(LABELS)), np.int8) if len(sizes) and sizes[0] > 1 else None
        longer = np.searchsorted(-sizes, -np.arange(2, (sizes[0] if len(sizes) else 0) + 1), side="right")
        for step, count in enumerate(longer, 1):
            reached = best[:count, :, None] + self.moves
            back[starts[:count] + step] = reached.argmax(axis=1)
            best[:count] = reached.max(axis=1) + scores[starts[:count] + step]
        best += np.where(plain_after[:, None], self.moves[:, 0], np.float32(0))
        now = best.argmax(axis=1)
        labels[starts + sizes - 1] = now
        for step in range(len(longer), 0, -1):
            count = longer[step - 1]
            now[:count] = back[starts[:count] + step, now[:count]]
            labels[starts[:count] + step - 1] = now[:count]
        return labels


def _rows(known: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Places of values among the sorted known ones, from 1; 0 for the others."""
    at = np.minimum(np.searchsorted(known, found), max(0, len(known) - 1))
    return np.where(known[at] == found, at + 1, 0) if len(known) else np.zeros(len(found), np.int64)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def likelihood(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
    """Log-likelihood of padded sentences, and its gradients by scores and moves, from forward and backward sums."""
    count, longest, _ = scores.shape
    held = np.arange(longest) < sizes[:, None]
    forward, backward = scores.copy(), np.zeros_like(scores)
    for t in range(1, longest):
        forward[:, t] += _log_sum(forward[:, t - 1, :, None] + moves, 1)
    for t in range(longest - 2, -1, -1):
        onward = _log_sum(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(held[:, t + 1, None], onward, 0)
    total = _log_sum(forward[np.arange(count), sizes - 1], 1)
    by_scores = -np.exp(forward + backward - total[:, None, None]) * held[..., None]
    by_moves = np.zeros_like(moves)
    rows, places = np.nonzero(held)
    value = scores[rows, places, labels[rows, places]].sum() - total.sum()
    by_scores[rows, places, labels[rows, places]] += 1
    rows, places = np.nonzero(held[:, 1:])
    a, b = labels[rows, places], labels[rows, places + 1]
    value += moves[a, b].sum()
    np.add.at(by_moves, (a, b), 1)
    for t in range(1, longest):
        own = held[:, t]
        pair = forward[own, t - 1, :, None] + moves + (scores[own, t] + backward[own, t])[:, None, :]
        by_moves -= np.exp(pair - total[own, None, None]).sum(axis=0)
    return value, by_scores, by_moves


def fit(sentences: list[list[tuple[str, str]]]) -> Field:
    """The field of highest penalised likelihood on sentences of ``(word, label)``; values seen once count as unknown."""
    sentences = [s for s in sentences if s]
    shapes = Shapes(pa.array([" ".join(word for word, _ in s) for s in sentences], pa.string()))
    sizes = np.array([len(s) for s in sentences], np.int64)
    if len(shapes.words) != sizes.sum():
        raise ValueError("a labelled word holds white space or is empty")
    labels = np.zeros((len(sizes), int(sizes.max(initial=1))), np.int64)
    held = np.arange(labels.shape[1]) < sizes[:, None]
    labels[held] = [LABELS.index(label) for s in sentences for _, label in s]
    features = shapes.features()
    values = []
    for found in features:
        known, counts = np.unique(found, return_counts=True)
        values.append(known[counts > 1])
    field = Field(values, [np.zeros((len(v) + 1, len(LABELS))) for v in values], np.zeros((len(LABELS), len(LABELS))))
    rows = field.rows_of(features)
    parameters = [*field.weights, field.moves]
    speed = [np.full_like(p, RATE) for p in parameters]
    signs = [np.zeros_like(p) for p in parameters]
    decays = [DECAY] * len(field.weights) + [MOVE_DECAY]
    for _ in range(ROUNDS if len(sizes) else 0):
        scores = np.zeros((*labels.shape, len(LABELS)))
        scores[held] = sum(w[r] for w, r in zip(field.weights, rows, strict=True))
        _, by_scores, by_moves = likelihood(scores, field.moves, sizes, labels)
        flat = by_scores[held]
        gradients = [np.zeros_like(w) for w in field.weights]
        for gradient, row in zip(gradients, rows, strict=True):
            for label in range(len(LABELS)):
                gradient[:, label] = np.bincount(row, flat[:, label], len(gradient))
        # Steps by the sign of the gradient, longer while it stays the same and shorter once it turns.
        for p, step, sign, decay, gradient in zip(parameters, speed, signs, decays, [*gradients, by_moves], strict=True):
            now = np.sign(gradient - decay * len(sizes) * p)
            step *= np.where(now * sign > 0, 1.15, np.where(now * sign < 0, 0.5, 1.0))
            np.clip(step, 1e-5, 1.0, out=step)
            p += now * step
            sign[...] = now
    field.weights = [w.astype(np.float32) for w in field.weights]
    field.moves = field.moves.astype(np.float32)
    return field


# Spans


def _is_iban(text: str) -> bool:
    compact = re.sub(r"[\x20-]", "", text).upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", compact, re.ASCII):
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _is_address(text: str) -> bool:
    try:
        return ipaddress.ip_address(text.strip("[]()")).version == 6
    except ValueError:
        return False


def _is_id(text: str) -> bool:
    m = re.fullmatch(r"([0-9]{3})[\x20-]([0-9]{2})[\x20-]([0-9]{4})", text, re.ASCII)
    return bool(m) and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"


_SPELLED = re.compile(r"[\x20]?[\[({<]?\x20?(?:@|at|AT|dot|DOT|\.)\x20?[\])}>]?\x20?")


def _is_email(text: str) -> bool:
    signs = re.findall(r"@|[\[({<]\x20?(?:at|AT)\x20?[\])}>]", text)
    return len(signs) == 1 and len([part for part in _SPELLED.split(text) if part]) >= 3


#: What a stretch of one label must be besides; the field finds it, this only rejects.
CONFIRM = {
    "email": _is_email,
    "ip": _is_address,
    "card": lambda text: 13 <= len(digits_of(text)) <= 19 and luhn(digits_of(text)),
    "phone": lambda text: 9 <= len(digits_of(text)) <= 15,
    "id": _is_id,
    "iban": _is_iban,
}


def _stretches(shapes: Shapes, labels: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Document, label and byte range of neighbouring words of one label on one line."""
    words = shapes.words
    marked = np.flatnonzero(labels)
    if not len(marked):
        return
    document = np.searchsorted(words.bounds, marked, side="right") - 1
    lines = np.searchsorted(np.flatnonzero(words.data == 10), words.starts[marked])
    same = (np.diff(marked) == 1) & (labels[marked[1:]] == labels[marked[:-1]])
    same &= (np.diff(document) == 0) & (np.diff(lines) == 0)
    begins = np.flatnonzero(np.append(True, ~same))
    stops = np.append(begins[1:], len(marked)) - 1
    for a, b in zip(begins, stops, strict=True):
        yield int(document[a]), int(labels[marked[a]]), int(shapes.starts[marked[a]]), int(shapes.ends[marked[b]])


def added_spans(field: Field, texts: pa.ChunkedArray | pa.Array) -> list[list[Span]]:
    """What the field finds in every text, confirmed by its kind's rule; code points, end exclusive."""
    shapes = Shapes(texts)
    words = shapes.words
    labels = field.decode(field.scores(shapes.features()), words.bounds)
    found: list[list[Span]] = [[] for _ in range(len(words.offsets) - 1)]
    for document, label, start, end in _stretches(shapes, labels):
        body = words.data[start:end].tobytes().decode("utf-8", "replace")
        if CONFIRM[LABELS[label]](body):
            low = int(words.offsets[document])
            # Code points: bytes that do not go on a character.
            before = int(np.count_nonzero((words.data[low:start] & 0xC0) != 0x80))
            found[document].append((ADDED + LABELS[label], before, before + len(body)))
    return found


def personal_spans(field: Field, texts: pa.ChunkedArray | pa.Array) -> list[list[Span]]:
    """Base spans, and those of the field that meet none of them; by kind as in ``KINDS``, then start."""
    out = []
    for text, added in zip(texts.to_pylist(), added_spans(field, texts), strict=True):
        base = base_spans(text or "")
        free = [s for s in added if not any(b[1] < s[2] and s[1] < b[2] for b in base)]
        out.append(sorted(base + free, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


_SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(f"n_{kind}", pa.int64()) for kind in KINDS],
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)
_SCANNED_SQL = ", ".join(["doc_id long", *(f"n_{kind} long" for kind in KINDS), "base_sha256 string", "spans string"])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def learn(labelled: DataFrame) -> Field:
    """The field of a labelled table (``sentence, place, word, label``) of at most ``FIT_SENTENCES`` sentences."""
    names = labelled.select(F.col("sentence").cast("long").alias("sentence")).where("sentence IS NOT NULL").distinct()
    chosen = bounded_sample(names, ["sentence"], FIT_SENTENCES)
    rows = labelled.select(F.col("sentence").cast("long").alias("sentence"), "place", "word", "label").join(chosen, "sentence")
    sentences: dict[int, list[tuple[str, str]]] = {}
    for row in rows.orderBy("sentence", "place").collect():
        sentences.setdefault(row["sentence"], []).append((row["word"], row["label"]))
    return fit(list(sentences.values()))


def find_personal_data(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per row of ``documents`` (``doc_id, text``; others do not matter), repeats included.

    A null or empty text has no spans; a null ``doc_id`` stays null; texts of any length are scanned whole, in slices of
    ``SLICE`` bytes (a longer text alone). An empty labelled table gives base spans only.
    """
    field = learn(labelled)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            spans = personal_spans(field, part.column("text"))
            base = [[s for s in found if s[0] in BASE_KINDS] for found in spans]
            counts = {f"n_{kind}": [sum(s[0] == kind for s in found) for found in spans] for kind in KINDS}
            yield table(
                _SCANNED,
                doc_id=part.column("doc_id").to_pylist(),
                **counts,
                base_sha256=[hashlib.sha256(_listed(found).encode()).hexdigest() for found in base],
                spans=[_listed(found) for found in spans],
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scan, _SCANNED_SQL)


# The labelled table

LABELLED_SENTENCES = 1000


def _check_digit(body: str) -> str:
    return next(d for d in "0123456789" if luhn(body + d))


def _iban(rng: random.Random) -> str:
    body = "".join(rng.choices("0123456789", k=18))
    country = rng.choice(["DE", "FR", "ES", "GB", "IT"])
    check = 98 - int(body + "".join(str(int(c, 36)) for c in country) + "00") % 97
    return f"{country}{check:02d}{body}"


def _word(rng: random.Random) -> str:
    return "".join(rng.choices("abcdeghilmnorstuéü", k=rng.randint(1, 10)))


def _number(rng: random.Random, size: int) -> str:
    return "".join(rng.choices("0123456789", k=size))


def _entity(rng: random.Random, label: str) -> str:
    n = lambda size: _number(rng, size)
    w = lambda: "".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(2, 8)))
    if label == "email":
        name, host = rng.choice([w(), w() + n(2), w() + "." + w(), w() + "." + n(2)]), rng.choice([w(), w() + n(1)])
        at, dot = rng.choice([("[at]", "[dot]"), ("(at)", "(dot)"), ("{at}", "{dot}"), ("(at)", "."), ("[at]", "."), ("[AT]", "[DOT]")])
        spelled = f"{name} {at} {host} {dot} com" if dot != "." else f"{name} {at} {host}.com"
        return rng.choice([f"{name}@{host}.{w()}.com", f"{name}{at}{host}{dot}com", spelled, spelled])
    if label == "ip":
        six = ":".join(rng.choice(["2001", "fe80", "0db8", n(4), n(1), "ff0a", "a1"]) for _ in range(8))
        return rng.choice([".".join(str(rng.randrange(256)) for _ in range(4)), six, f"2001:db8::{n(4)}", f"fe80::{n(2)}a:{n(4)}"])
    if label == "card":
        size = rng.choice([15, 16, 16])
        body = rng.choice("345") + n(size - 2)
        body += _check_digit(body)
        parts = [body[:4], body[4:10], body[10:]] if size == 15 else [body[i : i + 4] for i in range(0, 16, 4)]
        return rng.choice(["", " ", "-", "."]).join(parts)
    if label == "phone":
        area, middle, rest = n(3), n(3), n(4)
        forms = [f"({area}) {middle}-{rest}", f"{area}-{middle}-{rest}", f"{area}.{middle}.{rest}", f"({area}){middle}-{rest}"]
        forms += [f"+1 ({area}) {middle}-{rest}", f"+{n(2)} {area} {middle}{rest}", f"+{n(2)}-{area}-{middle}-{rest}"]
        return rng.choice([*forms, f"1-{area}-{middle}-{rest}", f"({area}) {middle} {rest}"])
    if label == "id":
        return rng.choice([f"{n(3)}-{n(2)}-{n(4)}", f"{n(3)} {n(2)} {n(4)}"])
    whole = _iban(rng)
    return rng.choice([whole, " ".join(whole[i : i + 4] for i in range(0, len(whole), 4))])


def _distractor(rng: random.Random) -> str:
    n = lambda size: _number(rng, size)
    size = rng.randint(1, 12)
    code = "".join(rng.choices("0123456789abcdef", k=rng.randint(6, 40)))
    forms = [n(size), f"{n(2)}.{n(1)}", f"{n(1)},{n(3)}", f"{n(4)}-{n(2)}-{n(2)}", f"{n(2)}/{n(2)}/{n(4)}", f"{n(2)}:{n(2)}", f"({n(4)})"]
    forms += [f"v{n(1)}.{n(1)}.{n(2)}", code, f'"{code}"', "=", "token", f"[{n(2)}]", f"${n(3)}.{n(2)}", f"{n(2)}%", f"({_word(rng)})"]
    forms += [f"https://{_word(rng)}.org/{_word(rng)}/{n(3)}", f"{_word(rng)}-{n(3)}", f"@{_word(rng)}", f"{_word(rng)}_{n(2)}", f"{n(3)} {n(3)}"]
    forms += [f"{n(1)}.{n(1)}.{n(1)}", f"{n(4)}-{n(4)}", f"[{_word(rng)}]", f"#{n(5)}", "***", "--", f"{n(1)} {n(2)} {n(1)}", f"AKIA{code.upper()}"]
    return rng.choice(forms)


def labelled_sentences(count: int = LABELLED_SENTENCES, seed: int = 11) -> list[list[tuple[str, str]]]:
    """Invented sentences with labels: words in several spellings, distractors, and personal data of every label."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        words: list[tuple[str, str]] = []
        style = rng.randrange(8)
        for _ in range(rng.randint(1, 2)):
            plain = [(w, "plain") for w in (_word(rng) for _ in range(rng.randint(0, 6)))]
            if rng.random() < 0.2 and plain:
                plain[0] = (plain[0][0].capitalize(), "plain")
            if rng.random() < 0.5:
                plain += [(w, "plain") for w in _distractor(rng).split()]
            words += plain
            if rng.random() < 0.5:
                label = rng.choice(("email", *LABELS[1:]))
                words += [(w, label) for w in _entity(rng, label).split()]
                # Two pieces of data never touch, or their words would be one stretch.
                words.append((_word(rng), "plain"))
        if style == 0:
            words = [(word + rng.choice(["!!", "###", "***", "&&&"]), label) for word, label in words]
        elif style == 1:
            words = [(word.upper() if label == "plain" else word, label) for word, label in words]
        elif words and rng.random() < 0.7:
            words[-1] = (words[-1][0] + rng.choice([".", ",", "?"]), words[-1][1])
        if words:
            out.append(words)
    return out


def labelled_table(spark: SparkSession) -> DataFrame:
    """The small labelled table: ``sentence, place, word, label``."""
    rows = [(s, p, word, label) for s, words in enumerate(labelled_sentences()) for p, (word, label) in enumerate(words)]
    return spark.createDataFrame(rows, "sentence long, place int, word string, label string")
