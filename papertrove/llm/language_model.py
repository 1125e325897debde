"""Language-model scores of whole documents: a gated recurrent network with a class-factored output.

The network reads a document word by word. Its state is carried across windows, so a document's score is the
log-likelihood of all of it; learning goes back a fixed number of steps (truncated backpropagation). A word's probability
is that of its class times that of the word within the class. Words outside the vocabulary share one entry, which is
followed by the word's share of all such words in the training documents, smoothed by the probability of its spelling,
so every text has a proper probability.

Everything is learned from all training documents. Words are counted per slice and added up by word; the vocabulary and
the spelling come from these counts. The network is trained in rounds, every document in one of them: each partition goes
on from the same weights over its share of the round, and the weights are averaged. Frequent words are counted out inside
a slice of documents; for the others a slice asks for the counts of the distinct words it holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papertrove.llm.words import Words, slices, table
from papertrove.sources import stage

#: Sizes of the network.
VOCABULARY = 2048
CLASSES = 64
HIDDEN = 24
STEPS = 32
STREAMS = 48
EPOCHS = 2
RATE = 0.01
#: Sixteenths of the training documents per round of training, and the rate and streams of each; weights averaged at a time.
ROUNDS = ((1, 1.0, STREAMS), (3, 1.0, 96), (4, 0.5, 192), (8, 0.3, 192))
AVERAGED = 32
#: States whose outputs are computed at a time, and the logit beyond which a row is shifted before its exponentials are taken.
OUTPUT_ROWS = 2048
LARGE_LOGIT = 60.0
#: Parameters that are changed at a time, so that all that belongs to them stays in the cache.
STEP_SIZE = 1 << 14
END, OTHER = 0, 1
#: Weight of a word's spelling beside its count, in tokens.
SPELLING_WEIGHT = 100_000.0
#: Bytes of text of a slice.
SLICE_TEXT = 8 << 20
#: Words that occur once in so many bytes of training text or oftener have counts that every task knows. There are fewer
#: of them than these bytes hold words, whatever the size of the corpus.
GROUP_TEXT = 1 << 20
FOLDS, HELD_OUT = 5, 1
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_END_CODE = np.uint64(0)


@dataclass
class Network:
    """Parameters of the network, and what it knows of spelling. Entries of a class are neighbours in the vocabulary."""

    codes: np.ndarray  # codes of the known words, sorted
    entries: np.ndarray  # their vocabulary entries
    spelling: np.ndarray  # log10 probability of a byte after a byte inside unknown words; a space is their edge
    weights: dict[str, np.ndarray]

    def entries_of(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.entries[at], OTHER)

    def spell(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log10 probability of the spelling of the words at these places, with the edges before and after them."""
        if not len(starts):
            return np.zeros(0)
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        letters = data[np.repeat(starts - first, lengths) + np.arange(lengths.sum())]
        before = np.append(np.uint8(32), letters[:-1])
        before[first] = 32
        inside = np.add.reduceat(self.spelling[before, letters], first)
        return inside + self.spelling[data[ends - 1], 32]

    def log_likelihood(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of every document's entries; each must close with ``END``.

        Documents advance together, longest first, and leave as they end; outputs are computed a window at a time.
        """
        order = np.argsort([-len(d) for d in documents], kind="stable")
        sizes = np.array([len(documents[i]) for i in order])
        flat = np.concatenate([documents[i] for i in order]) if len(order) else np.zeros(0, np.int64)
        first = np.cumsum(sizes) - sizes
        out = np.zeros(len(order))
        w = self.weights
        embedding, reading, going_on = _reading_weights(w)
        dtype = embedding.dtype
        # Held with a row per unit and a column per document, and one row of ones more for the bias.
        carried = np.zeros((HIDDEN + 1, len(order)), dtype)
        carried[HIDDEN] = 1
        width = -1
        before = np.full(len(order), END)
        step = 0
        while step < (sizes[0] if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -step))
            window = range(step, min(step + max(STEPS, 4096 // max(1, live)), int(sizes[0])))
            lives = np.searchsorted(-sizes, -np.arange(window.start, window.stop)).tolist()
            ends = np.cumsum(lives).tolist()
            states = np.empty((ends[-1], HIDDEN), dtype)
            owners = np.concatenate([np.arange(live) for live in lives])
            targets = flat[first[owners] + np.repeat(window, lives)]
            with np.errstate(over="ignore"):
                for live, end in zip(lives, ends, strict=True):
                    if live != width:
                        width, carried = live, carried[:, :live].copy()
                        given, own = np.empty((2, 3 * HIDDEN, live), dtype)
                        gates, candidate = np.empty((2 * HIDDEN, live), dtype), np.empty((HIDDEN, live), dtype)
                    np.dot(reading, embedding.take(before[:live], axis=0).T, out=given)
                    _advance(given, carried, going_on, own, gates, candidate, carried[:HIDDEN])
                    before = targets[end - live : end]
                    states[end - live : end] = carried[:HIDDEN].T
            step = window.stop
            out += np.bincount(owners, _output(states, targets, w), len(out))
        result = np.empty(len(order))
        result[order] = out
        return result


def _reading_weights(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings with a one at their end, and weights with their biases for what is read and for what is carried.

    Weights have a row per unit. Those of the gates change sign: the logistic function of x is 1 / (1 + exp(-x)).
    """
    embedding = np.column_stack([w["embedding"], np.ones(len(w["embedding"]), w["embedding"].dtype)])
    reading = np.vstack([w["input"], w["input_bias"]])
    going_on = np.vstack([w["hidden"], np.zeros_like(w["input_bias"])])
    going_on[HIDDEN, 2 * HIDDEN :] = w["candidate_bias"]
    for weights in (reading, going_on):
        weights[:, : 2 * HIDDEN] *= -1
    return embedding, np.ascontiguousarray(reading.T), np.ascontiguousarray(going_on.T)


def _advance(read, carried, going_on, own, gates, candidate, after) -> None:
    """One step, a column per stream: ``own``, ``gates`` (update, reset), ``candidate`` and the state ``after`` it are filled.

    ``carried`` has a row of ones below the state before; ``after`` may be that state. The exponential of a gate that is
    all but shut may be infinite, which makes it zero.
    """
    np.dot(going_on, carried, out=own)
    np.add(own[: 2 * HIDDEN], read[: 2 * HIDDEN], out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.divide(1, gates, out=gates)
    np.multiply(gates[HIDDEN:], own[2 * HIDDEN :], out=candidate)
    candidate += read[2 * HIDDEN :]
    np.tanh(candidate, out=candidate)
    np.subtract(carried[:HIDDEN], candidate, out=after)
    after *= gates[:HIDDEN]
    after += candidate


def _gates(read: np.ndarray, hidden: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """One step of states held in rows: the new state, update, reset and candidate."""
    read, going_on = read.T.copy(), _reading_weights(w)[2]
    read[: 2 * HIDDEN] *= -1
    carried = np.vstack([hidden.T, np.ones(len(hidden), hidden.dtype)])
    own, gates = np.empty_like(read), np.empty_like(read[: 2 * HIDDEN])
    candidate, after = np.empty_like(read[:HIDDEN]), np.empty_like(read[:HIDDEN])
    with np.errstate(over="ignore"):
        _advance(read, carried, going_on, own, gates, candidate, after)
    return after.T, gates[:HIDDEN].T, gates[HIDDEN:].T, candidate.T


def _log_shares(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log probability of one column of every row. The logits are lost."""
    picked = _shifted(logits).reshape(-1)[_places(logits, at)]
    return picked - np.log(_exponential_sums(logits))


def _places(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where one column of every row lies when all rows follow each other."""
    return np.arange(0, rows.size, rows.shape[1]) + at


def _shifted(logits: np.ndarray) -> np.ndarray:
    """Logits whose exponentials neither overflow nor are all lost; they are changed in place."""
    if logits.size and max(logits.max(), -logits.min()) > LARGE_LOGIT:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _exponential_sums(logits: np.ndarray) -> np.ndarray:
    """Sums of the rows' exponentials, which replace the logits."""
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], logits.dtype)


def _small_order(values: np.ndarray) -> np.ndarray:
    """The stable order of vocabulary entries or classes, which are small numbers."""
    return np.argsort(values.astype(np.uint16 if VOCABULARY <= 1 << 16 else np.uint32), kind="stable")


def _class_blocks(classes: np.ndarray) -> Iterator[tuple[slice, list[tuple[int, slice]]]]:
    """Blocks of sorted classes, and each block's classes with their places in it."""
    edges = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
    for start in range(0, len(classes), OUTPUT_ROWS):
        stop = min(start + OUTPUT_ROWS, len(classes))
        inside = ((one, max(edges[one], start), min(edges[one + 1], stop)) for one in range(classes[start], classes[stop - 1] + 1))
        yield slice(start, stop), [(one, slice(low - start, high - start)) for one, low, high in inside if low < high]


def _with_bias(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of classes and of words, each with its bias as one row more, for states with a one at their end."""
    return np.vstack([w["class"], w["class_bias"]]), np.concatenate([w["word"], w["word_bias"][:, None]], axis=1)


def _word_logits(states: np.ndarray, blocks: list[tuple[int, slice]], words: np.ndarray) -> np.ndarray:
    """Logits of all words of each state's class."""
    logits = np.empty((len(states), words.shape[2]), states.dtype)
    for one, rows in blocks:
        np.dot(states[rows], words[one], out=logits[rows])
    return logits


def _output(states: np.ndarray, targets: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """Log probability of the targets: of their class, and of the entry within it."""
    size = VOCABULARY // CLASSES
    order = _small_order(targets // size)
    classes, inside = np.divmod(targets[order], size)
    ordered = np.ones((len(order), HIDDEN + 1), states.dtype)
    ordered[:, :HIDDEN] = states.take(order, axis=0)
    by_class, by_word = _with_bias(w)
    found = np.empty(len(order))
    for rows, blocks in _class_blocks(classes):
        found[rows] = _log_shares(ordered[rows] @ by_class, classes[rows])
        found[rows] += _log_shares(_word_logits(ordered[rows], blocks, by_word), inside[rows])
    scores = np.empty(len(order))
    scores[order] = found
    return scores


def _loss_gradient(logits: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """A factor per row; times it, what replaces the logits is the gradient of the loss of one column of every row."""
    sums = _exponential_sums(_shifted(logits))
    logits.reshape(-1)[_places(logits, at)] -= sums
    return 1 / (count * sums)


def _output_gradient(states: np.ndarray, targets: np.ndarray, w: dict[str, np.ndarray], into: dict[str, np.ndarray]) -> np.ndarray:
    """Gradient of the mean loss for the states; those of the output layers are added into ``into``."""
    size, n = VOCABULARY // CLASSES, len(targets)
    order = _small_order(targets // size)
    classes, inside = np.divmod(targets[order], size)
    ordered, back = np.ones((n, HIDDEN + 1), states.dtype), np.empty((n, HIDDEN), states.dtype)
    ordered[:, :HIDDEN] = states.take(order, axis=0)
    by_class, by_word = _with_bias(w)
    # Held the other way round, in which they take less time.
    class_gradient, word_gradient = np.zeros_like(by_class.T, order="C"), np.zeros_like(by_word.swapaxes(1, 2), order="C")
    for rows, blocks in _class_blocks(classes):
        here, above = ordered[rows], back[rows]
        delta = here @ by_class
        factor = _loss_gradient(delta, classes[rows], n)[:, None]
        class_gradient += delta.T @ (here * factor)
        np.matmul(delta, w["class"].T, out=above)
        above *= factor
        delta = _word_logits(here, blocks, by_word)
        factor = _loss_gradient(delta, inside[rows], n)[:, None]
        weighted, word_back = here * factor, np.empty_like(above)
        for one, own in blocks:
            word_gradient[one] += np.dot(delta[own].T, weighted[own])
            np.dot(delta[own], w["word"][one].T, out=word_back[own])
        word_back *= factor
        above += word_back
    into["class"] += class_gradient[:, :-1].T
    into["class_bias"] += class_gradient[:, -1]
    into["word"] += word_gradient[:, :, :-1].swapaxes(1, 2)
    into["word_bias"] += word_gradient[:, :, -1]
    at = np.empty_like(order)
    at[order] = np.arange(n)
    return back.take(at, axis=0)


def spelling_of(pairs: np.ndarray) -> np.ndarray:
    """Log10 probability of a byte after a byte, from how often they follow each other in distinct words."""
    pairs = pairs.reshape(256, 256) + 1.0
    return np.log10(pairs / pairs.sum(axis=1, keepdims=True))


def byte_pairs(words: list[bytes]) -> np.ndarray:
    """How often each byte follows another in the words, a space as their edge; 256 x 256 counts in a row."""
    seen = np.frombuffer(b" " + b"".join(word + b" " for word in words), np.uint8).astype(np.int64)
    return np.bincount(seen[:-1] * 256 + seen[1:], minlength=1 << 16)


def distinct_codes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes in order, the first place of each, how often each occurs, and the order that sorts all codes.

    Sorting numbers is much faster than ordering their places, so places are sorted in the low bits, below the codes' high
    bits. Different codes with the same high bits are rare; if they come out of order, all are ordered the plain way.
    """
    low = np.uint64(len(codes).bit_length())
    keys = codes >> low << low | np.arange(len(codes), dtype=np.uint64)
    keys.sort()
    order = (keys & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    ordered = codes[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(codes, kind="stable")
        ordered = codes[order]
    firsts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(codes)])
    return ordered[firsts], order[firsts], np.diff(firsts, append=len(codes)), order


def words_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes at these places as one Arrow array, without an object for each."""
    lengths = ends - starts
    offsets = np.append(0, np.cumsum(lengths))
    letters = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return found.cast(pa.binary())


def initial_network(codes: np.ndarray, counts: np.ndarray, ends: int, others: int, pairs: np.ndarray, seed: int = 3) -> Network:
    """A network to be trained that knows these words, the most frequent first; no words give one that knows none."""
    order = np.argsort(codes)
    # Neighbours in the order of frequency share a class.
    known, entries = codes[order], order + 2
    if not len(known):
        known, entries = np.zeros(1, np.uint64), np.array([OTHER])
    rng = np.random.Generator(np.random.PCG64(seed))
    shapes = {
        "embedding": (VOCABULARY, HIDDEN),
        "input": (HIDDEN, 3 * HIDDEN),
        "input_bias": (3 * HIDDEN,),
        "hidden": (HIDDEN, 3 * HIDDEN),
        "candidate_bias": (HIDDEN,),
        "class": (HIDDEN, CLASSES),
        "class_bias": (CLASSES,),
        "word": (CLASSES, HIDDEN, VOCABULARY // CLASSES),
        "word_bias": (CLASSES, VOCABULARY // CLASSES),
    }
    w = {name: (rng.normal(0, 0.15, shape) if len(shape) > 1 else np.zeros(shape)).astype(np.float32) for name, shape in shapes.items()}
    shares = np.full(VOCABULARY, 0.1)
    shares[END] += ends
    shares[OTHER] += others
    shares[2 : len(counts) + 2] += counts
    grid = shares.reshape(CLASSES, -1)
    w["class_bias"][:] = np.log(grid.sum(axis=1) / grid.sum())
    w["word_bias"][:] = np.log(grid / grid.sum(axis=1, keepdims=True))
    return Network(known, entries, spelling_of(pairs), w)


def fit_network(texts: list[str], seed: int = 3) -> Network:
    """Fit a network on whole texts by truncated backpropagation; no texts give one that knows no words."""
    words = Words(pa.array(texts, pa.string()))
    data = _LOWER[words.data]
    codes = words.codes(data)
    distinct, first, counts, _ = distinct_codes(codes)
    kept = np.argsort(-counts, kind="stable")[: VOCABULARY - 2]
    pairs = byte_pairs([data[words.starts[i] : words.ends[i]].tobytes() for i in first])
    network = initial_network(distinct[kept], counts[kept], len(texts), len(codes) - counts[kept].sum(), pairs, seed)
    training = Training(network.weights)
    for epoch in range(EPOCHS):
        training.read(_stream(network, words, codes), RATE * (0.3 if epoch else 1.0))
    return network


def _stream(network: Network, words: Words, codes: np.ndarray) -> np.ndarray:
    return np.insert(network.entries_of(codes), words.bounds[1:], END)


class Training:
    """Goes on training weights in place, by Adam over windows of several streams."""

    def __init__(self, weights: dict[str, np.ndarray]):
        # All parameters in one stretch of memory, of which the named ones are views; likewise their gradient.
        self.flat = np.concatenate([value.ravel() for value in weights.values()])
        self.slope = np.zeros_like(self.flat)
        self.weights, self.into = weights, {}
        at = 0
        for name, value in weights.items():
            weights[name], self.into[name] = (one[at : at + value.size].reshape(value.shape) for one in (self.flat, self.slope))
            at += value.size
        self.mean, self.square = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.updates = 0

    def read(self, stream: np.ndarray, full_rate: float, most: int = STREAMS) -> None:
        """Learn from all of the stream, cut into pieces that are read side by side and filled up with ends."""
        if not len(stream):
            return
        streams = max(1, min(most, len(stream) // (STEPS + 1)))
        stream = np.append(stream, np.full(-len(stream) % streams, END, stream.dtype))
        length = len(stream) // streams
        # What comes before a piece is given along, so that its first entry is learned as well.
        before = np.append(END, stream[length - 1 :: length][: streams - 1])
        rows = np.column_stack([before, stream.reshape(streams, length)])
        hidden = np.zeros((streams, HIDDEN), np.float32)
        for start in range(0, length, STEPS):
            inputs, targets = rows[:, start : start + STEPS], rows[:, start + 1 : start + 1 + STEPS]
            inputs = inputs[:, : targets.shape[1]]
            self.slope.fill(0)
            _, hidden = _window_gradient(self.weights, inputs, targets, hidden, self.into)
            self.updates += 1
            rate = full_rate * math.sqrt(1 - 0.999**self.updates) / (1 - 0.9**self.updates)
            norm = math.sqrt(float(np.vdot(self.slope, self.slope)))
            self._step(min(1.0, 1.0 / max(norm, 1e-9)), rate)

    def _step(self, scale: float, rate: float) -> None:
        """One step of Adam along the gradient, which is lost."""
        for at in range(0, len(self.flat), STEP_SIZE):
            g, mean, square, weights = (x[at : at + STEP_SIZE] for x in (self.slope, self.mean, self.square, self.flat))
            g *= scale
            mean += 0.1 * (g - mean)
            g *= g
            g -= square
            g *= 0.001
            square += g
            np.sqrt(square, out=g)
            g += 1e-8
            np.divide(mean, g, out=g)
            g *= rate
            weights -= g


def _window_gradient(w, inputs: np.ndarray, targets: np.ndarray, hidden: np.ndarray, into: dict | None = None) -> tuple[dict, np.ndarray]:
    """Gradient over one window, added into ``into``, and the state it leaves for the next; a document's state begins at zero.

    What belongs to a step is one stretch of memory, with a row per unit and a column per stream.
    """
    into = {name: np.zeros_like(value) for name, value in w.items()} if into is None else into
    streams, steps = inputs.shape
    embedding, reading, going_on = _reading_weights(w)
    read_by = inputs.T.ravel()
    embedded = embedding.take(read_by, axis=0).reshape(steps, streams, HIDDEN + 1)
    given = np.matmul(reading, embedded.swapaxes(1, 2))
    fresh = (read_by != END).astype(hidden.dtype).reshape(steps, streams)
    parts = (HIDDEN + 1, 3 * HIDDEN, 2 * HIDDEN, HIDDEN)
    carried, own, gates, candidate = (np.empty((steps, units, streams), hidden.dtype) for units in parts)
    carried[:, HIDDEN] = 1
    states, after = np.empty((steps, streams, HIDDEN), hidden.dtype), np.ascontiguousarray(hidden.T)
    with np.errstate(over="ignore"):
        for now in range(steps):
            np.multiply(after, fresh[now], out=carried[now, :HIDDEN])
            _advance(given[now], carried[now], going_on, own[now], gates[now], candidate[now], after)
            states[now] = after.T
    back = _output_gradient(states.reshape(-1, HIDDEN), targets.T.ravel(), w, into).reshape(states.shape)
    # What the gradient of a state is multiplied by on its way into a step's parts: the candidate's own, then what is read
    # for update, reset and candidate.
    slopes = np.empty((steps, 4 * HIDDEN, streams), hidden.dtype)
    to_own, to_update, to_reset, to_candidate = (slopes[:, i * HIDDEN : (i + 1) * HIDDEN] for i in range(4))
    update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    kept = 1 - update
    np.multiply(candidate, candidate, out=to_candidate)
    np.subtract(1, to_candidate, out=to_candidate)
    to_candidate *= kept
    np.multiply(to_candidate, reset, out=to_own)
    np.subtract(carried[:, :HIDDEN], candidate, out=to_update)
    to_update *= update
    to_update *= kept
    np.subtract(1, reset, out=to_reset)
    to_reset *= to_own
    to_reset *= own[:, 2 * HIDDEN :]
    from_state, from_read = slopes[:, : 3 * HIDDEN], slopes[:, HIDDEN:]
    into_state = np.roll(w["hidden"], HIDDEN, axis=1)
    later, up = np.zeros((2, HIDDEN, streams), hidden.dtype)
    for now in reversed(range(steps)):
        np.add(back[now].T, later, out=up)
        slopes[now].reshape(4, HIDDEN, streams)[:] *= up
        np.dot(into_state, from_state[now], out=later)
        up *= update[now]
        later += up
        later *= fresh[now]
    gradient = np.matmul(from_state, carried.swapaxes(1, 2)).sum(axis=0)
    into["hidden"] += np.roll(gradient[:, :HIDDEN], -HIDDEN, axis=0).T
    into["candidate_bias"] += gradient[:HIDDEN, HIDDEN]
    gradient = np.matmul(from_read, embedded).sum(axis=0)
    into["input"] += gradient[:, :HIDDEN].T
    into["input_bias"] += gradient[:, HIDDEN]
    order = _small_order(read_by)
    sorted_by = read_by[order]
    firsts = np.flatnonzero(np.diff(sorted_by, prepend=-1))
    np.matmul(from_read.swapaxes(1, 2), w["input"].T, out=back)
    into["embedding"][sorted_by[firsts]] += np.add.reduceat(back.reshape(-1, HIDDEN).take(order, axis=0), firsts)
    return into, after.T


def held_out(doc_id: Column) -> Column:
    """True for the fold that nothing is learned from; a null id is in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


_ROWS = np.dtype(
    [("doc_id", "<i8"), ("has_id", "?"), ("held_out", "?"), ("n_tokens", "<i8"), ("n_others", "<i8"), ("n_known", "<i8")]
    + [("score", "<f8"), ("base", "<f8"), ("others", "<f8")]
)
#: A slice's documents, and the words whose counts it asks for: their codes, spelling, documents and times in these.
_SLICES = pa.schema([("slice", pa.string())] + [(name, pa.binary()) for name in ("about", "codes", "spelled", "n", "owner", "times")])
_SLICES_SQL = "slice string, about binary, codes binary, spelled binary, n binary, owner binary, times binary"


def training_words(training: DataFrame) -> DataFrame:
    """``code, n, word`` of every distinct word of the training documents and of the end, each once."""
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64()), ("word", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_TEXT):
            words = Words(part.column("text"))
            data = _LOWER[words.data]
            distinct, first, n, _ = distinct_codes(words.codes(data))
            codes = np.append(distinct, _END_CODE).view(np.int64)
            word = words_at(data, np.append(words.starts[first], 0), np.append(words.ends[first], 0))
            yield table(schema, code=codes, n=np.append(n, len(part)), word=word)

    found = training.mapInArrow(count, "code long, n long, word binary")
    # A code has one word. With the word among the keys, counts are added up by hashing; a least word would need sorts.
    return found.groupBy("code", "word").agg(F.sum("n").alias("n")).select("code", "n", "word")


def learned_words(words: DataFrame) -> tuple[Network, np.ndarray, np.ndarray, tuple[int, int, int]]:
    """An untrained network; codes (sorted) and counts of frequent words; distinct words, tokens, tokens outside the vocabulary."""
    sums = (F.sum("n"), F.sum(F.col("n") * (F.octet_length("word") + 1)))
    distinct, tokens, size = words.agg(F.count("*"), *(F.coalesce(one, F.lit(0)) for one in sums)).first()
    level = F.floor(8 * F.log2("n"))
    end = words.where(F.col("code") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Only what can be among the most frequent words is put in order.
    plain, wanted, least = words.where(F.col("code") != 0), VOCABULARY - 2, 0
    for one, n in sorted(plain.groupBy(level).count().collect(), reverse=True):
        wanted, least = wanted - n, one
        if wanted <= 0:
            break
    top = plain.where(level >= least).orderBy(F.desc("n"), "code").limit(VOCABULARY - 2).select("code", "n").collect()
    hot = plain.where(F.col("n") * GROUP_TEXT >= size).select("code", "n").collect()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            counts += byte_pairs(batch.column("word").to_pylist())
        used = np.flatnonzero(counts)
        yield table(pa.schema([("pair", pa.int64()), ("n", pa.int64())]), pair=used, n=counts[used])

    counted = np.zeros(1 << 16, np.int64)
    for pair, n in plain.select("word").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        counted[pair] = n
    codes, counts = (np.array([row[i] for row in top], np.int64) for i in (0, 1))
    others = tokens - end - int(counts.sum())
    network = initial_network(codes.view(np.uint64), counts, end, others, counted)
    known = dict([*map(tuple, hot), *map(tuple, top), (0, end)])
    hot_codes = np.array(list(known), np.int64).view(np.uint64)
    order = np.argsort(hot_codes)
    return network, hot_codes[order], np.array(list(known.values()), np.int64)[order], (distinct, tokens, others)


def train_network(training: DataFrame, network: Network) -> None:
    """Train the network on all of ``text``: per round every partition reads its share, then their weights are averaged."""
    spark = training.sparkSession
    schema = pa.schema([("part", pa.int64()), ("tokens", pa.int64()), ("weights", pa.binary())])
    kinds = "part long, tokens long, weights binary"

    def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([value.ravel() for value in weights.values()])

    def average(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda row: row["part"])
        tokens = [row["tokens"] for row in rows]
        mean = sum(n * np.frombuffer(row["weights"], np.float32).astype(np.float64) for n, row in zip(tokens, rows, strict=True))
        data = (mean / sum(tokens)).astype(np.float32).tobytes()
        return pa.Table.from_batches([table(schema, part=[rows[0]["part"] // AVERAGED], tokens=[sum(tokens)], weights=[data])])

    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(16))
    low = 0
    for size, rate, streams in ROUNDS:
        shared = spark.sparkContext.broadcast(network)

        def learn(batches: Iterator[pa.RecordBatch], rate=rate, streams=streams, shared=shared) -> Iterator[pa.RecordBatch]:
            mine = {name: value.copy() for name, value in shared.value.weights.items()}
            state, tokens = Training(mine), 0
            for part in slices(batches, "text", SLICE_TEXT):
                words = Words(part.column("text"))
                stream = _stream(shared.value, words, words.codes(_LOWER[words.data]))
                state.read(stream, RATE * rate, streams)
                tokens += len(stream)
            if tokens:
                part = TaskContext.get().partitionId()
                yield table(schema, part=[part], tokens=[tokens], weights=[packed(mine).tobytes()])

        learned = training.where((share >= low) & (share < low + size)).mapInArrow(learn, kinds)
        for _ in range(2):
            learned = learned.groupBy(F.floor(F.col("part") / AVERAGED)).applyInArrow(average, kinds)
        rows = learned.collect()
        low += size
        if rows:
            data = average(pa.Table.from_pylist([row.asDict() for row in rows], schema)).column("weights")[0].as_py()
            flat, at = np.frombuffer(data, np.float32), 0
            for name, value in network.weights.items():
                network.weights[name] = flat[at : at + value.size].reshape(value.shape).copy()
                at += value.size


def score_documents(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``): ``held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words, A-Z in lower case, and an end. ``base_score`` is the sum of log10 of smoothed unigram shares
    over all training tokens of the corpus; ``score`` is the network's log10 probability of the text. A null or empty
    text is its end alone. A null ``doc_id`` counts as held out; rows that repeat an id are scored one by one. With no
    training documents the counts are zero and the network is as it was initialised. Other columns do not matter.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("held_out", held_out(F.col("doc_id")))
    training = rows.filter(~F.col("held_out"))
    words = stage(training_words(training), "words")
    network, hot_codes, hot_counts, (distinct, tokens, other_tokens) = learned_words(words)
    train_network(training, network)
    known = spark.sparkContext.broadcast((network, hot_codes, hot_counts))
    smoothing = math.log10(tokens + 0.5 * (distinct + 1))
    other_smoothing = math.log10(other_tokens + SPELLING_WEIGHT)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(slices(batches, "text", SLICE_TEXT)):
            yield _score_slice(f"{TaskContext.get().partitionId()}:{number}", part, *known.value)

    scored = stage(rows.mapInArrow(score, _SLICES_SQL), "scored-slices")
    answers = answered(scored, words, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_())]
        + [(name, pa.int64()) for name in ("n_tokens", "n_known", "train_tokens")]
        + [("base_score", pa.float64()), ("score", pa.float64())]
    )

    def finish(slices_: pa.Table, found: pa.Table) -> pa.Table:
        row = slices_.to_pylist()[0]
        about, spelled = np.frombuffer(row["about"], _ROWS), np.frombuffer(row["spelled"], np.float32)
        counts = np.zeros(len(spelled), np.int64)
        for start, n in zip(found.column("start").to_pylist(), found.column("n").to_pylist(), strict=True):
            n = np.frombuffer(n, np.int64)
            counts[start : start + len(n)] = n
        word = np.repeat(np.arange(len(counts)), np.frombuffer(row["n"], np.uint32))
        base, others, n_known = _sums(counts, spelled, word, _wide(row["owner"]), _wide(row["times"]), len(about))
        return pa.table(
            [
                pa.array(about["doc_id"], mask=~about["has_id"]),
                pa.array(about["held_out"]),
                pa.array(about["n_tokens"]),
                pa.array(about["n_known"] + n_known),
                pa.array(np.full(len(about), tokens)),
                pa.array(about["base"] + base - about["n_tokens"] * smoothing),
                pa.array(about["score"] + about["others"] + others - about["n_others"] * other_smoothing),
            ],
            schema=schema,
        )

    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return scored.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(finish, kinds)


_ASKED = pa.schema([("bucket", pa.int64()), ("slice", pa.string()), ("start", pa.int64()), ("codes", pa.binary())])
_ASKED_SQL = "bucket long, slice string, start long, codes binary"
_ANSWERS = pa.schema([("slice", pa.string()), ("start", pa.int64()), ("n", pa.binary())])
_ANSWERS_SQL = "slice string, start long, n binary"


def answered(scored: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """``slice, start, n``: the counts of the words that the slices ask for, packed, from the place ``start`` on.

    Codes are even over their range. Each of ``buckets`` stretches of it meets what the slices ask of it: a row per slice
    and bucket is shuffled, not one per word.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], np.uint64)
                bucket = (codes >> np.uint64(40)).astype(np.int64) * buckets >> 24
                start = np.flatnonzero(np.diff(bucket, prepend=-1))
                packed = [some.tobytes() for some in np.split(codes, start[1:])] if len(codes) else []
                yield table(_ASKED, bucket=bucket[start], slice=[row["slice"]] * len(start), start=start, codes=packed)

    def answer(asked: pa.Table, counted: pa.Table) -> pa.Table:
        codes, n = (counted.column(name).to_numpy() for name in ("code", "n"))
        order = np.argsort(codes.view(np.uint64))
        codes, n = np.append(codes.view(np.uint64)[order], np.uint64(0)), np.append(n[order], 0)
        found = []
        for packed in asked.column("codes").to_pylist():
            wanted = np.frombuffer(packed, np.uint64)
            at = np.searchsorted(codes[:-1], wanted)
            found.append(np.where(codes[at] == wanted, n[at], 0).tobytes())
        return pa.table([asked.column("slice"), asked.column("start"), pa.array(found, pa.binary())], schema=_ANSWERS)

    asked = scored.select("slice", "codes").mapInArrow(ask, _ASKED_SQL)
    counted = words.select(F.shiftright(F.shiftrightunsigned("code", 40) * buckets, 24).alias("bucket"), "code", "n")
    return asked.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(answer, _ANSWERS_SQL)


def _sums(counts: np.ndarray, spelled: np.ndarray, word, owner, times, documents: int) -> tuple[np.ndarray, ...]:
    """Per document the logs of its words' counts, those of unknown words with their spelling, and its counted tokens."""
    logs = np.log10(counts + 0.5)
    is_other = ~np.isnan(spelled)
    other_logs = np.log10(counts + SPELLING_WEIGHT * 10.0 ** np.where(is_other, spelled, 0.0).astype(np.float64)) * is_other
    known = np.bincount(owner, (counts[word] > 0) * times, documents).astype(np.int64)
    return np.bincount(owner, logs[word] * times, documents), np.bincount(owner, other_logs[word] * times, documents), known


def _score_slice(name: str, part: pa.Table, network: Network, hot_codes: np.ndarray, hot_counts: np.ndarray) -> pa.RecordBatch:
    """Scores of a slice's documents and the sums of their frequent words; the others with their documents, packed."""
    words = Words(part.column("text"))
    data = _LOWER[words.data]
    codes = np.insert(words.codes(data), words.bounds[1:], _END_CODE)
    bounds = words.bounds + np.arange(len(words.bounds))
    sizes = np.diff(bounds)
    count = len(sizes)
    document = np.repeat(np.arange(count), sizes)
    distinct, first, n, order = distinct_codes(codes)
    which = np.empty(len(codes), np.int64)
    which[order] = np.repeat(np.arange(len(distinct)), n)

    entries = network.entries_of(distinct)
    entries[distinct == _END_CODE] = END
    # Every end stands where the words of its document are over, so it shifts the words after it by one.
    place = first - document[first]
    other = np.flatnonzero(entries == OTHER)
    spelled = np.full(len(distinct), np.nan, np.float32)
    spelled[other] = network.spell(data, words.starts[place[other]], words.ends[place[other]])
    entries = entries[which]
    score = network.log_likelihood(np.split(entries, bounds[1:-1])) if count else np.zeros(0)

    pairs, times = np.unique(which * count + document, return_counts=True)
    word, owner = pairs // count, pairs % count
    at = np.minimum(np.searchsorted(hot_codes, distinct), len(hot_codes) - 1)
    is_hot = hot_codes[at] == distinct
    here = is_hot[word]

    about = np.zeros(count, _ROWS)
    ids = part.column("doc_id").combine_chunks()
    about["doc_id"] = ids.fill_null(0).to_numpy()
    about["has_id"] = ids.is_valid().to_numpy(zero_copy_only=False)
    about["held_out"], about["n_tokens"] = part.column("held_out").to_numpy(), sizes
    about["score"] = score / math.log(10)
    about["n_others"] = np.bincount(document[entries == OTHER], minlength=count)
    found = _sums(np.where(is_hot, hot_counts[at], 0), spelled, word[here], owner[here], times[here], count)
    about["base"], about["others"], about["n_known"] = found
    per_word = np.bincount(word, minlength=len(distinct))
    values = {
        "slice": name,
        "about": about.tobytes(),
        "codes": distinct[~is_hot].tobytes(),
        "spelled": spelled[~is_hot].tobytes(),
        "n": per_word[~is_hot].astype(np.uint32).tobytes(),
        "owner": _narrow(owner[~here]),
        "times": _narrow(times[~here]),
    }
    return table(_SLICES, **{key: [value] for key, value in values.items()})


def _narrow(values: np.ndarray) -> bytes:
    """The values as bytes of the narrowest unsigned type, which the first byte names."""
    top = int(values.max()) if len(values) else 0
    width = next(width for width in (1, 2, 4) if top < 1 << (8 * width))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)
