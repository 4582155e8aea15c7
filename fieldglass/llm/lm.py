"""Language-model scoring: a gated recurrent network in numpy with a class-factored softmax."""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Words, most frequent first, whose counts are sent to all executors; the counts of all others are joined.
TABLE_WORDS = 200_000
#: Classes of the softmax and symbols in each. A symbol is a frequent word or one of the bands of less frequent ones.
CLASSES = WIDTH = 48
#: The bands by rank: up to these ranks; the last holds all that the table doesn't.
BANDS = (8_000, 40_000, TABLE_WORDS)
HIDDEN = 24
#: Tokens that are trained on from the same weights in one go, about, and the goes of a round at most; larger corpora have longer goes.
GROUP_TOKENS, MOST_GROUPS = 2_000_000, 4096
#: The end of a text; no word is empty.
END = b""


@dataclass(frozen=True)
class Vocabulary:
    """rank: of the table's words. counts: by rank. total, distinct: tokens and different tokens of the training texts.
    symbols: number of words that are symbols of their own; those of higher rank go by bands."""

    rank: dict[bytes, int]
    counts: np.ndarray
    total: int
    distinct: int

    @property
    def symbols(self) -> int:
        return CLASSES * WIDTH - len(BANDS) - 1

    def symbol_of_rank(self) -> np.ndarray:
        """By rank (the last entry, -1: not in the table) the symbol; symbols stand in order of frequency."""
        at = np.arange(len(self.counts))
        own = np.where(at < self.symbols, at, self.symbols + np.searchsorted(BANDS, at, side="right"))
        own = np.append(own, self.symbols + len(BANDS))
        n = np.bincount(own, np.append(self.counts, max(self.total - self.counts.sum(), 0)), minlength=CLASSES * WIDTH)
        place = np.empty(len(n), np.int64)
        place[np.argsort(-n, kind="stable")] = np.arange(len(n))
        return place[own].astype(np.int32)

    def static(self) -> tuple[np.ndarray, float, float]:
        """For words by rank: log10 of the chance within their symbol. For other words: what to take from
        log10(count + 1), and log10 of the divisor of the base score."""
        at = np.arange(len(self.counts))
        band = np.searchsorted(BANDS, at, side="right")
        out = np.zeros(len(at))
        for b in range(len(BANDS)):
            own = (at >= self.symbols) & (band == b)
            out[own] = np.log10(self.counts[own] + 1) - math.log10(max(self.counts[own].sum() + own.sum(), 1))
        rest = self.total - int(self.counts.sum()) + self.distinct - len(self.counts) + 1
        return out, math.log10(rest), math.log10(self.total + self.distinct + 1)


def words_of(texts: pa.Array, most: int = 8_000_000) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """Part by part, of about `most` bytes or one longer text: the number of the part's first text, where the words of each of its
    texts begin (and the last one's end), and the words, in lower case; each text has an end after them, as the empty word."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, empty, space = 0, pa.scalar("", texts.type), pa.scalar(" ", texts.type)
    while at < len(texts):
        first, before = at, int(sizes[at - 1]) if at else 0
        at = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
        part = pc.ascii_trim_whitespace(pc.fill_null(texts.slice(first, at - first), empty))
        #: What is cut off after a last space is the empty word; an empty text is one already.
        part = pc.if_else(pc.equal(part, empty), empty, pc.binary_join_element_wise(part, empty, space))
        words = pc.ascii_split_whitespace(pc.ascii_lower(part))  # ascii_lower gives zeros for an array that begins within its data
        yield first, words.offsets.to_numpy(), words.values.cast(pa.binary())


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of `texts` (text); an end for each text counts as the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
                yield from sums.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches()
                held.clear()

        for batch in batches:
            for _, _, words in words_of(batch.column(0)):
                found = pc.value_counts(words)
                held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                if sum(map(len, held)) > 500_000:  # a task's memory is bounded; the sum comes after
                    yield from out()
        yield from out()

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Network:
    """Weights by name. `x`: what a symbol adds to the gates (reset, update, new); `u`, `b`: hidden to gates; `wc`, `bc`:
    hidden to classes; `wo`, `bo`: hidden to the words of each class."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w, self.squares = weights, {}

    @staticmethod
    def initial(counts: np.ndarray, seed: int = 0) -> Network:
        """Small random weights; biases that start from the symbols' frequencies."""
        rng, n = np.random.default_rng(seed), CLASSES * WIDTH
        own = np.log((counts + 1) / (counts.sum() + n)).reshape(CLASSES, WIDTH)
        by_class = np.log(np.exp(own).sum(axis=1))
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return Network(
            {
                "x": small(n, 3 * HIDDEN), "u": small(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32), "wc": small(HIDDEN, CLASSES),
                "bc": by_class.astype(np.float32), "wo": small(CLASSES, HIDDEN, WIDTH), "bo": (own - by_class[:, None]).astype(np.float32),
            }
        )

    def bounded(self) -> bool:
        """Whether no logit can get near what exp can take: states lie between -1 and 1."""
        most = [np.abs(self.w[w]).sum(axis=-2).max() + np.abs(self.w[b]).max() for w, b in (("wc", "bc"), ("wo", "bo"))]
        return max(most) < 60

    def log_chance(self, h: np.ndarray, y: np.ndarray, grad: dict | None = None, bounded: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log of the chance of symbols `y` after states `h`; with `grad`, adds the gradient of their negative sum
        to it and returns that for `h` too. `bounded`: logits need not be shifted."""
        own, inner = np.divmod(y, WIDTH)
        order = np.argsort(own.astype(np.uint8), kind="stable")
        ends = np.cumsum(np.bincount(own, minlength=CLASSES)).tolist()
        parts = [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) if a < b]  # the rows of each class lie together
        one = np.empty((len(y), HIDDEN + 1), h.dtype)  # states, and a one for the biases
        one[:, :HIDDEN], one[:, HIDDEN] = h.take(order, 0), 1
        wc, wo = np.concatenate([self.w["wc"], self.w["bc"][None]]), np.concatenate([self.w["wo"], self.w["bo"][:, None]], axis=1)

        def softmax(logits: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The log chance of the chosen ones; in place of the logits, chances times a sum, and those sums."""
            chosen = chosen.take(order) + np.arange(0, logits.size, logits.shape[1])
            if not bounded:
                logits -= logits.max(axis=1, keepdims=True)
            out = logits.ravel().take(chosen)
            e = np.exp(logits, out=logits)
            sums = e @ np.ones(e.shape[1], e.dtype)
            out -= np.log(sums)
            if grad is not None:
                e.ravel()[chosen] -= sums
            return out, e, sums[:, None]

        logits = one @ wc
        found, e, sums = softmax(logits, own)
        back = None
        if grad is not None:
            both = (one / sums).T @ e
            grad["wc"] += both[:HIDDEN]
            grad["bc"] += both[HIDDEN]
            back = e @ self.w["wc"].T
            back /= sums
        for c, part in parts:
            np.matmul(one[part], wo[c], out=logits[part])
        more, e, sums = softmax(logits, inner)
        found += more
        if grad is not None:
            one /= sums
            inner_back = np.empty_like(back)
            for c, part in parts:
                both = one[part].T @ e[part]
                grad["wo"][c] += both[:HIDDEN]
                grad["bo"][c] += both[HIDDEN]
                np.matmul(e[part], self.w["wo"][c].T, out=inner_back[part])
            inner_back /= sums
            back += inner_back
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return found.take(place), None if back is None else back.take(place, 0)


class Cell:
    """The gated unit, its weights laid out gate by gate (those of the inputs for some `rows` only); those of reset and update
    times -1 and of the new state times -2, as the sigmoid of a is 1 / (1 + exp(-a)) and its tanh 2 / (1 + exp(-2 a)) - 1."""

    def __init__(self, w: dict[str, np.ndarray], rows: np.ndarray | slice = slice(None)):
        n = HIDDEN
        x, u, b = ([v[..., i * n : (i + 1) * n] * v.dtype.type(by) for i, by in enumerate((-1, -1, -2))] for v in (w["x"][rows], w["u"], w["b"]))
        self.x, self.u, self.inner = [x[0] + b[0], x[1] + b[1], x[2]], u, b[2][None]

    def step(self, x: np.ndarray, h: np.ndarray, r: np.ndarray, z: np.ndarray, new: np.ndarray, inner: np.ndarray) -> None:
        """One token on: `h` becomes the new state; the others get what the way back needs (`inner` times -2). Where exp
        overflows, a gate is 0, as it should: callers ignore that."""
        if len(self.inner) < len(h):
            self.inner = np.repeat(self.inner[:1], len(h), axis=0)
        for i, gate in enumerate((r, z)):
            np.matmul(h, self.u[i], out=gate)
            gate += self.x[i].take(x, 0, mode="clip")
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
        np.matmul(h, self.u[2], out=inner)
        inner += self.inner[: len(h)]
        np.multiply(r, inner, out=new)
        new += self.x[2].take(x, 0, mode="clip")
        np.exp(new, out=new)
        new += 1
        np.divide(2, new, out=new)
        new -= 1
        h -= new
        h *= z
        h += new


def _lay_out(texts: list[np.ndarray], slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deal texts (symbols, the last an end) to slots, the longest first to the emptiest, one after the other in a slot:
    symbols and text numbers (steps x slots, -1: nothing), fullest slot first, and each slot's steps."""
    size, longest = sum(map(len, texts)), max(map(len, texts), default=1)
    slots = max(1, min(slots, len(texts), -(-2 * size // longest)))  # beside a very long text, more slots would stay empty
    loads = [(0, s) for s in range(slots)]
    placed: list[list[int]] = [[] for _ in range(slots)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        load, s = heapq.heappop(loads)
        placed[s].append(i)
        heapq.heappush(loads, (load + len(texts[i]), s))
    steps = np.array([sum(len(texts[i]) for i in own) for own in placed])
    order = np.argsort(-steps, kind="stable")
    symbols, number = np.zeros((int(steps.max(initial=0)), slots), np.int32), np.full((int(steps.max(initial=0)), slots), -1, np.int32)
    for column, s in enumerate(order):
        at = 0
        for i in placed[s]:
            symbols[at : at + len(texts[i]), column], number[at : at + len(texts[i]), column] = texts[i], i
            at += len(texts[i])
    return symbols, number, steps[order]


class Slots:
    """Texts dealt to slots, window by window: what goes in, what comes out, which places begin a text (they see an end and an
    empty state before them) and which hold a symbol. Slots that have no more are left out, the fullest stand first; where
    few are left, as beside a very long text, windows get longer, so that all hold about `slots` times `window` symbols."""

    def __init__(self, texts: list[np.ndarray], end: int, slots: int, window: int):
        self.symbols, self.number, self.steps = _lay_out(texts, slots)
        self.end, self.window, self.size = end, window, slots * window

    def __iter__(self) -> Iterator[tuple[np.ndarray, ...]]:
        before, last = np.full(self.symbols.shape[1], self.end, np.int32), np.full(self.symbols.shape[1], -1, np.int32)
        a = 0
        while a < len(self.symbols):
            k = int(np.searchsorted(-self.steps, -a, side="left"))
            b = a + max(self.window, self.size // k)
            y, number = self.symbols[a:b, :k], self.number[a:b, :k]
            starts = np.concatenate([last[None, :k], number[:-1]]) != number
            x = np.where(starts, self.end, np.concatenate([before[None, :k], y[:-1]]))
            yield x, y, starts, number
            before, last, a = y[-1], number[-1], b


def score_texts(net: Network, texts: list[np.ndarray], end: int, slots: int = 512, window: int = 16) -> np.ndarray:
    """Log10 of the model's chance of each text's symbols. Slots go on in windows, and the state goes on from window to
    window to the end of a text; a text begins after an end, with an empty state."""
    out, bounded, cell = np.zeros(len(texts)), net.bounded(), Cell(net.w)
    h = np.zeros((slots, HIDDEN), np.float32)
    for x, y, starts, number in Slots(texts, end, slots, window):
        k = x.shape[1]
        h, room, states = h[:k], np.empty((4, k, HIDDEN), np.float32), np.empty((*y.shape, HIDDEN), np.float32)
        begins = starts.any(axis=1).tolist()
        with np.errstate(over="ignore"):
            for t in range(len(x)):
                if begins[t]:
                    h[starts[t]] = 0
                cell.step(x[t], h, *room)
                states[t] = h
        own = number >= 0
        chance, _ = net.log_chance(states[own], y[own], bounded=bounded)
        out += np.bincount(number[own], chance.astype(np.float64), minlength=len(texts))
    return out / math.log(10)


def gradient(net: Network, x: np.ndarray, y: np.ndarray, starts: np.ndarray, own: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The gradient, within one window, of the negative log chance of the symbols `y` at `own` (steps x slots) after the inputs
    `x`: by name, that of `x` for the rows of those symbols only that come up, which it returns as well. `h`, the state before
    the window, becomes the one after it."""
    (steps, k), kind = x.shape, h.dtype
    order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
    new_row = np.diff(x.ravel()[order], prepend=-1) != 0
    first = np.flatnonzero(new_row)
    rows, local = x.ravel()[order[first]], np.empty(x.size, np.int64)
    local[order] = np.cumsum(new_row) - 1
    cell, local, begins = Cell(net.w, rows), local.reshape(x.shape), starts.any(axis=1).tolist()
    old, r, z, new, inner, states = (np.empty((steps, k, HIDDEN), kind) for _ in range(6))
    with np.errstate(over="ignore"):
        for t in range(steps):
            if begins[t]:
                h[starts[t]] = 0
            old[t] = h
            cell.step(local[t], h, r[t], z[t], new[t], inner[t])
            states[t] = h
    grad = {key: np.zeros_like(v) for key, v in net.w.items() if key != "x"}
    if own.all():
        to_states = net.log_chance(states.reshape(-1, HIDDEN), y.ravel(), grad, net.bounded())[1].reshape(states.shape)
    else:
        to_states = np.zeros_like(states)
        to_states[own] = net.log_chance(states[own], y[own], grad, net.bounded())[1]
    #: By what a state's gradient goes on to the new state before its tanh, and to the gates: reset, update, inner.
    to_gates, to_new = np.empty((3, steps, k, HIDDEN), kind), 1 - z
    np.subtract(old, new, out=to_gates[1])
    to_gates[1] *= z
    to_gates[1] *= to_new
    new *= new
    to_new *= np.subtract(1, new, out=new)
    np.multiply(to_new, r, out=to_gates[2])
    np.multiply(to_gates[2], inner, out=to_gates[0])
    np.subtract(1, r, out=r)
    r *= -0.5
    to_gates[0] *= r
    dh, room = np.zeros((k, HIDDEN), kind), np.empty((3, k, HIDDEN), kind)
    u_back = np.ascontiguousarray(net.w["u"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0))
    for t in range(steps - 1, -1, -1):
        now, gates = to_states[t], to_gates[:, t]
        now += dh
        gates *= now
        np.matmul(gates, u_back, out=room)
        np.multiply(now, z[t], out=dh)
        for part in room:
            dh += part
        if begins[t]:
            dh[starts[t]] = 0
    flat = to_gates.reshape(3, -1, HIDDEN)
    grad["u"] += np.concatenate(old.reshape(-1, HIDDEN).T @ flat, axis=1)
    grad["b"] += (np.ones(steps * k, kind) @ flat).ravel()
    to_new *= to_states
    by_row = [np.add.reduceat(part.reshape(-1, HIDDEN).take(order, 0), first, axis=0) for part in (flat[0], flat[1], to_new)]
    grad["x"] = np.concatenate(by_row, axis=1)
    return grad, rows


def train_texts(net: Network, texts: list[np.ndarray], end: int, slots: int = 192, window: int = 16, rate: float = 0.1) -> None:
    """Adagrad steps by truncated back-propagation through time: gradients stay within a window, states go on. The sums of
    squares stay with the network, so it makes no difference how many calls its texts come in."""
    if not net.squares:
        net.squares = {k: np.full_like(v, 1e-2) for k, v in net.w.items()}
    h = np.zeros((slots, HIDDEN), np.float32)
    for x, y, starts, number in Slots(texts, end, slots, window):
        own, h = number >= 0, h[: x.shape[1]]
        grad, rows = gradient(net, x, y, starts, own, h)
        n = max(int(own.sum()), 1)
        for key, g in grad.items():
            g /= n / slots
            np.clip(g, -1, 1, out=g)
            at = rows if key == "x" else slice(None)
            squares = net.squares[key][at]
            squares += g * g
            net.squares[key][at] = squares
            g *= rate
            g /= np.sqrt(squares)
            net.w[key][at] -= g


def round_of(text: str | None, rounds: int) -> int:
    """The round in which a text is trained on, by its hash: the same one however the rows are dealt out."""
    return xxhash.xxh64_intdigest((text or "").encode("utf-8", "replace"), 42) % rounds


def most_frequent(counts: DataFrame, most: int = TABLE_WORDS) -> list[tuple[bytes, int]]:
    """The words of the highest counts, `most` at most, with their counts, in falling order. A histogram of the counts, which
    has the same number of steps for any corpus, tells how far down to go; only the words that are wanted leave their task."""
    step = F.floor(F.log2("n") * 64).cast("int")
    cut, sum_ = 0, 0
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        sum_ += r["count"]
        if sum_ > most:
            cut = r["step"] + 1
            break
    found = counts.where(step >= cut).toArrow()
    pairs = zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True)
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def _average(rows: list[tuple[int, bytes]]) -> tuple[int, dict[str, np.ndarray]]:
    total = sum(n for n, _ in rows)
    out: dict[str, np.ndarray] = {}
    for n, data in rows:
        for k, v in pickle.loads(data).items():
            out[k] = out.get(k, 0) + v * np.float32(n / total)
    return total, out


def encode(rows: DataFrame, vocabulary: Vocabulary, rounds: int = 2) -> DataFrame:
    """What training and scoring need of each row's text (column text, beside any others), so that words are looked up once:
    the other columns, n_tokens, n_known and logs (the sum of the log10 of the counts, and 1), inner (of the log10 of the
    chances within the symbols), each over the table's words, words and times of the other words, round, and symbols as
    unsigned 16-bit numbers."""
    symbol, (static, _, _) = vocabulary.symbol_of_rank().astype("<u2"), vocabulary.static()
    table = pa.array(sorted(vocabulary.rank, key=vocabulary.rank.get), pa.binary())
    sent = rows.sparkSession.sparkContext.broadcast((table, symbol, np.append(static, 0), np.append(np.log10(vocabulary.counts + 1), 0)))  # TABLE_WORDS words at most
    others = [c for c in rows.columns if c != "text"]
    names = [*others, "n_tokens", "n_known", "logs", "inner", "words", "times", "round", "symbols"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, symbol, within, log_count = sent.value
        for batch in batches:
            texts = batch.column(len(others))
            for first, begins, words in words_of(texts):
                head, starts = batch.slice(first, len(begins) - 1), begins[:-1]
                found = pc.fill_null(pc.index_in(words, value_set=table), -1).to_numpy()
                sums = [pa.array(np.add.reduceat(v, starts)) for v in ((found >= 0).astype(np.int64), log_count[found], within[found])]
                #: Each text's unlisted words, once each, with their times.
                unlisted = np.flatnonzero(found < 0)
                different = words.take(pa.array(unlisted)).dictionary_encode()
                text, n = np.searchsorted(begins, unlisted, side="right") - 1, max(len(different.dictionary), 1)
                key, times = np.unique(text * n + different.indices.to_numpy(), return_counts=True)
                cuts = pa.array(np.searchsorted(key, np.arange(len(begins)) * n), pa.int32())
                listed = [pa.ListArray.from_arrays(cuts, v) for v in (different.dictionary.take(pa.array(key % n)), pa.array(times, pa.int32()))]
                round_ = pa.array([round_of(t, rounds) for t in head.column(len(others)).to_pylist()], pa.int32())
                part = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((begins * 2).astype(np.int32)), pa.py_buffer(symbol[found])])
                yield pa.RecordBatch.from_arrays([*head.columns[:-1], pa.array(np.diff(begins), pa.int64()), *sums, *listed, round_, part], names)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    schema = f"{kinds}{', ' if kinds else ''}n_tokens long, n_known long, logs double, inner double, words array<binary>, times array<int>, round int, symbols binary"
    return rows.select(*others, "text").mapInArrow(task, schema)


def train(texts: DataFrame, vocabulary: Vocabulary, *, rounds: int = 2, seed: int = 0, at_once: int = 2_000_000) -> Network:
    """Train on every token of every row of `texts` (text); see train_encoded."""
    return train_encoded(stage(encode(texts.select("text"), vocabulary, rounds).select("round", "symbols")), vocabulary, rounds=rounds, seed=seed, at_once=at_once)


def train_encoded(encoded: DataFrame, vocabulary: Vocabulary, *, rounds: int = 2, seed: int = 0, at_once: int = 2_000_000) -> Network:
    """Train on all symbols of every row of `encoded` (round, symbols; staged), from the start of a text to its end.

    In each round a hash of the text tells its group; there are as many groups as the vocabulary's tokens ask for, so that
    neither depends on how rows are dealt out. Each group goes from the same weights over its texts, in the order of another
    hash, some `at_once` symbols at a time; then the groups' weights are averaged by their symbols, in a tree in the order of the
    groups, so that no more than 32 sets of weights meet anywhere.
    """
    spark = encoded.sparkSession
    symbol = vocabulary.symbol_of_rank()
    counts = np.bincount(symbol, np.append(vocabulary.counts, max(vocabulary.total - vocabulary.counts.sum(), 0)), minlength=CLASSES * WIDTH)
    net, end = Network.initial(counts, seed), int(symbol[vocabulary.rank.get(END, -1)])
    groups = max(1, min(MOST_GROUPS, -(-vocabulary.total // (rounds * GROUP_TOKENS))))
    order, group = F.xxhash64("symbols"), F.pmod(F.xxhash64("symbols", F.lit(1)), F.lit(groups)).cast("int")
    for part in range(rounds):
        sent = spark.sparkContext.broadcast(net.w)

        def task(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            now, own, n, held, size = -1, None, 0, [], 0

            def done() -> Iterator[pa.RecordBatch]:
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([n]), pa.array([pickle.dumps(own.w)], pa.binary())], ["part", "n", "data"])

            for batch in batches:
                for number, symbols in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if number != now:
                        if held:
                            train_texts(own, held, end)
                        yield from done()
                        now, own, n, held, size = number, Network({k: v.copy() for k, v in sent.value.items()}), 0, [], 0
                    held.append(np.frombuffer(symbols.as_py(), "<u2"))
                    size, n = size + len(held[-1]), n + len(held[-1])
                    if size >= at_once:
                        train_texts(own, held, end)
                        held, size = [], 0
            if held:
                train_texts(own, held, end)
            yield from done()

        def merge(table: pa.Table) -> pa.Table:
            table = table.sort_by("part")
            n, weights = _average(list(zip(table.column("n").to_pylist(), table.column("data").to_pylist(), strict=True)))
            return pa.table({"part": pa.array([table.column("part")[0].as_py() // 32], pa.int32()), "n": [n], "data": pa.array([pickle.dumps(weights)], pa.binary())})

        dealt = encoded.where(F.col("round") == part).select(group.alias("part"), "symbols", order.alias("order"))
        dealt = dealt.repartitionById(groups, "part").sortWithinPartitions("part", "order")
        found = stage(dealt.select("part", "symbols").mapInArrow(task, "part int, n long, data binary"))
        while found.count() > 32:
            found = stage(found.groupBy(F.floor(F.col("part") / 32)).applyInArrow(merge, "part int, n long, data binary"))
        rows = [(r["n"], bytes(r["data"])) for r in found.orderBy("part").collect()]
        if rows:
            net = Network(_average(rows)[1])
    return net


def score(docs: DataFrame, *, held_out_of: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from documents whose crc32 of the id, as text, modulo `held_out_of` is not `held_out`, and score all whole
    texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased (A-Z) words and one end. base_score is the add-one score of their counts. The model's score
    is the network's for the symbols, and for a word that shares its symbol with others its add-one share of them; the
    last band leaves one part for words never seen. Counts of words outside the table are joined by the word. Scores don't depend
    on how the rows are dealt out, but for what floating-point sums of another order differ by.

    Nulls: a null text is an empty one, which has only the end; a null id counts as an empty one and is kept. Repeated rows
    count and are returned each. With no rows to learn from, all counts are 0 and base_score is 0. An empty table gives no
    rows. Other columns, whatever their names, are not looked at.
    """
    spark = docs.sparkSession
    rest_of = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % held_out_of
    rows = docs.select(F.col(id_col).alias("doc_id"), (rest_of == held_out).alias("held_out"), F.col(text_col).alias("text"))

    counts = stage(count_words(rows.where("not held_out").select("text")))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    table = most_frequent(counts)
    vocabulary = Vocabulary({w: i for i, (w, _) in enumerate(table)}, np.array([n for _, n in table], np.int64), int(sums["total"]), int(sums["distinct"]))
    _, rest_divisor, divisor = vocabulary.static()
    encoded = stage(encode(rows, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    net = train_encoded(encoded.where("not held_out"), vocabulary)

    end, sent = int(vocabulary.symbol_of_rank()[vocabulary.rank.get(END, -1)]), spark.sparkContext.broadcast(net.w)
    kept = ["doc_id", "held_out", "n_tokens", "n_known", "logs", "row"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(sent.value)
        for batch in batches:
            lengths, at = batch.column(2).to_pylist(), 0
            while at < batch.num_rows:
                first, size = at, 0
                while at < batch.num_rows and size < 4_000_000:
                    size += lengths[at]
                    at += 1
                part = batch.slice(first, at - first)
                chances = score_texts(own, [np.frombuffer(x.as_py(), "<u2") for x in part.column(len(kept) + 1)], end)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], pa.array(chances + part.column(len(kept)).to_numpy())], [*kept, "chance"])

    schema = ", ".join(f"{c} {encoded.schema[c].dataType.simpleString()}" for c in kept)
    made = encoded.select(*kept, "inner", "symbols").mapInArrow(task, f"{schema}, chance double")
    others = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("o")).select("row", F.col("o.words").alias("word"), F.col("o.times").alias("times"))
    others = others.join(counts, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
    out = made.join(others, "row", "left")
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("more_logs", F.lit(0.0))
    rest = F.col("n_tokens") - F.col("n_known")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * divisor).alias("base_score"), (F.col("chance") + logs - rest * rest_divisor).alias("score"),
    )
