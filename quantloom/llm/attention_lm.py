"""Language-model scores by a small causal self-attention model over subword ids, in numpy.

A subword's probability is that of its class given all ids before it in its window, times its unit's share
of the class after the last id, times its share of the unit. The class part is a log-bilinear term of the
last id, from pair counts, plus one head of causal self-attention with learned distance biases; the
shares are counts alone. Texts are cut into windows of `width` ids that overlap; every id is scored
once, in the one window in which it is new, with masked attention over many windows at a time.

What is learned covers the whole training fold: word, id and pair counts come from all ids of all of
its texts, the end of each included. Attention is trained on windows that follow one another through
every whole text, so that every id is a target once a round. Rounds are data-parallel: tasks start from
the same weights, take Adam steps on their own windows, and the weights' mean, by windows seen, starts
the next round. Texts become ids once, in a written table. The driver holds the model only, whose size
is fixed: 2048 units (2016 ids of their own), 64 classes, 2048 x 2048 pair counts.

The base score needs the count of every word. The `frequent` most counted ones travel with the tasks;
a document's other words are joined to their counts.

Cases: null and empty texts are the end token alone. Without training documents all counts are 0 and the
class model is uniform. Long texts are scored window by window. Rows that repeat an id are scored each for
itself (rows are numbered once, in a written table), those that repeat id and text are of one shard; a null id counts as the id's empty text. Only id
and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_batches, record_batch, ship, slices, worker_store
from .packing import WordCoder

#: The vocabulary's own end id, also the start of every text.
END, VOCABULARY = 49407, 49408
UNITS, OWN_UNITS, CLASSES, OWN_CLASSES, DIM = 2048, 2016, 64, 48, 16
WORD, TEXTS = "word", "texts"


def ids_of(coder: WordCoder, texts: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4").astype(np.int64) for x in coder(texts)]


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of texts with A-Z lower-cased: each one's text and place in the array of distinct words, which comes last."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words = lists.flatten().cast(pa.binary()).dictionary_encode()
    of_text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).fill_null(0).to_numpy())
    at, distinct = words.indices.to_numpy(), words.dictionary
    # White space at a text's ends leaves empty words.
    real = pc.binary_length(distinct).to_numpy() > 0
    if not real.all():
        of_text, at = of_text[real[at]], (np.cumsum(real) - 1)[at[real[at]]]
        distinct = distinct.filter(pa.array(real))
    return of_text, at, distinct


@dataclass
class CountWords:
    """Words of training texts and the number of texts; counts leave a task once, or when the table is full."""

    most: int = 400_000

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        seen = 0

        def merged() -> tuple[pa.Array, np.ndarray]:
            words = pa.concat_arrays([pa.array([], pa.binary()), *(w for w, _ in held)]).dictionary_encode()
            return words.dictionary, np.bincount(words.indices.to_numpy(), np.concatenate([[], *(n for _, n in held)]), len(words.dictionary)).astype(np.int64)

        def out(mark: str, words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            return record_batch(["kind", "token", "n"], [pa.string(), pa.binary(), pa.int64()], [[mark] * len(words), words, n])

        for b in slices(batches, text=0, max_bytes=8 << 20):
            _, at, words = split(b.column(0))
            held.append((words, np.bincount(at, minlength=len(words)).astype(np.int64)))
            seen += b.num_rows
            if sum(len(w) for w, _ in held) > 2 * self.most:
                held = [merged()]
                if len(held[0][0]) > self.most:
                    yield out(WORD, *held.pop())
        yield out(WORD, *merged())
        if seen:
            yield out(TEXTS, pa.array([b""]), np.array([seen]))


class WordTable:
    """Places of words, and by place their ids and logs (none: a rare word), as a worker keeps them from task to task."""

    def __init__(self):
        self.known: dict[bytes, float] = {}
        self.drop(set())

    def drop(self, kept: set[bytes]) -> None:
        """Begins anew with those of the kept words that it has."""
        old = vars(self).get("place", {})
        words = [w for w in old if w in kept]
        at = np.array([old[w] for w in words], np.int64)
        start, length = (self.start[at], self.length[at]) if words else (at, at)
        ends = np.cumsum(length)
        self.ids = self.ids[np.repeat(start - ends + length, length) + np.arange(length.sum())] if words else np.zeros(0, "<u2")
        self.place, self.start, self.length = dict(zip(words, range(len(words)), strict=True)), ends - length, length
        self.logs = np.array([self.known.get(w, np.nan) for w in words], float)

    def add(self, coder: WordCoder, words: list[bytes]) -> None:
        # The coder takes many words at a time, and plain ASCII faster.
        words = [w for w in words if w.isascii()] + [w for w in words if not w.isascii()]
        as_text = [w.decode() for w in words]
        found = coder.encode(as_text)
        ids = [found[w] for w in as_text]
        length = np.array([len(x) // 4 for x in ids], np.int64)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4").astype("<u2")])
        self.logs = np.concatenate([self.logs, [self.known.get(w, np.nan) for w in words]])
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))


@dataclass
class Encode:
    """A text's ids between two ends, and what the base score needs: words, known words, their logs, rare words.

    Whatever white space stands between words, the tokenizer splits there: a text's ids are those of its words, one
    after another. Words meet the tokenizer once a table; from a full one the known words and those at hand stay. Only
    texts that may name special tokens, whose case counts, are encoded whole.
    """

    tokenizer: str
    words: Broadcast
    most: int = 500_000

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, known, end = WordCoder(self.tokenizer, most=100_000), self.words.value, np.array([END], "<u2").tobytes()
        table: WordTable = worker_store("subwords", f"table {self.tokenizer}").setdefault("it", WordTable())
        if table.known is not known:
            table.known = known
            table.drop(set())
        names = ["_row", "doc_id", "held", "n_tokens", "known", "logs", "rare", "ids"]
        types = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.binary()]
        for b in slices(batches, text=3, max_bytes=4 << 20):
            n, texts = b.num_rows, b.column(3).cast(pa.string())
            of_text, at, distinct = split(texts)
            words = distinct.to_pylist()
            place = list(map(table.place.get, words))
            if None in place:
                new = [w for w, p in zip(words, place, strict=True) if p is None]
                if len(table.place) + len(new) > self.most:
                    table.drop({*known, *words})
                table.add(coder, new)
                place = list(map(table.place.__getitem__, words))
            place = np.array(place, np.int64)[at]
            logs, size = table.logs[place], table.length[place]
            rare = np.isnan(logs)
            count, n_rare = np.bincount(of_text, minlength=n), np.bincount(of_text[rare], minlength=n)
            missing = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n_rare]), pa.int32()), distinct.take(pa.array(at[rare])))
            ends = np.cumsum(size)
            found = table.ids[np.repeat(table.start[place] - ends + size, size) + np.arange(size.sum())]
            stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])].tolist()
            ids = [end + found[a:z].tobytes() + end for a, z in zip(stops, stops[1:], strict=False)]
            for i in np.flatnonzero(pc.match_substring(texts, "<|").fill_null(False).to_numpy(zero_copy_only=False)).tolist():
                ids[i] = end + ids_of(coder, [texts[i].as_py()])[0].astype("<u2").tobytes() + end
            yield record_batch(names, [*b.schema.types[:3], *types], [*b.columns[:3], count + 1, count + 1 - n_rare - (b"" not in known), np.bincount(of_text, np.where(rare, 0, logs), n) + known.get(b"", 0.0), missing, ids])


class CountIds:
    """How often each id stands in sequences; of both ends, one counts."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, np.int64)
        for b in slices(batches, text=0):
            total += np.bincount(joined(b)[0], minlength=VOCABULARY)
            total[END] -= b.num_rows
        at = np.flatnonzero(total)
        yield record_batch(["i", "n"], [pa.int64(), pa.int64()], [at, total[at]])


class Room:
    """Arrays by name that are used again: at these sizes new memory costs more than what is computed in it."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, np.float32)
        return self.held[name][:size].reshape(shape)


def exponentials(s: np.ndarray, shifted: bool) -> np.ndarray:
    """exp(s) in place; shifted: by row times a factor that makes the largest 1."""
    if shifted:
        s -= s.max(-1, keepdims=True)
    with np.errstate(over="ignore"):
        return np.exp(s, out=s)


def in_range(sums: np.ndarray) -> bool:
    """Whether sums of plain exponentials are far from where float32 ends; else they are computed again, shifted."""
    return bool(sums.min(initial=1) > 1e-25 and sums.max(initial=1) < 1e25)


def sums_by(units: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sums by unit (a row each) of columns, which lie one after another in memory."""
    out = np.empty((len(columns), UNITS), np.float32)
    for row, c in zip(out, columns, strict=True):
        row[:] = np.bincount(units, c, UNITS)
    return np.ascontiguousarray(out.T)


@dataclass
class Ready:
    """The same model with its projections looked up by input, for scoring."""

    qkv: np.ndarray
    distance: np.ndarray
    o: np.ndarray
    bigram: np.ndarray
    #: exponentials of bigram
    chance: np.ndarray
    room: Room

    def log_class(self, x: np.ndarray, classes: np.ndarray, skip: int = 0, block: int = 20) -> np.ndarray:
        """Log probability of the classes after all inputs of x but each row's first `skip`, which are context only.

        Queries go by blocks, so that keys that lie wholly ahead of a block aren't read.
        """
        (rows, width), room = x.shape, self.room
        n = rows * (width - skip)
        qkv = np.take(self.qkv, x.reshape(-1), 0, out=room("qkv", rows * width, 3 * DIM + 1), mode="clip").reshape(rows, width, -1)
        q, k, v = qkv[..., :DIM], room("keys", rows, DIM, width), qkv[..., 2 * DIM :]
        k[:] = qkv[..., DIM : 2 * DIM].transpose(0, 2, 1)
        sums = room("sums", rows, width - skip, DIM + 1)
        for shifted in (False, True):
            for a in range(skip, width, block):
                z = min(a + block, width)
                s = np.matmul(q[:, a:z], k[..., :z], out=room("s", rows, z - a, z))
                s += self.distance[a:z, :z]
                with np.errstate(invalid="ignore"):
                    np.matmul(exponentials(s, shifted), v[:, :z], out=sums[:, a - skip : z - skip])
            if shifted or in_range(sums[..., DIM]):
                break
        h = np.divide(sums[..., :DIM], sums[..., DIM:], out=room("h", rows, width - skip, DIM)).reshape(n, DIM)
        at = np.arange(0, n * CLASSES, CLASSES) + classes[:, skip:].reshape(-1)
        before = x[:, skip:].reshape(-1)
        odds = exponentials(np.matmul(h, self.o, out=room("odds", n, CLASSES)), False)
        chance = np.take(self.chance, before, 0, out=room("chance", n, CLASSES), mode="clip")
        total, found = np.einsum("ij,ij->i", odds, chance), odds.take(at) * chance.take(at)
        if not (in_range(total) and in_range(found)):
            odds = h @ self.o + self.bigram[before]
            odds -= odds.max(-1, keepdims=True)
            return (odds.take(at) - np.log(np.exp(odds).sum(-1))).reshape(rows, width - skip)
        return np.log(found / total).reshape(rows, width - skip)


@dataclass
class Model:
    """unit_of: id to unit; class_of: unit to class; in_unit: log share of an id in its unit.

    bigram: class log-odds after a unit. within: log share of a unit in its class after a unit.
    """

    unit_of: np.ndarray
    class_of: np.ndarray
    in_unit: np.ndarray
    bigram: np.ndarray
    within: np.ndarray | None
    width: int
    weights: dict[str, np.ndarray]
    #: what a unit's share in its class after any unit counts for
    shrink: float = 3.0

    @classmethod
    def fresh(cls, counts: np.ndarray, word_end: np.ndarray, width: int, seed: int) -> Model:
        """Own units and classes for the most frequent ids; other classes by frequency band and word end."""
        rank = np.empty(VOCABULARY, np.int64)
        rank[np.lexsort((np.arange(VOCABULARY), -counts))] = np.arange(VOCABULARY)
        band = np.minimum(np.log2(np.maximum(rank, 1) / OWN_CLASSES).clip(0).astype(int), (CLASSES - OWN_CLASSES) // 2 - 1)
        of_id = np.where(rank < OWN_CLASSES, rank, OWN_CLASSES + 2 * band + word_end)
        # The rest's units are parts of a class.
        parts = (UNITS - OWN_UNITS) // (CLASSES - OWN_CLASSES)
        unit_of = np.where(rank < OWN_UNITS, rank, OWN_UNITS + (of_id - OWN_CLASSES) * parts + np.arange(VOCABULARY) % parts)
        class_of = OWN_CLASSES + np.maximum(np.arange(UNITS) - OWN_UNITS, 0) // parts
        class_of[unit_of] = of_id
        total = np.bincount(unit_of, weights=counts + 1.0, minlength=UNITS)
        r = np.random.default_rng(seed)
        draw = lambda *s: r.normal(0, 0.3, s).astype(np.float32)
        weights = {"e": draw(UNITS, DIM), "q": draw(DIM, DIM), "k": draw(DIM, DIM), "v": draw(DIM, DIM), "o": np.zeros((DIM, CLASSES), np.float32), "r": np.zeros(width, np.float32)}
        return cls(unit_of, class_of, np.log(counts + 1.0) - np.log(total[unit_of]), np.zeros((UNITS, CLASSES), np.float32), None, width, weights)

    def counted(self, counts: np.ndarray, pairs: np.ndarray) -> Model:
        """The model with what counts of ids and of pairs of units (before, after) say."""
        of_class = np.zeros((UNITS, CLASSES))
        np.add.at(of_class.T, self.class_of, pairs.T)
        prior = (of_class.sum(0) + 0.5) / (of_class.sum() + 0.5 * CLASSES)
        bigram = np.log((of_class + 8 * prior) / (of_class.sum(1, keepdims=True) + 8))
        unit = np.bincount(self.unit_of, weights=counts + 1.0, minlength=UNITS) + 1e-3
        share = unit / np.bincount(self.class_of, weights=unit, minlength=CLASSES)[self.class_of]
        within = np.log((pairs + self.shrink * share) / (of_class[:, self.class_of] + self.shrink))
        return replace(self, bigram=bigram.astype(np.float32), within=within.astype(np.float32))

    def ready(self) -> Ready:
        w = self.weights
        # Behind values stands a one, so that a row's sum of exponentials stands behind its sum of values.
        of_unit = np.hstack([w["e"] @ w["q"], w["e"] @ w["k"], w["e"] @ w["v"], np.ones((UNITS, 1))])
        return Ready(of_unit.astype(np.float32), self.distance(), np.asfortranarray(w["o"], np.float32), self.bigram, np.exp(self.bigram), Room())

    def distance(self) -> np.ndarray:
        """Bias by distance back; what lies ahead is masked."""
        gap = np.arange(self.width)[:, None] - np.arange(self.width)[None]
        return np.where(gap >= 0, self.weights["r"][np.abs(gap)], np.float32(-1e9)).astype(np.float32)

    def gradients(self, x: np.ndarray, classes: np.ndarray, counted: np.ndarray, room: Room | None = None, some: int = 32) -> dict[str, np.ndarray]:
        """Slopes of the mean loss of the counted targets behind windows of units x (rows, width).

        `some` windows at a time, so that their arrays stay in a processor's cache.
        """
        w, (rows, width), room = self.weights, x.shape, room or Room()
        flat, classes = x.reshape(-1), classes.reshape(-1)
        weight = (counted.reshape(-1) / max(1, counted.sum())).astype(np.float32)
        to_qkv, to_class, distance = np.hstack([w["q"], w["k"], w["v"]]), np.asfortranarray(w["o"]), self.distance()[:width, :width]
        of_qkv, of_o, ahead = np.zeros((DIM, 3 * DIM), np.float32), np.zeros(w["o"].shape, np.float32), np.zeros(width * width, np.float32)
        de = room("de", DIM, len(flat))
        for begin in range(0, rows, some):
            r = min(some, rows - begin)
            n, part = r * width, slice(begin * width, (begin + r) * width)
            e = np.take(w["e"], flat[part], 0, out=room("e", n, DIM), mode="clip")
            qkv = np.matmul(e, to_qkv, out=room("qkv", n, 3 * DIM)).reshape(r, width, 3 * DIM)
            q, k, v = qkv[..., :DIM], qkv[..., DIM : 2 * DIM], qkv[..., 2 * DIM :]
            # Products with keys and values as columns are faster if those lie side by side.
            columns = room("columns", r, 2 * DIM + 1, width)
            columns[:, : 2 * DIM] = qkv[..., DIM:].transpose(0, 2, 1)
            columns[:, 2 * DIM] = 1
            for shifted in (False, True):
                s = np.matmul(q, columns[:, :DIM], out=room("s", r, width, width))
                s += distance
                sums = exponentials(s, shifted) @ np.ones(width, np.float32)
                if in_range(sums):
                    break
            s *= (1 / sums)[..., None]
            h = np.matmul(s, v, out=room("h", r, width, DIM)).reshape(n, DIM)
            for shifted in (False, True):
                odds = np.matmul(h, to_class, out=room("odds", n, CLASSES))
                odds += np.take(self.bigram, flat[part], 0, out=room("bigram", n, CLASSES), mode="clip")
                sums = exponentials(odds, shifted) @ np.ones(CLASSES, np.float32)
                if in_range(sums):
                    break
            odds *= (weight[part] / sums)[:, None]
            odds.reshape(-1)[np.arange(0, n * CLASSES, CLASSES) + classes[part]] -= weight[part]
            of_o += (h.reshape(r, width, DIM).transpose(0, 2, 1) @ odds.reshape(r, width, CLASSES)).sum(0)
            dh = room("dh", n, DIM + 1)
            np.matmul(odds, w["o"].T, out=dh[:, :DIM])
            # A row's sum of ds * s is that of dh * h; it meets the ones behind the values.
            dh[:, DIM] = -np.einsum("ij,ij->i", dh[:, :DIM], h)
            dh = dh.reshape(r, width, DIM + 1)
            back = room("back", r, width, 3 * DIM)
            ds = np.matmul(dh, columns[:, DIM:], out=room("ds", r, width, width))
            ds *= s
            ahead += np.ones(r, np.float32) @ ds.reshape(r, -1)
            np.matmul(ds, k, out=back[..., :DIM])
            np.matmul(ds.transpose(0, 2, 1), q, out=back[..., DIM : 2 * DIM])
            np.matmul(s.transpose(0, 2, 1), dh[..., :DIM], out=back[..., 2 * DIM :])
            of_qkv += (e.reshape(r, width, DIM).transpose(0, 2, 1) @ back).sum(0)
            np.matmul(to_qkv, back.reshape(n, 3 * DIM).T, out=de[:, part])
        gap = np.arange(width)[:, None] - np.arange(width)[None]
        of_r = np.bincount(gap[gap >= 0], ahead.reshape(width, width)[gap >= 0], self.width).astype(np.float32)
        return dict(zip("qkv", np.hsplit(of_qkv, 3), strict=True)) | {"o": of_o, "e": sums_by(flat, de), "r": of_r}

    def trained(self, windows: np.ndarray, steps_of: int = 64, rate: float = 0.01) -> dict[str, np.ndarray]:
        """Adam over windows of width + 1 ids (-1: none), in the given order."""
        here, room = replace(self, weights={n: x.copy() for n, x in self.weights.items()}), Room()
        m = {n: np.zeros_like(x) for n, x in here.weights.items()}
        v = {n: np.zeros_like(x) for n, x in here.weights.items()}
        for step, at in enumerate(range(0, len(windows), steps_of), 1):
            part = windows[at : at + steps_of]
            counted = part[:, 1:] >= 0
            units = self.unit_of[np.maximum(part, 0)]
            for n, g in here.gradients(units[:, :-1], self.class_of[units[:, 1:]], counted, room).items():
                t = np.subtract(g, m[n], out=room("step", *g.shape))
                t *= 0.1
                m[n] += t
                np.multiply(g, g, out=t)
                t -= v[n]
                t *= 0.01
                v[n] += t
                np.divide(v[n], 1 - 0.99**step, out=t)
                np.sqrt(t, out=t)
                t += 1e-8
                np.divide(m[n], t, out=t)
                t *= rate / (1 - 0.9**step)
                here.weights[n] -= t
        return here.weights

    def packed(self) -> np.ndarray:
        return np.concatenate([self.weights[n].ravel() for n in sorted(self.weights)])

    def unpacked(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for n in sorted(self.weights):
            x = self.weights[n]
            out[n] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
        return out


def joined(b: pa.RecordBatch, column: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch's sequences one after another, and the length of each."""
    parts = b.column(column).to_pylist()
    return np.frombuffer(b"".join(parts), "<u2").astype(np.int64), np.array([len(x) // 2 for x in parts])


def window_table(ids: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """Windows of width + 1 ids (-1: none) in which every id but a sequence's first is a target once."""
    count = -(-(n - 1) // width)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = (np.repeat(np.cumsum(n) - n, count) + k * width)[:, None] + np.arange(width + 1)[None]
    return np.where(at < np.repeat(np.cumsum(n), count)[:, None], ids[np.minimum(at, len(ids) - 1)], -1)


@dataclass
class CountPairs:
    """How often a unit stands behind another."""

    unit_of: Broadcast

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS * UNITS, np.int64)
        for b in slices(batches, text=0):
            ids, n = joined(b)
            units = self.unit_of.value[ids]
            # From a sequence's last id to the next one's first there is no step.
            total += np.bincount(np.delete(units[:-1] * UNITS + units[1:], np.cumsum(n)[:-1] - 1), minlength=len(total))
        at = np.flatnonzero(total)
        yield record_batch(["i", "n"], [pa.int64(), pa.int64()], [at, total[at]])


@dataclass
class TrainShard:
    """Weights after each shard's own windows, times how many they are, summed over a task's shards.

    Rows come sorted by shard. A shard of over `most` windows starts from the given weights again behind every `most`.
    """

    model: Broadcast
    most: int = 65_536

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = self.model.value
        total, seen = 0.0, 0
        shard, held, n = None, [], 0

        def learnt(windows: np.ndarray) -> np.ndarray:
            order = np.random.default_rng(len(windows)).permutation(len(windows))
            return replace(model, weights=model.trained(windows[order])).packed().astype(float) * len(windows)

        for b in slices(batches, text=1, max_bytes=2 << 20):
            of_row = b.column(0).to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(of_row)) + 1).tolist(), len(of_row)]
            for i, j in zip(starts, starts[1:], strict=False):
                if of_row[i] != shard and n:
                    total, seen = total + learnt(np.concatenate(held)), seen + n
                    held, n = [], 0
                shard = of_row[i]
                held.append(window_table(*joined(b.slice(i, j - i), 1), model.width))
                n += len(held[-1])
                while n >= self.most:
                    windows = np.concatenate(held)
                    total, seen = total + learnt(windows[: self.most]), seen + self.most
                    held, n = [windows[self.most :]], n - self.most
        if n:
            total, seen = total + learnt(np.concatenate(held)), seen + n
        if seen:
            yield record_batch(["i", "x", "n"], [pa.int64(), pa.float64(), pa.int64()], [np.arange(len(total)), total, np.full(len(total), seen)])


@dataclass
class Score:
    """log10 probability of each sequence behind its first end, each id scored in one window."""

    model: Broadcast
    overlap: int
    rows: int = 64

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = self.model.value
        ready = model.ready()
        for b in slices(batches, text=b_ids, max_bytes=4 << 20):
            ids, n = joined(b, b_ids)
            yield pa.RecordBatch.from_arrays([*b.columns[:b_ids], pa.array(self.scores(model, ids, n, ready))], names=[*b.schema.names[:b_ids], "score"])

    def scores(self, model: Model, ids: np.ndarray, lengths: np.ndarray, ready: Ready | None = None) -> np.ndarray:
        units = model.unit_of[ids]
        n, first = lengths - 1, np.cumsum(lengths) - lengths
        width, new = model.width, model.width - self.overlap
        count = 1 + np.maximum(0, -(-(n - width) // new))
        doc = np.repeat(np.arange(len(n)), count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        ready = ready or model.ready()
        shares = model.in_unit[ids[1:]] + model.within.reshape(-1).take(units[:-1] * UNITS + units[1:])
        # From a sequence's last id to the next one's first there is no step.
        shares[first[1:] - 1] = 0
        total = np.add.reduceat(shares, first)
        classes = model.class_of[units]
        # In a text's first window all ids are new; in the others the overlap is context.
        for skip, those in ((0, np.flatnonzero(k == 0)), (self.overlap, np.flatnonzero(k > 0))):
            for a in range(0, len(those), self.rows):
                d, kk = doc[those[a : a + self.rows]], k[those[a : a + self.rows]]
                at = (first[d] + kk * new)[:, None] + np.arange(width)[None]
                inside = (at < (first[d] + n[d])[:, None])[:, skip:]
                at = np.minimum(at, len(ids) - 2)
                total += np.bincount(d, np.where(inside, ready.log_class(units[at], classes[at + 1], skip), 0).sum(1), len(n))
        return total / np.log(10)


#: Columns that pass through scoring stand before the ids.
SCORED = ["_row", "doc_id", "held", "n_tokens", "known", "logs"]
b_ids = len(SCORED)


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 == 2


def counts_of(df: DataFrame, fn, size: int) -> np.ndarray:
    """Sums by index: at most `size` rows reach the driver, in Arrow form."""
    got = in_batches(df, fn, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[got.column("i").to_numpy()] = got.column("n").to_numpy()
    return out


def attention_scores(docs: DataFrame, tokenizer: str, width: int = 48, overlap: int = 8, rounds: int = 1, shard: int = 32_768, frequent: int = 150_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    ship(spark, tokenizer)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = cut(in_batches(texts.where(~held_out("doc_id")).select("text"), CountWords(), "kind string, token binary, n long").groupBy("kind", "token").agg(F.sum("n").alias("n")), "counts")
    words = counts.where(F.col("kind") == WORD).select("token", "n")
    # The most frequent words by whole bands of counts: never more than `frequent` rows reach the driver.
    band, short = F.floor(8 * F.log2("n")), F.octet_length("token") <= 64
    bands = counts.groupBy("kind", short.alias("short"), band.alias("band")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).orderBy(F.desc("band")).collect()
    n_train = sum(r.n for r in bands if r.kind == TEXTS)
    n_all, distinct = sum(r.n for r in bands), sum(r.v for r in bands if r.kind == WORD) + (n_train > 0)
    bands = [r for r in bands if r.kind == WORD and r.short]
    fits = [r.band for r, total in zip(bands, np.cumsum([r.v for r in bands]), strict=True) if total <= frequent]
    known = {bytes(r.token): float(np.log10(r.n + 1)) for r in words.where(short & (band >= min(fits))).collect()} if fits else {}
    known |= {b"": float(np.log10(n_train + 1))} if n_train else {}

    # Texts become ids once, for counts, training and scores.
    kind = texts.schema[0].dataType.simpleString()
    numbered = texts.select(F.monotonically_increasing_id().alias("_row"), "doc_id", held_out("doc_id").alias("held"), "text")
    rows = cut(in_batches(numbered, Encode(tokenizer, send(known)), f"_row long, doc_id {kind}, held boolean, n_tokens long, known long, logs double, rare array<binary>, ids binary"), "sequences")
    train = rows.where("not held").select("doc_id", "ids")

    tok = Tokenizer.from_file(tokenizer)
    word_end = np.array([(tok.id_to_token(i) or "").endswith("</w>") for i in range(VOCABULARY)], np.int64)
    ids = counts_of(train.select("ids"), CountIds(), VOCABULARY)
    model = Model.fresh(ids, word_end, width, seed)
    model = model.counted(ids, counts_of(train.select("ids"), CountPairs(send(model.unit_of)), UNITS * UNITS).reshape(UNITS, UNITS))
    shards = max(1, int(ids.sum()) // (width * shard))
    text_hash = F.xxhash64(F.col("doc_id").cast("string"), "ids")
    dealt = train.select(F.pmod(text_hash, F.lit(shards)).alias("shard"), "ids", text_hash.alias("_order"))
    # A given number of tasks: small shards would else be merged into one.
    tasks = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for part in [F.col("shard") == 0, F.col("shard") > 0] * rounds:
        own = dealt.where(part).repartition(tasks, "shard").sortWithinPartitions("shard", "_order").select("shard", "ids")
        flat = model.packed().astype(float)
        for r in in_batches(own, TrainShard(send(replace(model, within=None))), "i long, x double, n long").groupBy("i").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect():
            flat[r.i] = r.x / r.n
        model.weights = model.unpacked(flat)

    scored = in_batches(rows.select(*SCORED, "ids"), Score(send(model), overlap), f"_row long, doc_id {kind}, held boolean, n_tokens long, known long, logs double, score double")
    rare = rows.select("_row", F.explode("rare").alias("token")).join(words, "token").groupBy("_row").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_logs"))
    # log10((c+1) / (N + 1*(V+1))), summed over tokens
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(n_all + distinct + 1)))
    return scored.join(rare, "_row", "left").select(F.col("doc_id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
