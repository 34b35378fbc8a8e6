"""Toxicity by noisy-channel restoration: decode disguised words, then score the restored text.

Disguise is read as a noisy channel: a letter may be sent as a look-alike (0 for o, $ for s), set
apart by separators, or repeated. Tokens with a letter and a look-alike, a doubled letter or an inner
separator, and three or more letters set apart, become a lattice of possible letters; the Viterbi path
under a character trigram model of the corpus is the restored word. Where repetitions may be a word's
own (he11), the path that keeps them is a second reading. Everything else is left alone.

The trigram counts come from all texts (at most 64^3 counters leave a task). Labels are read from the
training fold only: one half of a bounded sample of labelled rows gives weights to words and word
beginnings, the other half fits a logistic curve to three sums of these weights. A part's weight is its
log odds where these are surely high (the lower end of a 90 % interval exceeds `least`), else nothing.
The sample's bound is a parameter; scores cover every whole text. Workers keep what they decode by model.

Cases: null and empty texts have no words and get the curve's value at zero. Without labels of both
kinds in the training fold every score is the share of toxic labels (0 without any). Long texts are
scored whole. Repeated rows give repeated rows; a repeated label counts each time. A null id is never
held out and has no label. Of the documents only id and text are read. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_batches, record_batch, slices, worker_store

#: Look-alikes and the letters they may stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
#: Letters with a code of their own; all others share one.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
SIZE, OTHER = 64, 63
#: Codes by code point: 0 is no letter, OTHER a letter of any other alphabet.
CODES = np.fromiter((OTHER if chr(c).isalpha() else 0 for c in range(0x30000)), np.int64, 0x30000)
CODES[[ord(c) for c in LETTERS]] = np.arange(1, len(LETTERS) + 1)
CODE = {c: i for i, c in enumerate(LETTERS, 1)}

BETWEEN = r"[ .\-_*·,~]"
#: Single letters or look-alikes set apart, at least four of them, or three with a letter.
ONE, NEXT, APART = r"(?:[^\W\d_]|[0-9@$!|+])", r"(?:[^\W_]|[@$!|+])", BETWEEN + "{1,2}"
SPACED = re.compile(rf"(?<![\w@$!])(?:{ONE}(?:{APART}{NEXT}){{3,}}|(?=(?:[0-9@$!|+]{APART}){{0,2}}[^\W\d_]){ONE}(?:{APART}{NEXT}){{2}})(?![\w@$!])")
LOOK, SIGN = r"[0-9@$!|+(€£¡]", r"(?:[^\W_]|[@$!|+(€£¡])"
INNER = rf"[.\-_*·,~](?={SIGN})"
#: A whole token with a letter and a doubled letter, a look-alike or an inner separator.
MIXED = re.compile(rf"(?<![\w@$!|+(€£¡])(?:[^\W\d_]*?([^\W\d_])\1|[^\W\d_]+(?:{LOOK}|{INNER})|{LOOK}(?:{LOOK}|{INNER})*[^\W\d_])(?:{SIGN}|{INNER})*")
REPEATED = re.compile(r"(.)\1")
WORD = re.compile(r"[^\W\d_]+")


def trigrams(texts: list[str]) -> np.ndarray:
    """Counts by code of letter trigrams; a run of other characters is one boundary (code 0)."""
    points = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(points < len(CODES), CODES[np.minimum(points, len(CODES) - 1)], 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    codes = codes[keep]
    return np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3) if len(codes) > 2 else np.zeros(SIZE**3, np.int64)


class CountTrigrams:
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for b in slices(batches, text=0):
            total += trigrams([t for t in b.column(0).to_pylist() if t])
        at = np.flatnonzero(total)
        yield record_batch(["code", "n"], [pa.int64(), pa.int64()], [at, total[at]])


#: Longer tokens and spans aren't kept by workers.
LONGEST = 48
#: Characters of a path that a step copies at most; the first of the private code points, more than there are states.
PIECE, HEAD = 32, 0xF0000


@dataclass
class Restore:
    """Viterbi decoding under log p(c | a, b). The name is the model's own: workers keep decodings under it."""

    log_p: np.ndarray
    name: str = ""
    swap_cost: float = 2.0
    drop_cost: float = 0.3
    keep_repeat_cost: float = 1.5

    @classmethod
    def of(cls, counts: np.ndarray) -> Restore:
        n = counts.reshape(SIZE, SIZE, SIZE).astype(float)
        two = n.sum(0) + 0.5
        backed = two / two.sum(1, keepdims=True)
        return cls(np.log((n + 2.0 * backed[None]) / (n.sum(2, keepdims=True) + 2.0)), hashlib.sha256(counts.tobytes()).hexdigest())

    def readings(self, span: str) -> str:
        """What the span stands for: a letter's repetitions taken for one, and where they may be the word's own, kept."""
        out = [self.word(span)]
        if REPEATED.search(span) and not span.isalpha():
            out.append(self.word(span, repeats=True))
        return " ".join(dict.fromkeys(out))

    def word(self, span: str, repeats: bool = False) -> str:
        """The likeliest letters; ties go to the first found, which keeps what was written. With repeats, all are kept."""
        log_p = self.flat
        # A state is the last two letters' codes in one number.
        # A path's text begins with the number of the linked pieces before it, so a step copies one piece at most.
        heads: list[tuple | None] = [None]
        paths: dict[int, tuple[float, str]] = {0: (0.0, chr(HEAD))}
        last = ""
        for i, c in enumerate(span):
            if i % PIECE == 0 and i:
                heads = [(heads[ord(text[0]) - HEAD], text[1:]) for _, text in paths.values()]
                paths = {state: (cost, chr(HEAD + k)) for k, (state, (cost, _)) in enumerate(paths.items())}
            options = [(c, 0.0)] if c.isalpha() else []
            options += [(x, self.swap_cost) for x in LOOKS.get(c, "")]
            drop = self.drop_cost if not options else None
            if c == last and not (repeats and options):
                # A repetition is kept at a price, or taken for one letter.
                options, drop = [(x, cost + self.keep_repeat_cost) for x, cost in options], 0.0
            coded = [(CODE.get(x, OTHER), x, more) for x, more in options]
            ahead: dict[int, tuple[float, str]] = {}
            for state, (cost, text) in paths.items():
                if drop is not None and (state not in ahead or (cost + drop, text) < ahead[state]):
                    ahead[state] = cost + drop, text
                for to, x, more in coded:
                    place = state * SIZE + to
                    at, state_to = cost + more - log_p[place], place % SIZE**2
                    if state_to not in ahead or at < ahead[state_to][0]:
                        ahead[state_to] = at, text + x
            paths, last = ahead, c
        text = min((cost - log_p[state * SIZE], text) for state, (cost, text) in paths.items())[1]
        behind, pieces = heads[ord(text[0]) - HEAD], [text[1:]]
        while behind:
            behind, text = behind
            pieces.append(text)
        return "".join(reversed(pieces))

    @cached_property
    def flat(self) -> list[float]:
        return self.log_p.ravel().tolist()

    def reading(self, span: str, known: dict[str, str]) -> str:
        """known: what this model has decoded already."""
        if (out := known.get(span)) is None:
            if len(known) > 200_000:
                known.clear()
            out = self.readings(span)
            if len(span) <= LONGEST:
                known[span] = out
        return out

    def tokens(self, text: str, known: dict[str, str]) -> list[str]:
        """What stands between white space, in lower case; only spans of letters set apart reach across it, and are restored."""
        low = text.lower()
        if SPACED.search(low):
            low = SPACED.sub(lambda m: self.reading(m.group(), known), low)
        return low.split()

    def restored(self, token: str, known: dict[str, str]) -> str:
        return MIXED.sub(lambda m: self.reading(m.group(), known), token)

    def words(self, token: str, known: dict[str, str]) -> list[str]:
        """The words of a token with its spans restored."""
        return WORD.findall(self.restored(token, known))

    def text(self, text: str, known: dict[str, str]) -> str:
        """The text in lower case with its spans restored, one space between tokens."""
        return " ".join(self.restored(t, known) for t in self.tokens(text, known))


def looked_up(known: dict, tokens: list[str], make: Callable[[str], object], most: int = 400_000) -> list:
    """make of each token, kept in known: a worker works out a token once while its table isn't full."""
    missing = set(tokens).difference(known)
    if len(known) + len(missing) > most:
        known.clear()
        missing = set(tokens)
    for t in missing:
        known[t] = make(t)
    out = list(map(known.__getitem__, tokens))
    for t in missing:
        if len(t) > LONGEST:
            del known[t]
    return out


def parts(word: str) -> list[str]:
    """What can carry a weight: the word and its beginnings."""
    return ["=" + word, *("^" + word[:k] for k in range(3, min(len(word), 8) + 1))]


@dataclass
class CountParts:
    """Documents by part, half and label, counted within a task first."""

    restore: Broadcast

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: tuple[Counter, ...] = Counter(), Counter(), Counter(), Counter()
        restore, restored, known = self.restore.value, decoded(self.restore), {}
        for b in slices(batches):
            for which, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens = restore.tokens(t or "", restored)
                words = set().union(*looked_up(known, tokens, lambda x: restore.words(x, restored)))
                n[which].update({p for w in words for p in parts(w)})
                n[which][""] += 1
        keys = list(set().union(*n))
        yield record_batch(PARTS, [pa.string(), *[pa.int64()] * 4], [keys, *([x[k] for k in keys] for x in n)])


#: clean and toxic documents of the first half, then of the second; the empty part counts documents
PARTS = ["part", "clean0", "toxic0", "clean1", "toxic1"]


def decoded(restore: Broadcast) -> dict[str, str]:
    """What a worker has decoded by this very model."""
    return latest("restored", restore.value.name)


def latest(kind: str, name: str) -> dict:
    """A worker's table of one model: another model's goes."""
    held = worker_store("toxicity", kind)
    if held.get("name") != name:
        held.clear()
        held |= {"name": name, "table": {}}
    return held["table"]


@dataclass
class Score:
    """Three sums of weights over a text's words, and the curve's value if there is one."""

    restore: Broadcast
    weights: Broadcast
    curve: tuple[float, ...] | None
    names: tuple[str, ...]

    def of_words(self, words: list[str]) -> tuple[float, ...]:
        """The words' weights that aren't 0."""
        _, of, starts = self.weights.value
        return tuple(x for w in words if w[:3] in starts and (x := max(of.get(p, 0.0) for p in parts(w))) != 0.0)

    def features(self, text: str, restored: dict, known: dict[str, tuple[float, ...]]) -> tuple[float, float, float]:
        restore = self.restore.value
        by_token = looked_up(known, restore.tokens(text, restored), lambda t: self.of_words(restore.words(t, restored)))
        found = list(chain.from_iterable(filter(None, by_token)))
        return max(found, default=0.0), float(np.log1p(sum(x >= 3.0 for x in found))), float(np.log1p(sum(found)))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restored, known = decoded(self.restore), latest("weights", self.weights.value[0])
        for b in slices(batches, max_bytes=16 << 20):
            rows = np.array([self.features(t or "", restored, known) for t in b.column(1).to_pylist()]).reshape(-1, 3)
            if self.curve is None:
                cols = [pa.array(rows[:, k]) for k in range(3)]
            else:
                z = rows @ np.array(self.curve[1:]) + self.curve[0]
                cols = [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=list(self.names))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> tuple[float, ...]:
    """Newton's method; ridge keeps separable data finite."""
    x = np.column_stack([np.ones(len(x)), x])
    w, keep = np.zeros(x.shape[1]), ridge * np.diag([1e-6, *[1.0] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
    return tuple(map(float, w))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, least: float = 1.9, id_col: str = "doc_id", text_col: str = "text") -> tuple[Broadcast, Broadcast, tuple[float, ...]]:
    """Restoration model, weights and curve."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = np.zeros(SIZE**3, np.int64)
    for r in in_batches(texts.select("text"), CountTrigrams(), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[r.code] = r.n
    restore = send(Restore.of(counts))

    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    drawn = usable.orderBy(F.xxhash64("doc_id", F.lit(9)), "toxic").limit(sample)
    # At most `sample` rows of an id and a flag: a proven bound for the broadcast.
    rows = texts.join(F.broadcast(drawn), "doc_id").withColumn("_half", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)))
    coded = rows.select((F.col("toxic") + 2 * F.col("_half")).cast("int").alias("which"), "text")
    counted = cut(in_batches(coded, CountParts(restore), ", ".join([f"{PARTS[0]} string", *(f"{x} long" for x in PARTS[1:])])).groupBy("part").agg(*(F.sum(x).alias(x) for x in PARTS[1:])), "parts")
    n_of = counted.where("part = ''").first()
    n_of = n_of or dict.fromkeys(PARTS[1:], 0)

    def weights_of(halves: tuple[int, ...], least: float) -> Broadcast:
        """Log odds of parts among toxic and clean documents, where the lower end of their interval exceeds `least`.

        Such a part stands in several toxic documents of the sample, so there are fewer than its words.
        """
        clean, toxic = (sum(F.col(f"{x}{h}") for h in halves) + 0.5 for x in ("clean", "toxic"))
        n_clean, n_toxic = (sum(n_of[f"{x}{h}"] for h in halves) for x in ("clean", "toxic"))
        odds = F.log(toxic / (n_toxic + 1) * (n_clean + 1) / clean)
        sure = odds - 1.64 * F.sqrt(1 / toxic + 1 / clean) > least
        found = counted.where((F.col("part") != "") & sure).select("part", odds.alias("weight")).collect() if n_clean and n_toxic else []
        return send((uuid.uuid4().hex, {r.part: r.weight for r in found}, {r.part[1:4] for r in found}))

    # The curve is fitted on the half that its weights haven't seen; scores use the weights of both halves.
    clean, toxic = n_of["clean0"] + n_of["clean1"], n_of["toxic0"] + n_of["toxic1"]
    half = weights_of((0,), least - 1)
    curve_rows = in_batches(rows.where("_half = 1").select("toxic", "text"), Score(restore, half, None, ("toxic", "a", "b", "c")), "toxic int, a double, b double, c double").toPandas()
    share = float(curve_rows["toxic"].mean()) if len(curve_rows) else 0.0
    if 0 < share < 1 and half.value[1]:
        curve = logistic(curve_rows[["a", "b", "c"]].to_numpy(), curve_rows["toxic"].to_numpy())
    else:
        share = toxic / (clean + toxic) if clean + toxic and not 0 < share < 1 else share
        curve = (float(np.log((share + 1e-13) / (1 - share + 1e-13))), 0.0, 0.0, 0.0)
    return restore, weights_of((0, 1), least), curve


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = in_batches(texts, Score(*model, ("doc_id", "score")), f"doc_id {texts.schema[0].dataType.simpleString()}, score double")
    return scored.select(F.col("doc_id").alias(id_col), held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@dataclass
class Pass:
    """Rows whose score stays below the threshold, with all of their columns."""

    score: Score
    threshold: float
    text: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text=self.text):
            two = pa.RecordBatch.from_arrays([pa.array(range(b.num_rows)), b.column(self.text)], names=["i", "text"])
            (scored,) = self.score(iter([two]))
            yield b.filter(pa.compute.less(scored.column(1), self.threshold))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that aren't rejected, columns unchanged."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    return in_batches(docs, Pass(Score(*model, ("i", "score")), threshold, docs.columns.index(text_col)), docs.schema)
