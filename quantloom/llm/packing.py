"""Sum-of-squares packing of tokenised documents into sequences of fixed capacity.

A document's token ids, with an end id, are one piece; only documents longer than the capacity are cut,
into full pieces and a rest. A piece of length s goes where the sum over gaps g of N(g)^2 becomes
smallest, N(g) being the number of open bins with g free places. Placing into a bin with gap g changes
the sum by 2(N(g-s) - N(g)) + 2 (1 - 2N(g) for an exact fit), opening a bin by 2N(C-s) + 1.

The rule needs the gaps' counts only, at most C of them, so its state is bounded. Pieces are dealt by
hash to groups of about `group_rows` pieces, packed side by side in any number of tasks, longest
first; the bins that stay under-filled in a group are opened, and their pieces dealt to groups of the
same size and packed again. There are `levels` such passes for tables of every size; in the last one each
group closes its bins as they are, which leaves a few under-filled bins a group of that level.

Encoding works by words: this tokenizer splits at white space before anything else, so the ids of a
text are those of its space- or newline-separated words, of which the frequent ones are kept in a
bounded table. Misses go to the library in batches. Special-token strings hold no white space, and are
therefore treated as the library treats them.

Cases: null and empty text is the end id alone. Ties between gaps go to the smaller gap. Rows that
repeat an id are packed each for itself. Only id and text are read. An empty table gives an empty
result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_batches, local_file, record_batch, ship, slices, worker_store
from .token_cache import worker_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, input_ids binary, _order long"


#: A full stop or comma after a letter and before white space is a token of its own for this tokenizer.
#: The mark comes first in the pattern, so that the search skips to the next one.
STOP = re.compile("([.,])(?<=[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][.,])(?=[ \n]|$)")
#: Words that the tokenizer's normaliser leaves alone and its splitter keeps whole.
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: A plain word with a run of marks behind it is these two tokens for the splitter.
MARKED = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!#$%&*+,./:;=?@^_~-]+)")
#: Byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for 256, 257, ...
VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LEVEL = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in VISIBLE) if b != 0x20}
A_TO_Z = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass
class WordCoder:
    """Ids of whole texts through bounded tables of recent words: a full table becomes the older one.

    Texts are split at spaces, line feeds and single stops, which the tokenizer splits at too, and A-Z are
    lower-cased, which it does too. New words of plain letters, and marks behind them, need no normaliser or
    splitter and go to the library's merge model, many at a time. Other words are encoded each for itself.
    """

    path: str
    most: int = 250_000
    #: Words longer than this aren't kept.
    longest: int = 40

    def encode(self, words: list[str]) -> dict[str, bytes]:
        encode = worker_encoder(self.path)
        out: dict[str, bytes] = {}
        plain, joined, rest = [], [], []
        for w in words:
            if PLAIN.fullmatch(w):
                plain.append(w)
                joined.append(w)
            elif m := MARKED.fullmatch(w):
                plain.append(w)
                joined.append(f"{m[1]} {m[2]}")
            else:
                rest.append(w)
        for i in range(0, len(plain), 4000):
            out.update(zip(plain[i : i + 4000], self.merged(joined[i : i + 4000]), strict=True))
        for i in range(0, len(rest), 20_000):
            part = rest[i : i + 20_000]
            out.update(zip(part, (struct.pack(f"<{len(ids)}I", *ids) for ids in encode(part)), strict=True))
        return out

    def merged(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, one or two plain tokens, by the merge model alone; ids that end a token tell them apart."""
        held = worker_store("subwords", f"words {self.path}")
        if "merges" not in held:
            from tokenizers import Tokenizer, pre_tokenizers

            whole = Tokenizer.from_file(local_file(self.path))
            held["merges"] = Tokenizer(whole.model)
            held["merges"].pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            held["ends"] = np.array([(whole.id_to_token(i) or "").endswith(whole.model.end_of_word_suffix) for i in range(whole.get_vocab_size())])
        text = " ".join(parts)
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(BYTE_LEVEL)
        ids = np.array(held["merges"].encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        tokens = np.fromiter((" " in p for p in parts), np.int64, len(parts)) + 1
        at = (4 * (np.flatnonzero(held["ends"][ids])[np.cumsum(tokens) - 1] + 1)).tolist()
        found = ids.tobytes()
        return [found[a:z] for a, z in zip([0, *at], at, strict=False)]

    def words(self, text: str) -> list[str]:
        if "<|" not in text:  # lower case mustn't make special tokens
            text = text.lower() if text.isascii() else text.encode().translate(A_TO_Z).decode()
        text = STOP.sub(r" \1", text)
        return text.replace("\n", " ").split(" ")

    def __call__(self, texts: list[str]) -> list[bytes]:
        held = worker_store("subwords", f"words {self.path}")
        table: dict[str, bytes] = held.setdefault("new", {})
        per_text = [self.words(t) for t in texts]
        here = set().union(*per_text)
        missing = here.difference(table)
        if len(table) + len(missing) > self.most:
            held["old"], held["new"] = table, (table := {})
            missing = here
        old = held.get("old", {})
        new = [w for w in missing if w not in old]
        table.update((w, old[w]) for w in missing.difference(new))
        table.update(self.encode(new))
        out = [b"".join(map(table.__getitem__, ws)) for ws in per_text]
        for w in new:
            if len(w) > self.longest:
                del table[w]
        return out


@dataclass
class Cut:
    path: str
    capacity: int
    end_id: int
    with_ids: bool

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = WordCoder(self.path, most=400_000), np.uint32(self.end_id).astype("<u4").tobytes()
        step = 4 * self.capacity
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        names = [x.split()[0] for x in PIECES.split(", ")]
        for b in slices(batches, max_bytes=4 << 20):
            rows = []
            for doc, order, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), coder([t or "" for t in b.column(1).to_pylist()]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), part if self.with_ids else None, order))
            yield record_batch(names, types, list(zip(*rows, strict=True)))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item in the given order, and the final fill of each bin."""
    n = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, s in enumerate(lengths.tolist()):
        # Change of the sum for a bin of gap g = s .. capacity - 1; an exact fit only takes from N(s).
        change = 2 * (n[: capacity - s] - n[s:capacity]) + 2
        if len(change):
            change[0] = 1 - 2 * n[s]
            change[n[s:capacity] == 0] = np.iinfo(np.int64).max
        opening = 2 * n[capacity - s] + 1 if s < capacity else 0
        g = s + int(np.argmin(change)) if len(change) else capacity
        if len(change) == 0 or change[g - s] > opening:
            b, g = len(fill), capacity
            fill.append(0)
        else:
            b = open_bins[g].pop()
            n[g] -= 1
        where[i], offset[i] = b, fill[b]
        fill[b] += s
        if g > s:
            open_bins[g - s].append(b)
            n[g - s] += 1
    return where, offset, np.array(fill, np.int64)


PLACED = "piece_key long, length long, sequence_id long, offset long, open boolean"
#: A sequence's number is its level, group and bin, side by side in 63 bits.
GROUP_BITS, BIN_BITS = 36, 21


@dataclass
class PackGroup:
    capacity: int
    #: Bins filled less than this stay open for the next round.
    full: float
    level: int

    def function(self):
        return lambda key, rows: self(key, rows)

    def __call__(self, key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "piece_key"], ascending=[False, True], kind="stable")
        where, offset, fill = sum_of_squares(rows["length"].to_numpy(), self.capacity)
        opened = fill[where] < self.full * self.capacity
        return pd.DataFrame({"piece_key": rows["piece_key"].to_numpy(), "length": rows["length"].to_numpy(), "sequence_id": (((self.level << GROUP_BITS) + int(key[0])) << BIN_BITS) + where, "offset": offset, "open": opened})


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False, group_rows: int = 16_384, full: float = 0.97, levels: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and input_ids)."""
    ship(docs.sparkSession, tokenizer)
    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.monotonically_increasing_id())
    pieces = in_batches(narrow, Cut(tokenizer, capacity, end_id, with_ids), PIECES).withColumn("piece_key", F.monotonically_increasing_id()).drop("_order")
    pieces = cut(pieces if with_ids else pieces.drop("input_ids"), "pieces")
    left, n = pieces.select("piece_key", "length"), pieces.count()
    closed = []
    for level in range(levels):
        groups, last = max(1, -(-n // group_rows)), level == levels - 1
        packer = PackGroup(capacity, -1.0 if last else full, level)
        dealt = left.select("piece_key", "length", F.pmod(F.xxhash64("piece_key", F.lit(level)), F.lit(groups)).alias("group"))
        placed = cut(dealt.groupBy("group").applyInPandas(packer.function(), PLACED), f"packed{level}")
        closed.append(placed.where(~F.col("open")).select("piece_key", "sequence_id", "offset"))
        left = placed.where("open").select("piece_key", "length")
        n = 0 if last else left.count()
        if not n:
            break
    at = closed[0]
    for more in closed[1:]:
        at = at.unionByName(more)
    ids = ["input_ids"] if with_ids else []
    return pieces.join(at, "piece_key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *ids)
