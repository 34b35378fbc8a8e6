"""Compression bands: zstandard ratios of whole documents and fixed chunks, with limits by length.

Very repetitive text compresses too well, random or encoded text hardly at all. What is normal
depends on length (a frame has fixed costs, long texts have more to refer back to), so each length
class has its own lower and upper limit. Repetition in a small part of a long text is diluted in
the whole ratio; fixed-size chunks show it.

Every length has limits. A text of one chunk is judged by its whole ratio; a longer one also by the share
of its chunks out of band, and by two in a row, which no length dilutes.

Cases: null and empty text give zero measures; the base rule then fails on n_words. One very long text is read as one value and its chunks are
compressed one by one. Repeated rows give repeated rows. Only the id and text columns are read, so
other columns, whatever their names, play no part. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, record_batch, slices


@dataclass(frozen=True)
class Bands:
    """(least bytes, lowest ratio, highest ratio) by length; the last row whose length fits holds."""

    whole: tuple[tuple[int, float, float], ...] = ((1, 0.15, 1.2), (32, 0.60, 1.35), (64, 0.90, 2.2), (128, 1.10, 2.6), (300, 1.28, 2.8), (1000, 1.40, 3.2), (3000, 1.45, 3.7), (10000, 1.50, 4.2), (50000, 1.50, 5.0))
    chunk_bytes: int = 2048
    chunk: tuple[tuple[int, float, float], ...] = ((512, 1.28, 3.0), (1024, 1.32, 3.4), (2048, 1.40, 3.8))
    #: Share of a text's chunks that may lie outside of the chunk limits.
    chunk_share: float = 0.2
    #: Chunks in a row outside of the limits that reject a text of any length.
    chunk_run: int = 2
    level: int = 3

    def limits(self, table: tuple[tuple[int, float, float], ...], n: int) -> tuple[float, float]:
        return next(((lo, hi) for least, lo, hi in reversed(table) if n >= least), (0.0, float("inf")))


SYMBOLS = b"#*$%&|<>"
WHITE = bytes([0x20, *range(0x09, 0x0E)])
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, n_chunks long, n_chunks_out long, verdict string, kept boolean"


def repeat_words(words: list[bytes], n: int = 5) -> int:
    """Words that lie in an n-word window found at least twice."""
    if len(words) <= n:
        return 0
    windows = list(zip(*(words[i:] for i in range(n)), strict=False))
    if len(once := set(windows)) == len(windows):
        return 0
    seen: set = set()
    twice: set = set()
    for w in windows if len(once) < len(windows) else ():
        (twice if w in seen else seen).add(w)
    total = end = 0
    for i, w in enumerate(windows):
        if w in twice:
            total += i + n - max(i, end)
            end = i + n
    return total


@dataclass
class Measure:
    bands: Bands = field(default_factory=Bands)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=self.bands.level).compress
        for b in slices(batches):
            rows = [self.row(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()]
            names = [x.split()[0] for x in COLUMNS.split(", ")]
            types = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}[x.split()[1]] for x in COLUMNS.split(", ")]
            yield record_batch([b.schema.names[0], *names], [b.schema.types[0], *types], [b.column(0), *(zip(*rows, strict=True))])

    def row(self, t: bytes) -> tuple:
        words = t.split()
        points = len(t) - sum(t.count(x) for x in WHITE)
        if not t.isascii():
            points -= len(t) - len(t.decode())
        lines = [x for x in t.split(b"\n") if x.strip()]
        repeats = repeat_words(words)
        failed = len(words) < 10 or 100 * repeats > 20 * len(words)
        ratio, n, out, verdict = self.verdict(t)
        return len(words), points, sum(t.count(x) for x in SYMBOLS), len(lines) - len(set(lines)), repeats, failed, ratio, n, out, verdict, not failed and verdict == "kept"

    def verdict(self, t: bytes) -> tuple[float | None, int, int, str]:
        b = self.bands
        if not t:
            return None, 0, 0, "kept"
        ratio = len(t) / len(self.pack(t))
        lo, hi = b.limits(b.whole, len(t))
        # A rest below the smallest limit's length belongs to the chunk before it.
        n = max(1, (len(t) + b.chunk_bytes - b.chunk[0][0]) // b.chunk_bytes)
        out = run = longest = 0
        for i in range(n if n > 1 else 0):
            part = t[i * b.chunk_bytes : (i + 1) * b.chunk_bytes if i < n - 1 else None]
            low, high = b.limits(b.chunk, len(part))
            run = 0 if low <= len(part) / len(self.pack(part)) <= high else run + 1
            out, longest = out + (run > 0), max(longest, run)
        verdict = "incompressible" if ratio < lo else "repetitive" if ratio > hi else "chunks" if out > b.chunk_share * n or longest >= b.chunk_run else "kept"
        return ratio, n, out, verdict


def compression_bands(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, word and line measures, ratio, chunk counts and verdict. No shuffle."""
    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = narrow.schema[0].dataType.simpleString()
    return in_batches(narrow, Measure(bands), f"`{id_col}` {kind}, {COLUMNS}")
