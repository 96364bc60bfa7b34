"""Periodic runs of words by online dyadic square catching.

A square of period p is a stretch of 2p words whose halves are equal. Words are appended to a
``Catcher``. Whenever a block of 2^k words, at a multiple of 2^k, is complete, it is kept as a
catcher of squares with 2^(k+1) <= p < 2^(k+2): such a half contains a block, which stands again p
words later. So the suffix of 2^k words that ends at an appended word is compared with exactly two
blocks per level, those that begin 2^(k+1) to 2^(k+2) words before it. Blocks of the same distance
that match in a row are one catch, which grows while words are appended. Distance 1 is a level of
its own.

Catches become runs when the sequence is closed. Within a block's length of either end the first and
last word that still repeat at the distance are looked up; a catch inside a run of a smaller period
that divides its own is no square of its own; what remains are maximal runs by their smallest
period. Suffixes are compared by 64-bit names built by doubling; the words of every catch are then
compared themselves, so names only ever propose.

A run has at least ``exponent`` periods and ``least`` words. Periods beyond a document's length over
``exponent`` are not looked for, and a catch needs as many blocks as such a run must contain.

Documents are appended one after the other, with a word of its own between them, in steps of
``STEP`` words, so the working memory beyond a document's own words is that of a step.

Defined results: a null or empty text has no words and no run; repeated rows and ids all return; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.words import mix64, stream
from riskframe.session import ship_package

#: Words appended at a time, and bytes of text whose documents share a catcher.
STEP, CHUNK_BYTES = 1 << 16, 1 << 20
#: Odd multipliers that name a pair of neighbouring suffixes, one for each level.
_MULTIPLIERS = stream(31, 48) | np.uint64(1)


class Codes(dict):
    """Numbers the distinct words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``range(start, start + length)``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Catcher:
    """Catches the squares of a growing sequence of word codes with periods up to ``longest``."""

    def __init__(self, exponent: int, longest: int):
        if exponent < 2:
            raise ValueError("a run has at least two periods")
        self.exponent, self.longest = exponent, longest
        self.levels = 0
        while 2 << self.levels <= longest:
            self.levels += 1
        self.parts: list[np.ndarray] = []
        self.n = 0
        #: per level: names of complete blocks, and of the suffixes that later ones are built from
        self.blocks = [np.zeros(0, np.uint64) for _ in range(self.levels)]
        self.tails = [np.zeros(0, np.uint64) for _ in range(self.levels)]
        #: per level, -1 for distance 1: (distance, first block, last block) of the catches
        self.caught: dict[int, list[np.ndarray]] = {k: [] for k in range(-1, self.levels)}

    def append(self, codes: np.ndarray) -> None:
        """Add words and compare the suffixes that end at them."""
        if not len(codes):
            return
        before, last = self.n, self.parts[-1][-1] if self.parts else None
        self.parts.append(codes)
        self.n += len(codes)
        if self.longest >= 1:
            previous = codes[:-1] if last is None else np.r_[last, codes[:-1]]
            at = np.flatnonzero(codes[len(codes) - len(previous) :] == previous) + (before or 1) - 1
            self._catch(-1, np.ones(len(at), np.int64), at)
        names = mix64(codes.view(np.uint64))
        first = before  # where the suffix of names[0] begins
        for k in range(self.levels):
            size = 1 << k
            self.blocks[k] = np.concatenate([self.blocks[k], names[-first % size :: size]])
            row = np.arange(first, first + len(names)) >> k
            for back in (2, 3):
                use = slice(int(np.searchsorted(row, back)), None)
                hit = np.flatnonzero(names[use] == self.blocks[k][row[use] - back])
                if len(hit):
                    hit += use.start
                    block = (row[hit] - back) << k
                    self._catch(k, first + hit - block, block)
            # names of suffixes twice as long, from those that began before the new words as well
            whole = np.concatenate([self.tails[k], names])
            self.tails[k] = whole[-size:].copy()
            if len(whole) <= size:
                break
            names = whole[:-size] * _MULTIPLIERS[k] + whole[size:]
            first = self.n - 2 * size + 1 - len(names)

    def _catch(self, level: int, distance: np.ndarray, block: np.ndarray) -> None:
        """Merge matching blocks into catches: neighbours of the same distance in a row."""
        near = distance <= self.longest
        if not near.any():
            return
        new = np.stack([distance[near], block[near], block[near]], axis=1)
        self.caught[level].append(merge(new, 1 << max(level, 0)))

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All maximal runs as (start, end, period), by start and period."""
        codes = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)
        runs = np.zeros((0, 3), np.int64)
        for level, parts in self.caught.items():
            if not parts:
                continue
            size = 1 << max(level, 0)
            catches = merge(np.concatenate(parts), size)
            period, low, high = catches.T
            need = (self.exponent - 1) * period
            catches = catches[(high - low) // size + 1 >= np.maximum(1, (need + 1) // size - 1)]
            period, low, high = catches.T
            open_ = ~inside(runs, low, high + size + period, period)
            period, low, high = period[open_], low[open_], high[open_] + size
            # the words before the first block and after the last that repeat as well
            back = np.minimum(low, size)
            start = low - repeats(codes, low - 1, period, back, -1)
            ahead = np.minimum(len(codes) - period - high, size)
            end = high + repeats(codes, high, period, ahead, 1) + period
            long = end - start >= self.exponent * period
            start, end, period = start[long], end[long], period[long]
            # the words between them, which so far repeat by name only: stretches that truly repeat
            length = end - start - period
            at, of = spread(start, length), np.repeat(np.arange(len(start)), length)
            same = codes[at] == codes[at + period[of]]
            border = np.r_[True, of[1:] != of[:-1]] if len(of) else np.zeros(0, bool)
            heads = np.flatnonzero(same & (border | ~np.r_[False, same[:-1]]))
            tails = np.flatnonzero(same & np.r_[(border | ~same)[1:], True])
            start, end, period = at[heads], at[tails] + 1 + period[of[heads]], period[of[heads]]
            true = (end - start >= self.exponent * period) & ~inside(runs, start, end, period)
            runs = np.concatenate([runs, np.stack([start, end, period], axis=1)[true]])
            runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        return tuple(runs.T)


def merge(catches: np.ndarray, size: int) -> np.ndarray:
    """Join catches (distance, first, last) of one distance whose blocks follow each other."""
    catches = catches[np.lexsort((catches[:, 1], catches[:, 0]))]
    distance, low, high = catches.T
    new = np.r_[True, (distance[1:] != distance[:-1]) | (low[1:] > high[:-1] + size)]
    begins = np.flatnonzero(new)
    return np.stack([distance[begins], low[begins], high[np.r_[begins[1:], len(catches)] - 1]], axis=1)


def inside(runs: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether a known run of a smaller period that divides ``period`` contains a stretch.

    Two runs that overlap in the sum of their periods are the same, so at most one run of smaller
    periods contains a square, and that reaches farthest among those that begin no later.
    """
    if not len(runs):
        return np.zeros(len(start), bool)
    farthest = np.maximum.accumulate(runs[:, 1])
    holder = np.maximum.accumulate(np.where(runs[:, 1] == farthest, np.arange(len(runs)), 0))
    at = np.searchsorted(runs[:, 0], start, side="right") - 1
    own = holder[np.maximum(at, 0)]
    smaller = (runs[own, 2] < period) & (period % runs[own, 2] == 0) & (end - start >= period + runs[own, 2])
    return (at >= 0) & (runs[own, 1] >= end) & smaller


def repeats(codes: np.ndarray, at: np.ndarray, period: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
    """From each place in direction ``step``, how many words equal those a period later, to a limit."""
    out = np.zeros(len(at), np.int64)
    left = np.flatnonzero(limit > 0)
    width = 8
    while len(left):
        reach = np.minimum(limit[left] - out[left], width)
        offset = spread(np.zeros(len(left), np.int64), reach)
        place = np.repeat(at[left] + step * out[left], reach) + step * offset
        differs = codes[place] != codes[place + np.repeat(period[left], reach)]
        cuts = np.cumsum(reach) - reach
        equal = np.minimum.reduceat(np.where(differs, offset, np.repeat(reach, reach)), cuts)
        out[left] += equal
        left = left[(equal == reach) & (out[left] < limit[left])]
        width *= 4
    return out


def runs_of(documents: list[list[bytes]], exponent: int = 4, least: int = 6) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, length, period) of every run of each document, by start and period."""
    known = Codes()
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    heads = np.cumsum(sizes + 1) - sizes  # each document follows a word of its own
    catcher = Catcher(exponent, int(sizes.max(initial=0)) // exponent)
    held, waiting = [], 0
    for i, words in enumerate(documents):
        for at in range(0, len(words) or 1, STEP):
            part = words[at : at + STEP]
            codes = np.fromiter(map(known.__getitem__, part), np.int64, len(part))
            held.append(codes if at else np.r_[-1 - i, codes])
            waiting += len(held[-1])
            if waiting >= STEP:
                catcher.append(np.concatenate(held))
                held, waiting = [], 0
    if held:
        catcher.append(np.concatenate(held))
    start, end, period = catcher.close()
    long = end - start >= least
    start, end, period = start[long], end[long], period[long]
    cuts = np.searchsorted(start, np.r_[heads, heads[-1] + sizes[-1]] if len(heads) else np.zeros(1, np.int64))
    return [
        (start[a:b] - head, (end - start)[a:b], period[a:b]) for head, a, b in zip(heads.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())
    ]


def collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not len(start):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    keep = np.cumsum(edge[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _row(words: list[bytes], runs: tuple, text: bool) -> tuple:
    start, length, period = runs
    if len(start):
        # the greatest exact quotient: compare products, ties to the smaller start and period
        best = 0
        for i in range(1, len(start)):
            if int(length[i]) * int(period[best]) > int(length[best]) * int(period[i]):
                best = i
        top = (int(start[best]), int(length[best]), int(period[best]), 1000 * int(length[best]) // int(period[best]))
    else:
        top = (None,) * 4
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist()))
    kept = b" ".join(collapse(words, start, length, period))
    digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()
    return (len(start), *top, *digests) + (listed, kept.decode()) * text


def find_runs(documents: DataFrame, exponent: int = 4, least: int = 6, key: str = "doc_id", text: bool = False) -> DataFrame:
    """Per document the number of runs, its run of the greatest exponent, and digests of all runs
    and of the text without repetitions; with ``text`` also these two themselves.

    (key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256[, runs, collapsed])
    """
    ship_package(documents.sparkSession)
    fields = [(n, pa.int64()) for n in ("n_runs", "start", "length", "period", "exponent_milli")]
    fields += [(n, pa.string()) for n in ("runs_sha256", "collapsed_sha256", *("runs", "collapsed") * text)]
    chosen = documents.select(key, F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [(t or "").encode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            # documents of like length share a catcher, which has levels for the longest
            order = sorted(range(len(data)), key=lambda i: len(data[i]))
            out: list[tuple] = [()] * len(data)
            at = 0
            while at < len(order):
                end, size = at, 0
                while end < len(order) and (end == at or size + len(data[order[end]]) < CHUNK_BYTES):
                    size += len(data[order[end]])
                    end += 1
                words = [data[i].split() for i in order[at:end]]
                for i, own, runs in zip(order[at:end], words, runs_of(words, exponent, least)):
                    out[i] = _row(own, runs, text)
                at = end
            columns = [pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)] if out else [pa.array([], t) for _, t in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key, *(n for n, _ in fields)])

    types = ", ".join(f"{n} {'long' if t == pa.int64() else 'string'}" for n, t in fields)
    return chosen.mapInArrow(run, f"`{key}` {chosen.schema[key].dataType.simpleString()}, {types}")
