"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

The examples are a bounded sample of the labelled rows, ``MAX_EXAMPLES`` by a hash of the id. Terms
are the words and word prefixes in at least ``LEAST`` distinct toxic texts of the sample whose presence
goes with the label beyond the largest chi-square that chance gives among so many (twice the logarithm
of their number), with an odds ratio above 1. All of these counts are of distinct texts, and all such
terms are kept: the sample alone bounds them. Document frequencies of the terms are counted over all documents.

The index numbers the examples in blocks and keeps, for every term, postings by block and the
largest weight in each block. A search adds these maxima to an upper bound per block, visits blocks
from the highest bound on, and ends when no bound reaches the k-th best cosine, so it is exact.
Neighbours vote with the cubes of their cosines, beside a prior; votes become probabilities by a logistic curve fitted to votes
of the examples among each other. The neighbours are the evidence.

Defined results: a text without terms (null and empty ones too) scores the smoothed rate of the
label among distinct texts of examples without terms, and has no neighbours; ties in cosine go to the smaller id; ids
labelled more than once count as toxic if one label says so; null ids are never examples; without
labelled rows every score is 0; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import frugal, materialize, ship_package

#: Bound of the fitted model, labelled rows, and examples per block of the index.
MAX_EXAMPLES, BLOCK = 20_000, 64
#: Tokens that a task remembers, and bytes of text whose tokens it looks for together.
CACHED, CHUNK_BYTES = 300_000, 1 << 20
WORD = re.compile(r"[^\W\d_]+")
#: ASCII letters and bytes of other characters as they are, all else as blanks.
BLANK = 0x20
LETTERS = np.array([i if i > 127 or chr(i).isalpha() else BLANK for i in range(256)], dtype=np.uint8)
#: Lengths of the prefixes that are terms besides the word, for words that are inflected.
PREFIXES = range(4, 10)
#: Distinct toxic texts that must have a term, however many there are, and the prior's weight among the votes.
LEAST, PRIOR = 3, 1.0


def terms_of(word: str) -> list[str]:
    """Terms of a lower-case word: itself and its prefixes."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def head_hash(head: Sequence[np.ndarray]) -> np.ndarray:
    """16 bits of the first four bytes of words, blanks behind short ones."""
    a, b, c, d = (x.astype(np.uint32) for x in head)
    return (((a << 24) | (b << 16) | (c << 8) | d) * np.uint32(0x9E3779B1)) >> np.uint32(16)


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


class Terms(dict):
    """Numbers of the chosen terms in a token, remembered; a token is a run of ASCII letters and of
    bytes of other characters, in lower case."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms
        #: First letters of terms, and their hashes: an ASCII token whose own are not lit has no term.
        self.lit = np.zeros(1 << 16, dtype=bool)
        self.heads = {t.rstrip("*")[: PREFIXES[0]] for t in terms}
        self.lit[head_hash(np.frombuffer(b"".join(h.encode().ljust(4)[:4] for h in self.heads), np.uint8).reshape(-1, 4).T)] = True

    def __missing__(self, token: bytes) -> tuple:
        if len(self) > CACHED:
            self.clear()
        words = [w for w in WORD.findall(token.decode("utf-8", "replace")) if w[: PREFIXES[0]] in self.heads]
        found = self[token] = tuple(self.terms[t] for w in words for t in terms_of(w) if t in self.terms) if words else ()
        return found

    def count(self, texts: Iterable[str | None]) -> Iterator[Counter]:
        """The numbers of the terms in each text, with how often they occur."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            held.append((text or "").lower().encode("utf-8", "replace"))
            size += len(held[-1])
            if size >= CHUNK_BYTES:
                yield from self._count(held)
                held, size = [], 0
        yield from self._count(held)

    def _count(self, texts: list[bytes]) -> list[Counter]:
        data = b"\n".join([*texts, b"   "])
        raw = LETTERS[np.frombuffer(data, np.uint8)]
        inside = np.r_[False, raw != BLANK]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        head = [raw[starts]]
        for i in (1, 2, 3):
            head.append(np.where(head[-1] == BLANK, BLANK, raw[starts + i]))
        high = np.r_[0, np.cumsum(raw > 127, dtype=np.int32)]
        likely = self.lit[head_hash(head)] | (high[ends] > high[starts])
        starts, ends = starts[likely], ends[likely]
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
        out = [Counter() for _ in texts]
        for d, a, b in zip(doc.tolist(), starts.tolist(), ends.tolist()):
            if found := self[data[a:b]]:
                out[d].update(found)
        return out


class Index:
    """Block-max inverted index of unit TF-IDF vectors."""

    def __init__(self, idf: np.ndarray, counts: list[dict[int, int]], labels: list[int], ids: list[int]):
        self.idf, self.labels, self.ids = idf, np.array(labels, dtype=np.float64), np.array(ids, dtype=np.int64)
        self.blocks = -(-len(counts) // BLOCK)
        postings: list[list] = [[] for _ in idf]
        for i, c in enumerate(counts):
            for t, w in zip(*self.vector(c)):
                postings[t].append((i, w))
        self.at = np.array([i for p in postings for i, _ in p], dtype=np.int64)
        self.weight = np.array([w for p in postings for _, w in p])
        term = np.repeat(np.arange(len(idf)), [len(p) for p in postings])
        # where the postings of a term in a block begin
        grid = np.arange(len(idf))[:, None] * self.blocks + np.arange(self.blocks + 1)
        self.begin = np.searchsorted(term * self.blocks + self.at // BLOCK, grid)
        self.most = np.zeros((len(idf), self.blocks))
        np.maximum.at(self.most, (term, self.at // BLOCK), self.weight)

    def vector(self, counts: dict[int, int]) -> tuple[list[int], np.ndarray]:
        terms = sorted(counts)
        w = (1 + np.log([counts[t] for t in terms])) * self.idf[terms]
        return terms, w / np.linalg.norm(w)

    def nearest(self, counts: dict[int, int], k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the highest positive cosine, ties to the smaller number."""
        terms, weights = self.vector(counts)
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, score = np.zeros(0, np.int64), np.zeros(0)
        slot = np.zeros(self.blocks, dtype=np.int64)
        # a few blocks give a floor, below which the bounds of most others lie; these are visited together
        at_once, done = 16, 0
        while done < len(order):
            some = order[done : done + at_once]
            if len(score) == k:
                some = some[bound[some] * (1 + 1e-9) >= score[-1]]
                if not len(some):
                    break
            done, at_once = done + at_once, 512
            low, high = (self.begin[terms][:, some + d].ravel() for d in (0, 1))
            n = high - low
            at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            slot[some] = np.arange(len(some)) * BLOCK
            place = slot[self.at[at] // BLOCK] + self.at[at] % BLOCK
            part = np.bincount(place, np.repeat(np.repeat(weights, len(some)), n) * self.weight[at], len(some) * BLOCK)
            found = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            keep = (part > 0) & (found != but)
            best, score = np.r_[best, found[keep]], np.r_[score, part[keep]]
            top = np.lexsort((best, -np.round(score, 12)))[:k]
            best, score = best[top], score[top]
        return best, score


def platt(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve from votes to labels, by Newton steps.

    Targets are drawn in from 0 and 1 by one row of each class, so the fit stays finite.
    """
    good, bad = labels.sum(), (1 - labels).sum()
    aim = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    beta = np.array([0.0, np.log((good + 1) / (bad + 1))])
    x = np.stack([votes, np.ones(len(votes))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (aim - p) - 1e-3 * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


class Scorer:
    """What scoring needs: terms, index, calibration."""

    def __init__(self, terms: list[str], idf: np.ndarray, rows: list[tuple], without: tuple[int, int], k: int):
        self.k, self.terms = k, {t: i for i, t in enumerate(terms)}
        rows = sorted(rows)
        self.index = Index(idf, [dict(c) for _, _, c in rows], [y for _, y, _ in rows], [d for d, _, _ in rows])
        clean, toxic = without
        self.labelled = clean + toxic + len(rows) > 0
        self.rate = (toxic + 0.5) / (clean + toxic + 1) if clean + toxic else 0.5
        if clean + toxic == 0 and rows:
            self.rate = 0.0
        votes = np.array([self.vote(dict(c), i)[0] for i, (_, _, c) in enumerate(rows)])
        self.curve = platt(votes, self.index.labels) if len(rows) else (0.0, 0.0)

    def vote(self, counts: dict[int, int], but: int = -1) -> tuple[float, np.ndarray]:
        best, score = self.index.nearest(counts, self.k, but)
        if not len(best):
            return self.rate, best
        weight = score**3
        return float((weight @ self.index.labels[best] + PRIOR * self.rate) / (weight.sum() + PRIOR)), best

    def score(self, counts: dict[int, int]) -> tuple[float, list[int]]:
        if not self.labelled:
            return 0.0, []
        if not counts:
            return self.rate, []
        vote, best = self.vote(counts)
        return 1 / (1 + float(np.exp(-(self.curve[0] * vote + self.curve[1])))), self.index.ids[best].tolist()


def fit(documents: DataFrame, labels: DataFrame, k: int = 15, key: str = "doc_id", label: str = "toxic") -> Scorer:
    """Fit on the labelled rows that are not held out."""
    spark = documents.sparkSession
    ship_package(spark)
    known = labels.select(F.col(key).alias("doc"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("doc").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc")))
    chosen = known.groupBy("doc").agg(F.max("y").alias("y")).orderBy(F.xxhash64(F.lit(8), "doc"), "doc").limit(MAX_EXAMPLES)
    texts = documents.select(F.col(key).alias("doc"), F.col("text").cast("string").alias("text"))
    # at most MAX_EXAMPLES rows of two numbers
    sample = materialize(texts.join(F.broadcast(chosen), "doc"), "toxicity-examples")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            rows = [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)]
            return pa.RecordBatch.from_arrays(rows, ["term", "clean", "toxic"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y].update({t for w in set(WORD.findall((text or "").lower())) for t in terms_of(w)})
                if len(counts[0]) + len(counts[1]) > CACHED:
                    yield out()
                    counts = (Counter(), Counter())
        yield out()

    # copies of a text are one witness, in the terms' counts and in the totals
    distinct = materialize(sample.select("text", "y").distinct(), "toxicity-texts")
    witnesses = {r.y: r["count"] for r in distinct.groupBy("y").count().collect()}
    clean, toxic = witnesses.get(0, 0), witnesses.get(1, 0)
    per_term = distinct.mapInArrow(frugal(words), "term string, clean long, toxic long")
    per_term = materialize(per_term.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity-terms")
    n = clean + toxic
    # of one label alone nothing can be learnt
    both = F.lit(clean > 0 and toxic > 0)
    clean, toxic = max(clean, 1), max(toxic, 1)
    tested = max(per_term.count(), 2)
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    chi = F.lit(float(n)) * F.pow(a * (clean - b) - b * (toxic - a), 2) / ((a + b) * (n - a - b) * float(toxic) * float(clean))
    strong = (
        per_term.where(both & (a + b < n) & (a >= LEAST))
        .withColumn("chi", chi)
        .where((F.col("chi") >= 2 * float(np.log(tested))) & (a * (clean - b) > b * (toxic - a)))
    )
    terms = sorted(r.term for r in strong.collect())
    numbers = {t: i for i, t in enumerate(terms)}

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen, total = Terms(numbers), Counter(), 0
        for batch in batches:
            for counts in find.count(t.as_py() for t in batch.column(0)):
                seen.update(counts.keys())
                total += 1
        seen[-1] = total
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    counted = texts.select("text").mapInArrow(frugal(frequencies), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r.term: r.n for r in counted.collect()}
    idf = np.array([np.log((1 + df.get(-1, 0)) / (1 + df.get(i, 0))) + 1 for i in range(len(terms))])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Terms(numbers)
        for batch in batches:
            counts = list(find.count(t.as_py() for t in batch.column(2)))
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array([list(f(c)) for c in counts], pa.list_(pa.int32())) for f in (Counter.keys, Counter.values)]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "y", "terms", "counts"])

    kind = sample.schema["doc"].dataType.simpleString()
    vecs = sample.select("doc", "y", "text").mapInArrow(frugal(vectors), f"doc {kind}, y int, terms array<int>, counts array<int>")
    rows = [(r.doc, r.y, tuple(zip(r.terms, r.counts))) for r in vecs.where(F.size("terms") > 0).collect()]
    bare = distinct.select(F.lit(None).cast(kind).alias("doc"), "y", "text").mapInArrow(frugal(vectors), f"doc {kind}, y int, terms array<int>, counts array<int>")
    bare = {r.y: r["count"] for r in bare.where(F.size("terms") == 0).groupBy("y").count().collect()}
    without = [bare.get(y, 0) for y in (0, 1)]
    return Scorer(terms, idf, rows, tuple(without), k)


def score(documents: DataFrame, scorer: Scorer, key: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """(key, held_out, score, predicted, neighbours) for every document."""
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(scorer)  # bounded by the texts of MAX_EXAMPLES rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        find = Terms(model.terms)
        kept: dict[tuple, tuple] = {}
        for batch in batches:
            scores, evidence = [], []
            for counts in find.count(t.as_py() for t in batch.column(2)):
                sign = tuple(sorted(counts.items()))
                if sign not in kept:
                    if len(kept) > 20_000:
                        kept.clear()
                    kept[sign] = model.score(counts)
                scores.append(kept[sign][0])
                evidence.append(kept[sign][1])
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(evidence, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [key, "held_out", "score", "predicted", "neighbours"])

    chosen = documents.select(key, held_out(F.col(key)).alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = chosen.schema[key].dataType.simpleString()
    return chosen.mapInArrow(frugal(run), f"`{key}` {kind}, held_out boolean, score double, predicted int, neighbours array<long>")
