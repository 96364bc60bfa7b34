"""Personal data: fixed patterns, and bootstrapped extraction from the contexts they stand in.

Base spans of four kinds come from fixed patterns. They are the seeds. A lexical pattern is the pair
of words before a seed; a pair becomes a pattern once ``support`` distinct seeds follow it. Patterns
and the identifier-like strings that follow them (a word with a digit or an at sign) form a graph,
which Spark scores in rounds:

    pattern  = sum of the confidences of the strings after it / all places where its words occur
    string   = 1 - product of (1 - confidence) over its patterns; seeds stay at 1

so a pair of everyday words, mostly followed by ordinary words, scores near 0 however many seeds it
has. Strings of confidence at least ``trust`` after patterns of confidence at least ``trust`` are new
spans, of kind ``id``. How often a pattern's words occur anywhere is counted over all texts, behind
a filter of bounded size; an exact join then drops what passed the filter by chance.

Defined results: positions are code points, ends exclusive; a null or empty text has no spans;
kinds are matched independently, so spans of different kinds may overlap, but new spans overlap no
base span; repeated rows each return; an empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import frugal, materialize, ship_package

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive digits start at a run's first digit, which finds the
# same matches without trying every digit of a long run.
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LIKE = re.compile(r"[0-9@]")
BLANK = re.compile(r"[\x20\t-\r]")
EDGE = " \t\n\r\v\f.,;:!?'\"()[]{}<>*#$%&|=~^`-_/\\"
#: Characters looked at before a span for its two words.
REACH = 120
#: Where a span may start inside a word: behind marks, or where a base pattern can.
INSIDE = re.compile(rf"(?<=[{re.escape(EDGE)}])[^{re.escape(EDGE)}]|(?<![0-9])[0-9]|\+|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]")
#: Bits of the filter of pattern words; what passes by chance is dropped by the join.
FILTER_BITS = 1 << 20
#: Rows of documents with new spans up to which they are broadcast; a row takes about 100 bytes.
BROADCAST_ROWS = 50_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        # the local part reaches back to the last match or to a character of another class
        low = at
        while low > free and (found := LOCAL.search(text, max(free, low - 256), low)):
            low = found.start()
            if low > max(free, at - 256):
                break
        if low < at and (domain := AT.match(text, at)):
            out.append(("email", low, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(map(m[0].count, "0123456789")) <= 15]
    return out


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def plain(word: str) -> str:
    """A word as patterns know it: lower case, without marks at its ends, digits alike."""
    return re.sub("[0-9]", "0", word.lower().strip(EDGE))


def context(text: str, start: int) -> str:
    """The two words before ``start``; ``^`` stands for a missing one."""
    words = [plain(w) for w in text[max(0, start - REACH) : start].split()[-2:]]
    return " ".join(["^", "^", *words][-2:])


def heads(word: str) -> set[str]:
    """What stands before the places inside a word where a span may start, as ``context`` sees it."""
    return {plain(word[: m.start()]) for m in INSIDE.finditer(word, 0, REACH + 1) if m.start()}


def occurrences(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str, bool]]:
    """(context, start, end, string, seed) of the seeds and of identifier-like words elsewhere."""
    out = [(context(text, s), s, e, text[s:e], True) for _, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    behind = 0
    for m in LIKE.finditer(text):
        if m.start() < behind:
            continue
        start = m.start()
        while start > behind and not BLANK.match(text, start - 1):
            start -= 1
        after = BLANK.search(text, m.end())
        behind = end = after.start() if after else len(text)
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        if end - start >= 4 and not any(s < end and start < e for s, e in taken):
            out.append((context(text, start), start, end, text[start:end], False))
    return out


def scan(documents: DataFrame, key: str) -> DataFrame:
    """(key, row, counts of the kinds, base, seen): base spans and occurrences of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("context", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("seed", pa.bool_())]
        kind = pa.list_(pa.struct(fields))
        for batch in batches:
            counts, joined, seen = [], [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                base = base_spans(text) if LIKE.search(text) else []
                tally = Counter(k for k, _, _ in base)
                counts.append([tally[k] for k in KINDS])
                joined.append(join_spans(base))
                seen.append([dict(zip((f for f, _ in fields), o)) for o in occurrences(text, base)] if LIKE.search(text) else [])
            columns = [batch.column(0), batch.column(1)]
            columns += [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            columns += [pa.array(joined, pa.string()), pa.array(seen, kind)]
            yield pa.RecordBatch.from_arrays(columns, [key, "row", *(f"n_{k}" for k in KINDS), "base", "seen"])

    chosen = documents.select(key, F.xxhash64(key, "text").alias("row"), F.col("text").cast("string").alias("text"))
    schema = f"`{key}` {chosen.schema[key].dataType.simpleString()}, row long, " + ", ".join(f"n_{k} long" for k in KINDS)
    return chosen.mapInArrow(frugal(run), schema + ", base string, seen array<struct<context: string, start: long, end: long, name: string, seed: boolean>>")


def count_contexts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(context, total): how often the words of each wanted context occur in all texts, also where the
    second is the head of a longer word, as in ``<a@b.c>`` or ``mailto:a@b.c``."""
    bit = lambda c: F.pmod(F.crc32(c), F.lit(FILTER_BITS))
    both = wanted.select(F.explode(F.array("context", F.concat(F.lit("| "), F.substring_index("context", " ", -1)))).alias("c"))
    words = both.select(bit(F.col("c")).alias("b")).groupBy((F.col("b") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 64).cast("int"))).alias("bits")
    )
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for r in words.collect():  # at most FILTER_BITS / 64 rows
        table[r.w] = r.bits
    flags = documents.sparkSession.sparkContext.broadcast(table.view(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lit = np.unpackbits(flags.value, bitorder="little").tobytes()
        mask = FILTER_BITS - 1
        known: dict[str, tuple[str, int, list[str]]] = {}
        counts: Counter = Counter()
        start = lit[zlib.crc32(b"^ ^") & mask]

        def look(word: str) -> tuple[str, int, list[str]]:
            if word not in known:
                if len(known) > 200_000:
                    known.clear()
                p = plain(word)
                on = [h for h in {p} | heads(word) if lit[zlib.crc32(f"| {h}".encode()) & mask]]
                known[word] = p, p in on, [h for h in on if h != p]
            return known[word]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["context", "n"])

        for batch in batches:
            for text in batch.column(0):
                before = "^"
                words = (text.as_py() or "").split()
                if start and words:
                    counts["^ ^"] += 1
                for word, on, inner in map(look, words):
                    for head in [*inner, word] if on else inner:
                        pair = f"{before} {head}"
                        if lit[zlib.crc32(pair.encode()) & mask]:
                            counts[pair] += 1
                    before = word
                if len(counts) > 100_000:
                    yield out()
                    counts = Counter()
        yield out()

    found = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(frugal(run), "context string, n long")
    found = found.groupBy("context").agg(F.sum("n").alias("total"))
    return wanted.join(found, "context", "left").select("context", F.coalesce("total", F.lit(0)).alias("total"))


def score_patterns(edges: DataFrame, totals: DataFrame, rounds: int) -> DataFrame:
    """(context, name, pattern_conf, name_conf) of the pattern-string graph after some rounds.

    ``edges`` has context, name, n and seed.
    """
    edges = edges.join(totals, "context").withColumn("name_conf", F.col("seed").cast("double"))
    for _ in range(rounds):
        # a word that REACH cuts is not counted, so a total may lag behind its strings
        patterns = edges.groupBy("context").agg(
            (F.sum(F.col("n") * F.col("name_conf")) / F.greatest(F.max("total"), F.sum("n"))).alias("pattern_conf")
        )
        joined = edges.select("context", "name", "n", "seed", "total").join(patterns, "context")
        names = joined.groupBy("name").agg(
            F.max("seed").alias("s"), F.sum(F.log1p(-F.least(F.col("pattern_conf"), F.lit(1 - 1e-9)))).alias("l")
        )
        names = names.select("name", F.when(F.col("s"), 1.0).otherwise(1 - F.exp("l")).alias("name_conf"))
        edges = materialize(joined.join(names, "name"), "pii-graph")
    return edges.select("context", "name", "pattern_conf", "name_conf")


def extract(documents: DataFrame, key: str = "doc_id", support: int = 3, trust: float = 0.6, rounds: int = 3) -> DataFrame:
    """(key, row, n_email, n_ip, n_card, n_phone, base, base_sha256, added, spans) for every document.

    Counts and ``base_sha256`` are of the base spans; ``spans`` has all, ``added`` the new ones.
    """
    ship_package(documents.sparkSession)
    scanned = materialize(scan(documents, key), "pii-scan")
    places = scanned.where(F.size("seen") > 0).select(key, "row", F.explode("seen").alias("o")).select(key, "row", "o.*")
    edges = places.groupBy("context", F.sha2("name", 256).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    edges = materialize(edges, "pii-edges")
    induced = materialize(edges.where("seed").groupBy("context").count().where(F.col("count") >= support).select("context"), "pii-patterns")
    added = None
    if induced.take(1):
        totals = materialize(count_contexts(documents, induced), "pii-totals")
        scored = score_patterns(edges, totals, rounds)
        good = scored.where((F.col("pattern_conf") >= trust) & (F.col("name_conf") >= trust)).select("context", F.col("name").alias("known"))
        new = places.where(~F.col("seed")).join(good, (places["context"] == good["context"]) & (F.sha2(places["name"], 256) == good["known"]))
        added = new.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("new"))
    if added is None:
        out = scanned.withColumn("added", F.lit(""))
    else:
        added = materialize(added, "pii-added")
        small = added.count() <= BROADCAST_ROWS
        text = F.array_join(F.transform("new", lambda s: F.concat(F.lit("id:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
        out = scanned.join(F.broadcast(added) if small else added, "row", "left").withColumn("added", F.coalesce(text, F.lit("")))
    return out.select(
        key, "row", *(f"n_{k}" for k in KINDS), "base", F.sha2(F.col("base"), 256).alias("base_sha256"), "added",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.col("added") != "", F.col("added"))).alias("spans"),
    )


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """All rows and columns of ``documents`` with personal data in ``text`` replaced by its kind."""
    found = extract(documents, key).where("added <> ''").select(F.col("row").alias("__row"), F.col("added").alias("__added")).distinct()
    found = materialize(found, "pii-redact")
    small = found.count() <= BROADCAST_ROWS
    marked = documents.withColumn("__row", F.xxhash64(key, "text")).join(F.broadcast(found) if small else found, "__row", "left").drop("__row")
    at = marked.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, more in zip(batch.column(at), batch.column(batch.num_columns - 1).to_pylist()):
                text = text.as_py()
                spans = base_spans(text) if text and LIKE.search(text) else []
                spans += [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in (more or "").split(",") if x)]
                texts.append(redact_text(text, spans) if spans else text)
            columns = [pa.array(texts, batch.schema.field(i).type) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))

    return marked.mapInArrow(frugal(run), documents.schema)
