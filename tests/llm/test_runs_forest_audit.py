"""Periodic runs, the LSH forest and the source audit against brute force, on awkward rows and hot groups."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from riskframe.llm import lsh_forest, periodic_runs, queries, source_audit
from tests.llm.test_llm import ROWS, empty, odd, rows  # noqa: F401

random.seed(11)


# ---------------------------------------------------------------- periodic runs
def brute_runs(words, exponent, least):
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= exponent * q and not any(a <= i and j + q <= b and q % p == 0 for a, b, p in found):
                found.append((i, j + q, q))
            i = max(i + 1, j)
    return sorted((a, b - a, q) for a, b, q in found if b - a >= least)


def repetitive(n):
    words = [random.choice("abcde"[: random.choice([1, 2, 3, 5])]).encode() for _ in range(n)]
    if n and random.random() < 0.6:
        a = random.randrange(n)
        p = random.randint(1, max(1, (n - a) // 3))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("step", [1, 5, 1 << 16])
def test_runs_against_brute_force(monkeypatch, step):
    monkeypatch.setattr(periodic_runs, "STEP", step)
    for _ in range(120):
        documents = [repetitive(random.choice([0, 1, 3, 10, 40, 90])) for _ in range(random.randint(1, 6))]
        for exponent in (2, 4):
            got = [list(zip(*(x.tolist() for x in r))) for r in periodic_runs.runs_of(documents, exponent, 6)]
            assert got == [brute_runs(d, exponent, 6) for d in documents]


def test_long_repetitions():
    one, two = [b"a"] * 50_000, [b"a", b"b", b"b"] * 30_000
    got = periodic_runs.runs_of([one, two])
    assert [[x.tolist() for x in r] for r in got] == [[[0], [50_000], [1]], [[0], [90_000], [3]]]


def test_equal_names_alone_make_no_run(monkeypatch):
    # all suffixes have the same name: the words decide
    monkeypatch.setattr(periodic_runs, "mix64", lambda x: np.zeros(len(x), np.uint64))
    words = [str(i).encode() for i in range(100)] + [b"x", b"y"] * 5
    assert [x.tolist() for x in periodic_runs.runs_of([words])[0]] == [[100], [10], [2]]


def brute_row(i, words):
    runs = brute_runs(words, 4, 6)
    gone = {p for s, n, q in runs for p in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    return (
        i, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for p, w in enumerate(words) if p not in gone)).hexdigest(),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_run_query(spark, odd, empty):  # noqa: F811
    short = odd.where("doc_id is null or doc_id not in (6, 7)")
    extra = [(i, " ".join(f"w{random.randint(0, 60)}" for _ in range(random.randint(1, 120))), "s") for i in range(20, 140)]
    extra += [(200, "go go go go go go stop " * 9, "s"), (200, "go go go go go go stop " * 9, "s")]
    data = [(i, t) for i, t, _ in [*ROWS, *extra] if i not in (6, 7)]
    df = short.select("doc_id", "text", "source", "block").unionByName(spark.createDataFrame([(*r, 1) for r in extra], "doc_id long, text string, source string, block int"))
    want, looped = collections.Counter(), collections.Counter()
    for i, t in data:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        want[brute_row(i, words)] += 1
        n, h = len(words), zlib.crc32(str(i).encode())
        if n and i is not None and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        looped[brute_row(i, words)] += 1
    assert want != looped
    assert collections.Counter(tuple(r[c] for c in COLUMNS) for r in rows(periodic_runs.find_runs(df))) == want
    assert collections.Counter(tuple(r[c] for c in COLUMNS) for r in rows(periodic_runs.find_runs(queries.looped(df)))) == looped
    whole = [r for r in rows(periodic_runs.find_runs(df, text=True)) if r["doc_id"] == 200]
    assert len(whole) == 2 and whole[0]["collapsed"] == "go stop" and whole[0]["runs"].splitlines()[:2] == ["0,6,1", "0,63,7"]
    assert periodic_runs.find_runs(empty).count() == 0 and periodic_runs.find_runs(queries.looped(empty)).count() == 0


# ---------------------------------------------------------------- near duplicates
def brute_groups(data, part=80, whole=100):
    sets = [lsh_forest.shingle_set(t, 2) for _, t in data]
    label = list(range(len(data)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    by_shingle = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            by_shingle[g].append(k)
    for k, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in by_shingle[g] if j < k)
        for j, both in shared.items():
            if whole * both >= part * (len(s) + len(sets[j]) - both):
                label[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return collections.Counter(
        (i, len(s), i if not s else least.get(find(k)), i == (i if not s else least.get(find(k)))) for k, ((i, _), s) in enumerate(zip(data, sets))
    )


def forest(df, **options):
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows(lsh_forest.near_duplicates(df, **options)))


def changed(words, n):
    words = list(words)
    for place in random.sample(range(len(words)), n):
        words[place] = f"z{random.randint(0, 10**9)}"
    return words


def test_forest_on_awkward_rows(odd, empty):  # noqa: F811
    assert forest(odd) == brute_groups([(i, t) for i, t, _ in ROWS])
    assert lsh_forest.near_duplicates(empty).count() == 0


def test_forest_loses_no_link_in_hot_groups(spark):
    # small blocks: the groups are cut, crowded and come back as open regions
    small = lsh_forest.shape(block=8, side=16, partition_rows=500, cell_pairs=50)
    data = [(i, " ".join(f"w{random.randint(0, 300)}" for _ in range(random.randint(1, 60)))) for i in range(150)]
    base = [f"b{i}" for i in range(60)]
    # copies of one text that are near it, but mostly not near each other
    data += [(1000 + i, " ".join(changed(base, 3))) for i in range(80)] + [(2000, " ".join(base))]
    # a chain of texts, each near the next, and a group at the border of the similarity
    chain = [f"c{i}" for i in range(50)]
    for i in range(60):
        chain = changed(chain, 1)
        data.append((3000 + i, " ".join(chain)))
    edge = [f"e{i}" for i in range(46)]
    data += [(4000 + i, " ".join(changed(edge, random.choice([2, 3])))) for i in range(60)]
    # exact copies, and one word more than nothing
    data += [(5000 + i, " ".join(base[:30])) for i in range(100)] + [(6000, "alone"), (6001, "Alone"), (6002, "")]
    random.shuffle(data)
    assert forest(spark.createDataFrame(data, "doc_id long, text string"), shape=small) == brute_groups(data)


def test_forest_shape():
    s = lsh_forest.shape((80, 100), 4)
    assert (1 - 0.8**4) ** s.trees <= lsh_forest.MISS < (1 - 0.8**4) ** (s.trees - 1)
    assert s.in_sketch < 0.8 * lsh_forest.SKETCH and s.in_signature < 0.8 * s.values
    with pytest.raises(ValueError):
        lsh_forest.shape((100, 100))


def test_spanning_forest_is_the_heaviest():
    for _ in range(30):
        n, m = 30, random.randint(0, 120)
        u, v, w = (np.array([random.randrange(k) for _ in range(m)], np.int64) for k in (n, n, 9))
        u, v, w = u[u != v], v[u != v], w[u != v]
        label, total, edges = list(range(n)), 0, 0
        for k in np.argsort(-w, kind="stable"):
            a, b = label[u[k]], label[v[k]]
            if a != b:
                label = [a if x == b else x for x in label]
                total, edges = total + w[k], edges + 1
        picked = lsh_forest.spanning(u, v, w, n)
        assert (w[picked].sum(), len(picked)) == (total, edges)


# ---------------------------------------------------------------- source audit
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_audit(data, min_docs=3, scale=10**9, alpha=1, top=200):
    data = [tuple(x or "" for x in r) for r in data]
    docs, count, by_lang = collections.Counter(), collections.Counter(), collections.Counter()
    for text, lang, source in data:
        terms = TERM.findall(fold(text))
        docs.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
        by_lang.update((lang, t) for t in terms)
    groups = {(lang, source) for _, lang, source in data}
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for g, t in docs if g == lang and docs[g, t] >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)
        p = {}
        for s in [*sources, None]:
            of = {t: by_lang[lang, t] if s is None else count[lang, s, t] for t in kept}
            below = sum(of.values()) + alpha * len(kept)
            p[s] = {t: 1 + scale * (c + alpha) // below for t, c in of.items()}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - p[None][t]) ** 2 // p[None][t]) for t in kept if count[lang, s, t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:most], 1)]
    return sorted(out)


def audit(df, **options):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows(source_audit.divergence(df, **options)))


def test_terms_of_a_chunk():
    letters = ["a", "B", "z", "é", "你", " ", "1", "_", "\x00", "@", "[", "\x7f", "abcdefgh", "ÀÉ"]
    for _ in range(60):
        texts = ["".join(random.choice(letters) for _ in range(random.choice([0, 3, 40, 400]))) for _ in range(random.randint(1, 8))]
        groups = np.sort(np.array([random.randrange(3) for _ in texts]))
        want = collections.defaultdict(lambda: [0, 0])
        for text, group in zip(texts, groups):
            for term, n in collections.Counter(TERM.findall(fold(text))).items():
                want[term, int(group)][0] += n
                want[term, int(group)][1] += 1
        got = {}
        for terms, group, n, docs in source_audit.count_terms([t.encode() for t in texts], groups):
            for row in zip(terms, group.tolist(), n.tolist(), docs.tolist()):
                assert got.setdefault((row[0].decode(), row[1]), list(row[2:])) == list(row[2:])
        assert got == dict(want)


@pytest.mark.parametrize("small", [{}, {"task_counts": 20, "cells": 8, "chunk": 100}])
def test_audit_against_brute_force(spark, small):
    names = ["ab", "Abc", "ABCDEFGH", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "é" * 40, "x" * 300, "你好", "the", "of"]
    data = []
    for i in range(150):
        words = random.choices(names, [1, 1, 1, 1, 1, 1, 1, 1, 1, 9, 5], k=random.randint(0, 30)) + [f"rare{i % 70}"] * (i % 3)
        # a source of more than a third of all rows
        data.append((random.choice(" ,.1-").join(words), random.choice(["en", "en", "de", None]), "hot" if i % 2 else random.choice(["s1", "s2", None, ""])))
    data += [(None, "fr", "s1"), ("", "fr", "s2"), ("only one", "it", "s1"), ("x" * 100_000, "en", "long"), data[0], data[0]]
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in data], "text string, lang string, source string, n int, term string, total int")
    assert audit(df, top=7, **small) == brute_audit(data, top=7)
    assert audit(df, scale=10**6, alpha=2, min_docs=1, **small) == brute_audit(data, scale=10**6, alpha=2, min_docs=1)


def test_audit_of_nothing(spark, empty):  # noqa: F811
    from pyspark.sql import functions as F

    assert source_audit.divergence(empty.withColumn("lang", F.lit("en"))).count() == 0
    bare = spark.createDataFrame([(None, "en", "a"), (" 1 ", "en", "b")], "text string, lang string, source string")
    assert audit(bare) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
