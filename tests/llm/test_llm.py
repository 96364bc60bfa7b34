"""The training-data operators against brute force, on awkward rows and on the small tables."""

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import ann, bpe, mixing, pii, queries, simhash, substring_dedup, token_files, topk, toxicity, url_filter
from tests.oracle import compare, connect

random.seed(5)
LONG = " ".join(random.choice(["alpha", "beta", "Gamma", "delta,", "x"]) for _ in range(30_000))
#: Nulls, empty and very long texts, repeated rows and ids, columns whose names may clash.
ROWS = [
    (1, "a b c d e f g h i j k l m n o p", "s1"), (2, "zz a b c d e f g h i j k l m n o", None), (2, "zz a b c d e f g h i j k l m n o", None),
    (3, None, "s1"), (4, "", "s2"), (5, " \n\t ", "s2"), (None, "one two three four", "s3"), (None, None, None), (6, LONG, "s1"), (7, LONG, "s1"),
    (8, "x" * 5000, "s2"), (9, "mail me at some.one@mail.example.org now", "s1"), (10, "É́ 你好 <|endoftext|> don't", "s3"),
]
SCHEMA = "doc_id long, text string, source string, row long, score double, size long, words string, block int, shard int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 0.5, 3, "w", 2, 1) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


def key_of(r):
    return (r["doc_id"] is None, r["doc_id"] or 0)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_agrees_with_sql(spark, sf_dir, name):
    ok, message, _ = compare(spark, connect(sf_dir), queries.QUERIES[name], queries.SQL[name], sf_dir)
    assert ok, message


# ---------------------------------------------------------------- vectors
def vectors(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(size=8).astype(float).tolist(), 1) for i in range(300)]
    data += [(300 + i, data[3][1], 1) for i in range(40)] + [(20, data[20][1], 1)]
    data += [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] * 8, 1), (903, [None] * 8, 1), (904, [1.0] * 3, 1), (None, [1.0] * 8, 1), (905, [], 1)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, block int"), data


@pytest.mark.parametrize("whole", [False, True])
def test_nearest_is_exact(spark, monkeypatch, whole):
    from riskframe.llm import blocks

    monkeypatch.setattr(blocks, "QUERY_ROWS", 7)
    monkeypatch.setattr(blocks, "CANDIDATE_ROWS", 50)
    df, data = vectors(spark)
    good = {i: v for i, v, _ in data if i is not None and v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and (whole or any(v))}
    enc = {i: [int(np.floor(64 * x)) for x in v] if whole else v for i, v in good.items()}
    find = topk.top_k if whole else ann.nearest
    got = collections.defaultdict(list)
    for r in sorted(rows(find(df, df.where("vec_id % 20 = 0"), k=5)), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q in (i for i in good if i % 20 == 0):
        scores = [(-functools.reduce(lambda t, ab: t + ab[0] * ab[1], zip(enc[q], v), 0), i) for i, v in enc.items() if i != q]
        assert got.pop(q) == [(i, -s) for s, i in sorted(scores)[:5]]
    assert not got
    assert find(df.where("vec_id = -1"), df.where("vec_id = -1")).count() == 0


@pytest.mark.parametrize("find", [topk.top_k, ann.nearest])
def test_vectors_of_two_lengths_meet_their_own(spark, find):
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(size=4 if i % 2 else 8).tolist()) for i in range(120)] + [(200, [1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = rows(find(df, df.where("vec_id % 20 < 2 or vec_id = 200"), k=3))
    sizes = {i: len(v) for i, v in data}
    assert all(sizes[r["query_id"]] == sizes[r["vec_id"]] for r in got)
    # the only vector of its length finds none
    assert collections.Counter(r["query_id"] for r in got) == {q: 3 for q in sizes if q % 20 < 2 and q < 200}
    scores = {i: [int(np.floor(64 * x)) for x in v] if find is topk.top_k else v for i, v in data}
    for r in got:
        assert r["score"] == pytest.approx(sum(a * b for a, b in zip(scores[r["query_id"]], scores[r["vec_id"]])))
        better = [i for i in scores if i != r["query_id"] and sizes[i] == sizes[r["query_id"]] and sum(a * b for a, b in zip(scores[r["query_id"]], scores[i])) > r["score"] + 1e-9]
        assert len(better) < r["rank"]


# ---------------------------------------------------------------- tokens
def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 127, 128, 129, 1000):
        for top in (1, 300, 49408, 1 << 32):
            ids = rng.integers(0, top, n).astype(np.uint32)
            ids[rng.random(n) < 0.8] //= max(1, top // 50)
            data = token_files.encode_blocks(ids)
            assert (token_files.decode_blocks(data) == ids).all()
            assert (token_files.decode_blocks(data, n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_encoding_is_the_librarys():
    tok, model = library(), bpe.model_at(queries.tokenizer_path())
    runs, decoder = bpe.Runs(model), bpe.Decoder(model)
    texts = [t or "" for _, t, _ in ROWS] + ["the" * 2000, "ab!" * 900, "\x85　  \x1c", "ΟΔΟΣ İ ½²"]
    texts += ["".join(random.choice("theingAN.,!' é́\n9") for _ in range(random.randint(0, 2500))) for _ in range(60)]
    for text in texts:
        ids = runs.encode(text.encode())
        want = tok.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        decoder.reset()
        assert decoder.feed(ids[:2]) + decoder.feed(ids[2:], last=True) == tok.decode(want, skip_special_tokens=False)


def test_every_letter_is_split_as_the_library_does():
    # the planes that have letters of scripts, alone and inside a word; capitals whose small letters lie elsewhere are among them
    path, tok = queries.tokenizer_path(), library()
    both = bpe.Runs(bpe.model_at(path)), token_files.LibraryRuns(path)
    points = [c for c in [*range(0x3000), *range(0xA000, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x17000), *range(0x18D00, 0x20000), *range(0x20000, 0x110000, 1999)]]
    for at in range(0, len(points), 20_000):
        texts = [form.format(chr(c)) for c in points[at : at + 20_000] for form in ("{}", "a{}b")]
        for text, encoded in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
            for runs in both:
                assert runs.encode(text.encode()).tolist() == encoded.ids, ascii(text)
    for text in ("Əhməd Ɔman Ɛwe", "İSTANBUL ΟΔΟΣ", "x\u1c89y \U00010940"):
        assert all(runs.encode(text.encode()).tolist() == tok.encode(text, add_special_tokens=False).ids for runs in both)


def test_long_words_come_piece_by_piece(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 1000)
    monkeypatch.setattr(bpe, "STEP", 64)
    runs, tok = bpe.Runs(bpe.model_at(queries.tokenizer_path())), library()
    for text in ("intheand" * 2000 + " the " + "é!9" * 900, "the end " * 1000, "<|endoftext|>ab" * 400, ""):
        parts = list(runs.stream(text.encode()))
        assert np.concatenate(parts).tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(parts) > 4 or not text


def test_many_special_tokens_in_one_run():
    tok, runs = library(), bpe.Runs(bpe.model_at(queries.tokenizer_path()))
    for text in ("<|endoftext|>" * 5000, "It's<|endoftext|>é<|x" * 3000, "<|endoftext|>a" * 2 + "<|"):
        assert runs.encode(text.encode()).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_stream_emits_what_one_window_would():
    model = bpe.model_at(queries.tokenizer_path())
    for _ in range(20):
        word = "".join(random.choice(["the", "in", "an", "er", "ing", "a"]) for _ in range(600)).encode()
        assert list(bpe.stream_word(model, word)) == bpe.merge_word(model, word)


def test_token_queries(spark, odd, empty):
    path, tok = queries.tokenizer_path(), library()
    order = sorted((r for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(rows(token_files.round_trip(odd, path)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    sums = collections.Counter()
    for _, text, _ in ROWS:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        sums[len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert sums == collections.Counter((r["n_tokens"], r["ids_crc32"]) for r in got)
    digests = collections.Counter(
        (i, hashlib.sha256(" ".join(map(str, tok.encode(t or "", add_special_tokens=False).ids)).encode()).hexdigest()) for i, t, _ in ROWS
    )
    assert digests == collections.Counter((r["doc_id"], r["ids_sha256"]) for r in rows(bpe.encode_decode(odd, path)))
    assert token_files.round_trip(empty, path).count() == 0 and bpe.encode_decode(empty, path).count() == 0


# ---------------------------------------------------------------- urls
def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x", "http://example.net/eN/", "http://net", "http://x.org/fr/?a#b", "http://example.com/de", "https://xnet/", "http://net/?q"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(url_filter.judge_urls(df, queries.url_rules(spark)))}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == got[10] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[4][2:] == ("net/", "block") and got[5] == ("net", "", None, "allow")
    assert got[6][1:] == ("/fr/", "org/fr/", "allow") and got[7][2:] == (None, "allow") and got[8][2] is None and got[9][2] == "net/"
    assert url_filter.judge_urls(df, queries.url_rules(spark).limit(0)).where("verdict <> 'allow'").count() == 0


# ---------------------------------------------------------------- personal data
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    fits = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m[0].split(".")),
        "card": lambda m: 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m)),
        "phone": lambda m: 9 <= len(digits(m)) <= 15,
    }
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in p.finditer(text) if fits[k](m)]


def test_base_spans():
    for _ in range(5000):
        text = "".join(random.choice("ab@@..-%+1234567890 ()é\n") for _ in range(random.randint(0, 50)))
        assert pii.base_spans(text) == brute_spans(text)
    for n in (255, 256, 257, 600):
        text = "x " + "a" * n + "@b.c " + "b" * n + "@@" + "." * n + "@x.y"
        assert pii.base_spans(text) == brute_spans(text)


def test_contexts_reveal_identifiers(spark, odd, empty):
    data = [(i, f"write to the holder of account {'u%d@x.org' % i if i % 5 else 'AB-%05d' % (i % 3)} today") for i in range(60)]
    data += [(100 + i, "nothing to see in room 12345 of account") for i in range(3)]
    got = {r["doc_id"]: r for r in rows(pii.extract(spark.createDataFrame(data, "doc_id long, text string")))}
    assert all(got[i]["added"].startswith("id:") for i in range(0, 60, 5))
    assert all(got[i]["added"] == "" for i in got if i % 5 or i >= 100)
    redacted = {r["doc_id"]: r["text"] for r in rows(pii.redact(spark.createDataFrame(data, "doc_id long, text string")))}
    assert redacted[0].endswith("account [ID] today") and redacted[1].endswith("account [EMAIL] today")
    out = rows(pii.extract(odd))
    assert len(out) == len(ROWS) and sum(r["n_email"] for r in out) == 1
    assert pii.extract(empty).count() == 0 and pii.redact(empty).count() == 0
    assert pii.redact(odd).columns == odd.columns


def test_contexts_end_at_marks_and_labels(spark):
    forms = ["now contact <{}> today", 'his id "{}" here', "an account ({}) there", "{} at first"]
    data = [(100 * f + i, form.format(f"u{i}@x.org" if i % 5 else f"AB-{i % 3:05d}")) for f, form in enumerate(forms) for i in range(60)]
    # seeds are glued to the label, identifiers stand apart
    data += [(400 + i, f"write to mailto:u{i}@x.org" if i % 5 else "write to mailto: CD-00001") for i in range(60)]
    # quoted words, of which few are seeds
    data += [(500 + i, f'they said "{"u%d@x.org" % i if i < 4 else "EF-00001" if i < 7 else "hello"}" again') for i in range(60)]
    got = {r["doc_id"]: r["added"] for r in rows(pii.extract(spark.createDataFrame(data, "doc_id long, text string")))}
    # most texts do not begin with an identifier
    assert {i for i, added in got.items() if added} == {100 * f + i for f in (0, 1, 2, 4) for i in range(0, 60, 5)}
    first = spark.createDataFrame([r for r in data if 300 <= r[0] < 400], "doc_id long, text string")
    assert {r["doc_id"] for r in rows(pii.extract(first)) if r["added"]} == set(range(300, 360, 5))


# ---------------------------------------------------------------- repeats
def test_repeats_against_brute_force(spark, odd, empty, sf_dir, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 50_000)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 200_000)
    extra = [(5000 + i, " ".join(random.choice("ab") for _ in range(400)), None) for i in range(6)]
    extra += [(5100 + i, "word " * 100, None) for i in range(3)]
    for df in (odd.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string, s string").drop("s"))):
        data = [(r["doc_id"], (r["text"] or "").encode().split()) for r in rows(df)]
        first = {}
        for i, w in data:
            for j in range(len(w) - 12):
                g = tuple(w[j : j + 13])
                first[g] = min(first.get(g, 1 << 62), 1 << 62 if i is None else i)
        want = collections.Counter()
        for i, w in data:
            gone = [False] * len(w)
            for j in range(len(w) - 12):
                if first[tuple(w[j : j + 13])] < (1 << 62 if i is None else i):
                    gone[j : j + 13] = [True] * 13
            want[i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()] += 1
        out = rows(substring_dedup.remove_repeats(df))
        assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == want
    assert substring_dedup.remove_repeats(empty).count() == 0


# ---------------------------------------------------------------- near duplicates
def brute_components(fps, distance=3):
    label = np.arange(len(fps))
    u, v = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance)
    simhash._settle(label, u, v)
    return label


def near_prints(n):
    out = set()
    for _ in range(n):
        x = random.getrandbits(64)
        for _ in range(12):
            out.add(x)
            for _ in range(random.randint(1, 4)):
                x ^= 1 << random.randrange(64)
    return np.array(sorted(out), dtype=np.uint64)


def test_trie_links_everything_in_reach(spark):
    fps = near_prints(60)
    want = brute_components(fps)
    zero = np.zeros(len(fps), dtype=np.int64)
    a, b = simhash.trie_links(zero, zero, zero + 3, zero, fps, 3)
    got = np.arange(len(fps))
    simhash._settle(got, a, b)
    assert (got == want).all()
    # small tasks force the traversal through Spark
    signed = fps.view(np.int64)
    place = {int(x): i for i, x in enumerate(signed)}
    found = simhash.links(spark.createDataFrame([(int(x),) for x in signed], "fp long"), 3, limit=20).collect()
    got = np.arange(len(fps))
    simhash._settle(got, np.array([place[r.a] for r in found]), np.array([place[r.b] for r in found]))
    assert (got == want).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def test_fingerprints_and_groups(spark, odd, empty):
    import xxhash

    out = rows(simhash.near_duplicates(odd))
    assert len(out) == len(ROWS)
    def brute(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hs) * 2 > len(hs))
    fps = np.array([brute(t) for _, t, _ in ROWS], dtype=np.uint64)
    assert collections.Counter(f"{int(x):016x}" for x in fps) == collections.Counter(r["fingerprint"] for r in out)
    label = brute_components(fps)
    least = {}
    for (i, _, _), c in zip(ROWS, label):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    assert collections.Counter((i, least.get(c)) for (i, _, _), c in zip(ROWS, label)) == collections.Counter((r["doc_id"], r["component_id"]) for r in out)
    assert simhash.near_duplicates(empty).count() == 0


# ---------------------------------------------------------------- toxicity
def test_toxicity_on_held_out_rows(spark, odd, empty):
    data, marks = [], []
    for i in range(600):
        words = [random.choice("oak elm ash fir yew box bay fig".split()) for _ in range(30)]
        if i % 6 == 0:
            words[3] = random.choice(["vile", "nastyish", "nastyness"])
        data.append((i, " ".join(words)))
        marks.append((i, int(i % 6 == 0), 1))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, marks[0], (None, 1, 0), (7, None, 0)], "doc_id long, toxic int, quality int")
    scorer = toxicity.fit(docs, labels)
    out = rows(toxicity.score(docs, scorer))
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in held)
    assert all(r["neighbours"] for r in held if r["predicted"])
    assert len(rows(toxicity.score(odd, scorer))) == len(ROWS) and toxicity.score(empty, scorer).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in rows(toxicity.score(odd, none))} == {0.0}


def test_rare_toxic_words_are_terms(spark):
    ids = [i for i in range(8100) if zlib.crc32(str(i).encode()) % 4 != 2][:6000]
    rare = [f"q{a}{b}" for a in "abcdefghijklmno" for b in "abcdefghij"]
    data = [(i, f"{rare[n // 10 % 150]} oak elm ash {i}" if n % 10 == 0 else f"{random.choice(['fir', 'yew'])} oak elm ash {i}") for n, i in enumerate(ids)]
    docs = spark.createDataFrame([*data, (9000, "oak qaa"), (9001, "oak elm")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(n % 10 == 0)) for n, i in enumerate(ids)], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels)
    # each rare word is in 4 of 600 toxic texts
    assert set(rare) <= set(scorer.terms)
    got = {r["doc_id"]: r["predicted"] for r in rows(toxicity.score(docs.where("doc_id >= 9000"), scorer))}
    assert got == {9000: 1, 9001: 0}


def test_many_rare_terms_are_all_kept(spark):
    # 650 words, each in 3 of 1,950 toxic texts: with their prefixes 4,550 terms
    letters = "bcdfghjklm"
    rare = [a + b + c + "q" + "rstuvw" for a in letters for b in letters for c in letters][:650]
    ids = [i for i in range(20_200) if zlib.crc32(str(i).encode()) % 4 != 2][:15_000]
    toxic = {i: rare[n // 3] for n, i in enumerate(ids[:1950])}
    data = [(i, f"{toxic.get(i, 'fir')} oak elm {i}") for i in ids]
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    scorer = toxicity.fit(spark.createDataFrame(data, "doc_id long, text string"), labels)
    assert {t for w in rare for t in toxicity.terms_of(w)} <= set(scorer.terms)
    asked = spark.createDataFrame([(50_000 + k, f"elm {w}") for k, w in enumerate(rare)] + [(60_000, "oak elm")], "doc_id long, text string")
    got = {r["doc_id"]: (r["predicted"], bool(r["neighbours"])) for r in rows(toxicity.score(asked, scorer))}
    assert got.pop(60_000) == (0, False) and set(got.values()) == {(1, True)}


@pytest.mark.parametrize("share, copies", [(6, 0), (1, 3000)])
def test_terms_at_skewed_rates(spark, share, copies):
    # six in ten texts toxic; one in ten, with many copies of one more toxic text
    data = [(i, f"{'vile' if i % 10 < share else 'good'} oak elm {i}", int(i % 10 < share)) for i in range(800)]
    data += [(1000 + i, "foul oak elm", 1) for i in range(copies)]
    docs = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    scorer = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    assert "vile" in scorer.terms and "good" not in scorer.terms
    got = {(r["doc_id"] % 10 < share, r["predicted"]) for r in rows(toxicity.score(docs.where("doc_id < 1000"), scorer))}
    assert got == {(True, 1), (False, 0)}
    alone = toxicity.fit(docs, docs.where("toxic = 1").select("doc_id", "toxic"))
    assert not alone.terms and alone.rate > 0.9


def test_terms_of_chunks_are_those_of_words(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK_BYTES", 300)
    words = ["a", "as", "añb", "aßa", "asadoes", "asados", "ΟΔΟΣ", "x²y", "é"]
    terms = {t: i for i, t in enumerate(sorted({t for w in words[::2] for t in toxicity.terms_of(w.lower())}))}
    marks = [" ", "\n", "_", "9", "\x85", "—", ", "]
    texts = [None, "", "a", "9", LONG] + [
        "".join(random.choice([*words, "ASADOES"]) + random.choice(marks) for _ in range(random.randint(0, 40))) for _ in range(200)
    ]
    brute = [
        collections.Counter(terms[t] for w in toxicity.WORD.findall((x or "").lower()) for t in toxicity.terms_of(w) if t in terms)
        for x in texts
    ]
    assert list(toxicity.Terms(terms).count(texts)) == brute
    assert list(toxicity.Terms({}).count(["a b", None])) == [collections.Counter()] * 2


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    idf = rng.random(30) + 0.5
    counts = [{int(t): int(rng.integers(1, 4)) for t in rng.choice(30, rng.integers(1, 6), replace=False)} for _ in range(700)]
    index = toxicity.Index(idf, counts, [0] * 700, list(range(700)))
    dense = np.zeros((700, 30))
    for i, c in enumerate(counts):
        t, w = index.vector(c)
        dense[i, t] = w
    for i in range(0, 700, 23):
        best, score = index.nearest(counts[i], 10, i)
        cos = np.round(dense @ dense[i], 12)
        cos[i] = -1
        want = [j for j in np.lexsort((np.arange(700), -cos))[:10] if cos[j] > 0]
        assert best.tolist() == want and np.allclose(score, cos[want])


# ---------------------------------------------------------------- mixing
def test_mix_reaches_its_targets(spark, odd, empty, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.when(F.col("source") == "src0", None).otherwise(F.col("source")).alias("source"))
    out = rows(mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken"))
    by = collections.defaultdict(list)
    for r in out:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(r["size"] for r in by[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            break
        fixed |= {s: 3.0 * sizes[s] for s in over}
    for s in names:
        want = {**share, **fixed}[s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - want) < 1e-6 * want for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - want) <= 0.01 * want + 1
    again = rows(mixing.mix(docs.repartition(5)).select("doc_id", "taken"))
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in out)
    assert mixing.mix(odd).count() == len(ROWS) and mixing.mix(empty).count() == 0


def test_splitting_tree_is_exact_and_hypergeometric(spark):
    quotas = spark.createDataFrame([([100, 0, 37, 1],)], "quotas array<long>")
    for seed in (1, 2):
        leaves = [r.quotas for r in mixing.split_quotas(quotas, 3, seed).collect()]
        assert len(leaves) == 8 and [sum(c) for c in zip(*leaves)] == [100, 0, 37, 1]
        assert {sum(q) for q in leaves} <= {17, 18}
    x = spark.range(20_000).select(mixing.hypergeometric(F.lit(10).cast("long"), F.lit(30).cast("long"), F.lit(50).cast("long"), F.rand(1)).alias("x"))
    mean, var = x.agg(F.avg("x"), F.variance("x")).first()
    assert abs(mean - 6) < 0.05 and abs(var - 10 * 0.6 * 0.4 * 40 / 49) < 0.08


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = P.saved(P.toxic(spark, docs, sf_dir), "t")
    scores = toxicity.score(docs, toxicity.fit(docs, labels))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scores.where("predicted = 0").collect()}
    single = P.saved(P.near_duplicates(spark, clean, sf_dir), "t")
    groups = simhash.near_duplicates(clean)
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups.collect()}
    hidden = P.saved(P.personal_data(spark, single, sf_dir), "t")
    assert hidden.count() == single.count()
    assert not any(brute_spans(r.text or "") for r in hidden.collect())
    mixed = P.saved(P.mixed(spark, hidden, sf_dir), "t")
    want = {(r.doc_id, r.taken) for r in mixing.mix(hidden).where("taken > 0").collect()}
    got = mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n"))
    assert {(r.doc_id, r.n) for r in got.collect()} == want
    assert all(df.columns == docs.columns for df in (clean, single, hidden, mixed))
    out = P.encoded(spark, mixed, sf_dir)
    assert out.count() == mixed.count()
    assert out.where("size(ids) <> n_tokens").count() == 0
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "bpe"]


def test_pipeline_drops_rows_without_ids(spark, tmp_path):
    import corpus_pipeline as P

    words = "oak elm ash fir yew box bay fig".split()
    text = lambda i: " ".join([*random.Random(i).choices(words, k=30), f"n{i}"])
    data = [(i, f"vile {text(i)}" if i % 6 == 0 else text(i)) for i in range(600)]
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(600)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(None, "vile " + text(1)), (None, None), (None, ""), (None, text(2)), (1, "vile again " + text(1))]
    docs = spark.createDataFrame([(*r, "s") for r in data + odd], "doc_id long, text string, source string")
    got = collections.Counter((r.doc_id, r.text) for r in P.toxic(spark, docs, str(tmp_path)).collect())
    assert got == collections.Counter(r for r in data + odd if not (r[1] or "").startswith("vile"))
    copies = [(None, LONG)] * 5 + [(None, LONG + " x")] * 3 + [(None, text(3))] * 4 + [(7, text(3)), (7, text(3)), (9, text(3)), (9, "zig zag zog " * 9)]
    docs = spark.createDataFrame([(*r, s) for r, s in zip(copies, "ab" * 20)], "doc_id long, text string, source string")
    left = P.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert left[0].asDict().keys() == set(docs.columns) and sum(r.doc_id is None for r in left) == 1
    assert sorted(r.doc_id for r in left if r.doc_id) == [7, 7, 9]


def test_pipeline_mixes_repeated_rows_as_often_as_drawn(spark):
    import corpus_pipeline as P

    data = [(7, " ".join(f"w{i}" for i in range(50)), s, 0) for s in ["a"] * 300 + [None] * 3]
    data += [(i, f"x{i} y z " * 9, "ab"[i % 2], 0) for i in range(100, 300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, n_chars long")
    taken = mixing.mix(docs, weights=(5, 2, 1), cap=3).groupBy("source").agg(F.sum("taken").alias("n"))
    got = P.mixed(spark, docs, "").groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n"))
    assert {(r.source, r.n) for r in got.collect()} == {(r.source, r.n) for r in taken.collect() if r.n}


def test_shards_hold_every_draw_once(spark):
    data = [(i, " ".join(["w"] * random.randint(0, 90)), random.choice(["a", "a", "a", "b", None])) for i in range(700)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    sizes = docs.select("source", mixing.word_count(F.col("text")).alias("size"))
    plan = {r.source: r for r in mixing.plan_mix(sizes, depth=3).collect()}
    out = mixing.mix(docs, depth=3).collect()
    draws = collections.defaultdict(lambda: collections.defaultdict(int))
    for r in out:
        spans = sorted((p.epoch, p.first, p.first + p.words) for p in r.pieces)
        # pieces of one epoch do not overlap, and lie inside the document
        assert all(a[0] < b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:])) and all(0 <= a < b <= r.size for _, a, b in spans)
        assert r.taken == sum(p.words for p in r.pieces)
        assert [(s.shard, s.words) for s in r.shards] == sorted(
            (k, sum(p.words for p in r.pieces if p.shard == k)) for k in {p.shard for p in r.pieces}
        )
        for p in r.pieces:
            draws[r.source][p.shard, p.epoch, p.order] += p.words
    for source, row in plan.items():
        tail = row.source_size - (row.blocks - 1) * row.block
        found = draws[source]
        # each draw is one whole block, in one shard; only the last block may be shorter
        assert len(found) == row.quota == row.ends[-1] and set(found.values()) <= {row.block, tail}
        assert len({order for _, _, order in found}) == len(found)
        per_shard = collections.Counter(shard for shard, _, _ in found)
        assert [per_shard[k] for k in range(8)] == np.diff([0, *row.ends]).tolist()
        # a block comes again only when all others had their turn
        per_epoch = collections.Counter(epoch for _, epoch, _ in found)
        assert [per_epoch[e] for e in sorted(per_epoch)] == [row.blocks] * (row.quota // row.blocks) + [row.quota % row.blocks] * (row.quota % row.blocks > 0)
        assert sum(found.values()) == sum(r.taken for r in out if r.source == source)


def test_depth_follows_the_words(spark, monkeypatch):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g h i j").alias("text"), F.lit("s").alias("source"))
    monkeypatch.setattr(mixing, "SHARD_WORDS", 10)
    deep = mixing.mix(docs).select(F.explode("pieces.shard").alias("s")).agg(F.max("s")).first()[0]
    assert 32 <= deep < 64
    monkeypatch.setattr(mixing, "SHARD_WORDS", 1 << 25)
    assert mixing.mix(docs).select(F.explode("pieces.shard").alias("s")).agg(F.max("s")).first()[0] < 16
    # the pipeline writes its rows shard by shard
    import corpus_pipeline as P

    out = P.mixed(spark, docs.withColumn("n_chars", F.length("text")).withColumn("lang", F.lit("en")), "")
    assert out.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == mixing.mix(docs).agg(F.sum("taken")).first()[0]
    order = [r.doc_id for r in out.coalesce(1).collect()]
    assert sorted(order) != order


def test_texts_encoded_together_have_the_ids_of_the_library(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    library = Tokenizer.from_file(path)
    texts = [None, "", " \t\x0b\x0c\r\n ", "  Foo, foo's\x1cBAR\x85don't 12 ", "<|endoftext|>x a<|startoftext|>", "Ⱥb İx K ǅ été é 日本 ß\x00\x7f", "foo " * 50, "x" * 300]
    runs = token_files.LibraryRuns(path)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for part in (10, 1 << 20):
        monkeypatch.setattr(token_files, "PART", part)
        batch = pa.RecordBatch.from_arrays([pa.array([*texts, *texts])], ["text"])
        parts = list(token_files.parts_of(batch.slice(3), 0))
        assert sum(map(len, parts)) == 13 and (len(parts) > 5) == (part == 10)
        ids = [np.frombuffer(x, runs.type).tolist() for p in parts for x in token_files.encode_texts(runs, p.column(0)).to_pylist()]
        assert ids == [*want, *want][3:]


def test_a_worker_keeps_no_cache_of_runs_after_its_task(spark):
    import gc

    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("w"), F.hex("id")).alias("text"))
    assert bpe.encode_decode(docs, queries.tokenizer_path()).agg(F.sum("n_tokens")).first()[0] > 0

    def held(batches):
        import pyarrow as pa

        for batch in batches:
            n = sum(type(x).__name__ == "Runs" for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(batch), pa.int64())], ["n"])

    assert docs.select("doc_id").mapInArrow(held, "n long").agg(F.max("n")).first()[0] == 0


def test_stages_work_on_a_few_rows_at_a_time_and_give_memory_back(spark, monkeypatch):
    import os
    import resource

    import pyarrow as pa

    from riskframe import session

    docs = spark.createDataFrame([(i, f"mail a{i}@b.org now", "en", "s", 9) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars int")
    made, given = [], []
    original = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **k: made.append(f) or original(self, f, *a, **k))
    monkeypatch.setattr(session, "ROWS", 4)
    monkeypatch.setattr(session, "release", lambda: given.append(1))
    bpe.encode_decode(docs, queries.tokenizer_path(), ids=True), simhash.fingerprints(docs), pii.scan(docs, "doc_id")
    texts, keys = pa.array([f"mail a{i}@b.org now" for i in range(9)]), pa.array(range(9), pa.int64())
    for f, columns in zip(made, ([keys, texts], [keys, texts], [keys, keys, texts]), strict=True):
        batch = pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])
        out = list(f(iter([batch, batch.slice(0, 0), batch.slice(5)])))
        assert [len(x) for x in out] == [4, 4, 1, 4]
        assert [k for x in out for k in x.column(0).to_pylist()] == [*range(9), *range(5, 9)]
    assert len(given) == 3
    monkeypatch.undo()

    resident = lambda: int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize()
    held = [os.urandom(1000) for _ in range(200_000)]
    few = held[::1000]
    del held
    before = resident()
    session.release()
    assert before - resident() > 100_000_000 and len(few) == 200
