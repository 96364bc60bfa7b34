"""BPE as a streaming transducer with bounded lookahead, and decoding by a state machine.

Encoding follows the tokenizer file: NFC, white space to blanks, lower case, a split into words,
byte symbols, merges by rank with an end-of-word mark. All of these act on runs between ASCII white
space alone, so a text is a stream of such runs. Runs beyond Latin letters are normalised and split
by the tokenizers library, whose Unicode tables are those that count.

*Lookahead.* Merges apply in order of rank. Two continuations of the same prefix can differ left of
where they part only through a chain of merges of growing rank: one merge takes or leaves the symbol
at the frontier, so a later merge that ends with that symbol, or with its product, does or does not
happen and moves the frontier left by its left part. ``lookahead`` bounds the length of such chains
over the merge list. So in a window of an unfinished word all tokens that end at least that many
bytes before the window's end are stable: they are emitted and forgotten. Memory is one window,
however long a word is. Merges never cross a token border, so the rest of the word continues alone.

Runs that are short enough are remembered in a bounded cache, as most words of a corpus repeat.

*Decoding* feeds the bytes of each token to an incremental UTF-8 decoder; a character whose bytes
are split over tokens comes out when it is whole.

Defined results: null and empty texts have no tokens; special-token strings in a text become their
ids, as the tokenizer file says; repeated rows all return; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import frugal, ship_package

#: Bytes of a run that the cache takes, and runs in each of its two generations.
CACHED_BYTES, CACHED_RUNS = 40, 100_000
#: Bytes of text handled at a time.
PIECE = 1 << 20
#: Tokens decoded and digested at a time.
STEP = 1 << 14
# White space and letter classes of the tokenizer's patterns, by Unicode.
BLANKS = "\t-\r \x85\xa0  -     　"
LATIN_END = "ɐ"
LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+|[0-9²³¹¼½¾]|[^{BLANKS}a-zªµºß-öø-ɏ0-9²³¹¼½¾]+"
)
#: The same for bytes of a lower-case ASCII run, which holds no white space.
ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is printable
    in Latin-1, else the next free letter from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class Model:
    """The merge list of a tokenizer file of the kind named above."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("not a lower-casing word-end BPE tokenizer file")
        vocab, self.mark = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_bytes = re.compile(b"|".join(re.escape(x.encode()) for x in self.special) or rb"(?!)")
        self.letters_only = any(x.isalpha() and x.isascii() for x in self.special)
        self.path, self.library = path, None
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.names = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for name, i in {**vocab, **self.special}.items():
            self.names[i] = name
        letters = byte_letters()
        self.letters = str.maketrans({chr(b): letters[b] for b in range(256)})
        self.plain = str.maketrans({letters[b]: chr(b) for b in range(256)})
        self.inner = [vocab[x] for x in letters]
        self.final = [vocab[x + self.mark] for x in letters]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.product = [vocab[a + b] for a, b in pairs]
        keys = (self.left << 32) | self.right
        self.ranks = dict(zip(keys.tolist(), range(len(keys))))
        self.bytes = [len(n.removesuffix(self.mark)) for n in self.names]
        self.lookahead = lookahead(self)
        self.window = 4 * (self.lookahead + max(self.bytes))


def lookahead(model: Model) -> int:
    """Bytes of right context after which tokens of an unfinished word are stable.

    ``reach[s]`` is how far left the frontier can still move when a symbol s begins at it and only
    merges of higher rank are to come; ranks are visited from the last to the first.
    """
    reach = [0] * len(model.names)
    size = model.bytes
    for a, b, p in zip(model.left[::-1].tolist(), model.right[::-1].tolist(), model.product[::-1]):
        after = max(reach[a], reach[p])
        reach[b] = max(reach[b], size[a] + after)
        reach[a] = max(reach[a], reach[p])
    return 1 + max(reach[s] for s in (*model.inner, *model.final))


def merge_symbols(model: Model, symbols: list[int]) -> list[int]:
    """The tokens of one window, in place: lowest rank first, leftmost first."""
    ranks, product = model.ranks, model.product
    far = len(ranks)
    order = [ranks.get(a << 32 | b, far) for a, b in zip(symbols, symbols[1:])]
    while order and (best := min(order)) < far:
        i = order.index(best)
        symbols[i : i + 2] = (product[best],)
        del order[i]
        if i:
            order[i - 1] = ranks.get(symbols[i - 1] << 32 | symbols[i], far)
        if i < len(order):
            order[i] = ranks.get(symbols[i] << 32 | symbols[i + 1], far)
    return symbols


def merge_word(model: Model, word: bytes) -> list[int]:
    """Tokens of a word that fits a window."""
    symbols = [model.inner[b] for b in word]
    symbols[-1] = model.final[word[-1]]
    return merge_symbols(model, symbols)


def stream_word(model: Model, word: bytes) -> Iterator[int]:
    """Tokens of a word of any length, each as soon as it is stable."""
    at, stable = 0, model.window - model.lookahead
    while len(word) - at > model.window:
        begun = at
        for token in merge_symbols(model, [model.inner[b] for b in word[at : at + model.window]]):
            if at - begun + model.bytes[token] > stable:
                break
            at += model.bytes[token]
            yield token
    yield from merge_word(model, word[at:])


def word_tokens(model: Model, word: bytes) -> Iterable[int]:
    return merge_word(model, word) if len(word) <= model.window else stream_word(model, word)


def split_run(model: Model, run: bytes) -> list:
    """The words of a run between ASCII white space, as bytes; a special token as its id."""
    text = run.decode("utf-8", "replace")
    if not any(special in text for special in model.special):
        return split_text(model, text)
    out, at = [], 0
    for found in model.split_special.finditer(text):
        out += [*split_text(model, text[at : found.start()]), model.special[found[0]]]
        at = found.end()
    return [*out, *split_text(model, text[at:])]


def split_text(model: Model, text: str) -> list:
    """The words of a text without special tokens, as bytes."""
    if not text:
        return []
    plain = text.lower() if text.isascii() or max(text) < LATIN_END and "İ" not in text else None
    # some capitals below the end have small letters above it
    if plain is not None and max(plain) < LATIN_END:
        return [w.encode() for w in LATIN.findall(plain)]
    return library_words(model, text)


def library_words(model: Model, text: str) -> list[bytes]:
    """The words of any text by the tokenizer file's own normaliser and splitter, whose Unicode tables
    decide what a letter is."""
    if model.library is None:
        from tokenizers import Tokenizer

        model.library = Tokenizer.from_file(model.path)
    words = model.library.pre_tokenizer.pre_tokenize_str(model.library.normalizer.normalize_str(text))
    return [w.translate(model.plain).encode("latin-1") for w, _ in words]


class Runs(dict):
    """Packed token ids of runs; a bounded cache in two generations, filled on demand.

    A word is a run as well, so words that runs share are merged once.
    """

    def __init__(self, model: Model, tokens: Callable[[Model, bytes], Iterable[int]] = word_tokens):
        super().__init__()
        self.model, self.tokens, self.old, self.held = model, tokens, {}, 0
        self.kind = "H" if len(model.names) <= 1 << 16 else "I"
        self.type = np.dtype(f"u{array(self.kind).itemsize}")

    def __missing__(self, run: bytes) -> bytes:
        ids = self.old.get(run)
        if ids is None:
            ids = self.fresh(run)
        if len(run) <= CACHED_BYTES:
            self[run] = ids
        return ids

    def fresh(self, run: bytes) -> bytes:
        """The ids of a run that the cache does not hold."""
        if run.isalpha() and not self.model.letters_only:
            return self.word(run.lower(), run)
        if run.isascii() and not self.model.special_bytes.search(run):
            words = ASCII.findall(run.lower())
        else:
            words = split_run(self.model, run)
        if len(words) == 1:
            return self.word(words[0], run)
        return b"".join([self.word(w, run) for w in words])

    def word(self, word: bytes | int, run: bytes) -> bytes:
        if isinstance(word, int):
            return array(self.kind, [word]).tobytes()
        if word != run:
            return self[word]
        return array(self.kind, self.tokens(self.model, word)).tobytes()

    def renew(self) -> None:
        """Begin another generation if this one is full."""
        if len(self) > CACHED_RUNS:
            self.old = dict(self)
            self.clear()

    def stream(self, text: bytes) -> Iterator[np.ndarray]:
        """Token ids of a text, some at a time."""
        self.renew()
        for piece in pieces(text):
            if len(piece) <= 2 * PIECE:
                yield np.frombuffer(b"".join(map(self.__getitem__, piece.split())), dtype=self.type)
                continue
            for run in piece.split():
                for word in split_run(self.model, run):
                    tokens = iter([word] if isinstance(word, int) else self.tokens(self.model, word))
                    while some := list(islice(tokens, STEP)):
                        yield np.array(some, dtype=self.type)

    def encode(self, text: bytes) -> np.ndarray:
        """Token ids of a text."""
        parts = list(self.stream(text))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces that end at ASCII white space."""
    at = 0
    while len(data) - at > size:
        cut = next((i for i in range(at + size, len(data)) if data[i] in b" \t\n\v\f\r"), len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


class Decoder:
    """Token ids to text, piece by piece.

    ``names`` joins the vocabulary's own spellings by blanks, which is what a tokenizer file without
    a decoder does; otherwise the bytes that the tokens stand for are put together.
    """

    def __init__(self, model: Model, names: bool = True):
        if names:
            self.table, self.between = [n.encode() for n in model.names], b" "
        else:
            back = {c: bytes([b]) for b, c in enumerate(byte_letters())}
            spell = lambda n: b"".join(back.get(c, c.encode()) for c in n)
            mark = model.mark
            self.table = [
                n.encode() if n in model.special else spell(n.removesuffix(mark)) + b" " * n.endswith(mark) for n in model.names
            ]
            self.between = b""
        self.array = np.array(self.table, dtype=object)
        self.reset()

    def reset(self) -> None:
        self.state, self.begun = codecs.getincrementaldecoder("utf-8")("replace"), False

    def feed(self, ids: np.ndarray, last: bool = False) -> str:
        """The text that is whole after these ids."""
        data = self.between.join(self.array[ids].tolist())
        if len(ids):
            data = self.between * self.begun + data
            self.begun = True
        return self.state.decode(data, last)


_MODELS: dict[str, Model] = {}


def model_at(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode_decode(documents: DataFrame, path: str, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256), with the token ids themselves if ``ids``.

    The digests are of the decimal ids joined by blanks, and of the decoded text in UTF-8.
    """
    ship_package(documents.sparkSession)
    chosen = documents.select(key, F.col("text").cast("string").alias("text"))
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of this task: the worker lives on through stages that have no use for it
        runs = Runs(model_at(path))
        decoder = Decoder(runs.model)
        numbers = np.array([str(i) for i in range(len(runs.model.names))], dtype=object)
        for part in batches:
            rows, arrays = [], []
            for text in part.column(1):
                digest, decoded, n = hashlib.sha256(), hashlib.sha256(), 0
                decoder.reset()
                for tokens in runs.stream((text.as_py() or "").encode("utf-8", "replace")):
                    for i in range(0, len(tokens), STEP):
                        some = tokens[i : i + STEP]
                        digest.update((" " * (n > 0) + " ".join(numbers[some].tolist())).encode())
                        decoded.update(decoder.feed(some).encode())
                        n += len(some)
                    if ids:
                        arrays.append(tokens)
                decoded.update(decoder.feed(np.zeros(0, runs.type), last=True).encode())
                rows.append((n, digest.hexdigest(), decoded.hexdigest()))
            columns = [part.column(0), *(pa.array(x) for x in zip(*rows))]
            if ids:
                ends = np.cumsum([0, *(r[0] for r in rows)], dtype=np.int32)
                flat = np.concatenate(arrays).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = chosen.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return chosen.mapInArrow(frugal(run), schema)
