"""BPE encoding and decoding with forced-boundary splitting.

A pair of neighbouring byte symbols that occurs inside no token of the
vocabulary can never be joined by a merge.  Words are cut at such pairs, the
fragments are encoded independently of one another (and remembered, since few
distinct fragments make up most words), and their ids are concatenated.

Rows never leave their partition: one Arrow pass, no shuffle, and a lost
executor costs only its own partitions.  Memory is bounded by one Arrow batch,
the text at hand and two dictionaries of at most ``REMEMBERED`` entries.  A word
of any length takes time in proportion to it (but for a logarithm): the places
of each pair are kept by rank.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty string; null ids decode to the empty string; an empty
table gives an empty table; very long texts and words are taken whole; of equal
ranks the leftmost pair is merged first; repeated rows are encoded each; columns
other than those named are left as they are, and replaced if their names clash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from biblion.llm.base import bounded, slices

#: Words, and fragments, that a worker remembers; those asked for lately stay.
REMEMBERED = 600_000
#: Symbols of a fragment beyond which the places of pairs are kept by rank.
LONG = 48
END = "</w>"

#: Beyond these characters the library's own normalizer and splitter are asked.
_RARE = re.compile("[^\x00-ɏ]|İ")
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_BLANKS = "\t-\r \u0085 "
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_BLANKS}{_LETTERS}{_DIGITS}]+")
#: The splitting pattern for which the fast path above holds (a fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """A byte-level BPE vocabulary with word ends, read from a tokenizer's JSON."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != _PATTERN:
            raise ValueError("this is no word-end BPE vocabulary")
        self.ids = {**model["vocab"], **{x["content"]: x["id"] for x in spec["added_tokens"]}}
        self.tokens = [""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.tokens[i] = token
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.inside = self.pairs_inside(model["vocab"])
        special = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.heads = {x[0] for x in special}
        library = Tokenizer.from_str(raw.decode())
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.symbols = byte_symbols()
        self.words = _Remembered(lambda word: self.word(self.symbolic(word)))
        self.parts = _Remembered(self.fragment)
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.tokens))]

    @staticmethod
    def pairs_inside(vocab: Iterable[str]) -> set[str]:
        """Every pair of byte symbols that stands side by side in some token."""
        found: set[str] = set()
        for token in vocab:
            bare = token.removesuffix(END)
            found.update(map(str.__add__, bare, bare[1:]))
        return found

    def symbolic(self, word: str) -> str:
        if word.isascii() and word.isalnum():
            return word
        return "".join([self.symbols[b] for b in word.encode()])

    def cut(self, word: str) -> list[str]:
        """The fragments between forced boundaries; the last one carries the word end."""
        at = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.inside), len(word)]
        found = [word[a:b] for a, b in zip(at, at[1:], strict=False)]
        found[-1] += END
        return found

    def word(self, word: str) -> bytes:
        """The ids of a whole word in byte symbols, as little-endian 32-bit integers."""
        parts = self.cut(word)
        # a word of one fragment is remembered as a word
        return self.fragment(parts[0]) if len(parts) == 1 else b"".join(map(self.parts.__getitem__, parts))

    def fragment(self, part: str) -> bytes:
        """Merge the lowest-ranked pair, the leftmost first, until none is left."""
        if part.endswith(END):
            bare = part.removesuffix(END)
            symbols = [*bare[:-1], bare[-1] + END]
        else:
            symbols = [*part]
        if len(symbols) > LONG:
            return b"".join([self.packed[self.ids[x]] for x in self.merged(symbols)])
        rank, none = self.rank.get, len(self.rank)
        while len(symbols) > 1:
            ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return b"".join([self.packed[self.ids[x]] for x in symbols])

    def merged(self, symbols: list[str]) -> list[str]:
        """The same merges of many symbols: the places of each pair by rank, symbols linked to their neighbours."""
        rank, n = self.rank.get, len(symbols)
        before, behind = list(range(-1, n - 1)), list(range(1, n + 1))
        places: dict[int, list[int]] = {}
        for i in range(n - 1):
            r = rank((symbols[i], symbols[i + 1]))
            if r is not None:
                places.setdefault(r, []).append(i)
        ranks = list(places)
        heapq.heapify(ranks)
        while ranks:
            now = heapq.heappop(ranks)
            todo = sorted(places.pop(now))
            for k, i in enumerate(todo):
                j = behind[i]
                if j >= n or symbols[i] is None or rank((symbols[i], symbols[j])) != now:
                    continue  # merged otherwise meanwhile
                symbols[i] += symbols[j]
                symbols[j] = None
                after = behind[i] = behind[j]
                if after < n:
                    before[after] = i
                least = now
                for left, right in ((before[i], i), (i, after)):
                    if left >= 0 and right < n:
                        r = rank((symbols[left], symbols[right]))
                        if r is not None:
                            if r not in places:
                                places[r] = []
                                heapq.heappush(ranks, r)
                            places[r].append(left)
                            least = min(least, r)
                if least < now:  # a pair that comes first arose: the rest waits
                    places[now] = places.get(now, []) + todo[k + 1 :]
                    heapq.heappush(ranks, now)
                    break
        return [x for x in symbols if x is not None]

    def plain(self, text: str) -> bytes:
        """Ids of a text that holds no special token."""
        if text.isascii() or not _RARE.search(text):
            return b"".join(map(self.words.__getitem__, _PIECES.findall(text.lower())))
        pieces = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return b"".join([self.word(piece) for piece, _ in pieces])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special is None or not any(c in text for c in self.heads):
            return self.plain(text)
        split = self.special.split(text)
        return b"".join([self.packed[self.ids[x]] if k % 2 else self.plain(x) for k, x in enumerate(split) if x])

    def decode(self, ids: bytes) -> str:
        """The tokens joined by one blank, special ones too, as without a decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Remembered(dict):
    """Results of a function.  When there are too many, those not asked for since the last time go."""

    def __init__(self, of):
        super().__init__()
        self.of, self.old = of, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.of(key)
        self[key] = value
        return value


_LOADED: dict[bytes, WordBpe] = {}


def loaded(raw: bytes) -> WordBpe:
    """The vocabulary, parsed once in each Python worker."""
    key = hashlib.sha256(raw).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(raw)
    return _LOADED[key]


def vocabulary(df: DataFrame, path: str):
    """Broadcast of the vocabulary file: a few MB, whatever the data.  The driver reads it, so executors need no such file."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _texts(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _mapped(df: DataFrame, added: list[tuple[str, str, pa.DataType]], columns) -> DataFrame:
    """``df`` with columns that ``columns(batch)`` makes; they replace columns of the same name."""
    bounded(df.sparkSession)
    names = {name for name, _, _ in added}
    kept = [c for c in df.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                made = columns(batch)
                old = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*old, *(pa.array(x, kind) for x, (_, _, kind) in zip(made, added, strict=True))], names=[*kept, *names_in_order])

    names_in_order = [name for name, _, _ in added]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept), *(f"`{n}` {t}" for n, t, _ in added)])
    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` and the column ``ids`` (array<int>) of the whole text of each row."""
    raw = vocabulary(df, path)

    def columns(batch: pa.RecordBatch):
        bpe = loaded(raw.value)
        return [[np.frombuffer(bpe.encode(t), "<i4") for t in _texts(batch, text)]]

    return _mapped(df, [(ids, "array<int>", pa.list_(pa.int32()))], columns)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` and the column ``text`` that the ids of each row stand for."""
    raw = vocabulary(df, path)

    def columns(batch: pa.RecordBatch):
        bpe = loaded(raw.value)
        return [[bpe.decode(np.asarray(i or [], "<u4").tobytes()) for i in _texts(batch, ids)]]

    return _mapped(df, [(text, "string", pa.string())], columns)


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` without its text, with n_tokens, ids_sha256 and decoded_sha256 of each encoded and decoded text.

    Ids and decoded texts stay in the worker, which spares writing several
    times the input.
    """
    raw = vocabulary(df, path)

    def columns(batch: pa.RecordBatch):
        bpe = loaded(raw.value)
        n, ids, decoded = [], [], []
        for value in _texts(batch, text):
            packed = bpe.encode(value)
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(bpe.decode(packed).encode()).hexdigest())
        return [n, ids, decoded]

    added = [("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    return _mapped(df, added, columns).drop(text)
