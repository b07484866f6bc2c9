"""Token ids of whole texts with public tokenizer files, an Arrow column at a time.

A column of texts is cut at spaces by Arrow, where the tokenizer's own splitting cuts as
well. The pieces are dictionary-encoded, only distinct ones are split into words (those of
ASCII letters or digits by Arrow), only words not met before go through the tokenizer's model,
and numpy gathers the ids of all pieces. Texts that spell out an added token go through the library as a whole, so the ids
equal ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import gc
import json
from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
#: Runs of white space with two spaces, or with a space at the end of the text: their length
#: decides how they are split, so a text that holds one is a string by itself.
RUNS = f" {_BLANK}* |{_BLANK} $"
#: ASCII marks, neither letters nor digits nor white space.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bytes of text that are cut at a time (a longer text stands alone), and pieces whose ids are gathered at a time.
BYTES, STEP = 12 << 20, 1 << 20
#: Words to remember.
WORDS = 500_000


_id = attrgetter("id")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the letters from U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary for each run of ``counts`` values, without a copy."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), buffers)


def _joined(runs: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ids at some places, one after the other, and how many ids each has."""
    taken = runs.take(pa.array(at))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(at) + 1] // 2
    ids = np.frombuffer(taken.buffers()[2] or b"", np.uint16)[: ends[-1]]
    return ids, np.diff(ends)


class ColumnEncoder:
    """Encodes columns of texts; remembers up to about ``most`` words from one column to the next.

    A file whose added tokens take in their surroundings or are looked for after normalization
    can't be cut at spaces; the library encodes all texts of such a file.
    """

    def __init__(self, path: str, most: int = WORDS):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole, self.tokenizer, self.most = Tokenizer.from_file(path), Tokenizer.from_file(path), most
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # words come here once
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"])
        splitter = spec["pre_tokenizer"]
        self.keeps_space = splitter["type"] == "ByteLevel"
        if self.keeps_space:
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        else:
            pattern = splitter["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern).findall
        self.normalize = self.tokenizer.normalizer.normalize_str if spec["normalizer"] else None
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = array("H"), array("q", [0])

    def learn(self, words: set[str]) -> None:
        """Ids of new words, spaces included, by the tokenizer's model."""
        tokenize, letters, space, new = self.model.tokenize, self.letters, self.space, list(words)
        n = len(self.ends) - 1
        for at in range(0, len(new), 1000):
            some = new[at : at + 1000]
            parts = [tokenize(w.replace(" ", space) if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(letters)) for w in some]
            self.ends.extend(accumulate(map(len, parts), initial=len(self.ids)))
            del self.ends[-len(parts) - 1]  # the initial one
            self.ids.extend(map(_id, chain.from_iterable(parts)))
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def encode_strings(self, strings: list[str], heads: pa.Array | None = None, tails: Sequence[str] = (), tailed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some strings and how many each has; each is split on its own.

        ``heads`` are strings that come first and are known to be one word, or two where
        ``tailed`` says that one of ``tails`` follows.
        """
        if self.normalize:
            strings = [s.lower() if s.isascii() else self.normalize(s) for s in strings]
        collects = gc.isenabled()
        gc.disable()  # a list for each string, none of them in a cycle
        parts = list(map(self.split, strings))
        n_words = np.fromiter(map(len, parts), np.int64, len(parts))
        words = list(chain.from_iterable(parts))
        del parts
        new = set(words).union(tails)
        if heads is not None:
            one = heads.dictionary_encode()  # the same word before other tails
            own = one.dictionary.to_pylist()
            new.update(own)
        self.learn(new.difference(self.known))
        if collects:
            gc.enable()
        known = self.known.__getitem__
        at = np.fromiter(map(known, words), np.int64, len(words))
        if heads is not None:
            first = np.fromiter(map(known, own), np.int64, len(own))[one.indices.to_numpy()]
            n_first = 1 + tailed.astype(np.int64)
            both, ends = np.empty(int(n_first.sum()), np.int64), np.cumsum(n_first)
            both[ends - n_first] = first
            both[ends[tailed] - 1] = np.fromiter(map(known, tails), np.int64, len(tails))
            at, n_words = np.concatenate([both, at]), np.concatenate([n_first, n_words])
        ids, counts = _joined(binaries(np.frombuffer(self.ids, np.uint16), np.diff(np.frombuffer(self.ends, np.int64))), at)
        total, last = np.concatenate([[0], np.cumsum(counts)]), np.cumsum(n_words)
        return ids, total[last] - total[last - n_words]

    def _encode_pieces(self, pieces: pa.Array, firsts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces and first pieces, how many each has, and where each of ``pieces`` is among them.

        ASCII letters or digits, with ASCII marks behind them or not, are split without the pattern.
        """
        if not self.keeps_space:
            return *self.encode_strings(pieces.to_pylist() + firsts), np.arange(len(pieces))
        bare = pc.ascii_rtrim(pieces, characters=MARKS)
        plain = pc.or_(pc.ascii_is_alpha(bare), pc.ascii_is_decimal(bare))
        is_plain = plain.to_numpy(zero_copy_only=False)
        bare, whole = bare.filter(plain), pieces.filter(plain)
        cut = pc.binary_length(bare).to_numpy()
        tailed = pc.binary_length(whole).to_numpy() > cut
        tails = [x[n:] for x, n in zip(whole.filter(pa.array(tailed)).to_pylist(), cut[tailed].tolist(), strict=True)]
        heads = pc.binary_join_element_wise(" ", bare, "")
        place = np.empty(len(pieces), np.int64)
        place[is_plain] = np.arange(len(bare))
        place[~is_plain] = len(bare) + np.arange(len(pieces) - len(bare))
        rest = [f" {x}" for x in pieces.filter(pc.invert(plain)).to_pylist()]
        return *self.encode_strings(rest + firsts, heads, tails, tailed), place

    def encode(self, texts: pa.Array, end_id: int | None = None, step: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``first, last, ids, counts`` for runs of texts: all their ids and how many each has.

        Null texts have none. ``end_id`` follows each text where it is given. ``step`` bytes of
        text are cut at a time, ``BYTES`` by default.
        """
        texts = pc.fill_null(texts, "")
        sizes, first = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)), 0
        while first < len(texts):
            start = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, start + (step or BYTES), side="right")))
            for a, b, ids, counts in self._encode(texts.slice(first, last - first), end_id):
                yield first + a, first + b, ids, counts
            first = last

    def _encode(self, texts: pa.Array, end_id: int | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        if len(self.known) > self.most:
            self.reset()
        added = pa.array([not self.plain] * len(texts), pa.bool_())
        for content in self.added:
            added = pc.or_(added, pc.match_substring(texts, content))
        alone = pc.or_(added, pc.match_substring_regex(texts, RUNS)) if self.keeps_space else added
        cut = pc.split_pattern(pc.if_else(alone, "", texts), " ")
        pieces = cut.flatten().dictionary_encode()
        offsets = cut.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        index = pieces.indices.to_numpy().astype(np.int64)
        # The first piece of a text has no space before it; a text that isn't cut stands in its place.
        firsts = pieces.dictionary.take(pa.array(index[offsets[:-1]])).to_pylist()
        whole = np.flatnonzero(added.to_numpy(zero_copy_only=False))
        for i in np.flatnonzero(alone.to_numpy(zero_copy_only=False)):
            firsts[i] = texts[i].as_py()
        for i in whole:
            firsts[i] = ""
        ids, counts, place = self._encode_pieces(pieces.dictionary, firsts)
        index = place[index]
        index[offsets[:-1]] = len(place) + np.arange(len(texts))
        extra = [np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint16) for i in whole]
        # What the library has encoded stands last, and so does the end id.
        index[offsets[whole]] = len(counts) + np.arange(len(whole))
        runs = binaries(np.concatenate([ids, *extra, np.array([end_id or 0], np.uint16)]), np.concatenate([counts, np.array([*map(len, extra), 1], np.int64)]))
        if end_id is not None:
            index = np.insert(index, offsets[1:], len(runs) - 1)
            offsets = offsets + np.arange(len(offsets))
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + STEP, side="right")) - 1)
            ids, counts = _joined(runs, index[offsets[first] : offsets[last]])
            total = np.concatenate([[0], np.cumsum(counts)])
            yield first, last, ids, np.diff(total[offsets[first : last + 1] - offsets[first]])
            first = last


_encoders: dict[str, ColumnEncoder] = {}


def encode_column(path: str, texts: pa.Array, end_id: int | None = None, most: int = WORDS, step: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """:meth:`ColumnEncoder.encode` with one encoder for each file and Python worker; the first call decides on ``most``."""
    if path not in _encoders:
        _encoders[path] = ColumnEncoder(path, most)
    return _encoders[path].encode(texts, end_id, step)
