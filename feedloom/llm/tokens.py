"""Token ids from a public tokenizer: words as Arrow columns, distinct ones through a bounded cache."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Word pieces a task's cache holds between batches, bytes of text that are split at a time.
CACHE_WORDS = 700_000
CHUNK_BYTES = 12 << 20
# Words encoded in one call, words whose ids are gathered at a time.
LEARNED, GATHERED = 20_000, 1 << 20
# Texts that tell whether a tokenizer treats words, and the marks behind them, on their own.
APART = (("ab", " cd"), ("ab", "\n\t cd's"), ("Ab1", " é x"))
MARK = ".,;:?!#$%&*|"
MARKS = (("ab", ".,"), ("it's", "."), ("é", "...,"), ("Zz", ","), ("on", MARK), ("y", MARK[::-1]))
# Letters whose lower case is one of them as well; no mark joins them to another letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"


def ragged(flat: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``which`` of ``flat`` one after the other, and where each ends.

    Run ``i`` lies between ``ends[i]`` and ``ends[i + 1]``.
    """
    start = ends[which]
    size = ends[which + 1] - start
    stop = np.cumsum(size)
    kind = np.int32 if len(flat) < 1 << 31 and (not len(stop) or stop[-1] < 1 << 31) else np.int64
    at = np.repeat((start - (stop - size)).astype(kind), size)
    at += np.arange(len(at), dtype=kind)
    return flat[at], stop


class WordEncoder:
    """Ids of whole texts.

    Words between ASCII white space are told apart, and the distinct ones of a batch are encoded
    on their own. Closing marks after a letter are a piece of their own and words of ``LETTERS``
    are lower-cased where the tokenizer does the same, which is tried when the encoder is built.
    One that does not drop white space between words encodes whole texts. New pieces of letters
    alone are encoded in one string and told apart by the ids that end a word; if their number
    differs, each is encoded by itself. Lower-cased words of ``LETTERS`` go to a tokenizer that
    need not normalize or look for marks, if it gave the same ids for each letter.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        ends = [i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
                if t.endswith("</w>")]
        self.ends_word = np.zeros(self.size, bool)
        self.ends_word[ends] = True
        self.by_word = bool(ends) and all(self._plain(a + b) == self._plain(a) + self._plain(b)
                                          for a, b in APART)
        self.marks = all(self._plain(a + b) == self._plain(a) + self._plain(b) for a, b in MARKS)
        words = [*LETTERS, LETTERS, *(f"a{x}b" for x in LETTERS)]
        self.lower = all(self._plain(a.upper()) == self._plain(a) for a in words)
        self.quick = self._quick(path, words) or self.tokenizer
        self.limit = cache_words
        self.words, self.flat, self.ends = self._nothing()

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _quick(self, path: str, words: list[str]):
        """The tokenizer without normalizing, cut at spaces; None if it gives other ids."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        quick = Tokenizer.from_file(path)
        quick.normalizer = normalizers.Sequence([])
        steps = [pre_tokenizers.WhitespaceSplit()]
        if "ByteLevel" in repr(quick.pre_tokenizer):
            steps.append(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))
        quick.pre_tokenizer = pre_tokenizers.Sequence(steps)
        texts = [*words, " ".join(words)]
        same = all(quick.encode(x, add_special_tokens=False).ids == self._plain(x) for x in texts)
        return quick if same and self.lower else None

    def _nothing(self):
        # The empty piece comes first, so that it can stand for a missing one.
        return pa.array([""]), np.zeros(0, self.dtype), np.zeros(2, np.int64)

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each of the words, one after the other, and how many each has."""
        plain = pc.match_substring_regex(new, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False)
        alpha = pc.utf8_is_alpha(new).to_numpy(zero_copy_only=False)
        flats, sizes, places = [], [], []
        for tokenizer, which in ((self.quick, plain), (self.tokenizer, alpha & ~plain),
                                 (None, ~(alpha | plain))):
            at = np.flatnonzero(which)
            words = new.take(pa.array(at)).to_pylist()
            for lo in range(0, len(at), LEARNED):
                ids, own = self._ids(tokenizer, words[lo:lo + LEARNED])
                flats.append(ids)
                sizes.append(own)
            places.append(at)
        # Three kinds lie behind one another; bring them into the order of the words.
        order, size = np.concatenate(places), np.concatenate(sizes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ends = np.concatenate([[0], np.cumsum(size)])
        return ragged(np.concatenate(flats), ends, place)[0], size[place]

    def _ids(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if tokenizer is not None:
            ids = np.array(tokenizer.encode_batch_fast(
                [" ".join(words)], add_special_tokens=False)[0].ids, self.dtype)
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(words) and cuts[-1] == len(ids):
                return ids, np.diff(cuts, prepend=0)
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return (np.array([i for x in found for i in x], self.dtype),
                np.array([len(x) for x in found], np.int64))

    def _pieces(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Distinct pieces of distinct words, and two of them (one may be empty) per word."""
        body, tail = words, pa.repeat("", len(words))
        if self.marks:
            core = pc.utf8_rtrim(words, characters=MARK)
            split = pc.and_(pc.not_equal(core, words), pc.match_substring_regex(core, r"\p{L}$"))
            body = pc.if_else(split, core, words)
            tail = pc.if_else(split, pc.replace_substring_regex(words, r"^.*\p{L}", ""), "")
        if self.lower:
            plain = pc.match_substring_regex(body, f"^[{LETTERS}{LETTERS.upper()}]+$")
            body = pc.if_else(plain, pc.utf8_lower(body), body)
        both = pa.concat_arrays([body, tail]).dictionary_encode()
        return both.dictionary, both.indices.to_numpy().reshape(2, len(words)).T.ravel()

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one word after the other, and where they end."""
        pieces, at = self._pieces(words)
        known = pc.index_in(pieces, value_set=self.words)
        lacks = pc.is_null(known)
        new, known = pieces.filter(lacks), pc.fill_null(known, -1).to_numpy().copy()
        if len(new):
            ids, sizes = self._learn(new)
            if len(self.words) + len(new) > self.limit:  # keep what this batch uses
                held = known[known > 0]
                flat, stop = ragged(self.flat, self.ends, held)
                self.words = pa.concat_arrays([pa.array([""]), self.words.take(pa.array(held))])
                self.flat, self.ends = flat, np.concatenate([[0, 0], stop])
                known[known > 0] = np.arange(1, len(held) + 1)
            known[known < 0] = np.arange(len(self.words), len(self.words) + len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.flat = np.concatenate([self.flat, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        flat, stop = ragged(self.flat, self.ends, known[at])
        return flat, np.concatenate([[0], stop[1::2]])

    def encode_column(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per run of texts their ids, and where each text's begin and end (one more than texts).

        Null counts as empty. A run holds ``CHUNK_BYTES`` of text, or one longer text.
        """
        texts = pc.fill_null(texts, "")
        texts = texts.cast(pa.string()) if texts.type != pa.string() else texts
        size = np.cumsum(pc.binary_length(texts).to_numpy())
        lo = 0
        while lo < len(texts):
            done = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, done + CHUNK_BYTES, "right")))
            yield self._run(texts.slice(lo, hi - lo))
            lo = hi

    def _run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            found = [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(
                texts.to_pylist(), add_special_tokens=False)]
            return (np.concatenate(found), np.cumsum([0, *map(len, found)]))
        split = pc.ascii_split_whitespace(texts)
        first = split.offsets.to_numpy().astype(np.int64)
        words = split.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        at, first = words.indices.to_numpy(), first - first[0]
        flat, ends = self._of_words(words.dictionary)
        size = np.concatenate([[0], np.cumsum(np.diff(ends)[at])])
        out = np.empty(size[-1], self.dtype)
        for lo in range(0, len(at), GATHERED):
            own = ragged(flat, ends, at[lo:lo + GATHERED])[0]
            out[size[lo]:size[lo] + len(own)] = own
        return out, size[first]

    def encode(self, texts: list[str | None], chunk: int = CHUNK_BYTES) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``; ``chunk`` bounds a run's texts."""
        out = []
        for lo in range(0, len(texts), chunk):
            for ids, ends in self.encode_column(pa.array(texts[lo:lo + chunk], pa.string())):
                out += [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
