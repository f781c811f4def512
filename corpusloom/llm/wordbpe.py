"""Token ids by the tokenizers library, encoding each distinct word of some megabytes of text once.

The vocabulary's pre-tokenizer never joins what white space divides, and drops the white space, so the ids of a text
are the ids of its words in turn. Texts are taken together, up to ``CHUNK`` bytes of them; Arrow splits them and numbers
their distinct words, the library encodes each distinct word, and the ids of all texts are gathered from arrays.
Frequent words of the last chunk are kept for the next one, within ``MEMO`` words and ``MEMO_BYTES``.

Distinct words are encoded together in a few calls: words of letters only are told apart by the mark that ends a word
in this vocabulary, all others by a digit put between them, which the pre-tokenizer always splits off. ASCII punctuation
after a last letter is a pre-token of its own, so it is taken off first; only an apostrophe may belong to the letters
before it. For lower-case ASCII letters the normalizer and the byte mapping change nothing and are left out.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that are kept from one chunk to the next, and their bytes.
MEMO, MEMO_BYTES = 100_000, 4 << 20
#: Bytes of text that are taken together; a longer text is cut at white space.
CHUNK = 6 << 20
#: Words in one call of the library.
CALL = 40_000
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: Ids of several words: all ids, where each word's begin, how many they are.
Ids = tuple[np.ndarray, np.ndarray, np.ndarray]


def gather(ids: Ids, of: np.ndarray) -> Ids:
    """The ids of the words ``of``, one after the other."""
    flat, starts, sizes = ids
    size = sizes[of]
    ends = np.cumsum(size)
    at = np.repeat(starts[of] - (ends - size), size)
    at += np.arange(len(at))
    return flat[at], ends - size, size


def together(*parts: Ids) -> Ids:
    before = np.cumsum([0, *(len(p[0]) for p in parts)])
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + b for p, b in zip(parts, before)]), np.concatenate([p[2] for p in parts])


NONE: Ids = (np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _strings(words: pa.Array) -> list[str]:
    return [w.decode("utf-8", "replace") for w in words.view(pa.binary()).to_pylist()]


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        mark = rules["model"].get("end_of_word_suffix") or ""
        self.bare = Tokenizer.from_str(json.dumps(rules | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))  # for lower-case ASCII letters
        vocab = self.tokenizer.get_vocab()
        self.vocab_size = max(vocab.values()) + 1
        self.ends = np.zeros(self.vocab_size, bool)
        self.ends[[i for t, i in vocab.items() if mark and t.endswith(mark)]] = True
        self.dividers = {str(d): int(self._ids(str(d))[0]) for d in range(10)}
        if any(self._ids(f"a {d} b{d}").tolist().count(i) != 2 or self._ids(d).size != 1 for d, i in self.dividers.items()):
            raise ValueError(f"{path} does not split off digits")
        letters = "the quick brown foxes jumped over lazy dogs"
        if self._ids("Ab").tobytes() != self._ids("ab").tobytes() or self._ids("ab.;").tobytes() != self._ids("ab .;").tobytes() or self._ids(letters).tobytes() != self._ids(letters, True).tobytes() or not mark:
            raise ValueError(f"{path} does not lower-case and mark words as expected")
        self.known, self.known_ids = pa.array([], pa.string()), NONE

    def _ids(self, text: str, bare: bool = False) -> np.ndarray:
        return np.array((self.bare if bare else self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    @staticmethod
    def _cut(ids: np.ndarray, cuts: np.ndarray, skip: int, n: int) -> Ids:
        """n words whose ids lie between the cuts; ``skip`` ids after each cut belong to none."""
        if len(cuts) != n - 1:
            raise ValueError("the library joined or split words unexpectedly")
        starts = np.concatenate(([0], cuts + skip))
        return ids, starts, np.concatenate((cuts, [len(ids)])) - starts

    def _divided(self, words: list[str]) -> Ids:
        """Words of any kind: those without a digit d are put together with d between them."""
        parts, places, left = [], [], list(range(len(words)))
        for digit, own in self.dividers.items():
            plain, left = [k for k in left if digit not in words[k]], [k for k in left if digit in words[k]]
            for at in range(0, len(plain), CALL):
                some = plain[at : at + CALL]
                ids = self._ids(f" {digit} ".join([words[k] for k in some]))
                parts.append(self._cut(ids, np.flatnonzero(ids == own), 1, len(some)))
                places += some
        for k in left:
            ids = self._ids(words[k])
            parts.append((ids, np.zeros(1, np.int64), np.array([len(ids)])))
            places.append(k)
        if not parts:
            return NONE
        flat, starts, sizes = together(*parts)
        order = np.argsort(np.array(places))
        return flat, starts[order], sizes[order]

    def _letters(self, words: list[str], bare: bool) -> Ids:
        """Words of letters only; ``bare``: of lower-case ASCII letters."""
        parts = []
        for at in range(0, len(words), CALL):
            some = words[at : at + CALL]
            ids = self._ids(" ".join(some), bare)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            # where lower-casing made something else of a letter, there are more or fewer marks
            parts.append(self._cut(ids, cuts[:-1], 0, len(some)) if len(cuts) == len(some) else self._divided(some))
        return together(*parts) if parts else NONE

    def _learn(self, words: pa.Array) -> Ids:
        """The ids of distinct words: of each one's letters, of the punctuation after them, or of other words as they are."""
        stems = pc.ascii_rtrim(words, characters=PUNCTUATION)
        size = lambda a: pc.binary_length(a).to_numpy(zero_copy_only=False).astype(np.int64)
        plain = pc.ascii_is_alpha(stems).to_numpy(zero_copy_only=False)
        wide = np.flatnonzero(~pc.string_is_ascii(stems).to_numpy(zero_copy_only=False))
        wide_stems = stems.take(pa.array(wide)).dictionary_encode()
        spelled = _strings(wide_stems.dictionary)
        lettered = np.array([normalize("NFC", w).lower().isalpha() for w in spelled], bool)  # still letters when normalised
        is_letters = lettered[wide_stems.indices.to_numpy()] if len(wide) else np.zeros(0, bool)
        lower = pc.ascii_lower(stems.filter(pa.array(plain))).dictionary_encode()
        has_stem = plain.copy()
        has_stem[wide[is_letters]] = True
        tailed = np.flatnonzero(has_stem & (size(stems) < size(words)))
        tails = [w[len(s) :] for w, s in zip(*(a.take(pa.array(tailed)).view(pa.binary()).to_pylist() for a in (words, stems)))]
        number: dict[bytes, int] = {}
        of_tail = np.array([number.setdefault(t, len(number)) for t in tails], np.int64)
        other = np.flatnonzero(~has_stem)
        parts = [
            (np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)),  # the first unit has no ids
            self._letters(lower.dictionary.to_pylist(), True),
            self._letters([w for w, ok in zip(spelled, lettered) if ok], False),
            self._divided([t.decode() for t in number]),
            self._divided(_strings(words.take(pa.array(other)))),
        ]
        first = np.cumsum([0, *(len(p[1]) for p in parts)])
        units = np.zeros((len(words), 2), np.int64)
        units[plain, 0] = first[1] + lower.indices.to_numpy()
        units[wide[is_letters], 0] = first[2] + (np.cumsum(lettered) - 1)[wide_stems.indices.to_numpy()[is_letters]] if len(wide) else 0
        units[tailed, 1] = first[3] + of_tail
        units[other, 0] = first[4] + np.arange(len(other))
        flat, starts, sizes = gather(together(*parts), units.ravel())
        return flat, starts[::2], sizes[::2] + sizes[1::2]

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and where each text's end."""
        marked = pc.match_substring(texts, "<|")  # special tokens tell case apart
        split = pc.ascii_split_whitespace(pc.if_else(marked, texts, pc.ascii_lower(texts)))
        words = split.flatten()
        filled = pc.not_equal(words, "")  # before a first and after a last blank
        n_words = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))[split.offsets.to_numpy() - split.offsets[0].as_py()]
        words = words.filter(filled).dictionary_encode()
        distinct, of = words.dictionary, words.indices.to_numpy()
        place = pc.index_in(distinct, value_set=self.known)
        missing = place.is_null().to_numpy(zero_copy_only=False)
        ids = together(self.known_ids, self._learn(distinct.filter(pa.array(missing))))
        at = place.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[missing] = len(self.known) + np.arange(int(missing.sum()))
        flat, starts, _ = gather(ids, at[of])
        times = np.bincount(of, minlength=len(distinct))
        often = np.flatnonzero(times > 1)
        often = often[np.argsort(-times[often], kind="stable")[:MEMO]]
        often = often[np.cumsum(pc.binary_length(distinct).to_numpy(zero_copy_only=False)[often]) <= MEMO_BYTES]
        self.known, self.known_ids = distinct.take(pa.array(often)), gather(ids, at[often])
        return flat, np.append(starts, len(flat))[n_words[1:]]

    def encode_many(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            if len(texts[at]) > CHUNK:
                yield b"".join(self._encode_long(texts[at]))
                at += 1
                continue
            size, end = 0, at
            while end < len(texts) and size + len(texts[end]) <= CHUNK:
                size += len(texts[end])
                end += 1
            ids, ends = self._encode(pa.array(texts[at:end], pa.binary()).view(pa.string()))
            raw, start = ids.astype("<u4").tobytes(), 0
            for e in (4 * ends).tolist():
                yield raw[start:e]
                start = e
            at = end

    def _encode_long(self, text: bytes) -> Iterator[bytes]:
        """Parts of one text, cut before white space. Special tokens tell case apart in all parts or in none: they change nothing else."""
        at = 0
        while at < len(text):
            end = min((k for k in (text.find(w, at + CHUNK) for w in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) if k >= 0), default=len(text))
            yield self._encode(pa.array([text[at:end]], pa.binary()).view(pa.string()))[0].astype("<u4").tobytes()
            at = end

    def encode(self, text: bytes) -> bytes:
        return next(self.encode_many([text]))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
