"""Token ids of whole texts by the tokenizers library, each distinct word asked for once.

The vocabulary's pieces never hold white space, so a text's ids are those of its words in turn.
The words of a batch are numbered in Arrow together with those a worker has met, which come first
and so keep their numbers. Only new ones go to the library, and the ids of all words in turn are
one Arrow take. Kept words are bounded in number and length: longer ones are asked for in each
batch, and when there are too many only those of the last batch stay.
"""

from __future__ import annotations

from itertools import chain
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD_END = "</w>"  # how the vocabulary marks the last symbol of a word
KEPT_WORDS = 900_000
KEPT_BYTES = 48
WORDS_A_CALL = 4000
# Letters that Arrow lowers as the library does, and marks, which are one piece after letters;
# an apostrophe can be part of another piece
PLAIN = (
    "^(?P<base>[A-Za-zÀ-ÖØ-öø-ÿ]+)"
    r"(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
)
# Arrow takes these for white space, the tokenizer does not
SEPARATORS = "[\x1c-\x1f]"
NO_IDS = np.zeros(0, dtype="<u2")


def as_list(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()  # far faster than to_pylist


def as_binary(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Ids cut into the bytes of one word after the other."""
    offsets = 2 * np.concatenate([[0], cuts]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(cuts), buffers)


def in_halves(mask: pa.Array, yes: pa.Array, no: pa.Array) -> pa.Array:
    """The values of `yes` where the mask is true and those of `no` elsewhere, each in turn."""
    mask = np.asarray(mask)
    places = np.where(mask, np.cumsum(mask) - 1, len(yes) + np.cumsum(~mask) - 1)
    return pa.concat_arrays([yes, no]).take(pa.array(places))


class WordIds:
    """Ids below 2 ** 16 of texts, by one vocabulary."""

    def __init__(self, path: str = VOCABULARY):
        self.tokenizer = Tokenizer.from_file(path)
        # for words that normalising and cutting leave as they are, in the signs of byte level
        self.model = self.tokenizer.model
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # of the small letters of PLAIN beyond ASCII; no sign is one of these letters
        letters = map(chr, range(ord("ß"), ord("ÿ") + 1))
        self.signs = {c: byte_level.pre_tokenize_str(c)[0][0] for c in letters}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # words met before, and the ids of each as little-endian 16-bit numbers
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def ask_plain(self, words: pa.Array) -> pa.Array:
        """Small letters of PLAIN, by the library's model alone; the last id of each ends a word."""
        joined = " ".join(as_list(words))
        for letter, signs in self.signs.items():
            joined = joined.replace(letter, signs)
        tokens = chain.from_iterable(map(self.model.tokenize, joined.split()))
        ids = np.array(list(map(attrgetter("id"), tokens)), dtype="<u2")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            raise ValueError("the library did not give one end to each word")
        return as_binary(ids, cuts)

    def ask(self, words: list[str]) -> pa.Array:
        """The same for words of several pieces, told apart by where their ids come from."""
        parts, cuts, before = [NO_IDS], [np.zeros(0, dtype=np.int64)], 0
        for first in range(0, len(words), WORDS_A_CALL):
            some = words[first : first + WORDS_A_CALL]
            coded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in some])
            places = np.fromiter((a for a, _ in coded.offsets), dtype=np.int64)
            cuts.append(before + np.searchsorted(places, ends))
            parts.append(np.array(coded.ids, dtype="<u2"))
            before += len(places)
        return as_binary(np.concatenate(parts), np.concatenate(cuts))

    def of_words(self, words: pa.Array) -> pa.Array:
        """The ids of some different words as they stand in texts. Plain words are asked for by
        their letters and their marks."""
        parts = pc.extract_regex(words, PLAIN)
        plain = parts.is_valid()
        some = parts.filter(plain)
        bases = pc.utf8_lower(some.field("base")).dictionary_encode()
        marks = some.field("marks").dictionary_encode()
        return in_halves(
            plain,
            pc.binary_join_element_wise(
                self.ask_plain(bases.dictionary).take(bases.indices),
                self.ask(as_list(marks.dictionary)).take(marks.indices),
                pa.scalar(b"", pa.large_binary()),
            ),
            self.ask(as_list(words.filter(pc.invert(plain)))),
        )

    def numbered(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """A number for each word, and the ids by number."""
        kept = len(self.words)
        coded = pa.concat_arrays([self.words, words]).dictionary_encode()
        different = coded.dictionary.cast(pa.large_string())
        numbers, ids = coded.indices.slice(kept), self.ids
        if len(different) > kept:
            ids = pa.concat_arrays([ids, self.of_words(different.slice(kept))])
            keep = np.asarray(pc.binary_length(different)) <= KEPT_BYTES
            if int(keep.sum()) > KEPT_WORDS:
                last = np.zeros(len(different), dtype=bool)
                last[np.asarray(numbers)] = True
                keep &= last
                if int(keep.sum()) > KEPT_WORDS // 2:
                    keep[:] = False
            if keep.all():
                self.words, self.ids = different, ids
            else:
                keep = pa.array(keep)
                self.words, self.ids = different.filter(keep), ids.filter(keep)
        return numbers, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in turn (uint16), and how many each text has; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = np.asarray(pc.match_substring_regex(texts, SEPARATORS))
        if odd.any():
            return self.encode_odd(texts, odd)
        split = pc.utf8_split_whitespace(texts)
        numbers, ids = self.numbered(split.flatten())
        ids = ids.take(numbers)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset :][: len(ids) + 1]
        offsets = np.asarray(split.offsets)
        cuts = (ends if len(ends) else np.zeros(1, dtype=np.int64))[offsets - offsets[0]] // 2
        data = ids.buffers()[2]
        got = np.frombuffer(data, "<u2", int(cuts[-1] - cuts[0]), int(2 * cuts[0])) if data else NO_IDS
        return got, np.diff(cuts)

    def encode_odd(self, texts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same where some texts hold separators: the library gets these whole."""
        whole = self.tokenizer.encode_batch_fast(
            texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False
        )
        parts = np.empty(len(texts), dtype=object)
        parts[odd] = [None] * int(odd.sum())
        for at, coded in zip(np.flatnonzero(odd), whole):
            parts[at] = np.array(coded.ids, dtype="<u2")
        ids, lengths = self.encode(texts.filter(pa.array(~odd)))
        cuts = np.cumsum(lengths)
        for at, part in zip(np.flatnonzero(~odd), np.split(ids, cuts[:-1]) if len(cuts) else []):
            parts[at] = part
        return (
            np.concatenate([*parts, np.zeros(0, dtype="<u2")]),
            np.array([len(p) for p in parts], dtype=np.int64),
        )
