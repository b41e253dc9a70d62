"""Encodes texts with a public tokenizer file, each different word of a task once."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words a worker remembers; beyond that it starts afresh, so memory stays bounded.
REMEMBERED_WORDS = 200_000
# Text that is encoded at a time.
SLICE_BYTES = 4 << 20

# A Latin letter before ASCII punctuation always ends a word of these tokenizers
# (the apostrophe and the signs of special tokens are left out), and runs of these letters are
# always one word.
LETTER_THEN_MARK = r"([a-zA-ZÀ-ÖØ-öø-ÿ])([!-&(-/:;=-@\[-`{}~])"
SPECIAL_MARK = "<|"
LETTERS_ONLY = "^[a-zA-ZÀ-ÖØ-öø-ÿ]+$"


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of about `limit` bytes, one text at least."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


class WordEncoder:
    """Ids of whole texts, equal to the tokenizer's own `encode(text, add_special_tokens=False)`.

    The word tokenizers here drop white space and never look across it, so the ids of a text are
    those of its words in turn. Words are collected by Arrow, and only those not seen before in
    this task go through the tokenizer: plain letters as one joined text, whose word ends carry
    the end-of-word mark, the rest (special tokens too) one by one.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.whole.model)
        self.plain.normalizer = normalizers.Lowercase()
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        suffix = self.whole.model.end_of_word_suffix
        if not suffix:
            raise ValueError(f"{path} is not a tokenizer with word ends")
        vocabulary = self.whole.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = [np.zeros(0, dtype=np.int32)]
        self.lengths = [np.zeros(0, dtype=np.int64)]

    def learn(self, words: list[str]) -> None:
        """Encodes words that are new to this worker."""
        simple = np.asarray(pc.match_substring_regex(pa.array(words), LETTERS_ONLY))
        plain, other = list(compress(words, simple)), list(compress(words, ~simple))
        if plain:
            ids = np.array(
                self.plain.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids,
                dtype=np.int32,
            )
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(plain):
                raise ValueError("a plain word has more than one word end")
            self.ids.append(ids)
            self.lengths.append(np.diff(ends, prepend=0))
        if other:
            coded = [e.ids for e in self.whole.encode_batch_fast(other, add_special_tokens=False)]
            self.ids.append(np.array([i for ids in coded for i in ids], dtype=np.int32))
            self.lengths.append(np.array([len(ids) for ids in coded], dtype=np.int64))
        self.place.update(zip(plain + other, count(len(self.place))))
        self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none) one after another, and the number of each text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # Case does not matter but for the names of special tokens.
        texts = pc.if_else(pc.match_substring(texts, SPECIAL_MARK), texts, pc.ascii_lower(texts))
        spaced = pc.replace_substring_regex(texts, LETTER_THEN_MARK, r"\1 \2")
        words = pc.ascii_split_whitespace(spaced)
        coded = words.flatten().dictionary_encode()
        if len(self.place) > REMEMBERED_WORDS:
            self.forget()
        names, place = coded.dictionary.to_pylist(), self.place
        fresh = [name for name in names if name not in place]
        if fresh:
            self.learn(fresh)
        places = np.fromiter(map(place.__getitem__, names), dtype=np.int64, count=len(names))
        ids, lengths = self.ids[0], self.lengths[0]
        starts = np.cumsum(lengths) - lengths
        at = places[np.asarray(coded.indices)] if len(coded.indices) else np.zeros(0, np.int64)
        size = lengths[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        gathered = ids[np.repeat(starts[at] - (ends - size), size) + np.arange(total)]
        bounds = np.asarray(words.offsets, dtype=np.int64)
        bounds = bounds - bounds[0]
        per_text = np.diff(np.concatenate([[0], ends])[bounds])
        return gathered, per_text


@functools.lru_cache(maxsize=1)
def worker_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)
