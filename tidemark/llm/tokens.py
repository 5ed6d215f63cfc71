"""Token ids of whole texts by the ``tokenizers`` library, once per distinct word.

The vocabulary's normaliser and pre-tokeniser never join characters across
white space, so a text's ids are its words' ids one after the other.  A batch
is therefore split into words and every distinct word is encoded once.  A word
of Latin letters followed by ASCII punctuation (nearly all words) is encoded
by the library's model directly, letters and punctuation apart, because its
normal form is known: lower case.  Any other word goes through the whole
tokenizer.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters whose normal form is their lower-case letter, and ASCII punctuation.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PUNCTUATION = r"!-/:-@\[-`{-~"
SENTENCE_END = r"[.!?…]+[\"')\]»”’]*$"
#: Distinct pieces whose ids are kept from one batch of a task to the next, about.
CACHE = 100_000


class WordEncoder:
    """Encodes Arrow string arrays; one per Python worker and vocabulary."""

    _by_path: dict[str, "WordEncoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.as_bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}  # the model sees bytes as letters
        self.kept: dict[str, tuple[int, ...]] = {"": ()}

    @classmethod
    def get(cls, path: str) -> "WordEncoder":
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def forget(self) -> None:
        self.kept = {"": ()}

    def _pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of single pre-tokens in normal form."""
        if len(self.kept) > CACHE:
            self.forget()
        kept, tokenize, as_bytes = self.kept, self.model.tokenize, self.as_bytes
        kept.update({p: tuple([t.id for t in tokenize(p if p.isascii() else p.translate(as_bytes))]) for p in pieces if p not in kept})
        return [kept[p] for p in pieces]

    def _ragged(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and counts of distinct words."""
        plain = pc.match_substring_regex(words, f"^[{LETTERS}]*[{PUNCTUATION}]*$").to_numpy(zero_copy_only=False)
        chosen = words.filter(pa.array(plain))
        lower = pc.utf8_lower(pc.replace_substring_regex(chosen, f"[{PUNCTUATION}]+$", "")).dictionary_encode()
        marks = pc.replace_substring_regex(chosen, f"^[{LETTERS}]+", "").dictionary_encode()
        rest = [e.ids for e in self.whole.encode_batch_fast(words.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)]
        pools = [self._pieces(lower.dictionary.to_pylist()), self._pieces(marks.dictionary.to_pylist()), rest]
        flat, sizes = self._ragged([ids for pool in pools for ids in pool])
        starts = np.cumsum(sizes) - sizes
        first = np.full((len(words), 2), -1, np.int64)
        first[plain, 0] = lower.indices.to_numpy()
        first[plain, 1] = marks.indices.to_numpy() + len(pools[0])
        first[~plain, 0] = np.arange(len(rest)) + len(pools[0]) + len(pools[1])
        parts = first.ravel()
        parts = parts[parts >= 0]
        counts = np.where(first >= 0, sizes[first], 0).sum(axis=1)
        return flat[spread(starts[parts], sizes[parts])], counts

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts with ``end_id`` after each, ids per text, and where words end: token positions and whether a sentence ends there."""
        texts = pc.fill_null(texts, "")
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        per_text = pc.list_value_length(lists).to_numpy().astype(np.int64)
        coded = flat.dictionary_encode()
        words = coded.dictionary
        index = coded.indices.to_numpy().astype(np.int64)
        ids, counts = self._distinct(words) if len(words) else (np.empty(0, np.uint32), np.empty(0, np.int64))
        closes = pc.match_substring_regex(words, SENTENCE_END).to_numpy(zero_copy_only=False) if len(words) else np.empty(0, bool)
        starts = np.cumsum(counts) - counts
        # One more "word" after each text: the end id.
        ids, starts, counts = np.append(ids, np.uint32(end_id)), np.append(starts, len(ids)), np.append(counts, 1)
        closes = np.append(closes, False)
        at = np.cumsum(per_text)
        index = np.insert(index, at, len(words))
        sizes = counts[index]
        out = ids[spread(starts[index], sizes)]
        ends = np.cumsum(sizes)
        last = np.cumsum(per_text + 1) - 1
        return out, np.diff(ends[last], prepend=0), ends, closes[index]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + sizes[i] - 1``, one run after the other."""
    total = int(sizes.sum())
    out = np.ones(total, np.int64)
    full = sizes > 0
    starts, sizes = starts[full], sizes[full]
    if not total:
        return out
    heads = np.cumsum(sizes) - sizes
    out[0] = starts[0]
    out[heads[1:]] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
    return np.cumsum(out)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; it is read where it lies, never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


