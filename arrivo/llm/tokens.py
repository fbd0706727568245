"""Token ids of many texts at once, with a public tokenizer file.

The tokenizer splits at white space before anything else and drops it, so the ids of a text are those of its words in
a row: each distinct word of a piece is encoded once by the library, and the ids of the texts are gathered from that.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from arrivo.llm.words import Words

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CACHE_WORDS = 400_000
RUN_WORDS = 200
PIECE_BYTES = 8 << 20  # of text encoded at a time
_encoders: dict[str, "Encoder"] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


# Letters, then ASCII marks without an apostrophe: the tokenizer takes them for two pieces, whatever the case.
PLAIN = r"^(?P<core>\p{L}+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"


class Encoder:
    """Ids per distinct word. Plain words are looked up in lower case and without the marks after them; new ones are
    encoded many at a time, in one text, and told apart by the ids that end a word.

    Known words are an Arrow array beside their ids, looked up for all words of a piece at once. Beyond `CACHE_WORDS` of
    them, the half that was used last stays.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = self._word_ends()
        self.known = pa.array([], pa.string())
        self.flat = np.zeros(0, np.int32)
        self.width, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.rounds = 0

    def _word_ends(self) -> np.ndarray | None:
        """By id: closes a word. None where the vocabulary does not mark that."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        names = self.tokenizer.get_vocab()
        out = np.zeros(max(names.values()) + 1, bool)
        for name, number in names.items():
            out[number] = name.endswith(suffix)
        return out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words in a row, and how many each has. A run of plain words has one closing id for each; where the
        numbers differ (a letter whose lower case is not a letter alone), the words of that run are encoded one by one."""
        if not plain or self.ends_word is None:
            lists = self._ids(words)
            return np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))
        flat, width = [], []
        runs = [words[at : at + RUN_WORDS] for at in range(0, len(words), RUN_WORDS)]
        for run, ids in zip(runs, self._ids([" ".join(run) for run in runs])):
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            sizes = np.diff(ends, prepend=0)
            if len(ends) != len(run) or ends[-1] != len(ids):
                ids, sizes = self._encode(run, False)
            flat.append(ids)
            width.append(sizes)
        return np.concatenate(flat), np.concatenate(width)

    def _forget(self) -> None:
        if len(self.known) > CACHE_WORDS:
            keep = np.sort(np.argsort(-self.used, kind="stable")[: CACHE_WORDS // 2])
            self.flat = gathered(self.flat, self.width, keep)
            self.known, self.width, self.used = self.known.take(pa.array(keep)), self.width[keep], self.used[keep]

    def places(self, words: pa.Array, plain: np.ndarray) -> np.ndarray:
        """Where each of these words stands among the known ones, new ones included."""
        found = pc.index_in(words, value_set=self.known)
        at = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(at < 0)
        for some, kind in ((missing[plain[missing]], True), (missing[~plain[missing]], False)):
            if len(some):
                new = words.take(pa.array(some))
                flat, width = self._encode(new.to_pylist(), kind)
                at[some] = len(self.known) + np.arange(len(some))
                self.known = pa.concat_arrays([self.known, new])
                self.flat, self.width = np.concatenate([self.flat, flat]), np.concatenate([self.width, width])
                self.used = np.concatenate([self.used, np.zeros(len(some), np.int64)])
        self.rounds += 1
        self.used[at] = self.rounds
        return at

    def word_ids(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        self._forget()
        parts = pc.extract_regex(pc.ascii_lower(vocabulary), PLAIN)
        plain = pc.is_valid(parts)
        cores = pc.if_else(plain, pc.struct_field(parts, "core"), vocabulary).dictionary_encode()
        tails = pc.if_else(plain, pc.struct_field(parts, "tail"), "").dictionary_encode()
        core, tail = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (cores, tails))
        words = pa.concat_arrays([cores.dictionary, tails.dictionary])
        is_plain = np.zeros(len(words), bool)
        is_plain[core[plain.to_numpy(zero_copy_only=False)]] = True
        at = self.places(words, is_plain)
        # a word is its core, then its tail
        halves = at[np.stack([core, tail + len(cores.dictionary)], 1)]
        return gathered(self.flat, self.width, halves.ravel()), self.width[halves].sum(1)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by `END_ID`, and where each text starts (one more at the end)."""
        words = Words(texts)
        if not len(words):
            return np.full(len(texts), END_ID, np.int32), np.arange(len(texts) + 1)
        flat, width = self.word_ids(words.vocabulary)
        ends = np.concatenate([[0], np.cumsum(width[words.codes])])[words.starts]
        starts = ends + np.arange(len(ends))
        ids = gathered(flat, width, words.codes)
        # an id goes one place further for every text before its own
        out = np.full(int(starts[-1]), END_ID, np.int32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(ends))] = ids
        return out, starts


def gathered(flat: np.ndarray, width: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The picked runs of `flat` in a row; run i has `width[i]` values."""
    length = width[picks]
    ends = np.cumsum(length)
    shift = (np.cumsum(width) - width)[picks] - (ends - length)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, length)]


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def id_lists(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))


def crc_of_lists(lists: pa.Array) -> np.ndarray:
    """Unsigned crc32 of each list as little-endian unsigned 32-bit numbers."""
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4")
    raw = memoryview(values).cast("B")
    return np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])), np.int64, len(lists))
