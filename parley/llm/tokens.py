"""Token ids of whole texts, word by word.

For tokenizers whose pre-tokenizer drops white space and keeps runs of letters
apart from punctuation, the ids of a text are the ids of its words in a row,
and those of a word of letters with punctuation behind it are the ids of both
parts, provided that the letters are still letters once they are normalised
and in lower case: a mark that comes out joins what follows.  Arrow splits and dictionary-encodes the words of a slice of rows, one
search in sorted hashes finds those seen before, only the others go through the
tokenizer, and one gather puts the ids together.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parley.llm.common import worker_kept

SLICE_BYTES = 1_000_000
# Letters (lower-cased in A-Z by the tokenizer anyway), then ASCII punctuation
# other than the apostrophe, which starts contractions.
PARTS = r"^\p{L}+[!#$%&()*+,./:;=?@_|~-]*$"
TAIL = r"[!#$%&()*+,./:;=?@_|~-]+$"
JOINED = 64  # new words that go through the tokenizer as one text
LEARNT = 16_384  # new words that go through it in one call
CACHED_WORDS = 500_000


def default_tokenizer() -> str:
    """Path of the tokenizer file the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def odd_letters() -> str:
    """A pattern of the letters whose composed, lower-cased form is not all
    letters (some 60, such as the capital I with a dot)."""
    odd = []
    for code in range(128, 0x110000):
        c = chr(code)
        if unicodedata.category(c)[0] == "L":
            form = unicodedata.normalize("NFC", c).lower()
            if form != c and any(unicodedata.category(x)[0] != "L" for x in form):
                odd.append(c)
    return "[" + "".join(odd) + "]"


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: its bytes times powers of an odd number."""
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    if not len(words) or offsets[-1] == offsets[0]:
        return np.zeros(len(words), np.uint64)
    data = np.frombuffer(words.buffers()[2], np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0]))
    starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place])])
    h = sums[ends] - sums[starts]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


class WordEncoder:
    """Ids per word, remembered for at most ``CACHED_WORDS`` words."""

    def __init__(self, path: str):
        # A task has the cores that Spark gives it; threads of the tokenizer
        # beside them would keep memory of their own in every worker.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().items()
        plain = [(i, t.content) for i, t in added if t.special and not (t.lstrip or t.rstrip or t.normalized or t.single_word)]
        # A special token splits a text before anything else happens to it.
        self.mark = min(plain, default=None)
        self.odd = odd_letters()
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.string())
        # The words' hashes in order, and the words' numbers in that order.
        self.hashes = np.zeros(0, np.uint64)
        self.by_hash = np.zeros(0, np.int64)
        self.end_numbers: dict[int, int] = {}
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def learn(self, words: list[str]) -> None:
        """Run new words through the tokenizer, many at once between marks."""
        number, text = self.mark if self.mark is not None else (None, None)
        alone = [w for w in words if text is None or text in w]
        if alone:
            coded = self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in coded])
            self.add(alone, ids, np.array([len(e.ids) for e in coded], np.int64))
            words = [w for w in words if text is not None and text not in w]
        if not words:
            return
        chunks = [text.join([*words[i : i + JOINED], ""]) for i in range(0, len(words), JOINED)]
        coded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in coded])
        ends = np.flatnonzero(ids == number)
        self.add(words, ids[ids != number], np.diff(ends, prepend=-1) - 1)

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        total, n = len(ids), len(self.words)
        while len(self.pool) < self.used + total:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.starts) < n + len(words):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.pool[self.used : self.used + total] = ids
        self.lengths[n : n + len(words)] = lengths
        self.starts[n : n + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.used += total
        fresh = pa.array(words, pa.string())
        self.words = pa.concat_arrays([self.words, fresh])
        hashes = word_hashes(fresh)
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.by_hash = np.insert(self.by_hash, at, n + order)

    def known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the words' numbers, whether each is known).  A hash only proposes
        a word: the words themselves are compared."""
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.hashes, word_hashes(words)), len(self.hashes) - 1)
        numbers = self.by_hash[at]
        same = pc.equal(self.words.take(pa.array(numbers)), words)
        return numbers, same.to_numpy(zero_copy_only=False)

    def number_of(self, words: pa.Array) -> np.ndarray:
        """The words' numbers, new ones learnt: one lookup for all words."""
        numbers, found = self.known(words)
        if not found.all():
            missing = words.filter(pa.array(~found))
            new = missing.to_pylist()
            first = len(self.words)
            for i in range(0, len(new), LEARNT):
                self.learn(new[i : i + LEARNT])
            again, learnt = self.known(missing)
            if not learnt.all():  # two words of one hash: by their places
                places = {w: first + i for i, w in enumerate(self.words.slice(first).to_pylist())}
                again = np.array([places[w] for w in new], np.int64)
            numbers[~found] = again
        return numbers

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets per text); ``end_id`` closes
        each text, NULL is the empty text."""
        if len(self.words) > CACHED_WORDS:
            self.forget()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        vocabulary = coded.dictionary
        # Each word in two parts; a word of another form is whole, with nothing behind it.
        in_parts = pc.match_substring_regex(vocabulary, PARTS)
        in_parts = pc.and_not(in_parts, pc.match_substring_regex(vocabulary, self.odd))
        body = pc.if_else(in_parts, pc.ascii_lower(pc.replace_substring_regex(vocabulary, TAIL, "")), vocabulary)
        tail = pc.if_else(in_parts, pc.replace_substring_regex(vocabulary, r"^\p{L}+", ""), "")
        parts = np.empty((len(vocabulary), 2), np.int64)
        for i, column in enumerate((body, tail)):
            unique = column.dictionary_encode()
            parts[:, i] = self.number_of(unique.dictionary)[unique.indices.to_numpy()]
        if end_id not in self.end_numbers:
            self.end_numbers[end_id] = len(self.words)
            self.add([f" {end_id}"], np.array([end_id], np.uint32), np.array([1], np.int64))  # no word holds a space
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets = 2 * (offsets - offsets[0])
        which = parts[coded.indices.to_numpy()].reshape(-1)
        which = np.insert(which, offsets[1:], self.end_numbers[end_id])
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        at = np.repeat((self.starts[which] - (ends - lengths)).astype(np.int32), lengths)
        at += np.arange(len(at), dtype=np.int32)
        ids = self.pool[at]
        word_ends = np.concatenate([np.zeros(1, np.int64), ends])
        return ids, word_ends[offsets + np.arange(len(offsets))]


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker process, kept from task to task."""
    kept = worker_kept()
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def text_slices(batch: pa.RecordBatch, text: int = 1, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + size, side="right")))
        yield batch.slice(first, last - first)
        first = last
