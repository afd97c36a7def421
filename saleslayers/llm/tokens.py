"""Token ids of whole texts from a public tokenizer, word by word with a memory of words already met."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered by a worker; beyond this number the memory is emptied. Bounds memory, never the result.
REMEMBERED = 1_000_000
#: Words handed to the tokenizer at once, and bytes of text whose words are looked up together.
AT_ONCE = 4096
TEXT_AT_ONCE = 4_000_000
#: ASCII marks but the apostrophe, which may belong to the letters around it.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of a text by a tokenizer whose pre-tokens never hold white space.

    Such a tokenizer gives a text the ids of its words, one after the other, so each distinct word
    is encoded once. That holds for tokenizers that drop white space, like word_bpe_49k.json; the
    result equals encoding the text whole, which the tests check.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self._tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._known: dict[bytes, bytes] = {}
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _each(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "replace") for w in words]
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.dtype).tobytes() for x in found]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters only: encoded as one text, whose ids part after each word's end."""
        text = b" ".join(words).decode("utf-8")
        ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words):  # a tokenizer without word ends, or another notion of letters
            return self._each(words)
        data, width = ids.tobytes(), self.dtype.itemsize
        at = [0, *(ends * width).tolist()]
        return [data[a:b] for a, b in zip(at, at[1:])]

    def _learn(self, words: set[bytes]) -> None:
        """The memory holds all these words afterwards, however many they are."""
        known = self._known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = words
        same, letters, others = {}, set(), set()
        for w in new:
            # A word of letters has the ids of its lower case, and the marks after it stand by themselves.
            core = w.rstrip(MARKS)
            mark = w[len(core) :]
            if core.isalpha():  # ASCII letters
                low = core.lower()
            else:
                text = core.decode("utf-8", "replace")
                if not text.isalpha() or max(text) > "\u012f":  # beyond, a lower case may depend on its place
                    others.add(w)
                    continue
                low = text.lower().encode()
            if low not in known:
                letters.add(low)
            if mark and mark not in known:
                others.add(mark)
            if low != w:
                same[w] = low, mark
        for kind, todo in ((self._letters, list(letters)), (self._each, list(others))):
            for i in range(0, len(todo), AT_ONCE):
                known.update(zip(todo[i : i + AT_ONCE], kind(todo[i : i + AT_ONCE])))
        for w, (low, mark) in same.items():
            known[w] = known[low] + known[mark] if mark else known[low]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string array; null is empty. Words part at ASCII white space only."""
        out, a = [], 0
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        while a < len(texts):
            done = sizes[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(sizes, done + TEXT_AT_ONCE, "right")))
            out += self._encode(pc.fill_null(texts.slice(a, b - a), ""))
            a = b
        return out

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
        self._learn(set(distinct) - {b""})
        found = [self._known[w] if w else b"" for w in distinct]
        ids = np.frombuffer(b"".join(found), dtype=self.dtype)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        starts = np.cumsum(lengths) - lengths
        word = coded.indices.to_numpy()
        sizes = lengths[word]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        # Each word's ids, one after the other: its start, and then one more for each further id.
        all_ids = ids[np.repeat(starts[word] - ends[:-1], sizes) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy()
        at = ends[offsets - offsets[0]]
        return [all_ids[x:y] for x, y in zip(at[:-1], at[1:])]


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder; kept between tasks."""
    return WordEncoder(path)
