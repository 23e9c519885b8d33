"""Token ids of whole texts with the ``tokenizers`` library, white-space word by word.

The tokenizer of the contract lower-cases, drops white space and never joins over it, so the ids of
a text are those of its words in order. Words repeat: a batch's words are made a dictionary, and
each worker keeps the ids of words it has met. A text with one of the four separators that Arrow
takes for white space and the tokenizer does not, or with a special token's mark, is encoded as a whole.
"""

from __future__ import annotations

import functools
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT_WORDS = 1_000_000
ODD = r"[\x1c-\x1f]|<\|"  # or what may be a special token, whose case counts
JOINED_WORDS = 2_000


def _letters(word: str) -> bool:
    """Whether the tokenizer sees letters only: its normalizer splits marks off some letters."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class WordEncoder:
    """Ids take 2 bytes if the vocabulary fits into them, else 4."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For words of a-z the normalizer and the byte alphabet change nothing: the model alone.
        self.letters = Tokenizer(Tokenizer.from_file(path).model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.marks = {m: self._one(m) for m in ".,"}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _one(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin (one more entry than texts).

        A null text counts as empty.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pa.concat_arrays([texts, texts.slice(0, 0)])  # a slice of its own, offsets from 0
        whole = pc.match_substring_regex(texts, ODD)
        if pc.any(whole).as_py():
            odd = {i: texts[i].as_py() for i in np.flatnonzero(whole.to_numpy(False)).tolist()}
            texts = pc.if_else(whole, "", texts)
        else:
            odd = {}
        split = pc.utf8_split_whitespace(pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        ids, starts, counts = self._table(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        lengths = counts[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(starts[codes] - (ends - lengths), lengths)
        take += np.arange(total, dtype=take.dtype)
        words_before = split.offsets.to_numpy() - split.offsets[0].as_py()
        offsets = np.concatenate(([0], ends))[words_before]
        return self._spliced(ids[take], offsets, odd)

    def _spliced(self, ids, offsets, odd) -> tuple[np.ndarray, np.ndarray]:
        if not odd:
            return ids, offsets
        parts = [
            np.frombuffer(self._one(odd[i]), self.dtype) if i in odd
            else ids[offsets[i]:offsets[i + 1]]
            for i in range(len(offsets) - 1)
        ]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def _table(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words one after another, where each word's begin and how many they are."""
        found = list(map(self.known.get, words))
        missing = [w for w, i in zip(words, found, strict=True) if i is None]
        if missing:
            stems, marked = self._learn(missing)
            found = [
                i if i is not None else stems[w] if w in stems else marked[w]
                for w, i in zip(words, found, strict=True)
            ]
            if len(self.known) + len(stems) > KEPT_WORDS:
                self.known = {"": b""}
            self.known.update(stems)
        counts = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        return np.frombuffer(b"".join(found), self.dtype), np.cumsum(counts) - counts, counts

    def _learn(self, words: list[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of new words, and those of letters with a full stop or comma at their end.

        The latter take the ids of their letters and are not worth keeping.
        """
        stem_of, new_stems, rest = {}, {}, []
        for word in words:
            body = word[:-1] if word[-1] in ".," else word
            if _letters(body):
                if body is not word:
                    stem_of[word] = body
                if body not in self.known:
                    new_stems[body] = body.isascii()
            else:
                rest.append(word)
        stems = self._joined([s for s, plain in new_stems.items() if plain], self.letters)
        stems |= self._joined([s for s, plain in new_stems.items() if not plain], self.tokenizer)
        known, marks = self.known, self.marks
        marked = {
            word: (stems[stem] if stem in stems else known[stem]) + marks[word[-1]]
            for word, stem in stem_of.items()
        }
        for i in range(0, len(rest), JOINED_WORDS):
            part = rest[i:i + JOINED_WORDS]
            coded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            stems.update((w, self._bytes(c.ids)) for w, c in zip(part, coded, strict=True))
        return stems, marked

    def _joined(self, words: list[str], tokenizer) -> dict[str, bytes]:
        """Ids of words of letters, many in one call, cut after each end-of-word id."""
        out: dict[str, bytes] = {}
        size = self.dtype.itemsize
        for i in range(0, len(words), JOINED_WORDS):
            part = words[i:i + JOINED_WORDS]
            coded = tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(coded[0].ids, dtype=self.dtype)
            stops = (np.flatnonzero(self.ends[ids]) + 1) * size
            if len(stops) != len(part):  # a letter that the tokenizer does not take for one
                out.update((w, self._one(w)) for w in part)
                continue
            raw, at = ids.tobytes(), 0
            for word, stop in zip(part, stops.tolist(), strict=True):
                out[word] = raw[at:stop]
                at = stop
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
