"""Token ids of whole texts from the tokenizers library, each distinct word encoded once.

For a tokenizer that drops white space and never looks across it, the ids of a text are the ids of its blank-separated
words one after the other. A task keeps the ids of the words it has met (about KEPT of them) and asks the library only for
new ones, many in one call. Each some hundred texts are split and reduced to their distinct words by Arrow first.
"""

from __future__ import annotations

import os
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mercato.llm.kept import kept

KEPT = 1_000_000
AT_ONCE = 2000
TAIL = b".,;:!?"


def vocabulary(path: str, most: int = 64 << 20) -> str:
    """The tokenizer file's text, read on the driver and sent with the tasks. Its size is bounded by `most` bytes."""
    if os.path.getsize(path) > most:
        raise ValueError(f"{path} has over {most} bytes")
    with open(path, encoding="utf-8") as file:
        return file.read()


def _letters(core: bytes) -> bool:
    """Whether a word is letters alone, in lower case too (a letter may turn into a letter and a mark)."""
    text = core.decode("utf-8", "replace")
    return text.isalpha() and text.lower().isalpha()


class Slots(dict):
    """Word to its place in a list; a new word gets the next place."""

    def __init__(self, known: dict[bytes, int]):
        super().__init__(known)
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class WordTokens:
    def __init__(self, tokenizer: str, end_of_word: str = "</w>"):
        self.tokenizer, self.end_of_word = tokenizer, end_of_word
        self._forget()

    def _forget(self) -> None:
        self.slots, self.ids = Slots({b"": 0}), [b""]  # split texts begin or end with an empty word

    def __getstate__(self):
        return {"tokenizer": self.tokenizer, "end_of_word": self.end_of_word}

    def __setstate__(self, state):
        self.__init__(**state)

    def here(self) -> WordTokens:
        """The one of this process, with the words it already knows."""
        return kept("words", self.tokenizer + self.end_of_word, lambda: self)

    @cached_property
    def library(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.tokenizer)
        made.no_truncation()
        made.no_padding()
        return made

    @cached_property
    def closes(self) -> np.ndarray:
        """Whether an id ends a word."""
        vocab = self.library.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocab.values()) + 1, bool)
        out[[i for token, i in vocab.items() if token.endswith(self.end_of_word)]] = True
        return out

    def _call(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, cores: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that the library has to be asked for."""
        made, plain, other = {}, [], []
        for core in cores:
            (plain if core.isalpha() or _letters(core) else other).append(core)
        for at in range(0, len(plain), 4096):
            own = plain[at:at + 4096]
            ids = self._call([b" ".join(own).decode("utf-8")])[0]
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) == len(own) and ends[-1] == 4 * len(ids):
                data, stops = ids.tobytes(), ends.tolist()
                made.update(zip(own, [data[start:stop] for start, stop in zip([0, *stops], stops)]))
            else:
                other.extend(own)
        for at in range(0, len(other), 4096):
            own = other[at:at + 4096]
            for core, ids in zip(own, self._call([c.decode("utf-8", "replace") for c in own])):
                made[core] = ids.tobytes()
        return made

    @staticmethod
    def parts(word: bytes) -> list[bytes]:
        """A word and the marks that follow it, where no token can hold both."""
        core = word.rstrip(TAIL)
        if core.isalpha() or core and b"'" not in word and _letters(core):
            return [core.lower(), word[len(core):]] if len(core) < len(word) else [core.lower()]
        return [word]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        return self.encode_column(pa.array([text.encode("utf-8", "replace") for text in texts], pa.large_binary()).view(pa.large_string()))

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """uint32 ids of each text of an Arrow array of strings."""
        return [ids for at in range(0, len(texts), AT_ONCE) for ids in self._some(texts.slice(at, AT_ONCE))]

    def _some(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.slots) > KEPT:
            self._forget()
        place = self.slots.__getitem__
        split = pc.ascii_split_whitespace(texts)
        each = split.flatten().dictionary_encode()
        places = list(map(place, each.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False)))
        # New words, then the parts of them that are new as words themselves; only whole ones go to the library.
        pieces, at = [], 0
        while at < len(self.slots.new):
            pieces.append(self.parts(self.slots.new[at]))
            for part in pieces[-1]:
                place(part)
            at += 1
        new, known = self.slots.new, len(self.ids)
        made = self._learn([word for word, own in zip(new, pieces) if own == [word]])
        self.ids.extend([made.get(word) for word in new])
        for i, own in enumerate(pieces, known):
            if self.ids[i] is None:
                self.ids[i] = b"".join([self.ids[place(p)] for p in own])
        self.slots.new = []
        # The ids of the distinct words one after the other, then those of every word picked from there.
        own = list(map(self.ids.__getitem__, places))
        flat, sizes = np.frombuffer(b"".join(own), np.uint32), np.fromiter(map(len, own), np.int64, len(own)) // 4
        word = each.indices.to_numpy()
        starts, lengths = (np.cumsum(sizes) - sizes)[word], sizes[word]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = flat[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        return np.split(out, ends[split.offsets.to_numpy()[1:-1]])
