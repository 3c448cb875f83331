"""Byte-level BPE by forced boundaries.

A merge joins two neighbouring tokens into one of the vocabulary, so two bytes that stand side by side in no token can
never come into one: between them is a certain cut, and what lies on either side is encoded by itself. The table of
such byte pairs is made from the vocabulary. It cuts twice. First a whole text, vectorised, at the certain cuts between
anything and a white-space byte; the pattern that splits a text into words never matches across these either, so each
fragment (white space and what follows) can be looked up among those already encoded. Then, for a new fragment, every
word of it at all its certain cuts; only these last pieces are merged, pair by pair.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.kept import giving_back, kept

# Fixed value: the public byte-level pattern for words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT = 300_000
SHORT = 32
BITS = 32
MASK = (1 << BITS) - 1
NONE = 1 << 62


def byte_letters() -> dict[str, int]:
    """Letter to byte of the byte-level alphabet: printable bytes stand for themselves, the others for 256 and up, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder for a tokenizer file with byte-level BPE, no normaliser and no prefix space."""

    def __init__(self, tokenizer: str):
        self.tokenizer = tokenizer
        made = json.loads(tokenizer)
        if made["model"]["type"] != "BPE" or made["normalizer"] or made["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("byte-level BPE without normaliser and prefix space is asked for")

    def __getstate__(self):
        return {"tokenizer": self.tokenizer}

    def here(self) -> ByteBpe:
        """The one of this process, with the fragments it already knows."""
        return kept("bytes", self.tokenizer, lambda: self)

    @cached_property
    def parts(self) -> dict:
        return json.loads(self.tokenizer)

    @cached_property
    def token_bytes(self) -> dict[int, bytes]:
        letters = byte_letters()
        own = {i: bytes(letters[c] for c in token) for token, i in self.parts["model"]["vocab"].items()}
        return own | {a["id"]: a["content"].encode() for a in self.parts["added_tokens"]}

    @cached_property
    def byte_ids(self) -> list[int]:
        vocab = self.parts["model"]["vocab"]
        by_byte = {b: vocab[c] for c, b in byte_letters().items()}
        return [by_byte[b] for b in range(256)]

    @cached_property
    def merges(self) -> dict[int, int]:
        """Left id and right id, in one number, to rank and id of both together, in one number that sorts by rank."""
        vocab, out = self.parts["model"]["vocab"], {}
        for rank, (left, right) in enumerate(self.parts["model"]["merges"]):
            out.setdefault(vocab[left] << BITS | vocab[right], rank << BITS | vocab[left + right])
        return out

    @cached_property
    def special(self):
        contents = [a["content"] for a in self.parts["added_tokens"]]
        return regex.compile("(" + "|".join(regex.escape(c) for c in sorted(contents, key=len, reverse=True)) + ")") if contents else None

    @cached_property
    def special_ids(self) -> dict[str, int]:
        return {a["content"]: a["id"] for a in self.parts["added_tokens"]}

    @cached_property
    def never(self) -> np.ndarray:
        """[left byte, right byte]: whether no token holds the two side by side."""
        out = np.ones((256, 256), bool)
        letters = byte_letters()
        for token in self.parts["model"]["vocab"]:
            own = np.array([letters[c] for c in token], np.uint8)
            out[own[:-1], own[1:]] = False
        return out

    @cached_property
    def never_pairs(self) -> bytes:
        return self.never.astype(np.uint8).tobytes()

    @cached_property
    def before_space(self) -> np.ndarray:
        """Certain cuts between another byte and a white-space byte."""
        space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        return self.never & space[None, :] & ~space[:, None]

    @cached_property
    def words(self):
        return regex.compile(PATTERN)

    @cached_property
    def fragments(self) -> dict[bytes, bytes]:
        return {}

    @cached_property
    def pieces(self) -> dict[bytes, bytes]:
        return {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the pair of least rank is joined, leftmost first, until no pair is in the vocabulary."""
        ids, get = [self.byte_ids[b] for b in piece], self.merges.get
        if len(ids) > SHORT:
            return self._merge_long(ids)
        found = [get(a << BITS | b, NONE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != NONE:
            at = found.index(best)
            ids[at:at + 2] = [best & MASK]
            del found[at]
            if at:
                found[at - 1] = get(ids[at - 1] << BITS | ids[at], NONE)
            if at < len(found):
                found[at] = get(ids[at] << BITS | ids[at + 1], NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over a heap of pairs and a linked list, n log n."""
        merges, n = self.merges, len(ids)
        left, right, heap = list(range(-1, n - 1)), list(range(1, n + 1)), []

        def push(i: int) -> None:
            j = right[i]
            if j < n and (found := merges.get(ids[i] << BITS | ids[j])) is not None:
                heapq.heappush(heap, (found >> BITS, i, ids[i], ids[j], found & MASK))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, both = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = both, -1, right[j]
            if right[i] < n:
                left[right[i]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return [i for i in ids if i >= 0]

    def _cut(self, word: bytes) -> list[bytes]:
        """A word at all its certain cuts."""
        if len(word) > SHORT:
            view = np.frombuffer(word, np.uint8)
            cuts = (np.flatnonzero(self.never[view[:-1], view[1:]]) + 1).tolist()
        else:
            never = self.never_pairs
            cuts = [i for i in range(1, len(word)) if never[word[i - 1] << 8 | word[i]]]
        return [word[start:end] for start, end in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def _new_fragment(self, fragment: bytes) -> bytes:
        out, known = [], self.pieces
        for text in self.words.findall(fragment.decode("utf-8")):
            word = text.encode("utf-8")
            own = known.get(word)
            if own is None:
                parts = []
                for piece in self._cut(word):
                    part = known.get(piece)
                    if part is None:
                        part = array("I", self.merge(piece)).tobytes()
                        if len(piece) <= SHORT:
                            known[piece] = part
                    parts.append(part)
                own = b"".join(parts)
                if len(word) <= SHORT:
                    known[word] = own
            out.append(own)
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        view = np.frombuffer(data, np.uint8)
        cuts = (np.flatnonzero(self.before_space[view[:-1], view[1:]]) + 1).tolist()
        known, out = self.fragments, []
        for start, end in zip([0, *cuts], [*cuts, len(data)]):
            fragment = data[start:end]
            ids = known.get(fragment)
            if ids is None:
                ids = self._new_fragment(fragment)
                if end - start <= 4 * SHORT:
                    known[fragment] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        """uint32 ids of a whole text."""
        if len(self.fragments) > KEPT:
            self.fragments.clear()
        if len(self.pieces) > KEPT:
            self.pieces.clear()
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._plain(text) if text else b"", "<u4")
        parts = [np.array([self.special_ids[p]], "<u4").tobytes() if p in self.special_ids else self._plain(p)
                 for p in self.special.split(text) if p]
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, special tokens included; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _ids_column(all_ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in all_ids])]).astype(np.int32)
    flat = np.concatenate(all_ids).astype(np.int32) if all_ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


STEP = 512


def encoded(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """doc_id, ids (array<int>) of every whole text, one row per row; with `decode` also the text its ids give back.

    A null text counts as empty and has no ids; a null id stays null. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe.here()
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
                texts = [pa.array([own.decode(i) for i in ids], pa.string())] if decode else []
                yield pa.RecordBatch.from_arrays([batch.column(0), _ids_column(ids), *texts], names)

    names = ["doc_id", "ids"] + ["decoded"] * decode
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        giving_back(run), "doc_id long, ids array<int>" + ", decoded string" * decode)
