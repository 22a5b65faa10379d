"""Encoding of whole texts with public tokenizers, reusing the ids of chunks seen before.

A text is cut only where the tokenizer's own splitting always cuts, so that the ids of the pieces, put
together, are the ids of the text; texts with other white space than single spaces and newlines, and texts that
hold one of the tokenizer's special strings, go to it whole. Ids of chunks are kept in a table of bounded size.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of any kind, and the glue, but for single spaces and newlines between other characters.
_ODD_SPACE = r"[ \n][ \n]|^ | $|[\x01\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"

#: Begins a chunk that no space comes before.
GLUE = "\x01"


class ChunkEncoder:
    """encode(texts) gives all ids in a row and the number of each text's ids."""

    def __init__(self, path: str, max_entries: int = 400_000, step_chars: int = 6_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()]
        #: Texts that may hold an added token, whatever its case.
        self.special = "(?i)" + "|".join(special) if special else None
        self.max_entries, self.step_chars = max_entries, step_chars
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        self.spaced = np.zeros(self.size, bool)
        for token, i in vocab.items():
            self.spaced[i] = token.startswith("Ġ")
        #: Space is part of the token that follows it, or is dropped.
        self.keeps_space = self._ids([" a"])[0].tolist() != self._ids(["a"])[0].tolist()
        mark = self._ids(["\n" if self.keeps_space else GLUE])[0]
        self.mark = int(mark[0]) if len(mark) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.table: dict[str, int] = {}
        self.starts, self.sizes, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.uint32), 0
        self.hits = np.zeros(1024, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, first: int, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Give the entries from first on their ids."""
        end = first + len(sizes)
        while end > len(self.starts):
            self.starts, self.sizes, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.hits))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[first:end] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:end] = sizes
        self.used += len(ids)

    def _chunk(self, word: str) -> str:
        if not self.keeps_space or word[:1] == "\n":
            return word
        return word[1:] if word[:1] == GLUE else " " + word

    def _joined(self, words: list[str], begin: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, encoded as one text and told apart by how each begins or by a mark between them."""
        if not self.keeps_space:
            ids = self._ids([f" {GLUE} ".join(words)])[0]
            marks = np.flatnonzero(ids == self.mark)
            return np.delete(ids, marks), np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
        ids = self._ids([begin + begin.join(words)])[0]
        begins = np.flatnonzero(self.spaced[ids] if begin else ids == self.mark)
        return ids, np.diff(np.append(begins, len(ids)))

    def _learn(self, words: list[str]) -> None:
        """New entries for words."""
        if self.mark is None:
            return self._add(words, *self._single(words))
        kinds: dict[str, list[str]] = {" ": [], "": [], GLUE: []}
        for w in words:
            kinds[GLUE if GLUE in w or w in ("", "\n") else "" if w[0] == "\n" else " "].append(w)
        if odd := kinds.pop(GLUE):
            self._add(odd, *self._single(odd))
        for begin, own in kinds.items():
            for i in range(0, len(own), 20_000):
                part = own[i : i + 20_000]
                ids, sizes = self._joined(part, begin)
                self._add(part, *((ids, sizes) if len(sizes) == len(part) else self._single(part)))

    def _single(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self._ids([self._chunk(w) for w in words])
        return np.concatenate(each), np.array([len(x) for x in each])

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.table)
        self._store(first, ids, sizes)
        self.table.update(zip(words, range(first, first + len(words)), strict=True))

    def _forget(self, most: int) -> None:
        """Keep the chunks that were met most often, at most so many, and none that was met once.

        Their strings are made anew after all others have gone, so that the memory of these is given back.
        """
        order = np.argsort(-self.hits[: len(self.table)], kind="stable")[:most]
        chosen = np.zeros(len(self.table), bool)
        chosen[order[self.hits[order] > 1]] = True
        words = [w for w, at in self.table.items() if chosen[at] and "\0" not in w]
        at = np.fromiter(map(self.table.__getitem__, words), np.int64, len(words))
        size = self.sizes[at]
        ids = self.flat[np.repeat(self.starts[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        joined, n = "\0".join(words), len(words)
        del words
        self._clear()
        if n:
            self._add(joined.split("\0"), ids, size)

    def rest(self, most: int = 150_000) -> None:
        """Be small until the next task."""
        if len(self.table) > most:
            self._forget(most)
        pa.default_memory_pool().release_unused()

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        ids, sizes, i = [], [], 0
        chars = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else []
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(chars, (chars[i - 1] if i else 0) + self.step_chars, "right")))
            a, b = self._step(texts.slice(i, j - i))
            ids.append(a), sizes.append(b)
            i = j
        return (np.concatenate(ids), np.concatenate(sizes)) if ids else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Places of the texts that can't be cut."""
        patterns = [_ODD_SPACE] * self.keeps_space + [self.special] * (self.special is not None)
        found = np.zeros(len(texts), bool)
        for p in patterns:
            found |= pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False)
        return np.flatnonzero(found)

    def _step(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.table) > self.max_entries:
            self._forget(self.max_entries // 3)
        odd = self._whole(texts)
        whole = [(int(k), texts[int(k)].as_py()) for k in odd]
        if whole:
            keep = np.ones(len(texts), bool)
            keep[odd] = False
            texts = pc.if_else(pa.array(keep), texts, "")
        if self.keeps_space:
            # a chunk that begins a line has its newline; one more newline before the text goes again below
            texts = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
            texts = pc.replace_substring_regex(texts, "([a-z])([.,]+)( |$)", rf"\1 {GLUE}\2\3")
        else:
            # the tokenizer lower-cases, and parts letters from punctuation
            texts = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
            texts = pc.replace_substring_regex(texts, "([a-z])([.,]+) ", r"\1 \2 ")
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        own = np.fromiter(map(self.table.get, words, itertools.repeat(-1)), np.int64, len(words))
        if len(missing := np.flatnonzero(own < 0)):
            new = [words[k] for k in missing.tolist()]
            self._learn(new)
            own[missing] = np.fromiter(map(self.table.__getitem__, new), np.int64, len(new))
        at = own[coded.indices.to_numpy()]
        bounds = bounds - bounds[0]
        self.hits[own] += np.bincount(coded.indices.to_numpy(), minlength=len(own))
        if whole:
            each = self._ids([t for _, t in whole])
            if self.keeps_space:
                newline = self._ids(["\n"])[0]
                each = [np.concatenate([newline, x]) for x in each]
            used, first = self.used, len(self.table)
            self._store(first, np.concatenate(each), np.array([len(x) for x in each]))
            at[bounds[[k for k, _ in whole]]] = np.arange(first, first + len(each))
        size = self.sizes[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.starts[at] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        if whole:
            self.used = used  # texts aren't kept
        marks = np.concatenate([[0], ends])[bounds]
        if self.keeps_space:
            return np.delete(ids, marks[:-1]), np.diff(marks) - 1
        return ids, np.diff(marks)


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The id end after each text's ids."""
    return np.insert(ids, np.cumsum(sizes), end).astype(np.uint32), sizes + 1


def id_type(vocabulary: int, end_id: int) -> np.dtype:
    """Little-endian unsigned type that holds all ids."""
    return np.dtype("<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4")


def as_binary(ids: np.ndarray, sizes: np.ndarray, kind: np.dtype) -> pa.Array:
    """A binary value of kind for each text's ids."""
    ends = np.concatenate([[0], np.cumsum(sizes) * kind.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype(kind))])


@functools.lru_cache(4)
def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process, so that tasks share what it has learnt."""
    return ChunkEncoder(path)
