"""Whole texts to token ids with the ``tokenizers`` library, each distinct word once per batch.

A byte-level BPE cuts a text into pre-tokens before it merges, and a blank between two
visible characters always starts one. So a text may be cut there, and the parts be encoded
by themselves and kept; texts with other white space around a blank are encoded as a whole.
A tokenizer that drops white space may be cut at any blank.
"""

from __future__ import annotations

import re
from array import array
from codecs import charmap_decode
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from stepwise.llm.common import ragged

#: Parts kept by a worker; beyond it the table is started anew.
KEEP = 1_000_000
#: Pre-token patterns of the two kinds, as the tokenizer files state them (fixed values).
BLANK_KEPT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK_DROPPED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters on which all Unicode versions and both regex libraries agree; parts with others go to the library whole.
_PLAIN = re.compile(r"[\x21-\x7E\xA1-\xA9\xAE-\xB1\xB4-\xB8\xBB\xBF-\xFF]+")


def _byte_letters() -> list[str]:
    """The visible character that stands for each byte: itself, or one above 255 in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class IdRows:
    """Ids of parts in one flat array."""

    def __init__(self):
        self.flat, self.starts, self.sizes = array("I"), array("q"), array("I")
        self.whole = array("b")  # parts that a text must not be cut at

    def add(self, ids: list[int], whole: bool = False) -> int:
        row = len(self.starts)
        self.starts.append(len(self.flat))
        self.sizes.append(len(ids))
        self.flat.fromlist(ids)
        self.whole.append(whole)
        return row

    def ids(self, row: int) -> list[int]:
        start = self.starts[row]
        return self.flat[start : start + self.sizes[row]].tolist()

    def views(self) -> tuple[np.ndarray, ...]:
        """The arrays as they are, without a copy; no row can be added while a view lives."""
        if not self.starts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int8)
        flat = np.frombuffer(self.flat, np.uint32) if self.flat else np.zeros(0, np.uint32)
        return flat, np.frombuffer(self.starts, np.int64), np.frombuffer(self.sizes, np.uint32), np.frombuffer(self.whole, np.int8)


class Encoder:
    """Encodes arrays of texts; keeps what it has learned for the batches to come."""

    def __init__(self, path: str, keep: int = KEEP):
        from tokenizers import Tokenizer

        self.path, self.keep = path, keep
        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        text = self.library.to_str()
        pieces = text[text.index('"pre_tokenizer"') : text.index('"model"')]
        self.drops_blanks = "Removed" in pieces
        self.pattern = regex.compile(BLANK_DROPPED if self.drops_blanks else BLANK_KEPT)
        self.letters = "".join(_byte_letters())
        self.tokenize = self.library.model.tokenize
        self.line_end = [] if self.drops_blanks else self.library_ids("\n")
        self._forget()

    def _forget(self) -> None:
        self.inner: dict[str, int] = {}  # rows of parts behind a blank
        self.first: dict[str, int] = {}  # rows of parts at the beginning of a text
        self.known = IdRows()

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _part_ids(self, table: dict[str, int], blank: str, part: str) -> list[int]:
        """Ids of a part, with the blank before it if the tokenizer keeps blanks."""
        if part.isalpha() and (part.isascii() or _PLAIN.fullmatch(part)):
            return self._merged(blank + (part.lower() if self.drops_blanks else part))
        if _PLAIN.fullmatch(part) and "<|" not in part:
            if self.drops_blanks:
                part = part.lower()
            if part[-1] in ".,;:!?" and part[:-1].isalpha():  # a word and a mark
                return self._word(table, blank, part[:-1]) + self._word(self.first, "", part[-1])
            ids = []
            for token in self.pattern.findall(blank + part):
                ids += self._merged(token)
            return ids
        before, line_end, after = part.partition("\n")
        if line_end and _PLAIN.fullmatch(before) and _PLAIN.fullmatch(after):  # such a line end is a pre-token
            return self._part_ids(table, blank, before) + self.line_end + self._part_ids(self.first, "", after)
        return self.library_ids(blank + part)

    def _word(self, table: dict[str, int], blank: str, word: str) -> list[int]:
        """Ids of a word that is one pre-token; kept as a part of its own."""
        row = table.get(word)
        if row is None:
            ids = self._merged(blank + word)
            table[word] = self.known.add(ids)
            return ids
        return self.known.ids(row)

    def _merged(self, token: str) -> list[int]:
        return [t.id for t in self.tokenize(charmap_decode(token.encode(), "strict", self.letters)[0])]

    def _rows(self, table: dict[str, int], parts: np.ndarray, blank: str) -> np.ndarray:
        get = table.get
        found = np.fromiter(map(get, parts, repeat(-1)), np.int64, len(parts))
        for i in np.flatnonzero(found < 0).tolist():
            part = parts[i]
            row = get(part)  # one met twice here, or as the word of another part
            if row is None:
                whole = not self.drops_blanks and (not part or part[0].isspace() or part[-1].isspace())
                row = table[part] = self.known.add([] if whole else self._part_ids(table, blank, part), whole)
            found[i] = row
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        if len(self.inner) > self.keep or len(self.first) > self.keep:
            self._forget()
        cut = pc.split_pattern(texts, " ")
        offsets = np.asarray(cut.offsets).astype(np.int64)
        offsets = offsets - offsets[0]
        parts = cut.flatten().dictionary_encode()
        heads = offsets[:-1]
        names = parts.dictionary.to_numpy(zero_copy_only=False)
        spots = np.asarray(parts.indices)
        inner = np.ones(len(spots), bool)
        inner[heads] = False
        used = np.zeros(len(names), bool)
        used[spots[inner]] = True
        rows = np.zeros(len(names), np.int64)
        at = np.flatnonzero(used)
        rows[at] = self._rows(self.inner, names[at], "" if self.drops_blanks else " ")
        row = rows[spots]
        row[heads] = self._rows(self.first, names[spots[heads]], "")
        flat, starts, sizes, whole = self.known.views()
        begin, size, odd = starts[row], sizes[row].astype(np.int64), whole[row].astype(np.int64)
        odd_texts = np.add.reduceat(odd, heads) > 0 if len(heads) else np.zeros(0, bool)
        if odd_texts.any():
            return self._mixed(texts, odd_texts, flat, begin, size, offsets)
        counts = np.add.reduceat(size, heads) if len(heads) else np.zeros(0, np.int64)
        return flat[ragged(begin, size)], counts

    def _mixed(self, texts, odd, flat, begin, size, offsets):
        """As above, with the texts marked ``odd`` encoded as a whole."""
        plain = flat[ragged(begin, np.where(np.repeat(odd, np.diff(offsets)), 0, size))]
        counts = np.where(odd, 0, np.add.reduceat(size, offsets[:-1]))
        ends = np.cumsum(counts)
        out, position = [], 0
        for i in np.flatnonzero(odd).tolist():
            out.append(plain[position : ends[i]])
            position = int(ends[i])
            ids = np.array(self.library_ids(texts[i].as_py()), np.uint32)
            out.append(ids)
            counts[i] = len(ids)
        out.append(plain[position:])
        return np.concatenate(out).astype(np.uint32), counts


@lru_cache(maxsize=2)
def encoder(path: str, keep: int = KEEP) -> Encoder:
    """The worker's encoder of a tokenizer file; later tasks of the worker go on with it."""
    return Encoder(path, keep)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """One more id after each text."""
    total = counts + 1
    stops = np.cumsum(total) - 1
    out = np.full(int(total.sum()), end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[stops] = False
    out[keep] = ids
    return out, total
