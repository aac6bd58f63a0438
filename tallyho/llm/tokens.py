"""Token ids of whole texts by a public ``tokenizers`` file, with a cache of word units.

A text is cut where the pre-tokenizers of both files cut too, so the ids of
the text are the ids of its units one after another: at spaces that follow a
character other than white space (a space goes with what follows it, or is
dropped), between a letter and a stop or comma, and around a single line end.
Units repeat, so each worker encodes a unit once, with the ``tokenizers``
library, and keeps its ids; the rest is array work on Arrow columns.  New
units of Latin letters alone are one pre-token, so the library's model gets
them as the file's normalizer and pre-tokenizer would give them; others are
encoded many to a call, between separators whose id nothing else has.  The cache is emptied when it would pass ``CACHE`` units and a unit over
``LONG`` characters is not kept, so memory is bounded whatever the text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tallyho.llm.columns import hold, release

CACHE = 600_000
LONG = 64
SLICE = 1 << 20  # bytes of text encoded at a time
END_ID = 1
_UNIT = re.compile(r"(?<=\S)(?= )")
_SPACED = re.compile(r"\s")
_MARK = "\x01"  # before a unit that no space precedes
_JOINED = 64  # new units to a call
_ODD = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] |\x01"
_LETTERS = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]  # Latin; none of them joins its neighbours in NFC
_STOPS = r"([A-Za-z])([.,;:!?])"
_LINES = r"([!-~\pL])\n([!-~\pL])"


def _odd_rows(column: pa.Array) -> np.ndarray:
    """Rows with a space after other white space, where a cut would not be a boundary of the pre-tokenizer, or with the mark itself."""
    return np.flatnonzero(pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False))


class Units:
    """``keep_space``: a space belongs to the unit that follows it; else spaces are dropped."""

    def __init__(self, path: str, keep_space: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.model._resize_cache(0)  # the units are cached here
        self.lead = " " if keep_space else ""
        # A line end is a token of its own between units that hold no white space; where spaces are dropped, the mark is.
        self.between = "\n" if keep_space else f" {_MARK} "
        separator = self.plain([self.between])[0]
        self.separator = separator[0] if len(separator) == 1 else None
        self.spelled = {ord(c): x[0][0] for c in _LETTERS if len(x := self._pretokens(c)) == 1}
        if keep_space:
            self.spelled[ord(" ")] = self._pretokens(" a")[0][0][:-1]
        letters = "".join(map(chr, self.spelled)).replace(" ", "")
        self.letters = re.compile(f"[{letters}]+")
        word = self.lead + letters  # any letters after a lead are one pre-token; else each unit goes the longer way
        if self._model_ids(word) != self.plain([word])[0]:
            self.letters = re.compile("(?!)")
        self._empty()

    def _pretokens(self, text: str) -> list[tuple]:
        normal = self.tokenizer.normalizer
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(normal.normalize_str(text) if normal else text)

    def _model_ids(self, text: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(text.translate(self.spelled))]

    def _empty(self) -> None:
        self.known: dict[str, int] = {}  # what follows the leading space -> row of starts and sizes
        self.starts = np.zeros(1, dtype=np.int64)
        self.sizes = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, unit: str) -> str:
        """The text of a unit: without its mark, or with the space before it."""
        return unit[1:] if self.lead and unit.startswith(_MARK) else self.lead + unit

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of distinct units one after another, their number in each unit)."""
        out: list = [None] * len(units)
        texts, bodies = units, units
        if self.lead:
            texts = list(map(self._whole, units))
            bodies = [t[1:] if t[:1] == self.lead else t for t in texts]
        latin, joined, tokenize = [], [], self.tokenizer.model.tokenize
        for i, fits in enumerate(map(self.letters.fullmatch, bodies)):
            if fits:
                latin.append(i)
            elif not bodies[i] or self.separator is None or _MARK in bodies[i] or _SPACED.search(bodies[i]):
                out[i] = self.plain([texts[i]])[0]
            else:
                joined.append((i, texts[i]))
        if latin:  # no unit of letters holds a line end, and it is spelled as itself
            spelled = "\n".join([texts[i] for i in latin]).translate(self.spelled).split("\n")
            for i, text in zip(latin, spelled, strict=True):
                out[i] = [t.id for t in tokenize(text)]
        for at in range(0, len(joined), _JOINED):
            some = joined[at : at + _JOINED]
            flat = self.plain([self.between.join([*(t for _, t in some), ""])])[0]
            begin = 0
            for i, _ in some:
                end = flat.index(self.separator, begin)
                out[i] = flat[begin:end]
                begin = end + 1
        sizes = np.fromiter(map(len, out), dtype=np.int64, count=len(out))
        return np.fromiter(chain.from_iterable(out), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _rows(self, units: list[str]) -> np.ndarray:
        """The rows of distinct units; encodes the new ones."""
        rows = np.fromiter(map(self.known.get, units, repeat(-1)), dtype=np.int64, count=len(units))
        missing = np.flatnonzero(rows < 0)
        if len(self.known) + len(missing) > CACHE:
            self._empty()
            missing = np.arange(len(units))
        if not len(missing):
            return rows
        new = units if len(missing) == len(units) else [units[i] for i in missing.tolist()]
        ids, sizes = self._encode_units(new)
        at = len(self.sizes)
        rows[missing] = np.arange(at, at + len(new))
        self.known.update(zip(new, range(at, at + len(new)), strict=True))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, ids))
        for u in [u for u in new if len(u) > LONG]:
            del self.known[u]
        return rows

    def _odd(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.plain(_UNIT.split(text))))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, row offsets); a NULL text has no ids."""
        column = column.fill_null("").cast(pa.large_string())
        aside: dict[int, list[int]] = {}
        if self.lead:
            aside = {i: self._odd(column[i].as_py()) for i in _odd_rows(column).tolist()}
            if aside:
                keep = np.ones(len(column), dtype=bool)
                keep[list(aside)] = False
                column = pc.if_else(pa.array(keep), column, "")
            column = pc.replace_substring_regex(column, _LINES, f"\\1 {_MARK}\n {_MARK}\\2")
            column = pc.replace_substring_regex(column, _STOPS, rf"\1 {_MARK}\2")
        else:  # white space is dropped, and A-Z are folded
            column = pc.ascii_lower(pc.replace_substring(column, "\n", " "))  # a slice given to ascii_lower itself comes out garbled
            column = pc.replace_substring_regex(column, _STOPS, r"\1 \2")
        parts = pc.split_pattern(column, " ")
        bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.lead:  # the first part of a text has no space before it
            heads = bounds[:-1]
            first = [units[c] for c in codes[heads].tolist()]
            aside |= {i: ids for i, ids in enumerate(self.plain(first)) if i not in aside}
        rows = self._rows(units)[codes]
        if self.lead:
            rows[heads] = 0  # row 0 has no ids
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[rows] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        offsets = np.concatenate(([0], ends))[bounds]
        if aside:  # put them in front of their rows' other ids
            extra = np.array([len(aside.get(i, ())) for i in range(len(column))], dtype=np.int64)
            ids = np.insert(ids, np.repeat(offsets[:-1], extra), np.fromiter(chain.from_iterable(aside.get(i, ()) for i in range(len(column))), dtype=np.uint32, count=int(extra.sum())))
            offsets = offsets + np.concatenate(([0], np.cumsum(extra)))
        return ids, offsets


_loaded: dict[tuple[str, bool], Units] = {}


def units(path: str, keep_space: bool) -> Units:
    """The worker's units of a tokenizer file."""
    hold("units", _loaded.clear)
    if (path, keep_space) not in _loaded:
        _loaded[path, keep_space] = Units(path, keep_space)
    return _loaded[path, keep_space]


def forget() -> None:
    """Frees the worker's units, for stages that encode no text."""
    _loaded.clear()
    release()


def encoded_slices(column: pa.Array, path: str, keep_space: bool, most: int = SLICE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, the ids of each text and END_ID) for slices of about ``most`` bytes of text; nothing of a slice is kept."""
    known = units(path, keep_space)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(total, total[row] + most, side="right")) - 1)
        ids, offsets = known.encode(column.slice(row, stop - row))
        yield row, [np.append(ids[a:b], np.uint32(END_ID)) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        row = stop
    release()


def encoded(column: pa.Array, path: str, keep_space: bool) -> Iterator[np.ndarray]:
    """The ids of each text and END_ID, row by row, a slice of ``SLICE`` bytes at a time."""
    for _, rows in encoded_slices(column, path, keep_space):
        yield from rows
