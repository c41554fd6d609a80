"""Line tables: what the lines of a text and the whole text look like, as numbers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from . import _text

_U = np.uint64
#: Byte classes that are counted per line.
_CLASSES = ("symbols", "upper", "lower", "digits", "pipes", "shouts", "foreign", "points")
_MEMBERS = {
    "symbols": _text.byte_set(*((ord(c), ord(c)) for c in "#*$%&|<>")),
    "upper": _text.byte_set((0x41, 0x5A)),
    "lower": _text.byte_set((0x61, 0x7A)),
    "digits": _text.byte_set((0x30, 0x39)),
    "pipes": _text.byte_set((0x7C, 0x7C)),
    "shouts": _text.byte_set((0x21, 0x21)),
    "foreign": _text.byte_set((0xC0, 0xFF)),
    "points": _text.byte_set((0x2C, 0x2C), (0x2E, 0x2E)),
}
_CHARS = ~_text.byte_set((0x80, 0xBF))  # the first byte of each code point
_ENDS = _text.byte_set((0x21, 0x21), (0x22, 0x22), (0x2E, 0x2E), (0x3F, 0x3F), (0x3A, 0x3B))


@dataclass
class Lines:
    """The lines with a word of a chunk's texts; a line's words and bytes end at its newline."""

    line_at: np.ndarray  # index of each text's first line, and the end
    words: np.ndarray
    chars: np.ndarray  # code points in words
    counts: dict[str, np.ndarray]  # bytes of each class
    repeat: np.ndarray  # equal to an earlier line of the text
    repeat_words: np.ndarray  # words in three-word windows that the text holds twice or more
    ends: np.ndarray  # ends like a sentence

    def features(self) -> np.ndarray:
        """One row per line, all columns between 0 and about 1."""
        c, w = self.counts, np.maximum(self.words, 1)
        chars, letters = np.maximum(self.chars, 1), np.maximum(c["upper"] + c["lower"], 1)
        columns = [
            np.ones(len(w)), np.minimum(1, 3 * c["symbols"] / w), c["upper"] / letters, np.minimum(1, 3 * c["digits"] / chars),
            np.minimum(1, 2 * c["pipes"] / w), np.minimum(1, 2 * c["shouts"] / w), np.log1p(w) / 5, np.minimum(1, chars / w / 12),
            self.repeat, self.repeat_words / w, w < 4, np.minimum(1, 4 * c["points"] / w),
        ]
        return np.column_stack(columns).astype(np.float64)


LINE_FEATURES = 12


def line_table(w: _text.Words) -> Lines:
    n = len(w.data)
    breaks = np.flatnonzero(w.data == 0x0A)
    starts = np.union1d(w.doc_at[:-1], breaks + 1)
    starts = starts[starts < n]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Lines(np.zeros(len(w.doc_at), np.int64), none, none, {c: none for c in _CLASSES}, none.astype(bool), none, none.astype(bool))
    limits = np.append(starts[1:], n)
    ends = limits - (w.data[limits - 1] == 0x0A)
    first = np.searchsorted(w.start, starts)
    words = np.diff(np.append(first, len(w.start)))
    held = words > 0
    starts, ends, first, words = starts[held], ends[held], first[held], words[held]
    last = first + words - 1
    line_at = np.searchsorted(starts, w.doc_at)

    def per_line(member: np.ndarray) -> np.ndarray:
        running = np.zeros(n + 1, np.int32)
        np.cumsum(member[w.data], out=running[1:])
        return (running[ends] - running[starts]).astype(np.int64)

    doc = np.repeat(np.arange(len(line_at) - 1), np.diff(line_at))
    code = w.span_hash(starts, ends) ^ _text.mix(doc.astype(np.uint64) + _U(1))
    order = np.argsort(code, kind="stable")
    repeat = np.zeros(len(code), bool)
    repeat[order[1:]] = code[order][1:] == code[order][:-1]
    return Lines(
        line_at, words, per_line(_CHARS & ~_text.SPACES), {c: per_line(_MEMBERS[c]) for c in _CLASSES}, repeat,
        _text.sums_by_doc(repeated_words(w), np.append(first, len(w.start))), _ENDS[w.data[w.end[last] - 1]],
    )


def repeated_words(w: _text.Words, window: int = 3) -> np.ndarray:
    """True for words in windows found twice or more in their text."""
    out = np.zeros(len(w.code), bool)
    at = np.flatnonzero(w.room() >= window)
    if not len(at):
        return out
    code = w.grams(window)[at] ^ _text.mix(w.doc_of_word()[at].astype(np.uint64) + _U(1))
    order = np.argsort(code)
    same = code[order][1:] == code[order][:-1]
    hits = at[np.unique(np.concatenate([order[1:][same], order[:-1][same]]))]
    for i in range(window):
        out[hits + i] = True
    return out


def doc_counts(w: _text.Words, lines: Lines) -> dict[str, np.ndarray]:
    """Sums per text of what the lines hold; symbols are counted over all bytes, not only in lines with a word."""
    at = lines.line_at
    out = {"words": w.count, "chars": _text.sums_by_doc(lines.chars, at), "lines": np.diff(at), "repeat_lines": _text.sums_by_doc(lines.repeat, at)}
    out |= {"repeat_words": _text.sums_by_doc(lines.repeat_words, at), "ends": _text.sums_by_doc(lines.ends, at)}
    return out | {c: _text.sums_by_doc(x, at) for c, x in lines.counts.items()}
