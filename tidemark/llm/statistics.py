"""Statistics of texts that quality models and rules use, for a slice of texts at a time."""

from __future__ import annotations

import numpy as np

from tidemark.llm.bytescan import LEADING, Texts, Words, keyed, repeated, span_hashes, windows


def _class(characters: str) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[[ord(c) for c in characters]] = True
    return marks


#: The characters that count as symbols.
SYMBOLS = _class("#*$%&|<>")
UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = _class("abcdefghijklmnopqrstuvwxyz")
DIGIT = _class("0123456789")
WIDE = np.arange(256) >= 0x80


class Scan:
    """Words and lines of a slice, with what several statistics share."""

    def __init__(self, texts: Texts):
        self.texts, self.words = texts, Words(texts)
        self.hashes = self.words.hashes()
        stop = np.flatnonzero(texts.data == 10)
        begin = np.concatenate(([0], stop[:-1] + 1))
        has_word = np.searchsorted(self.words.begin, stop) > np.searchsorted(self.words.begin, begin)
        self.line_begin, self.line_end = begin[has_word], stop[has_word]
        self.line_text = np.searchsorted(texts.begin, self.line_begin, "right") - 1
        self.lines = np.bincount(self.line_text, minlength=len(texts))

    def sum_words(self, values: np.ndarray) -> np.ndarray:
        """Sum over the words of each text."""
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.words.last] - total[self.words.first]

    def word_chars(self) -> np.ndarray:
        """Code points inside words."""
        return self.texts.per_text(LEADING[self.texts.data] & ~self.words.space)

    def count(self, marks: np.ndarray) -> np.ndarray:
        return self.texts.per_text(marks[self.texts.data])

    def duplicate_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of the text."""
        keys = keyed(span_hashes(self.texts.data, self.line_begin, self.line_end), self.line_text)
        _, first = np.unique(keys, return_index=True)
        return self.lines - np.bincount(self.line_text[first], minlength=len(self.texts))

    def repeated_words(self, n: int = 3) -> np.ndarray:
        """Words that lie in runs of n words found twice or more in the text."""
        found, owner, at = windows(self.hashes, self.words.first, self.words.last, n)
        at = at[repeated(keyed(found, owner))]
        covered = np.zeros(len(self.hashes), bool)
        for j in range(n):
            covered[at + j] = True
        return self.sum_words(covered)

    def distinct_words(self) -> np.ndarray:
        owner = self.words.owner()
        _, first = np.unique(keyed(self.hashes, owner), return_index=True)
        return np.bincount(owner[first], minlength=len(self.texts))


FEATURES = (
    "log_words", "word_bytes", "word_bytes_spread", "distinct_words", "repeated_words", "echoes",
    "duplicate_lines", "words_per_line", "upper", "digits", "symbols", "wide", "exclamations",
    "bars", "stops", "commas", "capital_words", "upper_words", "words_without_letters",
    "words_ending_in_symbols", "longest_word",
)


def features(scan: Scan) -> np.ndarray:
    """A row of FEATURES for each text; shares are of words, lines or bytes, and 0 without any."""
    t, w = scan.texts, scan.words
    n = np.maximum(w.count, 1)
    size = np.maximum(t.end - t.begin, 1)
    length = (w.end - w.begin).astype(float)
    mean = scan.sum_words(length) / n
    spread = np.sqrt(np.maximum(scan.sum_words(length**2) / n - mean**2, 0))
    echo = np.zeros(len(scan.hashes), bool)
    echo[1:] = scan.hashes[1:] == scan.hashes[:-1]
    echo[w.first[w.count > 0]] = False

    def inside(marks: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(marks[t.data])))
        return total[w.end] - total[w.begin]

    first, last = t.data[w.begin], t.data[w.end - 1]
    upper, lower, wide = inside(UPPER), inside(LOWER), inside(WIDE)
    longest = np.zeros(len(t))
    some = w.count > 0
    if some.any():
        longest[some] = np.maximum.reduceat(length, w.first[some])
    return np.column_stack(
        [
            np.log1p(w.count), mean, spread, scan.distinct_words() / n, scan.repeated_words() / n,
            scan.sum_words(echo) / n, scan.duplicate_lines() / np.maximum(scan.lines, 1),
            w.count / np.maximum(scan.lines, 1), scan.count(UPPER) / size, scan.count(DIGIT) / size,
            scan.count(SYMBOLS) / size, scan.count(WIDE) / size, scan.count(_class("!")) / size,
            scan.count(_class("|")) / size, scan.count(_class(".")) / size, scan.count(_class(",")) / size,
            scan.sum_words(UPPER[first]) / n, scan.sum_words((upper > 1) & (lower == 0)) / n,
            scan.sum_words(upper + lower + wide == 0) / n, scan.sum_words(SYMBOLS[last]) / n, longest,
        ]
    )
