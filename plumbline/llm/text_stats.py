"""Statistics of texts that the quality operators judge by, in numpy over slices of texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from plumbline.llm.grams import SPACE, Spans, Words, mixed, words_of

#: Bytes that count as symbols.
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
UPPER = np.isin(np.arange(256), range(65, 91))
DIGIT = np.isin(np.arange(256), range(48, 58))
MARKS = np.isin(np.arange(256), list(b"!?.,;:"))
FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80

#: Base counts of a text, as the contract has them, and further ones.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_bangs", "n_same_words", "n_symbol_words", "n_upper_words", "n_chars"]


def by_text(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def per_text(text: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(text, weights=weights, minlength=n).astype(np.int64)


def repeated_words(words: Words, n: int) -> np.ndarray:
    """Words, by text, in 3-word windows that the text has twice or more."""
    w, text = words.print, words.text
    if len(w) < 3:
        return np.zeros(n, dtype=np.int64)
    full = np.flatnonzero(text[:-2] == text[2:])
    window = mixed(mixed(mixed(w[full]) + w[full + 1]) * np.uint64(0x9FB21C651E98DF25) + w[full + 2])
    window ^= mixed(text[full].astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(full), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(w), dtype=bool)
    for k in range(3):
        inside[full[twice] + k] = True
    return per_text(text[inside], n)


def repeated_lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By text: lines with a word, and those of them that equal an earlier line."""
    n = len(starts)
    breaks = np.flatnonzero(data == 10)
    some = starts < ends
    # A line runs from a text's start or behind a break to the next break or the text's end.
    begin = np.concatenate([starts[some], breaks + 1])
    stop = np.concatenate([ends[some], breaks])
    owner = np.searchsorted(ends, breaks, side="right")
    text = np.concatenate([np.flatnonzero(some), owner])
    begin = begin[np.lexsort((begin, text))]
    stop = stop[np.lexsort((stop, text))]
    text = np.sort(text)
    letters = np.concatenate([[0], np.cumsum(~SPACE[data])])
    ok = letters[stop] > letters[begin]
    begin, stop, text = begin[ok], stop[ok], text[ok]
    key = Spans(data).prints(begin, stop)[0].view(np.uint64) ^ mixed(text.astype(np.uint64) + np.uint64(0x14057B7EF767814F))
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    return per_text(text, n), per_text(text[order[1:][again]], n)


@dataclass
class Stats:
    counts: dict[str, np.ndarray]
    words: Words


def statistics(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Stats:
    """COUNTS of each text at data[starts[k]:ends[k]], and its words."""
    n = len(starts)
    words = words_of(data, starts, ends, lower=False)
    out = {"n_words": per_text(words.text, n)}
    inside = ~SPACE[data]
    out["word_chars"] = by_text(inside & FIRST_BYTE[data], starts, ends)
    out["n_chars"] = by_text(FIRST_BYTE[data], starts, ends)
    out["n_symbols"] = by_text(SYMBOLS[data], starts, ends)
    out["n_upper"] = by_text(UPPER[data], starts, ends)
    out["n_digits"] = by_text(DIGIT[data], starts, ends)
    out["n_marks"] = by_text(MARKS[data], starts, ends)
    out["n_bangs"] = by_text(data == 33, starts, ends)
    out["n_repeat_words"] = repeated_words(words, n)
    out["n_lines"], out["n_dup_lines"] = repeated_lines(data, starts, ends)
    same = np.flatnonzero((words.print[1:] == words.print[:-1]) & (words.text[1:] == words.text[:-1]))
    out["n_same_words"] = per_text(words.text[same], n)
    out["n_symbol_words"] = per_text(words.text[SYMBOLS[data[words.end - 1]]], n)
    out["n_upper_words"] = per_text(words.text[UPPER[data[words.start]] & UPPER[data[np.minimum(words.start + 1, words.end - 1)]]], n)
    return Stats(out, words)


#: Shares that rules and classifiers look at: (name, count, of).
SHARES = [
    ("symbol_share", "n_symbols", "word_chars"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("same_share", "n_same_words", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("digit_share", "n_digits", "word_chars"),
    ("mark_share", "n_marks", "word_chars"),
    ("bang_share", "n_bangs", "n_words"),
    ("symbol_word_share", "n_symbol_words", "n_words"),
    ("upper_word_share", "n_upper_words", "n_words"),
    ("word_length", "word_chars", "n_words"),
]
