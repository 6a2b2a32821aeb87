"""Quality rules from the coverage of a text by its own repetitions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from incident_analytics.llm.arrays import (
    Rolling,
    Words,
    by_text,
    later_copies,
    mix,
    numbered,
    repeated,
    sums,
)
from incident_analytics.llm.shared import ship

#: Characters counted as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """The largest share of word characters, in per cent, that a kept text may have inside repetitions.

    top: in the occurrences of the most frequent n-gram; inside: in all n-grams that occur twice or
    more. lines: in lines equal to an earlier one. symbols: symbols per 100 word characters.
    """

    top: tuple[tuple[int, int], ...] = ((2, 20), (3, 18), (4, 16))
    inside: tuple[tuple[int, int], ...] = ((5, 25), (6, 24), (7, 23), (8, 22), (9, 21), (10, 20))
    lines: int = 30
    symbols: int = 20
    min_words: int = 50
    repeat_words: int = 50


def _covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` words lie in a window of n words that begins at one of `at`."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _top(keys: np.ndarray, at: np.ndarray, n: int, text: np.ndarray, chars: np.ndarray, texts: int) -> np.ndarray:
    """Per text, the most characters that the occurrences of one repeated n-gram have together."""
    best = np.zeros(texts, np.int64)
    if len(at):
        kinds, first, times = np.unique(keys, return_index=True, return_counts=True)
        before = np.concatenate(([0], np.cumsum(chars)))
        where = at[first]
        np.maximum.at(best, text[where], times * (before[where + n] - before[where]))
    return best


def measure(data: np.ndarray, offsets: np.ndarray, limits: Limits = Limits()) -> dict[str, np.ndarray]:
    """Counts and verdict for each text of a slice."""
    words, n_texts = Words(data, offsets), len(offsets) - 1
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = lead[words.end] - lead[words.start]
    count, word_chars = words.count.astype(np.int64), sums(chars, words.first)
    symbols = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

    # Lines: they end at a line break or with the text.
    breaks = np.flatnonzero(data == 10)
    begins = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    begins = begins[begins < len(data)]
    # A break before the end of the data closes its line; so does the end of a text.
    closes = np.minimum(np.append(begins[1:], len(data)), len(data))
    line_text = np.searchsorted(offsets, begins, "right") - 1
    ends = np.where((closes > begins) & (data[np.maximum(closes - 1, 0)] == 10), closes - 1, closes) if len(data) else closes
    a, b = np.searchsorted(words.start, begins), np.searchsorted(words.start, ends)
    with_word = b > a
    begins, ends, line_text, a, b = (x[with_word] for x in (begins, ends, line_text, a, b))
    _, line = numbered(data, begins, ends)
    copy = later_copies(line * n_texts + line_text)
    n_dup_lines = np.bincount(line_text[copy], minlength=n_texts)
    before = np.concatenate(([0], np.cumsum(chars)))
    line_chars = np.bincount(line_text[copy], (before[b] - before[a])[copy], minlength=n_texts)

    # N-grams: one that occurs twice begins with a shorter one that does, so each length looks at what is left.
    rolling, text = Rolling(words.hashes()), words.text
    salt = mix(np.arange(n_texts, dtype=np.uint64))
    share = 100.0 / np.maximum(word_chars, 1)
    bad = (100 * n_symbols > limits.symbols * word_chars) | (line_chars * share > limits.lines)
    top, inside, total = dict(limits.top), dict(limits.inside), len(words)
    n_repeat = np.zeros(n_texts, np.int64)
    at = np.arange(total)
    for n in sorted({3, *top, *inside}):
        at = at[at + n <= total]
        at = at[text[at] == text[at + n - 1]]
        key = mix(rolling.run(at, at + n) ^ salt[text[at]])
        twice = repeated(key)
        at, key = at[twice], key[twice]
        if n == 3:
            n_repeat = sums(_covered(at, n, total), words.first)
        if n in top:
            bad |= _top(key, at, n, text, chars, n_texts) * share > top[n]
        if n in inside:
            bad |= sums(np.where(_covered(at, n, total), chars, 0), words.first) * share > inside[n]
    failed = (count < limits.min_words) | (100 * n_repeat > limits.repeat_words * count)
    return {
        "n_words": count, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat, "base_failed": failed, "kept": ~failed & ~bad,
    }


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, counts and verdict of each row, whole texts, without a shuffle.

    A null or empty text has no words, fails the base rule and is not kept. Rows are judged alone,
    so repeated rows and ids get equal verdicts. Other columns are not read.
    """
    ship(docs.sparkSession)
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [("doc_id", pa.int64()), *((c, pa.int64()) for c in longs), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
    shape = "doc_id long, " + ", ".join(f"{c} long" for c in longs) + ", base_failed boolean, kept boolean"
    rows = by_text(lambda data, offsets: measure(data, offsets, limits), pa.schema(fields))
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, shape)
