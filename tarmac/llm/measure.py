"""Counts over one text that several operators judge documents by."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa

from tarmac.llm.remembered import begin

BLANKS = b" \t\n\r\x0b\x0c"  # what separates words
SYMBOLS = b"#*$%&|<>"

COUNTS = (
    "n_words",  # runs of characters that are not blanks
    "word_chars",  # code points in words
    "n_symbols",  # characters of SYMBOLS
    "n_lines",  # lines with a word
    "n_dup_lines",  # of these, the ones equal to an earlier line
    "n_repeat_words",  # words in a run of three that the text holds at least twice
    "n_distinct_words",
    "n_same_words",  # words equal to the word before
    "n_upper_words",  # words of two letters and more, all of them capitals
    "n_pipes",
    "n_stops",  # words that end in a mark of punctuation
    "n_digits",
)


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of COUNTS; a null text is an empty one."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.translate(None, BLANKS)]
    blanks = len(raw) - len(raw.translate(None, BLANKS))
    return (
        n,
        len(text) - blanks,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(set(words)),
        sum(map(bytes.__eq__, words, words[1:])),
        sum(w.isupper() and len(w) > 1 for w in words),
        raw.count(b"|"),
        sum(w[-1] in b".,;:!?" for w in words),
        len(raw) - len(raw.translate(None, b"0123456789")),
    )


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a run of three words that occurs at least twice."""
    runs = list(zip(words, words[1:], words[2:]))
    times = Counter(runs)
    if len(times) == len(runs):
        return 0
    covered, reach = 0, 0  # words before `reach` are counted or passed
    for i, run in enumerate(runs):
        if times[run] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and the counts, for batches of doc_id and text."""
    begin("measures")
    for batch in batches:
        rows = [measure(t.as_py()) for t in batch.column("text")]
        columns = list(zip(*rows)) or [()] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *COUNTS]
        )


SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)
