"""Counts over one whole text, used by the quality operators.

A null text counts as an empty one: every count is 0.
"""

from __future__ import annotations

import numpy as np

from responsekit.llm.common import split_words

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def base_counts(text: str | None, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text with these words."""
    if not words:
        return 0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def word_ids(words: list[bytes]) -> tuple[np.ndarray, int]:
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    return ids, len(seen)


def repeat_words(words: list[bytes], n: int = 3) -> int:
    """Words that lie in a window of ``n`` words which occurs twice or more in the text."""
    if len(words) <= n:
        return 0
    ids, _ = word_ids(words)
    code = ids[: len(ids) - n + 1]
    for k in range(1, n):  # numbered anew at each step, so codes stay below the number of words squared
        code = np.unique(code * (ids.max() + 1) + ids[k: len(ids) - n + 1 + k], return_inverse=True)[1]
    twice = np.bincount(code)[code] >= 2
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(n):
        covered[k: len(ids) - n + 1 + k] |= twice
    return int(covered.sum())


#: Document statistics behind the quality rules and the quality classifier.
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_unique",
         "n_upper_words", "n_ended_lines", "n_bang", "n_digits", "n_letters", "n_upper", "n_marks", "longest_word",
         "sq_word_chars"]
MARKS = ".,;:?"
ENDS = (".", "!", "?", "…", '"', "”", ":")


def text_stats(text: str | None) -> list[int]:
    """The values of ``STATS`` for one text."""
    words = split_words(text)
    base = base_counts(text, words)
    if not words:
        return [*base, *[0] * (len(STATS) - 5)]
    lines = [x for x in (y.rstrip(BLANKS) for y in text.split("\n")) if x]
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_letter = ((code | 32) >= 97) & ((code | 32) <= 122)
    upper = int((((code >= 65) & (code <= 90)) | ((code >= 0xC0) & (code <= 0xDE))).sum())
    letters = int((ascii_letter | (code >= 0xC0)).sum())
    n_up = sum(len(w) > 1 and w.isupper() for w in words)
    return [*base, len(lines), len(set(words)), n_up, sum(x.endswith(ENDS) for x in lines), text.count("!"),
            int(((code >= 48) & (code <= 57)).sum()), letters, upper, sum(map(text.count, MARKS)), int(lens.max()),
            int((lens * lens).sum())]
