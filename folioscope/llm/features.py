"""Numbers that describe the form of a text, for the quality classifier."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

SYMBOLS = re.compile(r"[^\w\s]")
RUNS = re.compile(r"([^\w\s])\1+")

FEATURES = (
    "log_words",
    "word_length",
    "upper_share",
    "digit_share",
    "symbol_share",
    "doubled_symbols",
    "bar_words",
    "distinct_words",
    "top_word",
    "repeated_lines",
    "line_words",
    "capital_words",
    "comma_share",
    "point_share",
)


def text_features(text: str | None) -> list[float]:
    """Values of FEATURES over the whole text; all zero for a null or wordless text."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, letters = len(words), max(len(text), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    symbols = SYMBOLS.findall(text)
    kinds = Counter(symbols)
    upper = sum(map(str.isupper, words))
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        upper / n,
        sum(map(str.isdigit, words)) / n,
        len(symbols) / letters,
        len(RUNS.findall(text)) / n,
        kinds["|"] / n,
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        n / max(len(lines), 1),
        sum(map(str.istitle, words)) / n,
        kinds[","] / n,
        kinds["."] / n,
    ]
