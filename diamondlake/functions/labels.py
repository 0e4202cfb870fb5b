"""Result labels and runs read from the Korean relay text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words (separated by |) -> label, first match wins, no match -> UNK.
RESULT_PATTERNS = [
    ("홈런", "HR"),
    ("3루타", "3B"),
    ("2루타", "2B"),
    ("1루타", "1B"),
    ("고의사구", "IBB"),
    ("볼넷", "BB"),
    ("몸에 맞는 공|사구", "HBP"),
    ("삼진", "SO"),
    ("병살타", "GDP"),
    ("희생플라이|희생타", "SF"),
    ("땅볼|뜬공|파울플라이|내야플라이|파울 아웃|아웃", "OUT"),
]
UNKNOWN = "UNK"

# Report order of the labels.
LABEL_ORDER = ["HR", "3B", "2B", "1B", "SF", "BB", "IBB", "HBP", "SO", "GDP", "OUT", "UNK"]

# Labels for which "0 runs" after a fallback is not suspicious.
CERTAIN_ZERO_LABELS = ["OUT", "SO", "GDP", "UNK", "BB", "IBB", "HBP", "SF"]

# Pattern -> runs; the last one reads the number itself.
RUN_PATTERNS = [
    (r"만루\s*홈런", 4),
    (r"3점\s*홈런|쓰리런", 3),
    (r"2점\s*홈런|투런", 2),
    (r"홈런", 1),
]
RUN_NUMBER_PATTERN = r"(\d+)점"


def classify_result(text: Column) -> Column:
    """Label of a plate appearance. Blank text holds no word, so it is UNK too.

    The patterns are plain words, for which a substring test replaces a regex.
    """
    out = F.lit(UNKNOWN)
    for pattern, label in reversed(RESULT_PATTERNS):
        found = reduce(Column.__or__, [F.contains(text, F.lit(word)) for word in pattern.split("|")])
        out = F.when(found, F.lit(label)).otherwise(out)
    return out


def runs_from_text(text: Column) -> Column:
    """Runs named in the relay text, 0 when it names none."""
    number = F.regexp_extract(text, RUN_NUMBER_PATTERN, 1).try_cast("int")
    out = F.coalesce(number, F.lit(0))
    for pattern, runs in reversed(RUN_PATTERNS):
        out = F.when(text.rlike(pattern), F.lit(runs)).otherwise(out)
    return out.cast("int")


def fallback_runs(label: Column, base1: Column, base2: Column, base3: Column) -> Column:
    """Runs guessed from label and runners when no later score is known."""
    runners = base1 + base2 + base3
    return (
        F.when(label == "HR", runners + 1)
        .when(label == "SF", F.lit(1))
        .when(label.isin("BB", "IBB", "HBP") & (runners == 3), F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def label_rank(label: Column) -> Column:
    """Position in LABEL_ORDER, 1-based; 0 for a label outside the list."""
    return F.array_position(F.lit(LABEL_ORDER), label).cast("int")
