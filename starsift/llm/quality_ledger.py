"""Quality rules as a bitmask ledger.

``ledger`` measures every document once and stores, beside the measurements, one
bit for each failed rule. Policies are versioned masks over those bits: applying
another one, or asking what a rule costs, reads the ledger and never a text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import map_texts

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " n_lines bigint, n_digits bigint"
)
SYMBOLS = b"#*$%&|<>"
NOT_SPACES = bytes(b for b in range(256) if b not in b" \t\n\v\f\r")
NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
NOT_DIGITS = bytes(b for b in range(256) if b not in b"0123456789")
CONTINUATION = bytes(range(0x80, 0xC0))
REPEAT_WINDOW = 5


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of words found twice or more, the first occurrence included."""
    windows = list(zip(*(words[k:] for k in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = upto = 0
    for at, w in enumerate(windows):
        if seen[w] > 1:
            covered += at + window - max(at, upto)
            upto = at + window
    return covered


def repeated_lines(text: bytes) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, lines with a word)."""
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines)), len(lines)


def measure(texts: list[bytes]) -> dict[str, list]:
    out: dict[str, list] = {name: [] for name in re.findall(r"(\w+) bigint", MEASURES)}
    for text in texts:
        words = text.split()
        joined = len(text) - len(text.translate(None, NOT_SPACES))
        dup, lines = repeated_lines(text)
        out["n_words"].append(len(words))
        out["word_chars"].append(joined - (len(text) - len(text.translate(None, CONTINUATION))))
        out["n_symbols"].append(len(text.translate(None, NOT_SYMBOLS)))
        out["n_dup_lines"].append(dup)
        out["n_repeat_words"].append(repeated_words(words))
        out["n_lines"].append(lines)
        out["n_digits"].append(len(text.translate(None, NOT_DIGITS)))
    return out


@dataclass(frozen=True)
class Rule:
    """A bit of the ledger; the document fails where the SQL condition ``fails`` holds."""

    bit: int
    name: str
    fails: str


#: All rules. A bit keeps its meaning for ever: new rules take new bits.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "short_words", "word_chars < 2 * n_words"),
    Rule(3, "long_words", "word_chars > 20 * n_words"),
    Rule(4, "symbols", "n_symbols > n_words"),
    Rule(5, "repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    Rule(6, "digits", "2 * n_digits > word_chars"),
    Rule(7, "some_symbols", "10 * n_symbols > n_words"),
    Rule(8, "some_repeated_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
)


#: Version -> rules whose failure drops a document. A published version is never changed.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "short_words", "long_words", "symbols", "repeated_lines", "digits"),
    "strict": ("few_words", "repeated_words", "short_words", "long_words", "digits", "some_symbols", "some_repeated_lines"),
}


def mask_of(version: str) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[version])


def ledger(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, the measurements and ``fail_bits``.

    Null and empty texts have no words (all measurements 0), so they fail
    ``few_words``. Repeated rows each get their row; columns of ``docs`` that are
    named like a measurement may not be kept.
    """
    measured = map_texts(docs, text, keep, MEASURES, lambda: measure)
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total.cast("bigint"))


def passes(version: str, bits: str = "fail_bits") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(bits).bitwiseAND(F.lit(mask_of(version))) == 0


def ablation(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: documents failing it, and those that only it drops.

    The ledger is first grouped by its bits (at most two to the number of rules
    rows), so the rules cost nothing more. An empty ledger gives counts of 0.
    """
    mask = mask_of(version)
    own = F.col("fail_bits").bitwiseAND(F.lit(mask))
    grouped = rows.groupBy(own.alias("bits")).agg(F.count(F.lit(1)).alias("docs"))
    bits = {r.name: 1 << r.bit for r in RULES}
    counts = []
    for name in POLICIES[version]:
        fails = F.col("bits").bitwiseAND(F.lit(bits[name])) != 0
        only = F.col("bits") == bits[name]
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("docs"))), F.lit(0))
        counts.append(F.struct(F.lit(name).alias("rule"), total(fails).alias("failed"), total(only).alias("only_this")))
    docs = F.coalesce(F.sum("docs"), F.lit(0))
    dropped = F.coalesce(F.sum(F.when(F.col("bits") != 0, F.col("docs"))), F.lit(0))
    table = grouped.agg(F.array(*counts).alias("rules"), docs.alias("docs"), dropped.alias("dropped"))
    return table.select(F.lit(version).alias("version"), "docs", "dropped", F.inline("rules"))
