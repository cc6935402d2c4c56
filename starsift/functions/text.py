"""Text cleaning and counting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns decide which characters survive cleaning.
URL_PATTERN = r"https?://\S+|www\.\S+"
TAG_PATTERN = r"<[^>]+>"
# All but a-z, 0-9 and the apostrophe, as ranges: Java matches these several times
# faster than the negated class.
_DROPPED = r"[\x00-&(-/:-`{-\x{10FFFF}]"
# A run of dropped characters, unless it is one blank before a kept character: most runs
# are such blanks, which stay as they are, and every replacement costs more than the look.
DROPPED_RUN = rf"{_DROPPED}(?<! (?=[a-z0-9'])){_DROPPED}*+"


def clean_text(text: Column) -> Column:
    """Lower-cased text without URLs and tags, single-spaced; null becomes ''.

    Every run of dropped characters becomes one space, where it is not one already:
    the same text as blanking them and then collapsing white space, in one pass. The
    URL and tag patterns run only on texts that can match them.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    may_link = lowered.contains("http") | lowered.contains("www.")
    no_urls = F.when(may_link, F.regexp_replace(lowered, URL_PATTERN, " ")).otherwise(lowered)
    no_tags = F.when(no_urls.contains("<"), F.regexp_replace(no_urls, TAG_PATTERN, " ")).otherwise(no_urls)
    return F.trim(F.regexp_replace(no_tags, DROPPED_RUN, " "))


def word_count(cleaned: Column) -> Column:
    """Words of a single-spaced text; 0 for an empty one."""
    gaps = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(cleaned == "", F.lit(0)).otherwise(gaps + 1).cast("int")


def exclamation_count(raw: Column) -> Column:
    """Exclamation marks of the raw text; 0 for null."""
    text = F.coalesce(raw, F.lit(""))
    return F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))


def strip(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(cleaned: Column) -> Column:
    """Words of at least two characters."""
    return F.regexp_extract_all(cleaned, F.lit(r"\w\w+"), F.lit(0))


def with_pairs(word_list: Column) -> Column:
    """The words, followed by their neighbour pairs. Pass a stored column: it is read three times."""
    following = F.slice(word_list, 2, F.greatest(F.size(word_list), F.lit(1)))
    pairs = F.zip_with(word_list, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(word_list, F.array_compact(pairs))
