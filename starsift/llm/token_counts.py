"""Token counts of whole texts; huge ones in overlapping chunks that are spliced.

A huge document is encoded in chunks of ``CHUNK_CHARS`` that reach ``OVERLAP_CHARS``
over the next border. The text around the border is encoded once more on its own;
a splice is a position behind white space (which no token crosses) from which both
encodings have the same ids at the same offsets. If there is none, the overlap is
doubled, at last to the end of the text. So memory follows the chunk, not the text.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame

from starsift.llm.common import map_texts
from starsift.llm.words import load_tokenizer, word_memo

HUGE_BYTES = 32_768
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256


def splice(text: str, left, at: int, right, begin: int, border: int) -> tuple[int, int] | None:
    """(position, tokens of ``left`` before it) of a stable boundary both encodings share, nearest behind ``border``.

    ``left`` encodes the text from ``at`` on, ``right`` a range from ``begin`` on that
    reaches as far; both are compared over all they have in common from the splice.
    """
    starts, others = [at + o[0] for o in left.offsets], [begin + o[0] for o in right.offsets]
    ids, other_ids = left.ids, right.ids
    n = bisect_left(starts, border)
    while n < len(starts):
        position = starts[n]
        m = bisect_left(others, position)
        stable = position > at and text[position - 1] in " \t\n\r"
        if stable and ids[n:] == other_ids[m:] and starts[n:] == others[m:]:
            return position, n
        n += 1
    return None


def count_huge(text: str, tokenizer, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of a text, encoded in chunks."""
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False)
    total = at = 0
    while len(text) - at > chunk + overlap:
        border, reach, found = at + chunk, overlap, None
        while found is None and border + reach < len(text):
            # The chunk's last word may be cut; both encodings end at white space, or neither is used.
            end = border + reach
            while end > border and text[end - 1] not in " \t\n\r":
                end -= 1
            begin = max(at, border - reach)
            if end > border:
                left, right = encode(text[at:end]), encode(text[begin:end])
                found = splice(text, left, at, right, begin, border)
            reach *= 2
        if found is None:
            break
        at, tokens = found
        total += tokens
    return total + len(encode(text[at:]).ids)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text", huge_bytes: int = HUGE_BYTES
) -> DataFrame:
    """Columns ``keep`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text.

    Null and empty texts have 0 of both. Texts over ``huge_bytes`` go through
    overlapping chunks, others through the memo of words; either equals the
    library's count of the whole text. Repeated rows each get their row.
    """

    def make():
        memo, tokenizer = word_memo(tokenizer_path), load_tokenizer(tokenizer_path)

        def tokens(text: bytes) -> int:
            if len(text) <= huge_bytes:
                return memo.count(text)
            return count_huge(text.decode("utf-8", "replace"), tokenizer)

        return lambda texts: {"n_bytes": list(map(len, texts)), "n_tokens": list(map(tokens, texts))}

    return map_texts(docs, text, keep, "n_bytes bigint, n_tokens bigint", make)
