"""Chunked encoding, counts and packing against the tokenizers library."""

import random
from itertools import chain

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starsift.llm import chunk_codec, packing, token_counts
from starsift.llm.queries import tokenizer_path
from starsift.llm.words import WordMemo, load_tokenizer, word_memo
from starsift.staging import stage_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_encode_equals_library(spark, docs_of, odd_texts, real_docs, library):
    docs = docs_of(odd_texts).unionByName(real_docs)
    got = chunk_codec.encode_documents(docs, tokenizer_path(), ["doc_id", "text"], entries=20).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["ids"], r["decoded"]) == want(library, r["text"])


def test_encode_empty_table_and_clash(docs_of, real_docs):
    assert chunk_codec.encode_documents(docs_of([]), tokenizer_path(), ["doc_id"]).collect() == []
    clash = real_docs.limit(3).withColumnRenamed("lang", "ids")
    assert len(chunk_codec.encode_documents(clash, tokenizer_path(), ["doc_id"]).collect()) == 3
    with pytest.raises(ValueError):
        chunk_codec.encode_documents(clash, tokenizer_path(), ["ids"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab cé é\n ßﬁ'sKK1<|endoftext|> 漢"), max_size=40), min_size=1, max_size=6))
def test_join_repair_equals_whole(parts):
    t = load_tokenizer(tokenizer_path())
    memo = word_memo(tokenizer_path())
    chunks = [p.encode() for p in parts if p]
    whole = t.encode("".join(parts), add_special_tokens=False).ids
    assert np.frombuffer(chunk_codec.join_chunks(chunks, memo.encode, memo.encode), np.int32).tolist() == whole


def test_chunks_are_content_defined():
    rng = random.Random(3)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(1500)).encode()
    one, two = chunk_codec.split_texts([b"first start " * 40 + passage, b"other " * 77 + passage])
    assert b"".join(one) == b"first start " * 40 + passage
    assert len(set(one) & set(two)) >= 0.7 * min(len(one), len(two))
    assert all(len(c) <= chunk_codec.MAX_CHUNK for c in one + two)
    for c in chunk_codec.split_texts(["é漢\U0001f600".encode() * 2000])[0]:
        c.decode()


def test_shared_chunks_are_in_the_dictionary(docs_of):
    rng = random.Random(5)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(900))
    docs = docs_of([(i, f"start {i} " * (10 + i) + passage) for i in range(6)])
    table = chunk_codec.chunk_dictionary(docs, tokenizer_path())
    assert table and all(k in passage.encode() or b"start" in k for k in table)
    assert chunk_codec.chunk_dictionary(docs_of([(1, "only one")]), tokenizer_path()) == {}


def test_memo_stays_bounded_and_right(monkeypatch):
    monkeypatch.setattr("starsift.llm.words.MEMO_WORDS", 50)
    memo = WordMemo(tokenizer_path())
    text = " ".join(f"word{i % 170} x{i}" for i in range(2000))
    got = np.frombuffer(memo.encode(text.encode()), np.int32).tolist()
    assert got == memo.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(memo.young) <= 50 and len(memo.old) <= 50


def test_counts_equal_library(docs_of, odd_texts, real_docs, library):
    docs = docs_of(odd_texts).unionByName(real_docs)
    for huge in (0, 500, token_counts.HUGE_BYTES):
        for r in token_counts.count_tokens(docs, tokenizer_path(), ["doc_id", "text"], huge_bytes=huge).collect():
            assert r["n_tokens"] == len(want(library, r["text"])[0])
            assert r["n_bytes"] == len((r["text"] or "").encode())
    assert token_counts.count_tokens(docs_of([]), tokenizer_path(), ["doc_id"]).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab cdé\n '1<|endoftext|>漢"), max_size=600), st.integers(1, 60), st.integers(1, 20))
def test_huge_count_equals_library(text, chunk, overlap):
    t = load_tokenizer(tokenizer_path())
    assert token_counts.count_huge(text, t, chunk, overlap) == len(t.encode(text, add_special_tokens=False).ids)


def test_packing_round_trip(spark, docs_of, odd_texts, real_docs, library):
    docs = docs_of([r for r in odd_texts if r[0] not in (7, 10, None)]).unionByName(real_docs.where("doc_id > 100"))
    packed = packing.pack_documents(docs, tokenizer_path(), row_tokens=128, block_tokens=5000)
    path = stage_path(spark, "packed")
    packing.write_packed(packed, path)
    rows = spark.read.parquet(path).collect()
    for r in rows:
        ids = np.frombuffer(r["input_ids"], "<i4")
        assert len(ids) == 128 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 128
        want_places = list(chain.from_iterable(range(b - a) for a, b in zip(r["cu_seqlens"], r["cu_seqlens"][1:])))
        assert np.frombuffer(r["position_ids"], "<i4")[: r["n_tokens"]].tolist() == want_places
    assert len({r["pack_id"] for r in rows}) == len(rows)
    pieces = {}
    for r in packing.read_pieces(spark, path).collect():
        pieces.setdefault(r["doc_id"], []).append((r["piece_offset"], np.frombuffer(r["ids"], "<i4").tolist()))
    found = {k: list(chain.from_iterable(p for _, p in sorted(v))) for k, v in pieces.items()}
    assert found == {r["doc_id"]: [*want(library, r["text"])[0], 49407] for r in docs.collect()}


@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing(lengths):
    rows = packing.best_fit_decreasing(lengths, 64)
    assert sorted(chain.from_iterable(rows)) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in row) <= 64 for row in rows)
    plain = []  # the same rule by a linear search
    for n in sorted(lengths, reverse=True):
        fits = [b for b in plain if b + n <= 64]
        if fits:
            best = max(fits)
            plain[plain.index(best)] += n
        else:
            plain.append(n)
    assert sorted(plain) == sorted(sum(lengths[i] for i in row) for row in rows)


def test_packing_nulls_repeats_empty(docs_of):
    docs = docs_of([(1, None), (1, "two rows"), (None, "no id")])
    rows = packing.pack_documents(docs, tokenizer_path(), row_tokens=8).collect()
    assert sorted(map(str, chain.from_iterable(r["doc_ids"] for r in rows))) == ["1", "1", "None"]
    assert packing.pack_documents(docs_of([]), tokenizer_path()).collect() == []
