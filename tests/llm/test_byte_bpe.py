"""Byte-level BPE by folds: equal to the tiktoken library, and back."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tracewell.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = "abcdeéÉ'’ßΣσςİı 19²½\n\t\x1c\x85　<|>ñ中文가Åͅﬁ😀𝔸!!##ẞ́\u0870\u0558\U00010d40\U00011de0"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_ids_equal_the_library_s_and_decode_to_the_text(spark, library, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(200)]
    texts += ["", " ", "  a", "a  ", "a" * 900, "ab " * 700, " " * 3000, "-" * 777, "x" * 64 + "y", "".join(rng.choice("abcdefghij") for _ in range(2000)), "哈" * 300, "don't we'll 'sx", "<|endoftext|>"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    monkeypatch.setattr(byte_bpe, "CHUNK_STRETCHES", 5000)  # several chunks a task
    rows = [(i, t, b"x") for i, t in enumerate(texts)]
    out = byte_bpe.encode_documents(spark.createDataFrame(rows, "doc_id bigint, text string, ids binary"), RANKS, public_tokenizers.PATTERN).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode_ordinary(texts[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == want, texts[r.doc_id][:100]
        assert r.n_tokens == len(want)
        assert bytes(r.decoded) == texts[r.doc_id].encode()


def test_nulls_repeats_and_nothing(spark):
    rows = [(None, None), (1, None), (1, "a b"), (1, "a b"), (None, "c")]
    out = byte_bpe.encode_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.decoded)) for r in out) == [("1", 0, b""), ("1", 2, b"a b"), ("1", 2, b"a b"), ("None", 0, b""), ("None", 1, b"c")]
    assert byte_bpe.encode_documents(spark.createDataFrame([], "doc_id bigint, text string"), RANKS, public_tokenizers.PATTERN).collect() == []


def test_no_piece_of_the_ranks_is_out_of_reach(library):
    """What the folds rest on: the bytes of a piece, merged alone, give the piece."""
    ranks = byte_bpe.read_ranks(RANKS)
    pairs = byte_bpe.last_pairs(ranks)
    assert len(pairs) == sum(len(p) > 1 for p in ranks)
    assert all(ranks[a] < ranks[p] or len(a) == 1 for p, (a, b) in pairs.items())
    assert all(ranks[b] < ranks[p] or len(b) == 1 for p, (a, b) in pairs.items())


def test_stretches_are_cut_where_no_word_reaches_over(library):
    import regex

    word = regex.compile(byte_bpe.aligned_pattern(public_tokenizers.PATTERN))
    rng = random.Random(9)
    for wide in (True, False):
        texts = ["".join(rng.choice("ab  \n\t'.9　\0" if wide else "ab .'9") for _ in range(rng.randint(0, 30))) for _ in range(300)]
        texts = texts if wide else [" ".join(t.split()) for t in texts] + [" a", ""]
        flat, ends = byte_bpe._stretches(pa.array(texts))
        for text, start, end in zip(texts, [0, *ends[:-1]], ends, strict=True):
            cut = flat[start:end].to_pylist()
            assert "".join(cut) == text
            assert [w for s in cut for w in word.findall(s)] == word.findall(text)


def test_no_row_of_a_chunk_holds_all_of_it():
    """A chunk goes through the JVM as rows of bounded size, in place of one row that grows with it."""
    texts = [" ".join(f"w{chr(97 + i % 26)}{(i * 200 + j) % 40000:x}" for j in range(200)) for i in range(2000)]
    docs = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(2000), pa.int64()), "text": texts})
    sizes = [b.nbytes for b in byte_bpe._chunker(public_tokenizers.PATTERN, byte_bpe.aligned_pattern(public_tokenizers.PATTERN))([docs])]
    assert sum(sizes) > 1_600_000  # the places of all words
    assert max(sizes) < 500_000


def test_words_of_plain_stretches_are_those_of_the_pattern():
    import regex

    rng = random.Random(5)
    stretches = ["", " ", "don't", "don'", " it's,", "éÀÿ.", "×÷", " a1", " 12,", "1½", " _a", "a_", " a\n", "a\n\nb", "ª.", "aé", "", " 's"]
    stretches += ["".join(rng.choice(" abÀé×19²'.,_|~\ń中") for _ in range(rng.randint(0, 6))) for _ in range(3000)]
    stretches = list(dict.fromkeys(stretches))
    patterns = public_tokenizers.PATTERN, byte_bpe.aligned_pattern(public_tokenizers.PATTERN)
    word = regex.compile(patterns[1])
    chunk = byte_bpe._Chunk(patterns)
    assert chunk.plain
    for plain in (True, False):
        chunk.plain = plain
        words, places, counts = chunk._words(pa.array(stretches))
        listed = words.to_pylist()
        assert len(listed) == len(set(listed))
        found = iter(places)
        assert [[listed[next(found)] for _ in range(n)] for n in counts] == [word.findall(s) for s in stretches]


def test_chunks_without_words(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK_STRETCHES", 1)
    monkeypatch.setattr(byte_bpe, "ROWS", 1)
    rows = [(i, None if i % 3 else f"a {i}") for i in range(12)]
    out = byte_bpe.encode_documents(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in out) == [(i, (t or "").encode()) for i, t in rows]
