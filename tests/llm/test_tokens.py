"""Archives, tokens and packing: round trips and the tokenizers library."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tracewell.llm import bpe, packing, warc

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "abcdeéÉ'’ßΣσςİı 19²½\n\t\x1c\x85　<|>ñ中文가Åͅﬁ😀𝔸!!##ẞ́"


def fuzz(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


ODD = ["", "a" * 900, "ab " * 700, "x<|endoftext|>Y'S don't <|startoftext|><|endoftext|>", "ΑΣ ΑΣΑ", "ΩKᲉx", "हिन्दी à", "  \n\n  ", "word. Word, WORD! it's"]


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r.text for r in docs] + fuzz(300, 5) + ODD


def test_encoding_equals_the_library(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    out = {r.doc_id: r for r in bpe.encode_documents(df, WORD_BPE, bpe.build_lexicon(df, WORD_BPE, 2000)).collect()}
    library = Tokenizer.from_file(WORD_BPE)
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(out[i].ids, "<u4").tolist() == ids, t
        assert out[i].n_tokens == len(ids)
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encoding_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    path = bpe.build_lexicon(empty, WORD_BPE)
    assert bpe.encode_documents(empty, WORD_BPE, path).collect() == []
    assert bpe.Lexicon.load(path).places([b"word"]).tolist() == [-1]


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = [b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"a"]
    ids = {w: np.arange(i + 1, dtype=np.uint32) for i, w in enumerate(words)}
    lexicon = bpe.Lexicon.build(ids)
    assert len(lexicon.final) == 7  # root, st, t, ta/to, ta..p, final with s, final
    lexicon.save(str(tmp_path / "x" / "lexicon.bin"))
    lexicon = bpe.Lexicon.load(str(tmp_path / "x" / "lexicon.bin"))
    asked = [*words, b"", b"ta", b"tapss", b"b", b"tops"]
    for w, p in zip(asked, lexicon.places(asked).tolist(), strict=True):
        assert (p >= 0) == (w in ids)
        if p >= 0:
            assert lexicon.ids_of(p).tolist() == ids[w].tolist()


def test_merging_side_by_side_equals_merging_alone():
    merges = bpe.Merges(WORD_BPE)
    words = [w.encode() for w in ("internationalisation", "aaaaaaa", "aaaa", "zzzz", "a", "the", "abababab", "ééé", "!!!!")]
    assert [x.tolist() for x in merges.merge(words)] == [merges.merge_long(w).tolist() for w in words]


# --- packing

def test_pieces_hold_the_library_s_ids(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, "again"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    library = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or min(len(ids), 2048)
        bounds = [0, *range(first, len(ids), 2048), len(ids)]
        for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            want[(i, p, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    out = packing.pack_documents(df).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    check_places(out)


def check_places(rows, room=2048):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= room
    return len(places)


def test_packing_of_a_hot_length(spark):
    rows = [(i, 0, 0, 700 if i % 3 else 1 + i % 50, i) for i in range(3000)]
    out = packing.pack(spark.createDataFrame(rows, packing.PIECES)).collect()
    assert len(out) == 3000
    assert check_places(out) <= 1010
    assert packing.pack(spark.createDataFrame([], packing.PIECES)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_take_each_piece_once_and_waste_little(seed):
    rng = random.Random(seed)
    room = rng.choice([16, 64, 2048])
    histogram = Counter(min(room, max(1, int(rng.lognormvariate(2 + seed, 1)))) for _ in range(4000))
    sequences = packing.plan(dict(histogram), room)
    taken = Counter()
    for lengths, times in sequences:
        assert times > 0 and sum(lengths) <= room
        for x in lengths:
            taken[x] += times
    assert taken == histogram
    total = -(-sum(k * v for k, v in histogram.items()) // room)
    large = sum(v for k, v in histogram.items() if 2 * k > room)
    assert sum(t for _, t in sequences) <= 1.02 * max(total, large) + 1


def test_complements_fill_exactly():
    assert packing.plan({10: 2, 6: 2}, 16) == [((10, 6), 2)]
    assert packing.plan({10: 1, 4: 1, 2: 1}, 16) == [((10, 4, 2), 1)]
    assert packing.plan({9: 1, 4: 1, 2: 1, 1: 1}, 16) == [((9, 4, 2, 1), 1)]
    assert sum(t for _, t in packing.plan({8: 3}, 16)) == 2


# --- archives

def test_archives_round_trip(spark, tmp_path):
    html = ["<p>same</p>" * 50, "", None, "<b>é\r\n\r\n</b>", "x" * 200_000]
    rows = [(i, f"http://h/{i} a\n" if i % 3 else None, html[i % 5] if i % 2 else f"<html>{i} {'body ' * (i % 40)}</html>", "x") for i in range(400)]
    rows += [(None, "u", html[0], "x"), (None, "u", "only", "x"), (3, "again", html[3], "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string")
    archives = warc.write_archives(pages, f"file://{tmp_path}/warc")
    out = warc.read_archives(archives).collect()
    assert len(out) == len(rows) == sum(r.records for r in archives.collect())
    firsts = {}
    for i, _, h, _ in rows:
        if i is not None:
            firsts[h or ""] = min(firsts.get(h or "", i), i)
    want = Counter()
    for i, _, h, _ in rows:
        data = (h or "").encode()
        refers = firsts.get(h or "") if firsts.get(h or "") != i else None
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if refers is not None else "response", refers)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    payloads = {r.payload_digest: bytes(r.payload) for r in out if r.record_type == "response"}
    assert all(hashlib.sha1(p).digest() == base64.b32decode(d) for d, p in payloads.items())


def test_archives_of_nothing(spark, tmp_path):
    archives = warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), str(tmp_path / "w"))
    assert archives.collect() == [] and warc.read_archives(archives).collect() == []


def test_dictionary_leads_the_archive():
    records = [warc.build_record(i, f"http://h/{i}", f"<html><body>shared boilerplate of the site, page {i}</body></html>".encode() * 9, None) for i in range(200)]
    data = warc.archive_bytes(records)
    assert data[:4] == bytes.fromhex("5d2a4d18")
    assert list(warc.frames(data)) == records
    few = warc.archive_bytes(records[:2])
    assert few[:4] == bytes.fromhex("28b52ffd") and list(warc.frames(few)) == records[:2]
    with pytest.raises(ValueError):
        list(warc.frames(few[:-3]))
