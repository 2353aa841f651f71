"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A text is cut into words by a pattern.  The documents of a task become chunks: the distinct
words of their texts, and for each document the places of its words among them.  A distinct
word is a string of a character for each byte (ISO 8859-1), and every longer piece has a
character of its own.  The string is folded: the merges of its parts that have a rank, in the
order of the ranks, each put the character of a piece for the two it is joined of.  Decoding
concatenates the pieces of the ids.  Then each document takes what its words became.

Nothing is shuffled or broadcast, and a chunk is bounded but for its last document, so the
work grows with the texts.  A chunk travels as rows of bounded size, its words before its
documents, so no task holds a row as large as a chunk.  Spark looks a key up in a map by
scanning it, so the rank map is an array of small maps by the hash of a key.
"""

from __future__ import annotations

import base64
import itertools
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import map_batches, table

#: Small maps that the rank map is dealt over.
BUCKETS = 1 << 16
#: Words of more bytes join all occurrences of the lowest rank in a step, shorter ones the first.
LONG_WORD = 64
#: Stretches between spaces after which a chunk ends, and words put together at once, in a row.
CHUNK_STRETCHES, AT_ONCE = 5_000_000, 100_000
#: Distinct words of a row.
ROW_WORDS = 1000
#: Documents cut at once.
ROWS = 2000

_BYTES = "ISO-8859-1"
_CUT = re.compile(r"(?<=\S)(?= )")
#: White space before a space, where ``_CUT`` doesn't cut, or the character that marks where it does.
_WIDE = "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace()) + "] |\\x00"
#: The pattern of GPT-2, and stretches that it cuts in one or two words: letters or digits of the same kind in all versions of Unicode, then ASCII signs.
_GPT2 = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = r"^(?P<word> ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+))(?P<signs>[!-/:-@\[-`{-~]*)$"
#: The same of another pattern: none.
_NONE = r"\z(?P<word>.)(?P<signs>.)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bucketed(spark: SparkSession, entries: dict[str, object], kind: str) -> Column:
    """A literal map from strings to values of a SQL type, as an array of small maps by the hash of the key."""
    buckets: list[dict[str, object]] = [{} for _ in range(BUCKETS)]
    keys = spark.createDataFrame(pd.DataFrame({"key": list(entries)}, dtype=object), "key string")
    for row in keys.select("key", _bucket(F.col("key")).alias("at")).collect():
        buckets[row.at][row.key] = entries[row.key]
    return F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")


def _bucket(key: Column) -> Column:
    return F.hash(key).bitwiseAND(BUCKETS - 1)


def looked_up(buckets: Column, key: Column) -> Column:
    """The value of a key; null for other keys."""
    return F.element_at(F.get(buckets, _bucket(key)), key)


def read_ranks(path: str) -> dict[bytes, int]:
    """The pieces of a rank file: a line each of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def _class(code_points: Iterable[int]) -> str:
    """Code points as a set of a pattern."""
    ranges: list[list[int]] = []
    for c in sorted(code_points):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in ranges) + "]"


def aligned_pattern(pattern: str) -> str:
    """``pattern`` so that this library matches what the tokenizer's does: letters and numbers of its version of Unicode."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    for name in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(map(ord, library.decode(library.encode_ordinary(every))))
        ours = set(map(ord, regex.findall(name, every)))
        if theirs - ours:
            raise ValueError(f"the tokenizer's library knows characters of {name} that this one doesn't: {_class(theirs - ours)}")
        if ours - theirs:
            pattern = pattern.replace(name, f"[{name}--{_class(ours - theirs)}]")
    return f"(?V1){pattern}"


def last_pairs(ranks: dict[bytes, int]) -> dict[bytes, tuple[bytes, bytes]]:
    """The two pieces that each longer piece is joined of at last, when its own bytes are merged."""
    out = {}
    for piece in ranks:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 2:
            joins = [ranks.get(a + b, 1 << 32) for a, b in zip(parts, parts[1:], strict=False)]
            at = joins.index(min(joins))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out[piece] = (parts[0], parts[1])
    return out


def token_character(rank: int, piece: bytes) -> str:
    """The character that a piece is in a folded word: that of its byte, or one beyond the 256 of bytes that is no surrogate."""
    if len(piece) == 1:
        return piece.decode(_BYTES)
    return chr(256 + rank if 256 + rank < 0xD800 else 256 + rank + 0x800)


def _merge_ranked(word: Column, spans: Column, find: Callable[[Column], Column], tokens: Column) -> Column:
    """The merges that the parts of a word allow, folded over the word in the order of their ranks.

    A merge replaces its pair wherever the two stand side by side, from the left; a join never has
    a lower rank than its parts, so one pass does.  ``spans`` has the parts of words of each length.
    """
    parts = F.transform(F.get(spans, F.length(word)), lambda part: F.substr(word, part["at"], part["n"]))
    merges = F.sort_array(F.array_compact(F.transform(parts, find)))
    return F.aggregate(merges, word, lambda state, rank: F.replace(state, F.get(tokens, rank)["pair"], F.get(tokens, rank)["token"]))


def _merge_rounds(word: Column, find: Callable[[Column], Column], tokens: Column, ids: Callable[[Column], Column]) -> Column:
    """The same for a long word: each step looks up the pairs there are and joins all of the lowest rank."""

    def step(state: Column) -> Column:
        pieces = F.transform(ids(state["word"]), lambda i: F.get(tokens, i)["piece"])
        ranks = let(pieces, lambda p: F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: find(F.concat(a, b))))
        after = let(F.array_min(ranks), lambda rank: F.struct(
            F.when(rank.isNull(), state["word"]).otherwise(F.replace(state["word"], F.get(tokens, rank)["pair"], F.get(tokens, rank)["token"])).alias("word"),
            rank.isNotNull().alias("open"),
        ))
        return F.when(state["open"], after).otherwise(state)

    steps = F.sequence(F.lit(2), F.length(word))
    return F.aggregate(steps, F.struct(word.alias("word"), F.lit(True).alias("open")), lambda state, _: step(state), lambda state: state["word"])


def merged(word: Column, spans: Column, find: Callable[[Column], Column], tokens: Column, ids: Callable[[Column], Column]) -> Column:
    """The ids of the pieces that a word (a character for each byte) ends as."""
    folded = F.when(F.length(word) > LONG_WORD, _merge_rounds(word, find, tokens, ids)).otherwise(_merge_ranked(word, spans, find, tokens))
    return ids(F.coalesce(F.get(tokens, find(word))["token"], folded))


class Codec:
    """Encoding and decoding of words by the ranks of a file, given as literals."""

    def __init__(self, spark: SparkSession, path: str):
        ranks = read_ranks(path)
        pairs = last_pairs(ranks)
        token = {piece: token_character(rank, piece) for piece, rank in ranks.items()}
        tokens: list[dict[str, str] | None] = [None] * (max(ranks.values(), default=-1) + 1)
        by_character: list[int | None] = [None] * (max(map(ord, token.values()), default=-1) + 1)
        for piece, rank in ranks.items():
            pair = "".join(token[part] for part in pairs.get(piece, (piece,)))
            tokens[rank] = {"pair": pair, "token": token[piece], "piece": piece.decode(_BYTES)}
            by_character[ord(token[piece])] = rank
        self._ranks = bucketed(spark, {piece.decode(_BYTES): rank for piece, rank in ranks.items()}, "int")
        self._tokens = F.from_json(F.lit(json.dumps(tokens)), "array<struct<pair:string,token:string,piece:string>>")
        self._by_character = F.from_json(F.lit(json.dumps(by_character)), "array<int>")
        spans = [[{"at": at, "n": n} for at in range(1, length) for n in range(2, length - at + 2)] for length in range(LONG_WORD + 1)]
        self._spans = F.from_json(F.lit(json.dumps(spans)), "array<array<struct<at:int,n:int>>>")

    def encode_all(self, words: Column) -> Column:
        """An array of words (a character for each byte) as an array of their ids; each literal stands in the plan once."""

        def encoded(ranks: Column, tokens: Column, by_character: Column, spans: Column) -> Column:
            ids = lambda state: F.transform(F.split(state, ""), lambda c: F.get(by_character, F.ascii(c)))
            return F.transform(words, lambda word: merged(word, spans, lambda piece: looked_up(ranks, piece), tokens, ids))

        return let(self._ranks, lambda ranks: let(self._tokens, lambda tokens: let(self._by_character, lambda characters: let(
            self._spans, lambda spans: encoded(ranks, tokens, characters, spans)
        ))))

    def decode_all(self, ids: Column) -> Column:
        """An array of ids as an array of the bytes they stand for: the pieces of each, one after another."""
        decoded = lambda tokens, row: F.encode(F.array_join(F.transform(row, lambda i: F.get(tokens, i)["piece"]), ""), _BYTES)
        return let(self._tokens, lambda tokens: F.transform(ids, lambda row: decoded(tokens, row)))


#: Rows of a chunk: those of its words, then those of its documents.
_CHUNK = "chunk int, words array<string>, doc_ids array<bigint>, counts array<int>, places array<int>"


def _stretches(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut before each space that follows no white space, where no word reaches over: the stretches, and the end of each text's.

    Empty stretches may come in between.
    """
    wide = pc.match_substring_regex(texts, _WIDE)
    cut = pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")
    if not pc.any(wide).as_py():
        return cut.flatten(), cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()
    lists = [_CUT.split(t) if w else c for t, w, c in zip(texts.to_pylist(), wide.to_pylist(), cut.to_pylist(), strict=True)]
    return pa.array(itertools.chain.from_iterable(lists), pa.string()), np.cumsum([len(x) for x in lists])


def _row(chunk: int, words: pa.Array, doc_ids: pa.Array, counts: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    columns = words, doc_ids, pa.array(counts, pa.int32()), pa.array(places, pa.int32())
    lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *lists], ["chunk", "words", "doc_ids", "counts", "places"])


class _Chunk:
    """Documents, and the places of their stretches among the distinct ones; the first pattern is for ASCII."""

    def __init__(self, patterns: tuple[str, str], number: int = 0):
        self.plain = patterns[0] == _GPT2
        self.word, self.ascii_word = regex.compile(patterns[1]), regex.compile(patterns[0])
        self.number, self.ids, self.stretches, self.lengths, self.held = number, [], [], [], 0

    def add(self, doc_ids: pa.Array, texts: pa.Array) -> None:
        flat, ends = _stretches(pc.fill_null(texts, ""))
        self.ids.append(pa.concat_arrays([doc_ids]))
        self.stretches.append(flat.dictionary_encode())
        self.lengths.append(np.diff(ends, prepend=0))
        self.held += len(flat)

    def _words(self, stretches: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct words of distinct stretches, the places of those of each stretch among them, and their number."""
        cut = pc.extract_regex(stretches, _PLAIN if self.plain else _NONE)
        plain = np.asarray(cut.is_valid())
        cut = cut.drop_null()
        head, tail = cut.field("word"), cut.field("signs")
        signs = np.asarray(pc.not_equal(tail, ""), bool)
        others = [(self.ascii_word if s.isascii() else self.word).findall(s) for s in stretches.filter(pa.array(~plain)).to_pylist()]
        counts = np.empty(len(stretches), np.int64)
        counts[plain], counts[~plain] = 1 + signs, np.fromiter(map(len, others), np.int64, len(others))
        starts = np.cumsum(counts) - counts
        at = [starts[plain], starts[plain][signs] + 1, _taken(np.arange(counts.sum()), starts[~plain], counts[~plain])]
        listed = pa.concat_arrays([head, tail.filter(pa.array(signs)), pa.array(itertools.chain.from_iterable(others), pa.string())]).dictionary_encode()
        places = np.empty(len(listed), np.int32)
        places[np.concatenate(at)] = listed.indices.to_numpy()
        return listed.dictionary, places, counts

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The distinct words, then the documents with the places of their words among these; the chunk is empty then."""
        encoded = pa.chunked_array(self.stretches).unify_dictionaries()
        self.stretches.clear()
        words, flat, lengths = self._words(encoded.chunk(0).dictionary)
        stretches = np.concatenate([c.indices.to_numpy() for c in encoded.chunks])
        encoded = None
        places = _taken(flat, (np.cumsum(lengths) - lengths)[stretches], lengths[stretches])
        ends = np.concatenate([[0], np.cumsum(lengths[stretches])])[np.cumsum(np.concatenate([[0], *self.lengths]))]
        stretches = flat = lengths = None
        doc_ids = pa.concat_arrays(self.ids)
        pa.default_memory_pool().release_unused()  # the worker stays while the chunk is folded
        for at in range(0, len(words), ROW_WORDS):
            some = pa.array([w.encode().decode(_BYTES) for w in words[at : at + ROW_WORDS].to_pylist()], pa.string())
            yield _row(self.number, some, doc_ids[:0], ends[:0], places[:0])
        at = 0
        while at < len(doc_ids):
            until = max(at + 1, int(np.searchsorted(ends, ends[at] + AT_ONCE, "right")) - 1)
            yield _row(self.number, words[:0], doc_ids[at:until], np.diff(ends[at : until + 1]), places[ends[at] : ends[until]])
            at = until


def _chunker(*patterns: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts the documents of a task into chunks."""

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(patterns)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                rows = batch.slice(at, ROWS)
                chunk.add(rows.column("doc_id"), rows.column("text"))
                if chunk.held >= CHUNK_STRETCHES:
                    yield from chunk.rows()
                    chunk = _Chunk(patterns, chunk.number + 1)
        batch = rows = None  # not held while the last chunk is folded
        if chunk.ids:
            yield from chunk.rows()

    return chunks


def _taken(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that start there and are so long, one after another."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _joined(ids: list[pa.Array], pieces: list[pa.Array]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The ids and the bytes of a chunk's words: the bounds of each word's among all, and all."""
    ids, pieces = pa.concat_arrays(ids), pa.concat_arrays(pieces)
    offsets = np.frombuffer(pieces.buffers()[1], np.int32)[: len(pieces) + 1]
    values = ids.values.to_numpy().astype("<u4"), np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
    return [(ids.offsets.to_numpy().astype(np.int64), values[0]), (offsets.astype(np.int64), values[1])]


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids and bytes of each document of a chunk, from those of its words, which come first."""
    chunk, held, words = None, ([], []), []
    for batch in batches:
        for row in range(len(batch)):
            number, doc_ids = batch.column("chunk")[row].as_py(), batch.column("doc_ids")[row].values
            if number != chunk:
                chunk, words = number, []
            if not len(doc_ids):
                for arrays, column in zip(held, ("ids", "bytes"), strict=True):
                    arrays.append(pa.concat_arrays([batch.column(column)[row].values]))
                continue
            if held[0]:
                words, held = _joined(*held), ([], [])
            counts, places = (batch.column(c)[row].values.to_numpy() for c in ("counts", "places"))
            ends, made = np.concatenate([[0], np.cumsum(counts)]), []
            for start, value in words or [(np.zeros(1, np.int64), np.empty(0, t)) for t in ("<u4", np.uint8)]:
                lengths = np.diff(start)[places]
                data = _taken(value, start[places], lengths)
                bounds = np.concatenate([[0], np.cumsum(lengths)])[ends] * value.itemsize
                made.append(pa.Array.from_buffers(pa.large_binary(), len(doc_ids), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([doc_ids, *made], ["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32 bits), and decoded (the bytes of the ids).

    Every row gives a row, whatever its id: null or repeated ids stay.  Null and empty texts have
    no ids and decode to no bytes.  Columns but doc_id and text are left aside, so that no name
    clashes.  Words of any length are folded whole.
    """
    codec = Codec(docs.sparkSession, path)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = map_batches(source, _chunker(pattern, aligned_pattern(pattern)), _CHUNK)
    encoded = chunks.select("chunk", "doc_ids", "counts", "places", codec.encode_all(F.col("words")).alias("ids"))
    decoded = encoded.select("*", codec.decode_all(F.col("ids")).alias("bytes"))
    out = map_batches(decoded, _documents, "doc_id bigint, ids binary, decoded binary")
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", "decoded")


def query(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
