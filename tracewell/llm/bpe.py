"""BPE encoding and decoding with a lexicon compiled into a minimal acyclic transducer.

Frequent words of the corpus, each with its token ids, become an automaton whose states
share suffixes; its arcs carry numbers that add up to a word's place in the table of ids.
The automaton is one file of flat arrays in the shared folder, memory-mapped by the tasks.
Words it doesn't know are merged exactly, many at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame, functions as F

from tracewell.plans.workspace import stage_path

from .common import map_batches, once_per_worker, table

#: Words in the lexicon, and the least share of a task's words that a word needs to be counted in it.
LEXICON_WORDS, LEAST_SHARE = 1 << 16, 1e-5
#: Pieces of text whose ids a task remembers, bytes of text encoded at once, and bytes of a word merged alone.
REMEMBERED, AT_ONCE, LONG_WORD = 200_000, 2 << 20, 256

# Fixed value: the pattern that cuts a text into words, as the vocabulary file states it.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

#: Beyond these blocks libraries differ by their version of Unicode; there the tokenizer's own one decides.
UNLIKE = re.compile("[^\u0000-\u024f\u0370-\u0373\u0386-\u03ce\u0410-\u044f\u2010-\u205f\u20a0-\u20bf\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")

_LETTERS_ONLY = bytes(32 if b < 128 and not (65 <= b <= 90 or 97 <= b <= 122) else b for b in range(256))


def normalized(text: str) -> str:
    """Composed and lower-cased character by character."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Merges:
    """The vocabulary and the merges of a tokenizer file with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special = {k.encode(): v for k, v in added.items()}
        size = max([*vocab.values(), *added.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *added.items()]:
            self.tokens[i] = token
        characters = _byte_characters()
        self.first = np.array([vocab[c] for c in characters], np.int64)
        self.last = np.array([vocab[c + end] for c in characters], np.int64)
        pairs = np.array([(vocab[a] << 16 | vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])], np.int64)
        self.keys, self.ranks, self.merged = pairs[np.argsort(pairs[:, 0])].T.copy()
        self.none = len(pairs)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left << 16 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none), at

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: the pair of lowest rank first, leftmost first, all words side by side."""
        out: list[np.ndarray | None] = [None] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self.merge_long(w)
            elif w:
                short.append(i)
            else:
                out[i] = np.empty(0, np.uint32)
        if not short:
            return out
        lengths = np.array([len(words[i]) for i in short])
        data = np.frombuffer(b"".join(words[i] for i in short), np.uint8)
        symbols, owner = self.first[data], np.repeat(np.arange(len(short)), lengths)
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        while len(symbols):
            ranks, at = self._ranks_of(symbols, np.append(symbols[1:], 0))
            ranks[np.append(owner[1:] != owner[:-1], True)] = self.none
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(ranks, starts)
            each = np.repeat(best, np.diff(np.append(starts, len(symbols))))
            for s, e in zip(starts[best == self.none], np.append(starts[1:], len(symbols))[best == self.none], strict=True):
                out[short[owner[s]]] = symbols[s:e].astype(np.uint32)
            hit = (ranks == each) & (ranks < self.none)
            # of pairs that overlap, as in a run of one symbol, every other one from the left
            spots = np.arange(len(hit))
            run = spots - np.maximum.accumulate(np.where(~hit, spots + 1, 0))
            hit &= run % 2 == 0
            symbols = np.where(hit, self.merged[at], symbols)
            keep = ~np.append(False, hit[:-1]) & (each < self.none)
            symbols, owner = symbols[keep], owner[keep]
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, by a heap of pairs."""
        symbols = [int(self.first[b]) for b in word]
        symbols[-1] = int(self.last[word[-1]])
        table = self._table()
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        heap = [(table[p][0], i, p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in table]
        heapq.heapify(heap)
        alive = [True] * len(symbols)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or (symbols[i], symbols[j]) != pair:
                continue
            symbols[i], alive[j], after[i] = table[pair][1], False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (p := (symbols[a], symbols[b])) in table:
                    heapq.heappush(heap, (table[p][0], a, p))
        return np.array([s for s, ok in zip(symbols, alive, strict=True) if ok], np.uint32)

    def _table(self) -> dict[tuple[int, int], tuple[int, int]]:
        if not hasattr(self, "_pairs"):
            self._pairs = {(int(k) >> 16, int(k) & 0xFFFF): (int(r), int(m)) for k, r, m in zip(self.keys, self.ranks, self.merged, strict=True)}
        return self._pairs

    def decode(self, ids: np.ndarray) -> str:
        """Tokens with spaces between: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


@dataclass
class Lexicon:
    """A minimal acyclic automaton as flat arrays: arcs by (state, byte), and the ids of each word."""

    arcs: np.ndarray
    targets: np.ndarray
    outputs: np.ndarray
    final: np.ndarray
    starts: np.ndarray
    ids: np.ndarray

    _KINDS = (("arcs", "<i8"), ("targets", "<i4"), ("outputs", "<i4"), ("final", "u1"), ("starts", "<i8"), ("ids", "<u4"))

    @classmethod
    def build(cls, words: dict[bytes, np.ndarray]) -> Lexicon:
        """From words in sorted order, states that accept the same rest being one from the start."""
        ordered = sorted(w for w in words if w)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def settle(final: bool, arcs: list[tuple[int, int]]) -> int:
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        open_path: list[tuple[bool, list[tuple[int, int]]]] = [(False, [])]  # of the last word, with its settled arcs
        last = b""

        def close(depth: int) -> None:
            while len(open_path) > depth + 1:
                state = settle(*open_path.pop())
                open_path[-1][1].append((last[len(open_path) - 1], state))

        for word in ordered:
            shared = 0
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
            close(shared)
            open_path += [(i == len(word) - 1, []) for i in range(shared, len(word))]
            last = word
        close(0)
        root = settle(*open_path[0])
        # words reachable from a state: targets are settled before their sources
        reach = np.zeros(len(states), np.int64)
        for i, (final, arcs) in enumerate(states):
            reach[i] = final + sum(reach[t] for _, t in arcs)
        number = {root: 0}  # the root first
        for i in range(len(states)):
            number.setdefault(i, len(number))
        rows = []
        for i, (final, arcs) in enumerate(states):
            passed = int(final)
            for label, target in arcs:
                rows.append((number[i] << 8 | label, number[target], passed))
                passed += int(reach[target])
        rows.sort()
        arcs, targets, outputs = (np.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else ([], [], []), ("<i8", "<i4", "<i4"), strict=True))
        final = np.zeros(len(states), np.uint8)
        for i, (is_final, _) in enumerate(states):
            final[number[i]] = is_final
        lengths = [len(words[w]) for w in ordered]
        ids = np.concatenate([words[w] for w in ordered]).astype("<u4") if ordered else np.empty(0, "<u4")
        return cls(arcs, targets, outputs, final, np.concatenate([[0], np.cumsum(lengths)]).astype("<i8"), ids)

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's number in the lexicon, -1 for words it doesn't hold; all words walk side by side."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        begins = np.cumsum(lengths) - lengths
        state, out = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        walking = np.flatnonzero(lengths > 0) if len(self.arcs) else np.empty(0, np.int64)
        state[lengths == 0] = -1
        if not len(self.arcs):
            return np.full(len(words), -1)
        step = 0
        while len(walking):
            keys = state[walking] << 8 | data[begins[walking] + step]
            at = np.minimum(np.searchsorted(self.arcs, keys), len(self.arcs) - 1)
            found = self.arcs[at] == keys
            state[walking[~found]] = -1
            walking, at = walking[found], at[found]
            state[walking] = self.targets[at]
            out[walking] += self.outputs[at]
            step += 1
            walking = walking[lengths[walking] > step]
        known = (state >= 0) & (self.final[np.maximum(state, 0)] > 0)
        return np.where(known, out, -1)

    def ids_of(self, place: int) -> np.ndarray:
        return self.ids[self.starts[place] : self.starts[place + 1]]

    def save(self, path: str) -> None:
        """One file: the lengths of the arrays, then the arrays."""
        store, inner = pyarrow.fs.FileSystem.from_uri(path) if ":" in path else (pyarrow.fs.LocalFileSystem(), path)
        store.create_dir(inner.rpartition("/")[0], recursive=True)
        arrays = [np.ascontiguousarray(getattr(self, n), k) for n, k in self._KINDS]
        with store.open_output_stream(inner, compression=None) as f:
            f.write(np.array([len(a) for a in arrays], "<i8").tobytes())
            for a in arrays:
                f.write(a.tobytes())

    @classmethod
    def load(cls, path: str) -> Lexicon:
        """Mapped into memory where the folder is mounted; read where it is not."""
        store, inner = pyarrow.fs.FileSystem.from_uri(path) if ":" in path else (pyarrow.fs.LocalFileSystem(), path)
        if isinstance(store, pyarrow.fs.LocalFileSystem):
            raw = np.memmap(inner, np.uint8, "r")
        else:
            with store.open_input_stream(inner, compression=None) as f:
                raw = np.frombuffer(f.read(), np.uint8)
        sizes = raw[: 8 * len(cls._KINDS)].view("<i8")
        arrays, at = [], 8 * len(cls._KINDS)
        for n, (_, kind) in zip(sizes, cls._KINDS, strict=True):
            end = at + int(n) * np.dtype(kind).itemsize
            arrays.append(np.frombuffer(raw[at:end].data, kind))
            at = end
        return cls(*arrays)


class Encoder:
    """Whole texts to ids: pieces between white space are looked up, cut into words and merged once each."""

    def __init__(self, tokenizer_path: str, lexicon: Lexicon | None = None):
        self.path = tokenizer_path
        self.merges = Merges(tokenizer_path)
        self.lexicon = lexicon
        self.memory: dict[bytes, bytes] = {}
        self.library = None
        self.special = re.compile(b"(" + b"|".join(map(re.escape, self.merges.special)) + b")") if self.merges.special else None

    def words(self, words: list[bytes]) -> list[bytes]:
        """Each word's ids as little-endian unsigned 32-bit integers."""
        places = self.lexicon.places(words) if self.lexicon is not None else np.full(len(words), -1)
        unseen = np.flatnonzero(places < 0)
        merged = iter(self.merges.merge([words[i] for i in unseen]))
        return [self.lexicon.ids_of(p).tobytes() if p >= 0 else next(merged).astype("<u4", copy=False).tobytes() for p in places.tolist()]

    def _by_library(self, text: str) -> bytearray:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return bytearray(np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes())

    def _cut(self, piece: bytes) -> list[bytes | bytearray]:
        """The words of a piece; where ids are known at once, those as a bytearray."""
        parts: list[bytes | bytearray] = []
        for segment in self.special.split(piece) if self.special and b"<|" in piece else (piece,):
            if segment in self.merges.special:
                parts.append(bytearray(np.array([self.merges.special[segment]], "<u4").tobytes()))
                continue
            text = segment.decode("utf-8", "replace")
            if UNLIKE.search(text):
                parts.append(self._by_library(text))
            else:
                parts += map(str.encode, WORD.findall(normalized(text)))
        return parts

    def _resolve(self, pieces: Iterable[bytes]) -> None:
        plain: dict[bytes, bytes] = {}
        cuts: dict[bytes, list[bytes | bytearray]] = {}
        for piece in pieces:
            if piece.isalpha():  # ASCII letters are one word
                plain[piece] = piece.lower()
            else:
                cuts[piece] = self._cut(piece)
        distinct = list({*plain.values(), *(w for parts in cuts.values() for w in parts if type(w) is bytes)})
        ids = dict(zip(distinct, self.words(distinct), strict=True))
        self.memory.update((piece, ids[word]) for piece, word in plain.items())
        self.memory.update((piece, b"".join([ids[p] if type(p) is bytes else p for p in parts])) for piece, parts in cuts.items())

    def encode_all(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text; texts are taken some megabytes at a time."""
        group: list[list[bytes]] = []
        size = 0

        def flush() -> Iterator[np.ndarray]:
            if len(self.memory) > REMEMBERED:
                self.memory.clear()
            self._resolve({p for pieces in group for p in pieces if p not in self.memory})
            for pieces in group:
                yield np.frombuffer(b"".join(map(self.memory.__getitem__, pieces)), "<u4")

        for text in texts:
            group.append(text.split())
            size += len(text)
            if size >= AT_ONCE:
                yield from flush()
                group, size = [], 0
        yield from flush()


def frequent_words(docs: DataFrame, words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent runs of letters of all texts, lower-cased; a list of bounded length.

    A word with less than LEAST_SHARE of a task's words isn't counted there.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            least = LEAST_SHARE * sum(held.values())
            rows = [(w, n) for w, n in held.items() if n >= least and len(w) <= LONG_WORD]
            columns = zip(*rows, strict=True) if rows else [[]] * 2
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64()), strict=True)], ["word", "n"])

        for batch in batches:
            for text in batch.column("text"):
                held.update((text.as_py() or b"").lower().translate(_LETTERS_ONLY).split())
                if len(held) > 1 << 20:
                    yield flush()
        yield flush()

    source = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    sums = map_batches(source, count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r["word"]) for r in sums.orderBy(F.desc("n"), "word").limit(words).collect()]


def build_lexicon(docs: DataFrame, tokenizer_path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of ``docs`` into a file of the shared folder; return its path."""
    found = set()
    for raw in frequent_words(docs, words):
        text = raw.decode("utf-8", "replace")
        if not UNLIKE.search(text):
            found.update(w.encode() for w in WORD.findall(normalized(text)))
    ordered = sorted(found)
    lexicon = Lexicon.build(dict(zip(ordered, Merges(tokenizer_path).merge(ordered), strict=True)))
    path = f"{stage_path(docs.sparkSession, 'llm-lexicon')}/lexicon.bin"
    lexicon.save(path)
    return path


def encoder_for(tokenizer_path: str, lexicon_path: str) -> Encoder:
    """One per worker process and lexicon."""
    return once_per_worker(("bpe", tokenizer_path, lexicon_path), lambda: Encoder(tokenizer_path, Lexicon.load(lexicon_path)))


def encode_documents(docs: DataFrame, tokenizer_path: str, lexicon_path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32 bits), n_tokens, and digests of the ids and of the text they decode to.

    Null and empty texts have no ids and decode to the empty text.  Extra columns are left aside.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer_path, lexicon_path)
        for batch in batches:
            rows = []
            for ids in encoder.encode_all(t.as_py() or b"" for t in batch.column("text")):
                data = ids.tobytes()
                decoded = encoder.merges.decode(ids).encode()
                rows.append((len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded).hexdigest(), data if with_ids else None))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], [f.split(" ")[0] for f in schema.split(", ")])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_batches(source, encode, schema)


def query(spark, sf_dir):
    import public_tokenizers

    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    return encode_documents(docs, path, build_lexicon(docs, path), with_ids=False).drop("ids")
