"""Packing token sequences: exact complements first, best fit for the rest.

Only the histogram of piece lengths (at most one entry per length up to the sequence
length) decides the plan: which combinations of lengths fill a sequence, and how many
times.  The pieces themselves are numbered within their length and find their place in
the plan by that number, so packing is two shuffles of narrow rows, whatever their count.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, number_from_zero, once_per_worker, stage, table

SEQUENCE = 2048
END_ID = 0
#: Chunks of a length when its pieces are numbered.
PARTS = 256

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACES = f"{PIECES}, sequence_id bigint, offset bigint"


class Encoder:
    """Token ids of whole texts, as the tokenizers library gives them for the vocabulary file.

    The rank file of the same vocabulary serves the faster library; texts with a character
    of ``unlike``, which the two libraries classify differently, go to the first.
    """

    def __init__(self, path: str, rank_path: str | None, special: dict[str, int]):
        import base64
        import re

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = set(special)
        self.ranks = None
        if rank_path is not None:
            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            # letters, digits and spaces beyond these planes and blocks are the same in every Unicode version
            self.unlike = re.compile("[^\u0000-\u024f\u0370-\u0373\u0386-\u03ce\u0410-\u044f\u2000-\u206f\u20a0-\u20bf\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")

    def ids(self, text: str) -> np.ndarray:
        if self.ranks is None or self.unlike.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranks.encode_to_numpy(text, allowed_special=self.special)


def cut(ids: np.ndarray, room: int = SEQUENCE) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids: whole sequences, before them what is left over."""
    starts = list(range(len(ids) % room, len(ids), room))
    if len(ids) % room:
        starts.insert(0, 0)
    for i, start in enumerate(starts):
        part = ids[start : starts[i + 1] if i + 1 < len(starts) else len(ids)]
        yield i, start, len(part), zlib.crc32(part.astype("<u4").tobytes())


def tokenize(docs: DataFrame, path: str, rank_path: str | None, special: dict[str, int], room: int = SEQUENCE) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text), each document's ids followed by id 0; null text is empty."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker(("packing", path, rank_path), lambda: Encoder(path, rank_path, special))
        names = [c.split(" ")[0] for c in PIECES.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(END_ID)).astype(np.uint32)
                rows += [(doc_id.as_py(), *piece) for piece in cut(ids, room)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), pieces, PIECES)


class Complements:
    """Sums of one, two and three available lengths, by which a gap is filled exactly."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.have = counts > 0

    def take(self, length: int, gap: int) -> tuple[int, ...] | None:
        """Lengths that sum to ``gap``, available beside one piece of ``length``: one, else two, else three."""
        self.counts[length] -= 1
        self.have[length] = self.counts[length] > 0
        try:
            return self._sum_of(gap)
        finally:
            self.counts[length] += 1
            self.have[length] = True

    def _sum_of(self, gap: int) -> tuple[int, ...] | None:
        if self.have[gap]:
            return (gap,)
        pair = self._pair(gap)
        if pair:
            return pair
        for a in np.flatnonzero(self.have[: gap - 1])[::-1]:
            a = int(a)
            if 3 * a < gap:
                break
            self.counts[a] -= 1
            self.have[a] = self.counts[a] > 0
            pair = self._pair(gap - a, a)
            self.counts[a] += 1
            self.have[a] = True
            if pair:
                return (a, *pair)
        return None

    def _pair(self, total: int, most: int | None = None) -> tuple[int, int] | None:
        """Two available lengths of this sum, the larger as large as can be and ``most`` at most."""
        low = np.arange(1, total // 2 + 1)
        both = self.have[low] & self.have[total - low]
        if total % 2 == 0 and total and self.counts[total // 2] < 2:
            both[-1:] = False
        if most is not None:
            both &= total - low <= most
        found = np.flatnonzero(both)
        return (total - int(low[found[0]]), int(low[found[0]])) if len(found) else None


def plan(histogram: dict[int, int], room: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, how many such), from the number of pieces of each length.

    From the longest down, each length is completed by exact complements as long as there are any;
    what stays is placed by best fit, longest first, many alike at a time.
    """
    counts = np.zeros(room + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out: list[tuple[tuple[int, ...], int]] = []
    if counts[room]:
        out.append(((room,), int(counts[room])))
        counts[room] = 0
    sums = Complements(counts)
    for length in range(room - 1, 0, -1):
        while counts[length]:
            rest = sums.take(length, room - length)
            if rest is None:
                break
            whole = (length, *rest)
            times = min(int(counts[x]) // whole.count(x) for x in set(whole))
            for x in whole:
                counts[x] -= times
                sums.have[x] = counts[x] > 0
            out.append((whole, times))
    # best fit: open sequences by gap; those with the smallest gap that fits take the next pieces
    open_by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = room - sum(lengths)
        if not gap:
            out.append((lengths, times))
            return
        if gap not in open_by_gap:
            bisect.insort(gaps, gap)
        open_by_gap.setdefault(gap, []).append((lengths, times))

    for length in range(room - 1, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                each = room // length
                if left >= each:
                    put((length,) * each, left // each)
                    left %= each
                else:
                    put((length,) * left, 1)
                    left = 0
                continue
            gap = gaps[at]
            lengths, times = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                del open_by_gap[gap], gaps[at]
            each = min(gap // length, left)
            many = min(times, left // each)
            if many < times:
                again = times - many
                if gap not in open_by_gap:
                    bisect.insort(gaps, gap)
                open_by_gap.setdefault(gap, []).append((lengths, again))
            put(lengths + (length,) * each, many)
            left -= each * many
    for rows in open_by_gap.values():
        out += rows
    return out


class Places:
    """Where the n-th piece of a length goes: the plan turned round."""

    def __init__(self, sequences: list[tuple[tuple[int, ...], int]], room: int = SEQUENCE):
        taken: dict[int, int] = {}
        slots: dict[int, list[tuple[int, int, int]]] = {}
        base = 0
        for lengths, times in sequences:
            offset = 0
            for x in lengths:
                slots.setdefault(x, []).append((taken.get(x, 0), base, offset))
                taken[x] = taken.get(x, 0) + times
                offset += x
            base += times
        self.sequences = base
        self.slots = {x: np.array(rows, np.int64).T for x, rows in slots.items()}

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        bounds = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for a, b in zip(bounds, bounds[1:], strict=False):
            rows = order[a:b]
            first, base, start = self.slots[int(lengths[rows[0]])]
            at = np.searchsorted(first, numbers[rows], "right") - 1
            sequence[rows] = base[at] + numbers[rows] - first[at]
            offset[rows] = start[at]
        return sequence, offset


def pack(pieces: DataFrame, room: int = SEQUENCE) -> DataFrame:
    """Give each piece (PIECES) a sequence and its place there.

    ``pieces`` is read twice and should be a stage table.  Only the histogram, one row per
    length, comes to the driver; the plan that goes back has a few rows per length too.  No
    pieces, no sequences; pieces alike in every column take their places in any order.
    """
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = Places(plan(histogram, room), room)
    shared = pieces.sparkSession.sparkContext.broadcast(places)
    part = F.pmod(F.hash("doc_id", "piece", "ids_crc32"), F.lit(PARTS))
    numbered = number_from_zero(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], part, "__number")

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value.of(batch.column("length").to_numpy(), batch.column("__number").to_numpy())
            columns = [batch.column(c.split(" ")[0]) for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [c.split(" ")[0] for c in PLACES.split(", ")])

    return map_batches(numbered, place, PLACES)


def pack_documents(docs: DataFrame, path: str | None = None, rank_path: str | None = None, special: dict[str, int] | None = None) -> DataFrame:
    """Tokenize and pack ``docs`` (doc_id, text); extra columns are left aside.

    Every row is packed, rows that repeat a doc_id or have none too.
    """
    if path is None:
        import public_tokenizers

        path, rank_path, special = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}
    return pack(stage(tokenize(docs, path, rank_path, special or {}), "pieces"))


def query(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
