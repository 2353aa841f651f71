"""Periodic runs of words, found in the grammar that Re-Pair makes of a document.

Word ids are compressed by Re-Pair: pairs that repeat become nonterminals, the most frequent
first, in rounds that replace all pairs of which no more frequent one overlaps; what is left is
joined by a balanced tree of nonterminals that occur once.  A run of words lies across the
boundary of one node of the derivation, the lowest that holds it whole, so for each nonterminal
the runs across its boundary are computed once, in one of its occurrences, and translated to all
its positions; intervals of a period that lie in others of it are merged into these.

A run of at least three periods and ``LEAST`` words has half its words on one side of the
boundary, so there the ``GRAM`` words beside it come again one period away.  Places of equal
grams give the candidate periods, which are then verified word by word.  Documents of a batch
go through these steps side by side, in numpy; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, table

#: A run's least length in words and in periods.
LEAST, PERIODS = 24, 3
#: Words beside a boundary that any run across it repeats: half a run less a period, at least.
GRAM = 4
#: Words worked on at once, but for a longer document.
AT_ONCE = 400_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    x = (x.astype(np.uint64) + np.uint64(1)) * _ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Grammar:
    """The nonterminals of several sequences at once, with the places where each occurs.

    ``symbols`` are numbers that no two sequences share; ``ends`` are the sequences' ends.
    ``starts, splits, stops`` have the extent of each nonterminal in its first occurrence and the
    boundary between its two parts; ``rule, place`` have all occurrences.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        n = len(symbols)
        self.extents: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.rules = 0
        owner = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
        place, stop = np.arange(n), np.arange(1, n + 1)
        owner, place, stop = self._pair(symbols.astype(np.int64), owner, place, stop, int(symbols.max(initial=0)) + 1)
        self._join(owner, place, stop)
        self.starts, self.splits, self.stops = (np.concatenate([e[i] for e in self.extents]) if self.extents else np.empty(0, np.int64) for i in range(3))
        self.rule, self.place = (np.concatenate([f[i] for f in self.found]) if self.found else np.empty(0, np.int64) for i in range(2))

    def _add(self, rule: np.ndarray, start: np.ndarray, split: np.ndarray, stop: np.ndarray) -> None:
        """Occurrences of new rules, numbered from zero."""
        _, first = np.unique(rule, return_index=True)
        self.extents.append((start[first], split[first], stop[first]))
        self.found.append((rule + self.rules, start))
        self.rules += len(first)

    def _pair(self, symbols, owner, place, stop, fresh):
        """Rounds of Re-Pair until no pair repeats; what is left of each sequence."""
        fixed = np.zeros(len(symbols), bool)  # pairs known to come once
        while len(symbols) > 1:
            open_ = np.flatnonzero((owner[1:] == owner[:-1]) & ~fixed[:-1])
            if not len(open_):
                break
            pairs = np.stack([symbols[open_], symbols[open_ + 1]], 1)
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            ranked = pairs[order]
            new = np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(1)])
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(new) - 1
            counts = np.bincount(group)
            fixed[open_[counts[group] < 2]] = True
            again = counts[group] >= 2
            open_, group = open_[again], group[again]
            if not len(open_):
                break
            # the more frequent first; of equally frequent ones any order that has no long slopes
            keys = np.lexsort((_mixed(np.arange(len(counts))), -counts))
            rank = np.empty(len(counts), np.int64)
            rank[keys] = np.arange(len(counts))
            worst = len(counts)
            of = np.full(len(symbols) + 2, worst)  # of the pair at each place, one place on
            of[open_ + 1] = rank[group]
            best = (of[1:-1] < worst) & (of[1:-1] <= of[:-2]) & (of[1:-1] <= of[2:])
            # pairs that overlap themselves, as in a run of one symbol: every other one from the left
            same = np.concatenate([[False], (of[1:-1] == of[:-2])[1:] & best[1:] & best[:-1]])
            spots = np.arange(len(best))
            hit = best & ((spots - np.maximum.accumulate(np.where(same, 0, spots))) % 2 == 0)
            at = np.flatnonzero(hit)
            rules = np.unique(of[at + 1], return_inverse=True)[1]
            self._add(rules, place[at], place[at + 1], stop[at + 1])
            symbols[at] = fresh + rules
            stop[at] = stop[at + 1]
            fresh += int(rules.max()) + 1
            # pairs beside a new symbol are new ones
            fixed[at] = False
            fixed[np.maximum(at - 1, 0)] = False
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            fixed[at] = False
            symbols, owner, place, stop, fixed = (x[keep] for x in (symbols, owner, place, stop, fixed))
        return owner, place, stop

    def _join(self, owner, place, stop):
        """A balanced tree over what is left of each sequence, level by level."""
        while len(owner):
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            index = np.arange(len(owner)) - np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))
            left = np.flatnonzero((index[:-1] % 2 == 0) & (owner[1:] == owner[:-1])) if len(owner) > 1 else np.empty(0, np.int64)
            if not len(left):
                return
            self._add(np.arange(len(left)), place[left], place[left + 1], stop[left + 1])
            stop[left] = stop[left + 1]
            keep = np.ones(len(owner), bool)
            keep[left + 1] = False
            owner, place, stop = owner[keep], place[keep], stop[keep]


class _Hashes:
    """Hashes of stretches of the words; equal stretches have equal ones."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _ODD))])
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(words) * self.powers[:n])])

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at ``a`` and at ``b`` (a <= b) may be equal: never false for equal ones."""
        return (self.sums[a + length] - self.sums[a]) * self.powers[b - a] == self.sums[b + length] - self.sums[b]


def _extent(words: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``at`` within bounds whose words equal those a period on, as its start and end."""

    def steps(forward: bool, room: int) -> int:
        done, width = 0, 32
        while done < room:
            width = min(width, room - done)
            a = at + done if forward else at - done - width
            unlike = np.flatnonzero(words[a : a + width] != words[a + period : a + period + width])
            if len(unlike):
                return done + int(unlike[0] if forward else width - 1 - unlike[-1])
            done, width = done + width, width * 2
        return done

    return at - steps(False, at - low), at + steps(True, high - period - at) + period


def _crossing(words: np.ndarray, grammar: Grammar) -> Iterator[tuple[int, int, int, int]]:
    """Rule, start, end and period of the runs across the boundary of each nonterminal, in its first occurrence."""
    rules = np.flatnonzero(grammar.stops - grammar.starts >= LEAST)
    n = len(words)
    if not len(rules) or n < LEAST:
        return
    low, split, high = grammar.starts[rules], grammar.splits[rules], grammar.stops[rules]
    hashes = _Hashes(words)
    grams = np.arange(n - GRAM + 1)
    gram = (hashes.sums[grams + GRAM] - hashes.sums[grams]) * hashes.powers[n - grams]
    # places by gram; a key is the gram's number and the place
    order = np.lexsort((grams, gram))
    number = np.empty(len(grams), np.int64)
    number[order] = np.cumsum(np.concatenate([[0], (gram[order][1:] != gram[order][:-1]).astype(np.int64)]))
    keys = np.sort(number * n + grams)

    for forward in (True, False):
        # the gram beside the boundary, on the side that holds half the run
        side = high - split if forward else split - low
        own = split if forward else split - GRAM
        fits = np.flatnonzero((side >= LEAST // 2) & (own + GRAM <= n))
        base = number[own[fits]] * n
        last = side[fits] * 2 // PERIODS  # no longer period has half a run on this side
        nearest = np.ones(len(fits), np.int64)  # least period still to be tried
        while len(fits):
            if forward:
                at = np.searchsorted(keys, base + own[fits] + nearest)
                there = keys[np.minimum(at, len(keys) - 1)] - base
                period = np.where(at < len(keys), there - own[fits], n + 1)
            else:
                at = np.searchsorted(keys, base + own[fits] - nearest, "right") - 1
                there = keys[np.maximum(at, 0)] - base
                period = np.where((at >= 0) & (there >= 0), own[fits] - there, n + 1)
            alive = (period >= nearest) & (period <= last)
            fits, base, last, period = fits[alive], base[alive], last[alive], period[alive]
            if not len(fits):
                break
            nearest = period + 1
            # what half a run beyond its period repeats, and the word on the other side of the boundary
            length = np.maximum(np.maximum(LEAST // 2 - period, (period + 1) // 2), 1)
            b = split[fits]
            if forward:
                likely = (words[b - 1] == words[b - 1 + period]) & hashes.equal(b, b + period, np.minimum(length, high[fits] - b - period))
            else:
                likely = (words[b] == words[b - period]) & hashes.equal(b - period - length, b - length, length)
            for i in np.flatnonzero(likely).tolist():
                r, q = fits[i], int(period[i])
                if forward:
                    start, end = _extent(words, int(b[i]), q, int(low[r]), int(high[r]))
                    far = end - int(b[i])
                else:
                    start, end = _extent(words, int(b[i]) - q, q, int(low[r]), int(high[r]))
                    far = int(b[i]) - start
                if start < b[i] < end and end - start >= max(LEAST, PERIODS * q):
                    yield int(rules[r]), start, end, q
                    # two runs overlap by less than the sum of their periods
                    nearest[i] = max(nearest[i], far - q + 1) if far >= 2 * q else nearest[i]


def find_runs(words: np.ndarray, ends: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Start, length and smallest period of the runs of each of several sequences of word numbers.

    ``ends`` are the sequences' ends; numbers in ``words`` are equal for equal words.
    """
    owner = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    out: list[list[tuple[int, int, int]]] = [[] for _ in ends]
    if not len(words):
        return out
    _, symbols = np.unique(owner * (int(words.max()) + 1) + words, return_inverse=True)
    grammar = Grammar(symbols, ends)
    found = np.array(list(_crossing(symbols, grammar)), np.int64).reshape(-1, 4)
    if not len(found):
        return out
    # to all positions of their nonterminals
    order = np.argsort(grammar.rule, kind="stable")
    rule, place = grammar.rule[order], grammar.place[order]
    first, until = (np.searchsorted(rule, found[:, 0], side) for side in ("left", "right"))
    times = until - first
    which = np.repeat(np.arange(len(found)), times)
    spot = place[np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())]
    shift = spot - grammar.starts[found[which, 0]]
    start, end, period = found[which, 1] + shift, found[which, 2] + shift, found[which, 3]
    # the widest interval of each period; parts of it lie inside
    order = np.lexsort((-end, start, period, owner[start]))
    begins = np.concatenate([[0], ends[:-1]])
    widest: dict[tuple[int, int], int] = {}
    for o, s, e, q in zip(owner[start[order]].tolist(), start[order].tolist(), end[order].tolist(), period[order].tolist(), strict=True):
        if e > widest.get((o, q), -1):
            widest[o, q] = e
            out[o].append((s - int(begins[o]), e - s, q))
    return [_smallest(runs) for runs in out]


def _smallest(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs without those of a multiple of a run's period that lie in it, by start and then period."""
    kept: list[tuple[int, int, int]] = []
    by_period: dict[int, list[tuple[int, int]]] = {}
    for start, length, period in sorted(runs, key=lambda r: r[2]):
        inside = any(
            period % q == 0 and any(s <= start and start + length <= e for s, e in spans) for q, spans in by_period.items() if q < period
        )
        if not inside:
            kept.append((start, length, period))
            by_period.setdefault(period, []).append((start, start + length))
    return sorted(kept, key=lambda r: (r[0], r[2]))


def _repeated(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of a document made periodic; None for all others."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def _summary(runs: list[tuple[int, int, int]], words: list[bytes]) -> tuple:
    """The output columns of a document."""
    best = (None,) * 4
    if runs:
        top = runs[0]
        for run in runs[1:]:
            if run[1] * top[2] > top[1] * run[2]:
                top = run
        best = (*top, 1000 * top[1] // top[2])
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()


_SCHEMA = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def _collapse(group: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
    """The rows of several documents."""
    texts = []
    for doc_id, words in group:
        places = _repeated(doc_id, len(words))
        texts.append(words if places is None else [words[i] for i in places.tolist()])
    flat = [w for words in texts for w in words]
    numbers = np.asarray(pc.dictionary_encode(pa.array(flat, pa.binary())).indices, np.int64)
    ends = np.cumsum([len(t) for t in texts])
    rows = [(doc_id, *_summary(runs, words)) for (doc_id, _), words, runs in zip(group, texts, find_runs(numbers, ends), strict=True)]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    names = [f.split(" ")[0] for f in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """Each document's runs, and the digest of its words without their repetitions.

    Words are what stands between ASCII white space; those of a tenth of the documents, chosen by
    the checksum of the id, are first made periodic.  A null id makes none periodic.  Null and empty
    texts have no words and no runs.  Every row gives a row, repeated ones too; columns but doc_id
    and text are left aside.  Runs of equal exponent: the first by start, then period.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int | None, list[bytes]]] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = (text.as_py() or b"").split()
                group.append((doc_id, words))
                held += len(words)
                if held >= AT_ONCE:
                    yield _collapse(group)
                    group, held = [], 0
        if group:
            yield _collapse(group)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_batches(source, run, _SCHEMA)


def query(spark, sf_dir):
    return collapse_runs(table(spark, sf_dir, "documents"))
