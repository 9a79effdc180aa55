"""Periodic runs of words, found in a grammar instead of in the text.

A run is a stretch of words with smallest period q that no neighbouring word extends.  Here a run has at least
`exponent` periods and `least` words.  Of each text

1. stretches are cut out in which every three consecutive words stand three times or more.  A run of four periods and
   six words has no rarer three, so none passes a cut; most texts end here.
2. Re-Pair turns the word ids of the stretches into a grammar: the most frequent adjacent pair becomes a
   nonterminal, again and again, until no pair stands three times.  What is left of a stretch is folded by balanced pairs.
3. A nonterminal is looked at once, at its first place: a run of four periods over the boundary between its two
   parts has two periods on one side, so a part ends (begins) with a square there.  Squares are found for all periods
   at once from prefix hashes, compared word by word, and extended to both sides.
4. The intervals are moved to all places where the nonterminal is derived; those of one period that overlap by
   a period or more are one run.  The lowest nonterminal that holds all of a run has found it whole.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sparkops import own_columns
from .textops import U64, mix, seeded

#: A pair, or three consecutive words, inside a run of four periods (and six words) stands so often at least.
OFTEN = 3
_BASE = int(seeded(1, 31)[0])

Run = tuple[int, int, int]


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """The parts (start, end) of a text of which all three consecutive words stand OFTEN times, six words long at least."""
    if len(ids) < 6:
        return []
    k = int(ids.max()) + 1
    _, back, times = np.unique((ids[:-2] * k + ids[1:-1]) * k + ids[2:], return_inverse=True, return_counts=True)
    edges = np.flatnonzero(np.diff(np.r_[False, times[back] >= OFTEN, False]))
    return [(int(a), int(b) + 2) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= 4]


def re_pair(text: list[int]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int]]]:
    """The grammar of a text: rules (left symbol, right symbol, first place, place of the right part), and the symbols left as (symbol, start, end).

    Symbols from 0 are words, negative ones cuts; rule r has the symbol len(text) + r, as all word ids are smaller.
    """
    n, symbols = len(text), list(text)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i in range(n - 1):
        where[symbols[i], symbols[i + 1]].add(i)
    agenda = [(-len(at), pair) for pair, at in where.items() if len(at) >= OFTEN]
    heapq.heapify(agenda)
    rules: list[tuple[int, int, int, int]] = []
    while agenda:
        times, pair = heapq.heappop(agenda)
        at = where.get(pair, ())
        if len(at) != -times:  # it has changed since: back with the number it has now
            if len(at) >= OFTEN:
                heapq.heappush(agenda, (-len(at), pair))
            continue
        left, right = pair
        new, touched, first = n + len(rules), set(), None
        for i in sorted(where.pop(pair)):
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:  # a place that overlaps the one before, as in a a a
                continue
            h, k = before[i], after[j]
            if h >= 0:
                where[symbols[h], left].discard(h)
                where[symbols[h], new].add(h)
                touched.add((symbols[h], new))
            if k < n:
                where[right, symbols[k]].discard(j)
                where[new, symbols[k]].add(i)
                touched.add((new, symbols[k]))
                before[k] = i
            symbols[i], symbols[j], after[i] = new, None, k
            if first is None:
                first = (i, j)
        if first:
            rules.append((left, right, *first))
        for new_pair in touched:
            if len(where[new_pair]) >= OFTEN:
                heapq.heappush(agenda, (-len(where[new_pair]), new_pair))
    top, i = [], 0
    while i < n:
        top.append((symbols[i], i, after[i]))
        i = after[i]
    return rules, top


class _Squares:
    """Prefix hashes of a text, and the runs over a boundary in it."""

    def __init__(self, text: np.ndarray, least: int, exponent: int):
        self.text, self.least, self.exponent = text, least, exponent
        n = len(text)
        self.power = np.full(n + 1, U64(_BASE))
        self.power[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(mix(text.astype(U64)) * self.power[:n], out=self.sums[1:])

    def across(self, start: int, middle: int, end: int) -> list[Run]:
        """The runs (start, end, period) of text[start:end] over the boundary at middle, as far as this part goes."""
        if end - start < self.least:
            return []
        found, most = [], (end - start) // self.exponent
        for side, room in ((-1, middle - start), (1, end - middle)):
            q = np.arange(1, min(most, room // 2) + 1)
            if not len(q):
                continue
            a, b = (middle - 2 * q, middle - q) if side < 0 else (middle, middle + q)
            near, far = self.sums[b] - self.sums[a], self.sums[b + q] - self.sums[b]
            covered = 0
            for period in q[far == near * self.power[q]].tolist():
                if 2 * period <= covered:  # a multiple of a smaller period
                    continue
                at = middle - 2 * period if side < 0 else middle
                if not np.array_equal(self.text[at : at + period], self.text[at + period : at + 2 * period]):
                    continue
                same = self.text[start : end - period] == self.text[start + period : end]
                before, behind = np.flatnonzero(~same[: at - start]), np.flatnonzero(~same[at - start + period :])
                lo = start + int(before[-1]) + 1 if len(before) else start
                hi = at + 2 * period + int(behind[0]) if len(behind) else end
                covered = middle - lo if side < 0 else hi - middle
                if hi - lo >= max(self.least, self.exponent * period):
                    found.append((lo, hi, period))
        return found


def runs_of(ids: np.ndarray, least: int = 6, exponent: int = 4) -> list[Run]:
    """The runs (start, length, period) of word ids by start, then period; `least` is 6 or more, `exponent` 4 or more."""
    parts = stretches(ids)
    if not parts:
        return []
    # the stretches in one text, each behind a cut that stands once
    pieces, offsets, moved, at = [], [], [], 0
    for k, (a, b) in enumerate(parts):
        pieces += [np.array([-1 - k]), ids[a:b]]
        offsets.append(at + 1)
        moved.append(a - at - 1)
        at += 1 + b - a
    text = np.concatenate(pieces)
    _, small = np.unique(text, return_inverse=True)
    squares = _Squares(small, least, exponent)
    smaller = small - len(parts)  # cuts stay negative, words are below len(text)
    rules, top = re_pair(smaller.tolist())
    n = len(text)
    length = {}
    for r, (left, right, _, _) in enumerate(rules):
        length[n + r] = length.get(left, 1) + length.get(right, 1)
    out: list[Run] = []
    inside = {}
    for r, (_, _, first, middle) in enumerate(rules):
        if found := squares.across(first, middle, first + length[n + r]):
            inside[n + r] = (first, found)
    level: list[tuple[int, int]] = []
    for symbol, a, b in [*top, (-1, n, n)]:
        if symbol >= 0:
            level.append((a, b))
            continue
        while len(level) > 1:  # the end of a stretch: fold what is left of it
            for (start, middle), (_, end) in zip(level[::2], level[1::2], strict=False):
                out += squares.across(start, middle, end)
            level = [(level[i][0], level[min(i + 1, len(level) - 1)][1]) for i in range(0, len(level), 2)]
        level = []
    if inside:
        places: dict[int, list[np.ndarray]] = defaultdict(list)
        for symbol, a, _ in top:
            if symbol >= n:
                places[symbol].append(np.array([a]))
        for r in range(len(rules) - 1, -1, -1):
            if not (known := places.pop(n + r, None)):
                continue
            here = np.concatenate(known)
            left, right, _, _ = rules[r]
            if left >= n:
                places[left].append(here)
            if right >= n:
                places[right].append(here + length.get(left, 1))
            if n + r in inside:
                first, found = inside[n + r]
                for lo, hi, period in found:
                    out += [(a, a + hi - lo, period) for a in (here + (lo - first)).tolist()]
    merged: list[list[int]] = []
    for lo, hi, period in sorted(out, key=lambda x: (x[2], x[0], x[1])):
        if merged and merged[-1][2] == period and lo <= merged[-1][1] - period:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi, period])
    shift = np.array(moved)[np.searchsorted(offsets, [m[0] for m in merged], side="right") - 1].tolist() if merged else []
    return sorted(((lo + d, hi - lo, period) for (lo, hi, period), d in zip(merged, shift, strict=True)), key=lambda x: (x[0], x[2]))


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (array of start, length, period: word numbers from 0) and text, of which only a run's first period is left.

    Words are what stands between ASCII white space; those kept are joined by one space.  Runs have at least `exponent`
    periods (4 or more) and `least` words (6 or more).  A null, empty or blank text has no word and no run.  Repeated rows and null
    ids are kept as they are; an empty table gives an empty result; other columns are ignored.  Nothing is shuffled.
    """
    if exponent < 4 or least < 6:
        raise ValueError("runs have four periods and six words at least")
    item = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes, found, kept = [], [], []
                for text in part.column(1):
                    words = (text.as_py() or "").encode().split()
                    known: dict[bytes, int] = {}
                    number = known.setdefault
                    ids = np.fromiter((number(w, len(known)) for w in words), np.int64, len(words))
                    runs = runs_of(ids, least, exponent)
                    if runs:
                        gone = np.zeros(len(words) + 1, np.int64)
                        for start, length, period in runs:
                            gone[start + period] += 1
                            gone[start + length] -= 1
                        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                    sizes.append(len(ids))
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(found, item), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "text"])

    docs = own_columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents; a tenth of the texts, by a checksum of the id, is repeated from a word on: word i >= a becomes word a + (i - a) % p.

    With h the CRC-32 of the decimal id and g = h div 10, texts with h % 10 = 0 have a = g % n and p = 1 + (n - a) div (3 + g % 8);
    their words are joined by one space.  A null id changes nothing; a null text is empty.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = own_columns(docs, doc_id="doc_id", text="text").withColumns({"g": F.floor(h / 10), "w": F.when(h % 10 == 0, words)})
    docs = docs.withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, g % n, null)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return docs.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.coalesce("text", F.lit(""))).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """documents with their planted runs, collapsed: numbers of runs, the run of greatest length / period, and digests of runs and text."""
    best = F.expr("aggregate(slice(runs, 2, size(runs)), runs[0], (x, y) -> if(y.length * x.period > x.length * y.period, y, x))")
    lines = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    found = collapse_runs(with_planted_runs(docs)).withColumn("best", F.when(F.size("runs") > 0, best))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
