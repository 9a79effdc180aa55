"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive tokens; its hash takes the tokens at the mask's ones
and ignores the others, so a replaced token at an ignored place changes nothing.  The hashes of
training texts are joined with those of the test items inside the tasks; around each hit the item
is laid over the text and the best stretch (one for an equal token, -PENALTY for a replaced one)
decides.

Test items are taken in blocks whose size is checked: one block at a time is sent to the executors
and meets all texts; what earlier blocks found is stored.  The number of blocks follows the size of
the test set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sparkops import materialize, own_columns, row_key, without
from .textops import U64, mix, seeded, slices, utf8, words

#: Masks of items whose shortest leak is as long as they are, and that of shorter items.
MASKS, SHORT_MASK = ("1101100111", "1110010111", "1011101011"), "1110111"
#: A replaced token costs this much; a stretch of LEAST, or of SHARE of the item if that is less, is a leak.
PENALTY = 2
LEAST, SHARE = 15, 0.7
#: Items of fewer tokens leak only as a whole.
WHOLE = 10
#: Default of the parameter `fewest`: items of fewer tokens ("yes", a number) are in clean texts, too, and are ignored.
FEWEST = 5
#: Bytes of item texts in a block that is sent at once.
BLOCK_BYTES = 8 << 20

_SPAN = max(map(len, MASKS))
_OTHER = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes of consecutive texts and where each text's begin.

    Tokens are runs of letters and digits; ASCII and the letters of Latin-1 are lower-cased.
    """
    data, offsets = utf8(column)
    for _, _, part, cuts in slices(data, offsets):
        part = part.copy()
        if len(part) > 1:
            upper = (part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[1:] != 0x97)
            part[1:][upper] += 0x20
        part[_OTHER[part]] = 0x20
        yield words(part, cuts, True)


def needed(size: int) -> float:
    """The score that a stretch of an item of so many tokens must reach."""
    return size if size < WHOLE else min(LEAST, SHARE * size)


def masks_of(size: int) -> tuple[str, ...]:
    """The masks of an item: none is longer than its shortest leak."""
    return ("1" * size,) if size < WHOLE else MASKS if needed(size) >= _SPAN else (SHORT_MASK,)


def seed_hashes(toks: np.ndarray, mask: str) -> np.ndarray:
    """A hash for every place of the mask on a token sequence."""
    count = len(toks) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, U64)
    out = np.full(count, U64(int(mask, 2)))
    for j, k in enumerate(seeded(len(mask), 71)):
        if mask[j] == "1":
            out += toks[j : j + count] * k
    return mix(out)


class Block:
    """The seeds of some test items, ready to be looked up."""

    def __init__(self, items: list[tuple[int, str]], fewest: int = FEWEST):
        self.ids, self.toks = [], []
        for item, text in items:
            for toks, first in tokens(pa.array([text])):
                if first[1] >= max(fewest, 1):
                    self.ids.append(item)
                    self.toks.append(toks)
        self.need = [needed(len(t)) for t in self.toks]
        self.masks = sorted({mask for t in self.toks for mask in masks_of(len(t))})
        self.tables = []
        for mask in self.masks:
            own = [(i, seed_hashes(t, mask)) for i, t in enumerate(self.toks) if mask in masks_of(len(t))]
            hashes = np.concatenate([h for _, h in own] or [np.zeros(0, U64)])
            item = np.concatenate([np.full(len(h), i) for i, h in own] or [np.zeros(0, np.int64)])
            place = np.concatenate([np.arange(len(h)) for _, h in own] or [np.zeros(0, np.int64)])
            order = np.argsort(hashes, kind="stable")
            maybe = np.zeros(1 << 20, bool)
            maybe[hashes >> U64(44)] = True
            self.tables.append((mask, hashes[order], item[order], place[order], maybe))

    def hits(self, toks: np.ndarray) -> set[tuple[int, int]]:
        """(item, offset of the item's start in toks) wherever a seed is shared."""
        out: set[tuple[int, int]] = set()
        for mask, hashes, item, place, maybe in self.tables:
            h = seed_hashes(toks, mask)
            at = np.flatnonzero(maybe[h >> U64(44)])
            low, high = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
            for p, a, b in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
                out.update((int(item[i]), p - int(place[i])) for i in range(a, b))
        return out

    def leaks(self, toks: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item id, start, tokens, equal tokens) of the verified stretches, the best of each text and item."""
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for i, offset in self.hits(toks):
            item = self.toks[i]
            a = max(offset, 0)
            # texts that the laid-over item touches; seeds may join two texts, stretches may not
            b = min(offset + len(item), len(toks))
            for doc in range(int(np.searchsorted(first, a, "right")) - 1, int(np.searchsorted(first, b - 1, "right"))):
                lo, hi = max(a, int(first[doc])), min(b, int(first[doc + 1]))
                if lo >= hi:
                    continue
                equal = toks[lo:hi] == item[lo - offset : hi - offset]
                sums = np.r_[0, np.cumsum(np.where(equal, 1, -PENALTY))]
                least = np.minimum.accumulate(sums)
                end = int(np.argmax(sums - least))
                start = int(np.argmin(sums[: end + 1]))
                value = int(sums[end] - sums[start])
                if value >= self.need[i]:
                    key = (doc, self.ids[i])
                    best[key] = max(best.get(key, (0, 0, 0, 0)), (value, -(lo + start - int(first[doc])), end - start, int(equal[start:end].sum())))
        return sorted((doc, item, -place, size, same) for (doc, item), (_, place, size, same) in best.items())


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about BLOCK_BYTES; one block at a time is on the driver."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for i in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()]


_KIND = "array<struct<item_id:long,start:int,tokens:int,equal:int>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("tokens", pa.int32()), ("equal", pa.int32())]))


def _leaks(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, fewest: int) -> DataFrame:
    """(doc_id, rid, leaks) of every row (doc_id, rid, text).  What one block of items finds is stored and joined by row."""
    items = own_columns(benchmark, item_id=item_col, text=item_text_col).filter("item_id is not null and text is not null").withColumn("item_id", F.col("item_id").cast("long"))

    def scan(items: list[tuple[int, str]]) -> DataFrame:
        sent = rows.sparkSession.sparkContext.broadcast(Block(items, fewest))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                at = 0
                for toks, first in tokens(batch.column(2)):
                    for doc, item, start, size, equal in sent.value.leaks(toks, first):
                        found[at + doc].append({"item_id": item, "start": start, "tokens": size, "equal": equal})
                    at += len(first) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, _ARROW)], ["doc_id", "rid", "leaks"])

        return rows.mapInArrow(run, f"doc_id long, rid long, leaks {_KIND}")

    last: list[tuple[int, str]] | None = None
    stored: list[DataFrame] = []
    for block in _blocks(items):
        if last is not None:
            stored.append(materialize(scan(last).filter(F.size("leaks") > 0), "leaks"))
        last = block
    out = scan(last or [])
    if stored:
        # equal rows (id, text) have equal leaks
        earlier = reduce(DataFrame.unionByName, stored).select("rid", F.explode("leaks").alias("x")).distinct().groupBy("rid").agg(F.collect_list("x").alias("earlier"))
        out = out.join(earlier, "rid", "left").select("doc_id", "rid", F.array_sort(F.array_distinct(F.concat("leaks", F.coalesce("earlier", F.array().cast(_KIND))))).alias("leaks"))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", fewest: int = FEWEST) -> DataFrame:
    """One row per input row: doc_id, leaks (array of item_id, start, tokens, equal, in this order) over all test items.

    A leak is a stretch of the item laid over the text whose score (equal tokens less PENALTY for each
    other) reaches LEAST, or SHARE of a shorter item; items of fewer than WHOLE tokens leak only as a whole.  Null and empty
    texts have none; items that are null or have fewer than `fewest` tokens are ignored, and the items without any token
    always are; repeated rows and null ids stay, each judged by its own text; without items nothing leaks; an empty
    table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rid"), F.col(f"`{text_col}`").alias("text"))
    return _leaks(rows, benchmark, item_col, item_text_col, fewest).select("doc_id", "leaks")


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", fewest: int = FEWEST) -> DataFrame:
    """The rows of docs, all columns, whose text has no leak; each row is judged by itself, those with null ids, too."""
    rows = docs.select(F.lit(None).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rid"), F.col(f"`{text_col}`").alias("text"))
    return without(docs, _leaks(rows, benchmark, item_col, item_text_col, fewest).filter(F.size("leaks") > 0).select("rid"), row_key(id_col, text_col))
