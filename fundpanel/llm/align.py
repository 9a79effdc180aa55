"""Alignment of two tokenizers' tokens over the bytes of a text.

A byte-level BPE (A) encodes a space and the text; a merge-type vocabulary with byte fallback (B) encodes the text and adds the
space itself.  Both then cover the same bytes, and two sparse matrices hold which token covers which byte.

* The product A * B^T has a row per A token; its entries are the B tokens that share bytes with it, and how many.
  Where the last B token of a row ends before the first one of the next, both tokenizers have a cut: these overlap links
  part the tokens into groups.
* The incidence of (text, A id) and groups times that of groups and B ids counts, for each text and pair of ids, the
  links between tokens of one group.

Matrices are compressed by rows (numpy arrays) and multiplied row by row after Gustavson: the entries of a row pick rows of
the second factor, and what falls on one column is added up; blocks of rows bound what is laid out at a time.

Counts of pairs over the corpus are added up by Spark.  They come back to the texts in blocks of BLOCK pairs, each broadcast
to tasks that read the stored pairs once; as many blocks as the counted pairs need, which the vocabularies bound.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sparkops import Scratch, own_columns

#: Products laid out at a time, bytes of text looked at together (or one text), pairs of a broadcast block, pairs counted together.
LIMIT, SLICE_BYTES, BLOCK, COUNTED = 1 << 20, 1 << 21, 2_000_000, 4_000_000
#: Fixed value: how the byte-level vocabulary's file ("use_regex") cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The characters by which a byte-level vocabulary spells bytes: printable Latin-1 stands for itself, the rest follows from U+0100."""
    itself = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(itself)]
    return {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """The byte-level BPE of a tokenizers file, without special tokens."""

    def __init__(self, file: str):
        import tiktoken  # by the workers alone

        with open(file, encoding="utf-8") as opened:
            stated = json.load(opened)
        symbols, vocab = byte_symbols(), stated["model"]["vocab"]
        special = {t["content"] for t in stated["added_tokens"]}
        ranks = {bytes(symbols[c] for c in entry): i for entry, i in vocab.items() if entry not in special}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in stated["model"]["merges"]]
        if merged != sorted(merged) or stated["pre_tokenizer"]["type"] != "ByteLevel" or stated["normalizer"]:
            raise ValueError("only byte-level vocabularies in the order of their merges are supported")
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        coding = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = coding.encode_ordinary
        self.joined = coding.decode_bytes


class Pieces:
    """A sentencepiece vocabulary; a piece's bytes are its characters in UTF-8, U+2581 a space, <0xHH> the byte."""

    def __init__(self, file: str):
        lib = sentencepiece.SentencePieceProcessor(model_file=file)
        names = [lib.id_to_piece(i) for i in range(len(lib))]
        self.pieces = [bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.encode = lambda text: lib.encode(text, num_threads=1)
        self.joined = lambda ids: b"".join(map(self.pieces.__getitem__, ids))


@dataclass
class Csr:
    """A sparse matrix by rows: row i has the columns indices[start[i] : start[i + 1]], with values in data."""

    start: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.start) - 1

    @classmethod
    def counted(cls, row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> Csr:
        """Of entries of one each, those at one place added up."""
        key = row.astype(np.int64) * columns + column
        key, times = np.unique(key, return_counts=True)
        return cls(np.searchsorted(key, np.arange(rows + 1, dtype=np.int64) * columns), key % columns, times, columns)

    def __matmul__(self, other: Csr) -> Csr:
        """The product, row by row in blocks of at most LIMIT single products (or one row)."""
        sizes = (other.start[1:] - other.start[:-1])[self.indices]
        laid = np.concatenate([[0], np.cumsum(sizes)])
        at_row, keys, sums, r = laid[self.start], [], [], 0
        while r < self.rows:
            to = max(r + 1, int(np.searchsorted(at_row, at_row[r] + LIMIT, side="right")) - 1)
            a, b = self.start[r], self.start[to]
            n = sizes[a:b]
            row = np.repeat(np.arange(r, to), self.start[r + 1 : to + 1] - self.start[r:to])
            take, value = other.start[self.indices[a:b]], self.data[a:b]
            if (n != 1).any():  # else each entry picks a row of one entry, as bytes do
                row, value = np.repeat(row, n), np.repeat(value, n)
                take = np.repeat(take - (laid[a:b] - laid[a]), n) + np.arange(len(row))
            key, value = row * other.columns + other.indices[take], value * other.data[take]
            if len(key) and (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            if len(key):
                heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                keys.append(key[heads])
                sums.append(np.add.reduceat(value, heads))
            r = to
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        start = np.searchsorted(key, np.arange(self.rows + 1, dtype=np.int64) * other.columns)
        return Csr(start, key % other.columns, np.concatenate(sums) if sums else key, other.columns)


def overlaps(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Csr:
    """The overlap links of tokens of these byte lengths: A tokens x bytes times bytes x B tokens; values are shared bytes."""
    n = int(sizes_a.sum())
    byte, one = np.arange(n + 1), np.ones(n, np.int8)
    a = Csr(np.concatenate([[0], np.cumsum(sizes_a)]), byte[:-1], one, n)
    b = Csr(byte, np.repeat(np.arange(len(sizes_b)), sizes_b), np.ones(n, np.int64), len(sizes_b))
    return a @ b


def group_numbers(links: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, from 0 in order: a group ends where the next A token meets only later B tokens."""
    first, last = links.indices[links.start[:-1]], links.indices[links.start[1:] - 1]
    group = np.concatenate([[0], np.cumsum(last[:-1] < first[1:])]) if len(first) else np.zeros(0, np.int64)
    of_b = np.zeros(links.columns, np.int64)
    of_b[links.indices] = np.repeat(group, links.start[1:] - links.start[:-1])
    return group, of_b


class Aligner:
    """Both tokenizers, and the tables of their tokens' bytes, lengths and names."""

    def __init__(self, file_a: str, file_b: str):
        self.a, self.b = ByteLevel(file_a), Pieces(file_b)
        self.size_a, self.size_b = (np.array([len(p) for p in t.pieces]) for t in (self.a, self.b))
        # a token's name with what follows it inside and at the end of its half of a group, filled up with zero bytes
        self.names = np.array([f"{i}{mark}".encode() for n, marks in ((len(self.a.pieces), ",|"), (len(self.b.pieces), ",;")) for mark in marks for i in range(n)])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of both, or none if the text is empty or one of them has other bytes than a space and the text."""
        if text:
            a, b, want = self.a.encode(f" {text}"), self.b.encode(text), f" {text}".encode()
            if self.a.joined(a) == want and self.b.joined(b) == want:
                return np.array(a, np.int64), np.array(b, np.int64)
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def align(self, coded: list[tuple[np.ndarray, np.ndarray]], with_overlaps: bool) -> list[dict]:
        """For each text's ids: sizes, the groups as text, the pairs of ids (a * size of B + b, ascending) with their numbers of links."""
        a, b = (np.concatenate([c[k] for c in coded]) for k in (0, 1))
        n_a, n_b = (np.array([len(c[k]) for c in coded]) for k in (0, 1))
        text_a = np.repeat(np.arange(len(coded)), n_a)
        links = overlaps(self.size_a[a], self.size_b[b])
        group_a, group_b = group_numbers(links)
        groups, wide = (int(group_a[-1]) + 1 if len(a) else 0), len(self.b.pieces)
        # rows are pairs of text and A id, in order
        ids, row = np.unique(text_a * len(self.a.pieces) + a, return_inverse=True)
        pairs = Csr.counted(row, group_a, len(ids), groups) @ Csr.counted(group_b, b, groups, wide) if groups else Csr(np.zeros(1, np.int64), a, a, wide)
        key = np.repeat(ids % len(self.a.pieces), pairs.start[1:] - pairs.start[:-1]) * wide + pairs.indices
        cut = pairs.start[np.searchsorted(ids, np.arange(len(coded) + 1) * len(self.a.pieces))]
        # names in the order of the groups: a group's A tokens, then its B tokens
        ends_a, ends_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        name = np.empty(len(a) + len(b), np.int64)
        before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]) for g in (group_a, group_b))
        name[np.arange(len(a)) + before_b[group_a]] = a + len(self.a.pieces) * ends_a[: len(a)]
        name[np.arange(len(b)) + before_a[group_b + 1]] = 2 * len(self.a.pieces) + b + wide * ends_b[: len(b)]
        name = self.names[name]
        out, at, at_a, at_b = [], 0, 0, 0
        for i in range(len(coded)):
            to = at + int(n_a[i] + n_b[i])
            lo, hi = int(cut[i]), int(cut[i + 1])
            found = {"n_a": int(n_a[i]), "n_b": int(n_b[i]), "n_groups": int(group_a[at_a + n_a[i] - 1] - group_a[at_a]) + 1 if n_a[i] else 0}
            found |= {"n_links": int(pairs.data[lo:hi].sum()), "groups": name[at:to].tobytes().translate(None, b"\0")[:-1].decode(), "pairs": key[lo:hi], "times": pairs.data[lo:hi]}
            if with_overlaps:
                own = slice(links.start[at_a], links.start[at_a + n_a[i]])
                rows = np.repeat(np.arange(n_a[i]), np.diff(links.start[at_a : at_a + n_a[i] + 1]))
                found["overlaps"] = [{"a": x, "b": y, "bytes": z} for x, y, z in zip(rows.tolist(), (links.indices[own] - at_b).tolist(), links.data[own].tolist(), strict=True)]
            out.append(found)
            at, at_a, at_b = to, at_a + int(n_a[i]), at_b + int(n_b[i])
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(file_a: str, file_b: str) -> Aligner:
    """This process's aligner for two files."""
    if (file_a, file_b) not in _aligners:
        _aligners[file_a, file_b] = Aligner(file_a, file_b)
    return _aligners[file_a, file_b]


def align_tokens(docs: DataFrame, file_a: str, file_b: str, id_col: str = "doc_id", text_col: str = "text", with_overlaps: bool = False, digests: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, the groups (`a1,a2|b1;a3|b2,b3`, or their SHA-256 by digests),
    first and steps of the ascending id pairs (a * size of B + b; steps are the differences), times (links of each pair), and by choice
    the overlap links (token numbers from 0, shared bytes).

    A text that is null or empty, or that one of the tokenizers doesn't give back byte by byte, has no tokens: zeros, empty
    lists and ''.  Repeated rows and null ids are kept as they are; an empty table gives an empty result; other columns are
    ignored.  Nothing is shuffled.  The files must be readable at the same paths on every executor.
    """
    kinds = {"doc_id": ("long", pa.int64())} | {n: ("long", pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")}
    kinds |= {"groups_sha256" if digests else "groups": ("string", pa.string()), "first": ("long", pa.int64()), "steps": ("array<int>", pa.list_(pa.int32())), "times": ("array<int>", pa.list_(pa.int32()))}
    if with_overlaps:
        kinds["overlaps"] = ("array<struct<a: int, b: int, bytes: int>>", pa.list_(pa.struct([(n, pa.int32()) for n in ("a", "b", "bytes")])))

    def lists(parts: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, parts)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), pa.int32()))

    def batch_of(own: Aligner, ids: list, coded: list) -> pa.RecordBatch:
        found = own.align(coded, with_overlaps)
        cols: dict[str, pa.Array] = {"doc_id": pa.array(ids, pa.int64())}
        cols |= {n: pa.array([f[n] for f in found], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")}
        texts = [f["groups"] for f in found]
        if digests:
            cols["groups_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts], pa.string())
        else:
            cols["groups"] = pa.array(texts, pa.string())
        cols["first"] = pa.array([int(f["pairs"][0]) if len(f["pairs"]) else None for f in found], pa.int64())
        cols["steps"], cols["times"] = lists([np.diff(f["pairs"]) for f in found]), lists([f["times"] for f in found])
        if with_overlaps:
            cols["overlaps"] = pa.array([f["overlaps"] for f in found], kinds["overlaps"][1])
        return pa.RecordBatch.from_arrays([cols[n] for n in kinds], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(file_a, file_b)
        for batch in batches:
            ids, coded, size = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or ""
                ids.append(doc_id.as_py())
                coded.append(own.encode(text))
                size += len(text)
                if size > SLICE_BYTES or len(ids) == 1000:
                    yield batch_of(own, ids, coded)
                    ids, coded, size = [], [], 0
            if ids:
                yield batch_of(own, ids, coded)

    docs = own_columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, ", ".join(f"{name} {kind}" for name, (kind, _) in kinds.items()))


def _keys(batch: pa.RecordBatch, first: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """The ascending pairs of all rows in one array, and where each row's begin (rows + 1); a row without pairs has none."""
    starts, values = batch.column(first), batch.column(steps)
    there = np.asarray(starts.is_valid())
    sizes = np.where(there, np.asarray(values.value_lengths().fill_null(0)) + 1, 0)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.zeros(ends[-1], np.int64)
    heads = ends[:-1][there]
    inner = np.ones(ends[-1], bool)
    inner[heads] = False
    flat[inner] = np.asarray(values.flatten())
    # the first pair of a row, less what the running sum has reached before it
    whole = np.cumsum(flat)
    begin = np.asarray(starts.fill_null(0))[there]
    flat = whole - np.repeat(whole[heads] - begin, sizes[there])
    return flat, ends


def count_pairs(stored: DataFrame, wide: int) -> DataFrame:
    """(pair, docs, best): in how many rows a pair of ids stands, and whether no pair of its A id stands in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            keys, _ = _keys(batch, 0, 1)
            held.append(keys)
            n += len(keys)
            if n > COUNTED:
                key, docs = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(docs)], ["pair", "docs"])
                held, n = [], 0
        if held:
            key, docs = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(docs)], ["pair", "docs"])

    counted = stored.select("first", "steps").mapInArrow(run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    most = F.max("docs").over(Window.partitionBy(F.expr(f"pair div {wide}")))
    return counted.withColumn("best", F.col("docs") == most)


def score_links(docs: DataFrame, file_a: str, file_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: align_tokens with digests, n_best (links of id pairs that stand in as many rows as any pair of their A id) and count_sum (each link's pair's number of rows, added up).

    Rows count as documents of their own, repeated ones too.  See align_tokens for nulls, empty texts and tables.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "align")
    aligned = align_tokens(docs, file_a, file_b, id_col, text_col, digests=True)
    stored = scratch.store(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = scratch.store(count_pairs(stored, len(aligner(file_a, file_b).b.pieces)), "counts")
    blocks = -(-counts.count() // BLOCK) or 1

    def scores(block: int) -> DataFrame:
        own = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).sort("pair").toArrow()
        sent = spark.sparkContext.broadcast(tuple(np.ascontiguousarray(own.column(c).to_numpy()) for c in ("pair", "docs", "best")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, n_docs, best = sent.value
            for batch in batches:
                keys, ends = _keys(batch, 1, 2)
                at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
                known = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
                times = np.where(known, np.asarray(batch.column(3).flatten()), 0)
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in ((times * n_docs[at], times * best[at]) if len(pair) else (times, times))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums)], ["row", "count_sum", "n_best"])

        return stored.select("row", "first", "steps", "times").mapInArrow(run, "row long, count_sum long, n_best long")

    scored = scores(0)
    for block in range(1, blocks):
        scored = scored.unionByName(scores(block))
    scored = scored.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return stored.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(scored, "row").drop("row")
