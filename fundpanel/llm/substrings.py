"""Substring dedup by suffix automata of reference shards.

The reference is what repeats: stretches of words all of whose windows (of `window` words) begin
in a second text, each in the text with the smallest id.  They are found by hashes: minimizers of
the windows choose the texts that may share one, hashes of these texts' windows choose the owners.
The reference is cut into shards of about SHARD words; a suffix automaton of each shard is built once, by a task of its own.
Shards are broadcast in rounds of ROUND bytes at most (or one shard, whose size SHARD bounds), each to tasks
that read the texts which share a window with the owners of that round's shards; a round reads its own shards alone.  A text is then streamed through the
automaton; wherever the matching statistic reaches the window's length in words that an owner with a
smaller id has, the window is removed.  The automaton alone decides; hashes only choose the shards of a text.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sparkops import materialize, own_columns, shared_dir
from .textops import U64, grams, slices, utf8, words

#: Words of a minimizer.
GRAM = 12
#: Words of a reference shard, and of the texts that one task streams through its automaton, about; bytes of automata that are broadcast together.
SHARD, STREAM, ROUND = 150_000, 1_500_000, 1 << 25


class SuffixAutomaton:
    """A suffix automaton of several word sequences, each with an owner's id."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def _state(self, moves: dict[int, int], length: int, link: int, owner: int | None) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.owner.append(owner)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the words of q that end p's extension by c, if q stands for longer ones, too."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q], None)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], owner: int) -> None:
        """Adds a sequence; its prefixes' states know the smallest owner."""
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:
                last = self._split(last, c, q)
            else:
                new = self._state({}, self.length[last] + 1, 0, None)
                p = last
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, c, self.next[p][c])
                last = new
            if self.owner[last] is None or owner < self.owner[last]:
                self.owner[last] = owner

    def finish(self) -> None:
        """Passes the smallest owner of every state on to its suffixes."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            p, own = self.link[v], self.owner[v]
            if p > 0 and own is not None and (self.owner[p] is None or own < self.owner[p]):
                self.owner[p] = own

    def pack(self, alphabet: np.ndarray) -> bytes:
        """The automaton as compressed bytes; alphabet: the word hash of each number in the sequences."""
        moves = [(s * len(alphabet) + c, t) for s, d in enumerate(self.next) for c, t in d.items()]
        keys, to = (np.array(x, np.int64) for x in zip(*moves, strict=True)) if moves else (np.zeros(0, np.int64),) * 2
        none = np.iinfo(np.int64).max
        return zlib.compress(pickle.dumps((alphabet, keys, to.astype(np.int32), np.array(self.link, np.int32), np.array(self.length, np.int32), np.array([none if x is None else x for x in self.owner]))), 1)


class Matcher:
    """Streams texts through a packed automaton."""

    def __init__(self, packed: bytes):
        self.alphabet, keys, to, link, length, owner = pickle.loads(zlib.decompress(packed))
        self.moves = dict(zip(keys.tolist(), to.tolist(), strict=True))
        self.link, self.length, self.owner = link.tolist(), length.tolist(), owner.tolist()

    def repeats(self, hashes: np.ndarray, own: int, window: int) -> list[tuple[int, int]]:
        """Maximal stretches (start, end) of the windows that an owner with a smaller id than own has."""
        if not len(self.alphabet):
            return []
        at = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        numbers = np.where(self.alphabet[at] == hashes, at, -1).tolist()
        moves, link, length, owner, size = self.moves.get, self.link, self.length, self.owner, len(self.alphabet)
        out: list[tuple[int, int]] = []
        s = n = 0
        for i, c in enumerate(numbers):
            if c < 0:
                s = n = 0
                continue
            t = moves(s * size + c)
            while t is None and s:
                s = link[s]
                n = length[s]
                t = moves(s * size + c)
            if t is None:
                continue
            s = t
            n += 1
            if n >= window:
                while length[link[s]] >= window:
                    s = link[s]
                n = min(n, length[s])
                if owner[s] < own:
                    if out and out[-1][1] >= i + 1 - window:
                        out[-1] = (out[-1][0], i + 1)
                    else:
                        out.append((i + 1 - window, i + 1))
        return out


def minimizers(gram_hashes: np.ndarray, span: int) -> np.ndarray:
    """The place of the (first) least hash in each of the spans of consecutive n-grams."""
    view = np.lib.stride_tricks.sliding_window_view(gram_hashes, span)
    return view.argmin(axis=1) + np.arange(len(view))


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text."""
    data, offsets = utf8(column)
    for _, _, part, cuts in slices(data, offsets):
        found, first = words(part, cuts, False)
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield found[a:b]


def describe(docs: DataFrame, window: int) -> DataFrame:
    """(id, rid, n_words, kept_sha256, anchors) of every row: the digest of all its words, the hashes of its windows' minimizers."""
    span = window - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, anchors = [], [], []
            for text, hashes in zip(batch.column(2), _texts(batch.column(2)), strict=True):
                sizes.append(len(hashes))
                digests.append(hashlib.sha256(b" ".join((text.as_py() or "").encode().split())).hexdigest())
                g = grams(hashes, GRAM, 41)
                anchors.append(np.unique(g[np.unique(minimizers(g, span))]).astype(np.int64) if len(g) >= span else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(anchors, pa.list_(pa.int64()))], ["id", "rid", "n_words", "kept_sha256", "anchors"])

    return docs.mapInArrow(run, "id long, rid long, n_words long, kept_sha256 string, anchors array<long>")


def shared_windows(texts: DataFrame, window: int) -> DataFrame:
    """(w, id, rid, pos): hashes of the windows whose minimizer is among the anchors that repeat.  texts: (id, rid, text, anchors)."""
    span = window - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                out = []
                for i, r, hashes, anchors in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _texts(part.column(2)), part.column(3), strict=True):
                    g = grams(hashes, GRAM, 41)
                    if len(g) >= span:
                        pos = np.flatnonzero(np.isin(g[minimizers(g, span)].astype(np.int64), np.array(anchors.as_py(), np.int64)))
                        w, once = np.unique(grams(hashes, window, 42)[pos], return_index=True)
                        out.append((w.astype(np.int64), np.full(len(w), i), np.full(len(w), r), pos[once].astype(np.int32)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["w", "id", "rid", "pos"])

    return texts.mapInArrow(run, "w long, id long, rid long, pos int")


def owners(rows: DataFrame) -> DataFrame:
    """Of windows in texts of different ids: (rid, owner, pos), where a text has a window of an owner with a smaller id; pos null but in the owner's own rows.

    Rows are dealt by window and sorted by id; the run of a window is walked without being held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, first, told_owner, told = None, None, False, set()
        for batch in batches:
            out = []
            w, ids, rids, pos = (batch.column(c).to_numpy() for c in ("w", "id", "rid", "pos"))
            shared = np.ones(len(w), bool)
            shared[1:-1] = (w[1:-1] == w[:-2]) | (w[1:-1] == w[2:])
            for x, i, r, p in zip(*(y[shared].tolist() for y in (w, ids, rids, pos)), strict=True):
                if x != window:
                    window, first, told_owner = x, (i, r, p), False
                elif i > first[0]:
                    if not told_owner:
                        told_owner = True
                        out.append((first[1], first[1], first[2]))
                    if (r, first[1]) not in told:
                        if len(told) > 300_000:
                            told.clear()
                        told.add((r, first[1]))
                        out.append((r, first[1], None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32()), strict=True)], ["rid", "owner", "pos"])

    return rows.repartition("w").sortWithinPartitions("w", "id", "rid").mapInArrow(run, "rid long, owner long, pos int")


def reference_words(places: Column, window: int) -> Column:
    """The words that windows at ascending places cover."""
    n = F.size(places) - 1
    steps = F.zip_with(F.slice(places, F.lit(2), n), F.slice(places, F.lit(1), n), lambda y, x: F.least(y - x, F.lit(window)).cast("long"))
    return F.aggregate(steps, F.lit(window).cast("long"), lambda a, x: a + x)


def build_shards(reference: DataFrame, window: int, shards: int) -> DataFrame:
    """(shard, bytes, packed): an automaton for each shard of rows (shard, id, text, places), each by a task of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            for s, i, hashes, places in zip(batch.column("shard").to_pylist(), batch.column("id").to_pylist(), _texts(batch.column("text")), batch.column("places"), strict=True):
                shard = s
                pos = np.array(places.as_py(), np.int64)
                cut = np.flatnonzero(np.diff(pos) > window) + 1
                held.extend((hashes[p[0] : p[-1] + window].copy(), i) for p in np.split(pos, cut))
        if shard is not None:
            alphabet, automaton = np.unique(np.concatenate([h for h, _ in held])), SuffixAutomaton()
            for h, own in held:
                automaton.add(np.searchsorted(alphabet, h).tolist(), own)
            automaton.finish()
            packed = automaton.pack(alphabet)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(packed)], pa.int64()), pa.array([packed], pa.binary())], ["shard", "bytes", "packed"])

    return reference.repartitionById(shards, F.col("shard")).sortWithinPartitions("id").mapInArrow(run, "shard int, bytes long, packed binary")


def rounds_of(automata: DataFrame) -> DataFrame:
    """(shard, round): shards in the order of their numbers, a new round where their bytes pass another ROUND / 2, so that a round of several has no more than ROUND.

    One task sees two numbers per shard, that is per 150,000 words of reference.
    """
    before = F.coalesce(F.sum("bytes").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return materialize(automata.select("shard", "bytes").select("shard", F.floor(before / (ROUND // 2)).cast("int").alias("round")), "rounds")


def stream(routed: DataFrame, automata: DataFrame, rounds: DataFrame, window: int) -> DataFrame:
    """(rid, spans) of what is to be removed.  routed: the rows (round, shard, rid, id, text), stored by round, in the order of shards; automata: (shard, packed), stored by shard; rounds: (shard, round).

    Each round's automata are read and broadcast, its spans are stored, and the broadcast goes before the next; a task holds the one of
    the shard it is at.
    """
    spark, kinds = routed.sparkSession, "rid long, spans array<int>"
    path = f"{shared_dir(spark)}/spans-{uuid.uuid4().hex}"
    spark.createDataFrame([], kinds).write.parquet(f"{path}/none")
    for r, lo, hi in sorted(map(tuple, rounds.groupBy("round").agg(F.min("shard"), F.max("shard")).collect())):
        held = automata.filter(F.col("shard").between(lo, hi)).select("shard", "packed").toArrow()  # ROUND bytes, or one shard
        sent = spark.sparkContext.broadcast(dict(zip(held["shard"].to_pylist(), held["packed"].to_pylist(), strict=True)))
        del held

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            shard, matcher = None, None
            for batch in batches:
                rids, spans = [], []
                for s, r, i, hashes in zip(batch.column("shard").to_pylist(), batch.column("rid").to_pylist(), batch.column("id").to_pylist(), _texts(batch.column("text")), strict=True):
                    if s != shard:
                        matcher = None  # the one before goes first
                        shard, matcher = s, Matcher(sent.value[s])
                    if found := matcher.repeats(hashes, i, window):
                        rids.append(r)
                        spans.append([x for span in found for x in span])
                if rids:
                    yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(spans, pa.list_(pa.int32()))], ["rid", "spans"])

        routed.filter(F.col("round") == r).select("shard", "rid", "id", "text").mapInArrow(run, kinds).write.parquet(f"{path}/round{r}")
        sent.destroy()
    return spark.read.schema(kinds).option("recursiveFileLookup", True).parquet(path)


def _cut(texts: DataFrame, with_text: bool) -> DataFrame:
    """(rid, n_removed, kept_sha256, kept) of rows (rid, text, spans); spans of several shards may overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                whole = text.as_py().encode().split()
                gone = np.zeros(len(whole), bool)
                for a, b in np.array(spans.as_py(), np.int64).reshape(-1, 2):
                    gone[a:b] = True
                left = b" ".join(w for w, x in zip(whole, gone.tolist(), strict=True) if not x)
                n.append(int(gone.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())], ["rid", "n_removed", "kept_sha256", "kept"])

    return texts.mapInArrow(run, "rid long, n_removed long, kept_sha256 string, kept string")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, with_text: bool = False) -> DataFrame:
    """Removes each word in a window of words that also begins in a text with a smaller id.

    Returns one row per input row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space) and
    by choice kept (that text; null where nothing was removed).  Windows are judged on the input.  Null and empty texts have no words;
    a row with a null id is neither cut nor a reference; rows of one id aren't compared with
    each other; an empty table gives an empty result; other columns are ignored.
    """
    if window < GRAM:
        raise ValueError(f"a window has {GRAM} words at least")
    docs = own_columns(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.xxhash64("id", "text").alias("rid"), "text")
    described = materialize(describe(docs, window), "described")
    anchors = described.filter("id is not null").select("id", "rid", F.explode("anchors").alias("anchor"))
    repeated = anchors.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("anchor")
    wanted = materialize(anchors.join(repeated, "anchor").groupBy("rid").agg(F.collect_set("anchor").alias("anchors")), "wanted")
    texts = materialize(docs.join(wanted, "rid").dropDuplicates(["rid"]).select("id", "rid", "text", "anchors"), "texts")
    found = materialize(owners(shared_windows(texts, window)), "owners")

    places = found.filter("pos is not null").groupBy("owner").agg(F.array_sort(F.collect_set("pos")).alias("places"))
    places = materialize(places.withColumn("n", reference_words(F.col("places"), window)), "places")
    total = places.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int")
    plain = texts.select("id", "rid", "text")
    reference = places.join(plain, places.owner == plain.rid).select(shard.alias("shard"), "id", "text", "places")
    automata = materialize(build_shards(reference, window, shards), "automata", by="shard")
    rounds = rounds_of(automata)
    routes = found.filter("pos is null").select("rid", shard.alias("shard")).distinct()
    sizes = described.groupBy("rid").agg(F.max("n_words").alias("n"))
    load = routes.join(sizes, "rid").groupBy("shard").agg(F.ceil(F.sum("n") / STREAM).cast("int").alias("parts"))
    rows = routes.join(load.join(rounds, "shard"), "shard").join(plain, "rid").select("round", "shard", F.pmod(F.hash("rid"), F.greatest(F.col("parts"), F.lit(1))).alias("part"), "rid", "id", "text")
    # a folder per round: each reads its own texts
    routed = materialize(rows.repartition("shard", "part").drop("part").sortWithinPartitions("round", "shard"), "routed", by="round")
    spans = stream(routed, automata, rounds, window).groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    cut = materialize(_cut(plain.join(spans, "rid").select("rid", "text", "spans"), with_text), "cut").withColumnRenamed("kept_sha256", "cut_sha256")
    out = described.join(cut, "rid", "left").select(F.col("id").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("cut_sha256", "kept_sha256").alias("kept_sha256"), "kept")
    return out if with_text else out.drop("kept")
