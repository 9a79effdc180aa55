"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding follows the merge order of the vocabulary: all adjacent symbol pairs that form a piece
wait in an agenda ordered by score, ties by place; the best is merged, its neighbours form new
pairs, and so on.  Characters outside the vocabulary become byte pieces.

No piece of such a vocabulary has a space mark behind another character, so merges never cross
the start of a run of marks, nor a character that stands in no piece of several characters.
Texts are cut there; the parts are encoded on their own and kept in a bounded memory of each
Python worker.  In every Arrow batch all newly encoded parts are put together and compared with
the sentencepiece library; a difference stops the job.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sparkops import own_columns

MARK = "▁"
#: Parts kept by a worker: two generations of this many, and of so many characters in all; longer parts aren't kept.
MEMORY, MEMORY_CHARS, LONGEST = 220_000, 2_500_000, 200
#: Characters of a part up to which its agenda is a plain list; the score of a pair that is no piece.
SHORT, NO_PIECE = 24, float("-inf")
#: Characters of new parts that are compared with the library at a time.
COMPARE = 1 << 20


class PieceBpe:
    """Encoder and decoder for one model file."""

    def __init__(self, model_file: str, memory: int = MEMORY):
        self.memory, self.memory_chars = memory, MEMORY_CHARS * memory // MEMORY
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = {i for i in range(len(lib)) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)}
        self.pieces = [lib.id_to_piece(i) for i in range(len(lib))]
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.special = special - set(self.byte_of)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a space mark behind another character")
        if "\n" in "".join(p for p in self.ids if len(p) > 1):
            self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        else:
            self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")
        probe = "a  b\n ½Å"
        if lib.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model rewrites its input; only a leading mark and marks for spaces are supported")
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.new: list[tuple[str, tuple[int, ...]]] = []
        self.new_size = self.young_chars = 0

    def merge(self, part: str) -> tuple[int, ...]:
        """The ids of one part, by the agenda: of the pairs of highest score the first is merged, until no pair is a piece."""
        return self._ids(self._merged_short(part) if len(part) <= SHORT else self._merged_long(part))

    def _merged_short(self, part: str) -> list[str]:
        """The agenda of a short part is a list beside its symbols: the score of each with the next."""
        get, symbols = self.scores.get, list(part)
        agenda = [get(a + b, NO_PIECE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := max(agenda)) > NO_PIECE:
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(symbols[i] + symbols[i + 1], NO_PIECE)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + symbols[i], NO_PIECE)
        return symbols

    def _merged_long(self, part: str) -> list[str]:
        """The agenda of a long part is a heap over linked symbols."""
        scores, symbols = self.scores, list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if (score := scores.get(pair)) is not None:
                agenda.append((-score, i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, pair = heapq.heappop(agenda)
            if symbols[i] and symbols[j] and after[i] == j and len(symbols[i]) + len(symbols[j]) == len(pair):
                symbols[i], symbols[j] = pair, ""
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    wider = pair + symbols[k]
                    if (score := scores.get(wider)) is not None:
                        heapq.heappush(agenda, (-score, i, k, wider))
                h = before[i]
                if h >= 0:
                    wider = symbols[h] + pair
                    if (score := scores.get(wider)) is not None:
                        heapq.heappush(agenda, (-score, h, i, wider))
        return [s for s in symbols if s]

    def _ids(self, symbols: list[str]) -> tuple[int, ...]:
        """The ids of symbols; one that is no piece has those of its bytes."""
        out: list[int] = []
        for s in symbols:
            found = self.ids.get(s)
            if found is None:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(found)
        return tuple(out)

    def _learn(self, part: str) -> tuple[int, ...]:
        ids = self.old.get(part)
        if ids is None:
            ids = self.merge(part)
            self.new.append((part, ids))
            self.new_size += len(part)
            if self.new_size > COMPARE:
                self.compare()
        if len(part) <= LONGEST:
            if len(self.young) >= self.memory or self.young_chars > self.memory_chars:
                self.old, self.young, self.young_chars = self.young, {}, 0
            self.young[part] = ids
            self.young_chars += len(part)
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a text; an empty text has none."""
        out: list[int] = []
        if not text:
            return out
        known, learn, extend = self.young.get, self._learn, out.extend
        for part in self.cut.findall(MARK + text.replace(" ", MARK)):
            extend(known(part) or learn(part))
        return out

    def compare(self) -> None:
        """Stops if the library encodes the parts learned since the last call in another way."""
        learned, self.new, self.new_size = self.new, [], 0
        line = self.merge("\n")
        text, mine = ["x"], list(self.merge(f"{MARK}x"))
        for part, ids in learned:
            if part[0] not in (MARK, "\n"):
                text.append("\n")
                mine.extend(line)
            text.append(part)
            mine.extend(ids)
            if part[-1] == MARK:  # else its marks would run into those of the next part
                text.append("\n")
                mine.extend(line)
        if learned and self.library.encode("".join(text)) != mine:
            raise ValueError("the library encodes a text of this batch in another way")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that form no UTF-8 give U+FFFD each, control ids nothing."""
        out, pending, first = [], bytearray(), True

        def flush() -> None:
            while pending:
                for size in range(min(4, len(pending)), 0, -1):
                    try:
                        out.append(bytes(pending[:size]).decode())
                        del pending[:size]
                        break
                    except UnicodeDecodeError:
                        if size == 1:
                            out.append("�")
                            del pending[:1]

        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                first = False
                continue
            flush()
            if i in self.special:
                out.append(" ⁇ " if self.library.is_unknown(i) else "")
                continue
            piece = self.pieces[i].replace(MARK, " ")
            out.append(piece[1:] if first and piece.startswith(" ") else piece)
            first = False
        flush()
        return "".join(out)


_coders: dict[tuple[str, int], PieceBpe] = {}


def coder(model_file: str, memory: int = MEMORY) -> PieceBpe:
    """This process's coder for a model file, with what it remembers."""
    if (model_file, memory) not in _coders:
        # remembered parts are tuples that live on; the collector needn't look at them every few hundred objects
        gc.set_threshold(50_000)
        pa.default_memory_pool().release_unused()  # of what the worker did before
        _coders[model_file, memory] = PieceBpe(model_file, memory)
    return _coders[model_file, memory]


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, digests: bool = False, memory: int = MEMORY) -> DataFrame:
    """One row per input row: doc_id, n_tokens, and by choice ids, decoded (the library's decode(ids)) and digests of both.

    A null or empty text has no ids and decodes to the empty text.  Repeated rows and null ids are
    kept as they are; an empty table gives an empty result; other columns are ignored.  The model
    file must be readable at the same path on every executor.  memory: parts that a worker remembers, which costs
    about 500 bytes each and spares encoding them again.
    """
    kinds = {"doc_id": ("long", pa.int64()), "n_tokens": ("long", pa.int64())}
    if with_ids:
        kinds |= {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string())}
    if digests:
        kinds |= {"ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(model_file, memory)
        names = [str(i) for i in range(len(bpe.pieces))]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                cols: dict[str, list] = {name: [] for name in kinds}
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = bpe.encode(text.as_py() or "")
                    cols["doc_id"].append(doc_id)
                    cols["n_tokens"].append(len(ids))
                    decoded = bpe.library.decode(ids)
                    if with_ids:
                        cols["ids"].append(ids)
                        cols["decoded"].append(decoded)
                    if digests:
                        cols["ids_sha256"].append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                        cols["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([pa.array(cols[name], kind) for name, (_, kind) in kinds.items()], list(kinds))
            bpe.compare()

    docs = own_columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, ", ".join(f"{name} {kind}" for name, (kind, _) in kinds.items()))
