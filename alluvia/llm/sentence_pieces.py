"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps a score-ordered agenda of adjacent symbol pairs and merges the best pair (ties: the leftmost) until none is
a piece. Where no piece of the vocabulary holds a space mark after another character, nor an ASCII sign or digit beside a Latin letter, a text falls apart before each run of space marks and between signs and letters, and equal parts have equal ids;
parts are memoised. Models of which this isn't true are refused. Each part new to a worker is checked, batch by batch, against
the sentencepiece library: if the two should ever differ, the library's ids count, and the result says how many of a text's
parts differed (n_differing), so that a broken agenda shows.

Nulls are empty texts; an empty text has no ids. Repeated rows give repeated rows; other columns are left out unless named, and
may have any names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
SIGNS = r"\x00-@\[-`{-\x7f"
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]"
PARTS = re.compile(f"{MARK}*(?:{LETTER}++(?=[{MARK}{SIGNS}]|\\Z)|[{SIGNS}]++(?={MARK}|{LETTER}|\\Z)|[^{MARK}]+)|{MARK}+")
JOINT = re.compile(f"{LETTER}[{SIGNS}]|[{SIGNS}]{LETTER}|[^{MARK}]{MARK}|\n.|.\n", re.DOTALL)
MEMO_PARTS = 600_000
MEMO_LENGTH = 64


def _fields(message: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, message[at : at + size]
            at += size


class PieceCoder:
    """A merge-type vocabulary of the sentencepiece library: encode, decode and the check of one against the other."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        fields = [(k, v) for k, v in _fields(sp.serialized_model_proto()) if k in (2, 3)]
        trainer = dict(_fields(next(v for k, v in fields if k == 2)))
        normaliser = dict(_fields(next((v for k, v in fields if k == 3), b"")))
        self.plain = not normaliser.get(2) and normaliser.get(4, 1) == 0 and normaliser.get(5, 1) == 1 and not trainer.get(24)
        self.prefix = normaliser.get(3, 1)
        self.rank, self.bytes_of = {}, {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_of[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.rank[piece] = (-sp.get_score(i), i)
                if sp.is_unused(i) or JOINT.search(piece):
                    self.plain = False
        if trainer.get(3, 1) != 2 or not self.plain:
            raise ValueError("a merge-type model with identity normalisation is needed")
        self.unknown, self.memo, self.differing = sp.unk_id(), {}, set()

    def merge(self, text: str) -> list[int]:
        """The ids of one part, by the agenda."""
        rank, symbols = self.rank, list(text)
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        agenda = [(rank[p][0], i, p) for i in range(len(symbols) - 1) if (p := symbols[i] + symbols[i + 1]) in rank]
        heapq.heapify(agenda)
        while agenda:
            _, left, pair = heapq.heappop(agenda)
            right = after[left]
            if not symbols[left] or right < 0 or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            after[left] = nxt = after[right]
            if nxt >= 0:
                before[nxt] = left
                if (p := pair + symbols[nxt]) in rank:
                    heapq.heappush(agenda, (rank[p][0], left, p))
            prev = before[left]
            if prev >= 0 and (p := symbols[prev] + pair) in rank:
                heapq.heappush(agenda, (rank[p][0], prev, p))
        ids = []
        for s in symbols:
            if s in rank:
                ids.append(rank[s][1])
            elif s:
                ids += [self.bytes_of[b] for b in s.encode()] if self.bytes_of else [self.unknown]
        return ids

    def library_ids(self, parts: list[str]) -> list[list[int]]:
        """The library's ids of parts: those that open with a mark lose it to the mark that the library sets first; others follow a line feed that is cut off."""
        if not self.prefix:
            return self.library.encode(parts, num_threads=1)
        lead = self.library.encode("\n", num_threads=1)
        marked = [p[0] == MARK for p in parts]
        found = self.library.encode([p[1:] if m and len(p) > 1 else p if m else "\n" + p for p, m in zip(parts, marked)], num_threads=1)
        alone = None
        out = []
        for p, m, ids in zip(parts, marked, found):
            if m and len(p) == 1:
                alone = alone or [self.library.piece_to_id(MARK)]
                ids = alone
            out.append(ids if m else ids[len(lead) :])
        return out

    def encode(self, texts: list[str]) -> list[tuple[list[list[int]], int]]:
        """For each text the ids of its parts, and how many of them the agenda got wrong. Parts new to this worker are checked against the library."""
        memo = self.memo
        cut = [PARTS.findall((MARK if self.prefix and t else "") + t.replace(" ", MARK)) for t in texts]
        new = {p for parts in cut for p in parts if p not in memo}
        fresh = list(new)
        ids = [self.merge(p) for p in fresh]
        for k, theirs in enumerate(self.library_ids(fresh)):
            if theirs != ids[k]:
                self.differing.add(fresh[k])
                ids[k] = theirs
        found = dict(zip(fresh, ids))
        memo.update(found)
        wrong = self.differing
        out = [([memo[p] for p in parts], sum(p in wrong for p in parts) if wrong else 0) for parts in cut]
        if len(memo) > MEMO_PARTS:
            memo.clear()
        else:
            for p in fresh:
                if len(p) > MEMO_LENGTH:
                    del memo[p]
        return out


_coders: dict[str, PieceCoder] = {}


def coder(model: str) -> PieceCoder:
    """One coder for each model and worker."""
    if model not in _coders:
        _coders[model] = PieceCoder(model)
    return _coders[model]


def _slices(batch: pa.RecordBatch, at: int):
    from alluvia.llm.arrow_text import row_chunks

    for start, stop in row_chunks(batch.column(at)):
        yield batch.slice(start, stop - start)


def encode_texts(df: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ids array<int> of the whole text, decoded, the library's text for those ids, and n_differing."""
    kept = df.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        own = coder(model)
        for batch in batches:
            for b in _slices(batch, len(keep)):
                coded = own.encode([t or "" for t in b.column(len(keep)).to_pylist()])
                ids = [[i for part in parts for i in part] for parts, _ in coded]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.list_(pa.int32())), pa.array(own.library.decode(ids) if ids else [], pa.string()), pa.array([n for _, n in coded], pa.int64())], [*keep, "ids", "decoded", "n_differing"])

    return kept.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1]) + ", ids array<int>, decoded string, n_differing long")


def decode_ids(df: DataFrame, model: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and text, what the library decodes from each list of ids; a null list gives an empty text."""
    kept = df.select(*keep, F.col(ids).alias("__ids"))

    def run(batches):
        own = coder(model)
        for b in batches:
            lists = [x or [] for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(own.library.decode(lists) if lists else [], pa.string())], [*keep, "text"])

    return kept.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1]) + ", text string")


def encoding_digests(df: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_differing of each row: encode_texts and decode_ids in one pass, without moving the ids."""
    kept = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        own = coder(model)
        decimal = [str(i) for i in range(own.library.get_piece_size())]
        for batch in batches:
            for b in _slices(batch, 1):
                n, ids_of, text_of, wrong = [], [], [], []
                for parts, differing in own.encode([t or "" for t in b.column(1).to_pylist()]):
                    ids = [i for part in parts for i in part]
                    n.append(len(ids))
                    wrong.append(differing)
                    ids_of.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                    text_of.append(hashlib.sha256(own.library.decode(ids).encode() if ids else b"").hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_of, pa.string()), pa.array(text_of, pa.string()), pa.array(wrong, pa.int64())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_differing"])

    return kept.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_differing long")
