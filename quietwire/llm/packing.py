"""Best-fit packing of documents into sequences of fixed length, by exact-complement hashing.

A packing only depends on how many pieces there are of each length, so the plan is made on counts:
at most ``capacity`` integers, whatever the corpus. Lengths are taken from the longest down. The
gap that a length leaves is looked up among single lengths, sums of two and sums of three; a
combination that fills it exactly is used as often as the counts allow, which empties at least one
length each time. Where nothing fits exactly, the longest length that fits goes in (best fit) and
the smaller gap is looked up again. Pieces then find their place by their number within their
length, in parallel.

Null and empty texts are documents of one token, the closing one. Repeated rows are packed as often
as they occur; which of two equal rows goes where makes no difference. An empty table gives no rows.
Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import in_batches, numbered
from quietwire.session import stage

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# ASCII signs that never join a letter before them into one token.
_TAIL = ".,!?;:*&$#%"
_KEPT = re.compile("[\x1c-\x1f]")
# Words a worker remembers, and their parts without the signs after them; beyond that it starts anew.
_REMEMBERED = 600_000
_PARTS = 600_000
# Signs of the texts whose new words are learnt together.
_LEARNT = 1 << 20


class _Encoder:
    """Token ids of texts, word by word. White space always ends a token, so equal words have equal ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}

    @staticmethod
    def _split(word: str) -> tuple[str, str]:
        """A word of letters and the signs after it, which are tokens of their own; else the word as it is."""
        core = word.rstrip(_TAIL)
        if not core.isalpha():
            return word, ""
        return (core.lower() if core.isascii() else core), word[len(core) :]

    def _learn(self, parts: list[str]) -> None:
        """Encodes new parts: those of letters only in one long text, since each is one word of it."""
        plain = [p for p in parts if p.isalpha()]
        encoded = self.tokenizer.encode(" ".join(plain), add_special_tokens=False) if plain else None
        if encoded is not None:
            of = np.array(encoded.word_ids, np.int64)
            if len(of) and of[-1] + 1 == len(plain):
                ids = np.array(encoded.ids, "<u4")
                ends = np.searchsorted(of, np.arange(len(plain)), side="right")
                start = 0
                for part, end in zip(plain, ends.tolist()):
                    self.cores[part] = ids[start:end].tobytes()
                    start = end
                parts = [p for p in parts if not p.isalpha()]
        for part, one in zip(parts, self.tokenizer.encode_batch(parts, add_special_tokens=False)):
            self.cores[part] = np.array(one.ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of several texts; what is new in them is learnt at once."""
        known = self.known
        # str.split() also splits at four control characters that the tokenizer keeps in a word.
        split = [re.findall(r"[^ \t-\r]+", text) if _KEPT.search(text) else text.split() for text in texts]
        if len(known) > _REMEMBERED:
            known.clear()
        if len(self.cores) > _PARTS:
            self.cores.clear()
        new = {w: self._split(w) for w in set().union(*split).difference(known)}
        parts = {p for pair in new.values() for p in pair if p and p not in self.cores}
        if parts:
            self._learn(sorted(parts))
        for word, (core, tail) in new.items():
            known[word] = self.cores[core] + (self.cores[tail] if tail else b"")
        return [b"".join([known[w] for w in words]) for words in split]


def _in_groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts of about _LEARNT signs together, a longer one by itself."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= _LEARNT:
            yield held
            held, size = [], 0
    if held:
        yield held


_ENCODERS: dict[str, _Encoder] = {}


def encoder(path: str) -> _Encoder:
    """One per worker process, so that what it has learnt serves the next task as well."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Documents as token ids plus the closing one, cut where they are longer than a sequence."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        code = encoder(tokenizer)
        closing = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            encoded = (ids for group in _in_groups(texts) for ids in code.encode_all(group))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += closing
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, piece, start, len(part) // 4, crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [()] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return in_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, PIECES)


class _Plan:
    """Counts per length, and the sequences made from them as (length, per sequence, offset) lists."""

    def __init__(self, counts: np.ndarray, capacity: int) -> None:
        self.left = counts.astype(np.int64).copy()
        self.capacity = capacity
        self.made: list[tuple[int, list[tuple[int, int]]]] = []

    def _pair(self, gap: int) -> tuple[int, int] | None:
        """Two lengths with this sum, the longer one as long as possible."""
        longer = np.arange(gap - 1, (gap - 1) // 2, -1)
        if not len(longer):
            return None
        free = (self.left[longer] > 0) & (self.left[gap - longer] > (longer == gap - longer))
        found = int(np.argmax(free))
        return (int(longer[found]), gap - int(longer[found])) if free[found] else None

    def exact(self, gap: int) -> list[int] | None:
        """One, two or three lengths that fill the gap."""
        if self.left[gap] > 0:
            return [gap]
        if pair := self._pair(gap):
            return list(pair)
        for first in (np.flatnonzero(self.left[: gap - 1]))[::-1]:
            first = int(first)
            if 3 * first < gap:  # the longest of three is at least a third
                break
            self.left[first] -= 1
            pair = self._pair(gap - first)
            self.left[first] += 1
            if pair:
                return [first, *pair]
        return None

    def run(self) -> list[tuple[int, list[tuple[int, int]]]]:
        for length in range(self.capacity, 0, -1):
            while self.left[length] > 0:
                self._fill(length)
        return self.made

    def _fill(self, length: int) -> None:
        """One kind of sequence that starts with ``length``, as often as the counts allow."""
        inside: dict[int, int] = {length: 1}
        self.left[length] -= 1
        gap = self.capacity - length
        while gap:
            found = self.exact(gap)
            if found is None:
                fitting = np.flatnonzero(self.left[: gap + 1])
                if not len(fitting):
                    break
                best = int(fitting[-1])
                found = [best] * int(min(self.left[best], gap // best))
            for one in found:
                self.left[one] -= 1
                inside[one] = inside.get(one, 0) + 1
                gap -= one
        # The same again while every length in it lasts.
        more = min(int(self.left[one]) // n for one, n in inside.items())
        for one, n in inside.items():
            self.left[one] -= more * n
        self.made.append((1 + more, sorted(inside.items(), reverse=True)))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(how many sequences, [(length, pieces of it in each)])]; uses up exactly the counts."""
    vector = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        vector[length] = n
    return _Plan(vector, capacity).run()


def _slots(made: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first sequence, pieces per sequence, first offset) of every run of places."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, inside in made:
        offset = 0
        for length, each in inside:
            start = used.get(length, 0)
            used[length] = start + times * each
            rows.append((length, start, used[length], sequence, each, offset))
            offset += each * length
        sequence += times
    return rows


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``."""
    parts = stage(parts, "pieces")
    counts = parts.groupBy("length").count().collect()  # a row per length, so at most ``capacity``
    rows = _slots(plan({r["length"]: r["count"] for r in counts}, capacity))
    schema = "length bigint, _from bigint, _to bigint, _sequence bigint, _each bigint, _offset bigint"
    # Each kind of sequence but the last best fits empties a length: a few thousand rows at any size.
    places = F.broadcast(parts.sparkSession.createDataFrame(rows, schema).coalesce(1))
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "piece", "ids_crc32")]
    ranked = numbered(parts, order, ["length"], "_number", "numbered-pieces", few=True)
    inside = F.col("_number") - F.col("_from")
    return (
        ranked.join(places, "length")
        .where((F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_to")))
        .withColumn("sequence_id", F.col("_sequence") + F.floor(inside / F.col("_each")))
        .withColumn("offset", F.col("_offset") + F.pmod(inside, F.col("_each")) * F.col("length"))
        .select(*parts.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity), capacity)
