"""Substring deduplication by content-defined chunks.

Texts are cut into variable chunks where a gear hash rolled over their words is least within WINDOW
words. A cut only depends on the words around it, so an insertion moves no cut beyond its own
surroundings, and a repeated passage is cut alike wherever it stands, but for a few words at its
ends. Each two neighbouring chunks have a digest. The first place of the document with the least id
that holds a digest keeps it; all other places are repeats, those later in the same document too.
Runs of repeats of at least LEAST_WORDS words are cut out of the text, with the white space after
them. A passage of more than 50 words always leaves such a run.

Words are runs without ASCII white space and must be equal letter by letter; the white space between
them may differ. Null texts stay null, empty ones empty; both have no words. Rows equal in id and
text are one document: both keep what it keeps. Null ids come last. An empty table gives no rows.
Columns besides ``doc_id`` and ``text`` are handed on as they are, whatever their names: a result
column whose name is taken gets underscores added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietwire.llm.common import free, hash_words, in_batches, mix, signed, text_bytes
from quietwire.session import stage

WINDOW = 8
LEAST_WORDS = 30
# Words that the gear hash of a place looks back on.
LOOK_BACK = 3
# Chunk rows a task sorts at a time.
BLOCK = 1_000_000
_LAST = (1 << 63) - 1


def cuts(hashes: np.ndarray) -> np.ndarray:
    """The starts of chunks, from the hashes of the words; the first is 0."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        gear = hashes.copy()
        for back in range(1, LOOK_BACK):
            gear[back:] += hashes[:-back] << np.uint64(back)
    gear = mix(gear)
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(gear, WINDOW)
    # The last of equal minima: a run of one word is cut evenly.
    least = np.arange(n - WINDOW + 1) + WINDOW - 1 - np.argmin(windows[:, ::-1], axis=1)
    starts = np.unique(least)
    return starts if starts[0] == 0 else np.concatenate([[0], starts])


def digests(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One per chunk: of it and the next chunk, or of the last chunk by itself."""
    lengths = np.diff(np.concatenate([starts, [len(hashes)]]))
    place = np.arange(len(hashes)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        own = np.add.reduceat(mix(hashes + mix(place.astype(np.uint64), 3)), starts) + lengths.astype(np.uint64)
        own = mix(own, 1)
        both = own.copy()
        both[:-1] = own[:-1] * np.uint64(0x8CB92BA72F3D8DD7) + own[1:]
    return mix(both, 2)


def _chunks(docs: DataFrame) -> DataFrame:
    """kind 0: (digest, doc, at) to meet those of other tasks; kind 1: places known to be repeats."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0

        def block() -> Iterator[pa.RecordBatch]:
            digest, doc, at = (np.concatenate(c) for c in zip(*held))
            later, digest, doc, at = _later(digest, doc, at)
            for kind, part in ((0, ~later), (1, later)):
                arrays = [pa.array(np.full(int(part.sum()), kind, np.int8)), *(pa.array(c[part]) for c in (digest, doc, at))]
                yield pa.RecordBatch.from_arrays(arrays, ["kind", "digest", "doc", "at"])

        for batch in batches:
            ids, salts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for doc, salt, text in zip(ids.tolist(), salts.tolist(), text_bytes(batch.column(2))):
                h, _ = hash_words(text)
                if not len(h):
                    continue
                starts = cuts(h)
                n = len(starts)
                held.append((signed(digests(h, starts)), np.full(n, doc, np.int64), (salt << 32) + np.arange(n)))
                rows += n
                if rows >= BLOCK:
                    yield from block()
                    held.clear()
                    rows = 0
        if held:
            yield from block()

    return in_batches(docs.select("_doc", "_salt", "text"), work, "kind tinyint, digest bigint, doc bigint, at bigint")


def _later(digest, doc, at) -> tuple[np.ndarray, ...]:
    """Rows sorted by digest, and whether each lies elsewhere than the first of its digest."""
    by = np.lexsort((at, doc, digest))
    digest, doc, at = digest[by], doc[by], at[by]
    first = np.ones(len(digest), bool)
    first[1:] = digest[1:] != digest[:-1]
    start = np.flatnonzero(first)[np.cumsum(first) - 1]
    return (doc != doc[start]) | (at != at[start]), digest, doc, at


def _repeats(rows: DataFrame) -> DataFrame:
    """(doc, at) of chunks that an earlier place has as well."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = (None, None, None)
        for batch in batches:
            digest, doc, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(digest):
                continue
            first = np.ones(len(digest), bool)
            first[1:] = digest[1:] != digest[:-1]
            start = np.flatnonzero(first)[np.cumsum(first) - 1]
            own_doc, own_at = doc[start], at[start]
            if digest[0] == owner[0]:
                ahead = digest == digest[0]
                own_doc, own_at = np.where(ahead, owner[1], own_doc), np.where(ahead, owner[2], own_at)
            owner = (digest[-1], own_doc[-1], own_at[-1])
            later = (doc != own_doc) | (at != own_at)
            yield pa.RecordBatch.from_arrays([pa.array(doc[later]), pa.array(at[later])], ["doc", "at"])

    ordered = rows.select("digest", "doc", "at").repartition("digest").sortWithinPartitions("digest", "doc", "at")
    return in_batches(ordered, work, "doc bigint, at bigint")


def _spans(text: bytes, places: np.ndarray, least: int) -> tuple[list[tuple[int, int]], int, int]:
    """(byte ranges to cut out, words cut, words) given the numbers of the chunks that are repeats."""
    if not len(places):
        return [], 0, len(text.split())
    hashes, begins = hash_words(text)
    starts, n = cuts(hashes), len(hashes)
    marked = np.zeros(len(starts) + 2, bool)
    inner = places + 1
    marked[inner] = True  # each digest is of a chunk and the next one
    marked[np.minimum(inner + 1, len(starts))] = True
    edges = np.flatnonzero(marked[1:] != marked[:-1])
    limits = np.concatenate([starts, [n]])
    out, gone = [], 0
    for a, b in zip(limits[edges[::2]].tolist(), limits[edges[1::2]].tolist()):
        if b - a >= least:
            out.append((int(begins[a]), int(begins[b]) if b < n else len(text)))
            gone += b - a
    return out, gone, n


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns of ``docs``, ``text`` without its repeats, and words, removed_words and removed:
    the ranges cut out, as first character and number of characters of the text before."""
    columns = docs.columns
    doc, of, found = (free(c, columns) for c in ("_doc", "_salt", "_places"))
    results = [free(c, columns) for c in ("words", "removed_words", "removed")]
    number = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))
    sign = F.hash("text").bitwiseAND(0x7FFFFFFF).cast("bigint")
    own = stage(_chunks(docs.select(number.alias("_doc"), sign.alias("_salt"), "text")), "chunks")
    places = own.where("kind = 1").select("doc", "at").unionByName(_repeats(own.where("kind = 0")))
    places = places.groupBy(F.col("doc").alias(doc), F.shiftright("at", 32).alias(of)).agg(
        F.sort_array(F.collect_set(F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))).alias(found)
    )
    # The small side is hashed, so that texts are moved once and never sorted.
    kept = docs.withColumns({doc: number, of: sign})
    met = kept.join(stage(places, "repeats").hint("shuffle_hash"), [doc, of], "left")
    text_at, places_at = columns.index("text"), len(columns)
    range_type = pa.struct([("start", pa.int64()), ("length", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, words, gone, ranges = [], [], [], []
            for value, marked in zip(batch.column(text_at), batch.column(places_at)):
                text = value.as_py()
                raw = (text or "").encode()
                marked = marked.as_py()
                spans, removed, n = _spans(raw, np.array(marked or [], np.int64), least_words)
                if spans:
                    bounds = [0, *(x for s in spans for x in s), len(raw)]
                    text = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])).decode()
                texts.append(text)
                words.append(n)
                gone.append(removed)
                ranges.append([{"start": len(raw[:a].decode()), "length": len(raw[a:b].decode())} for a, b in spans])
            arrays = [batch.column(i) for i in range(places_at)]
            arrays[text_at] = pa.array(texts, batch.column(text_at).type)
            arrays += [pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(ranges, pa.list_(range_type))]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *results])

    ranges = T.ArrayType(T.StructType().add("start", T.LongType()).add("length", T.LongType()))
    schema = T.StructType([*docs.schema.fields])
    for name, kind in zip(results, (T.LongType(), T.LongType(), ranges)):
        schema = schema.add(name, kind)
    return in_batches(met.select(*columns, found), work, schema)
