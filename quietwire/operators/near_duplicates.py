"""Exact near-duplicate clustering: TF-IDF cosine, greedy, earliest item first.

Within a bucket, items are taken in order; an item joins the first earlier leader whose
cosine similarity reaches the threshold, else it becomes a leader. Word and word-pair
weights are ``tf * (ln((1 + n) / (1 + df)) + 1)``, scaled to unit length, with ``n`` and
``df`` counted per bucket.

How the work is spread:

* Items with equal words have equal vectors, so the later ones always follow the first. They are
  folded into one (keeping their count for ``n``, ``df``).
* Words are folded once. Grams are 64-bit hashes that tell buckets apart as well. Blocks of texts send each of their
  grams once, packed by ranges of hashes, and get back the counts alone, in the order of the hashes. A text keeps the
  packed counts of its grams; its hashes and weights are made again from the words where a pair needs them.
* Pairs are found by prefix filtering (Bayardo et al., WWW 2007): per item only the rarest
  grams are joined, up to the point where the remaining tail is shorter than the threshold. Where two
  items meet, the product of what is left of both bounds their cosine.
* A pair is verified by looking the shorter vector up in the longer; no gram becomes a row again. Pairs are dealt by the first item that their
  later end may be similar to, so the words of a group of near copies move once, not once a pair.
* Items that may be similar to nothing before them lead. Pairs with these are verified first; what follows them drops
  all its pairs with later items, unverified. So a group of near copies costs its items, not its pairs. Once that
  no longer halves the pairs (long chains), all that are left are verified.
* The greedy pass runs on the similar pairs, not on items. When a bucket has too many
  candidate pairs, only the head of its order is settled first, the rest is compared with
  the leaders found there, and only what is still open goes on. A large group of near
  copies so meets its leader once instead of forming all pairs (prefix rounds as in
  Blelloch, Fineman, Shun, SPAA 2012).
* The pairs of a bucket are folded in order in one pass that remembers the followers, however long
  the chains among them. A bucket with more pairs than a fold may hold is worked off from both
  sides: its first pairs are folded, and wherever an item has no earlier open neighbour it leads.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietwire.functions.text import common_words, spaced_words, words_apart
from quietwire.llm.common import hash_words, in_batches, mix, signed, text_bytes
from quietwire.operators import skew
from quietwire.operators.skew import BROADCAST_ROWS, hot_keys, lookup_join, number_rows, salted_join
from quietwire.session import stage
from quietwire.settings import DEDUP_SIMILARITY


@dataclass(frozen=True)
class Effort:
    """Bounds on one step. They change the number of rounds, never the result."""

    # Candidate pairs a bucket may form at once: the larger of a constant and a multiple of
    # its items, which keeps the total linear in the data.
    pairs_per_bucket: int = 20_000_000
    pairs_per_item: int = 1024
    # Items a round always takes from the head of an overfull bucket.
    head: int = 1024
    # Similar pairs of one bucket that a single fold may settle; it holds the ids of their followers.
    pairs_in_one_fold: int = 2_000_000
    # Candidate pairs that are verified whole; of more, those with known leaders come first.
    pairs_at_once: int = 4096


# Cosines are sums of rounded products; prefixes are cut a little late to stay on the safe side.
_SLACK = 1e-9
# Texts whose grams are counted together, a power of two.
TEXTS_IN_BLOCK = 4096
# Shares of all codes that are counted apart, at least.
LEAST_RANGES = 32
# Candidate pairs whose vectors go to the same place, and those that are verified at a time.
PAIRS_TOGETHER = 1024
PAIRS_AT_ONCE = 128

# Bytes of texts that are hashed together.
BYTES_AT_ONCE = 1 << 17

_FACTOR = np.uint64(0x9FB21C651E98DF25)
# Bytes of a UTF-8 character by its first one.
_SIGN_BYTES = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])


def near_duplicates(
    items: DataFrame,
    *,
    bucket: list[str],
    order: list[str],
    text: Column,
    id_col: str = "id",
    threshold: float = DEDUP_SIMILARITY,
    effort: Effort = Effort(),
) -> DataFrame:
    """(bucket..., id, leader_id) for every item; an item is kept when both ids are equal.

    ``id_col`` must be unique. Bucket columns must not be null. Nulls in ``order`` come first,
    ties are settled by id.
    """
    keyed, copies, vectors = _vectors(items, bucket, order, text, id_col, threshold)
    followers = _greedy(vectors, bucket, threshold, effort)

    led = followers.select(F.col("id").alias("first_id"), F.col("leader_id").alias("led_by"))
    # Later copies take the leader of the first one. Only texts with copies need the lookup.
    repeated = copies.where("copies > 1").select(*bucket, "key", F.col("first.id").alias("first_id"), "copies")
    firsts = salted_join(
        keyed,
        repeated.drop("copies"),
        [*bucket, "key"],
        hot_keys(repeated, [*bucket, "key"], "copies"),
        F.col("id"),
        "left",
    ).select(*bucket, "id", F.coalesce("first_id", "id").alias("first_id"))
    often = hot_keys(repeated, ["first_id"], "copies")
    return salted_join(firsts, led, ["first_id"], often, F.col("id"), "left").select(
        *bucket, F.col("id").alias(id_col), F.coalesce("led_by", "first_id").alias("leader_id")
    )


def near_duplicate_followers(
    items: DataFrame,
    *,
    bucket: list[str],
    order: list[str],
    text: Column,
    id_col: str = "id",
    threshold: float = DEDUP_SIMILARITY,
    effort: Effort = Effort(),
) -> DataFrame:
    """(bucket..., member, leader, similarity): one row for each item that is not kept, copies included.

    A group of n items gives n - 1 rows, however similar its members are to each other.
    """
    keyed, copies, vectors = _vectors(items, bucket, order, text, id_col, threshold)
    led = _greedy(vectors, bucket, threshold, effort).where("id <> leader_id")
    scored = stage(led.select(F.col("id").alias("first_id"), F.col("leader_id").alias("a"), "similarity"), "led")
    # Later copies follow the leader of the first one, or the first one itself.
    repeated = copies.select(*bucket, "key", F.col("first.id").alias("first_id"), "copies")
    firsts = salted_join(keyed, repeated.drop("copies"), [*bucket, "key"], hot_keys(repeated, [*bucket, "key"], "copies"), F.col("id"))
    found = lookup_join(firsts.select(*bucket, "id", "first_id"), scored, ["first_id"], F.col("id"), "left")
    own = F.col("a").isNull()
    return found.where(~own | (F.col("id") != F.col("first_id"))).select(
        *bucket,
        F.col("id").alias("member"),
        F.when(own, F.col("first_id")).otherwise(F.col("a")).alias("leader"),
        F.when(own, F.lit(1.0)).otherwise(F.col("similarity")).alias("similarity"),
    )


def _vectors(items, bucket, order, text, id_col, threshold):
    """Staged (items with content key, copies per key, unit vectors with join prefix).

    Texts move twice, first to those of their bucket, then to the counts of their grams. Grams move as sorted hashes
    in arrays, once per block of texts that has them; only their counts come back.
    """
    words, made = common_words(text)
    given = items.select(
        *bucket, F.struct(*order, F.col(id_col).alias("id")).alias("ord"), F.col(id_col).alias("id"), words.alias("key"), made.alias("made")
    )
    keyed = stage(_keyed(given).withColumn("key", F.coalesce("key", F.concat(F.lit("item "), "id"))), "keyed")
    copies = stage(
        keyed.groupBy(*bucket, "key").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("copies")), "copies"
    )
    sizes = stage(
        copies.groupBy(*bucket).agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("texts")).where("texts > 1"),
        "sizes",
    )
    firsts = stage(
        lookup_join(copies, sizes.drop("texts"), bucket, F.col("key")).select(
            *bucket, "n", "copies", F.col("first").alias("ord"), F.col("first.id").alias("id")
        ),
        "firsts",
    )
    again = stage(keyed.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("id"), "repeated-ids")
    return keyed, copies, stage(_weighed(_worded(firsts, again, items, bucket, text, id_col), bucket, threshold), "vectors")


def _keyed(given: DataFrame) -> DataFrame:
    """``given`` with a digest of the words in place of its ``key``, null where there is none of two characters."""
    schema = T.StructType([field for field in given.schema if field.name != "made"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text, made in zip(text_bytes(batch.column("key")), batch.column("made").to_pylist()):
                words = (text if made else words_apart(text)).split()
                some = any(len(word.decode()) > 1 for word in words)
                keys.append(blake2b(b" ".join(words), digest_size=16).hexdigest() if some else None)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()) if c == "key" else batch.column(c) for c in schema.names], schema.names)

    return in_batches(given, work, schema)


def _worded(firsts: DataFrame, again: DataFrame, items: DataFrame, bucket: list[str], text: Column, id_col: str) -> DataFrame:
    """Staged: ``firsts`` with the packed words of their texts, folded and one blank apart, in blocks of TEXTS_IN_BLOCK,
    and ``at``, a number that ascends in their order. The rows of an id of ``again`` are one text, a line for each."""
    texts = items.select(F.col(id_col).alias("id"), text.alias("text"))
    met = lookup_join(texts, firsts, ["id"], F.col("id"))
    if again.isEmpty():
        dealt = met.select(*firsts.columns, "text", F.lit(False).alias("lines"))
    else:
        marked = lookup_join(met, again.withColumn("again", F.lit(True)), ["id"], F.col("id"), "left")
        lines = F.array_join(F.collect_list(spaced_words(F.col("text"))), "\n").alias("text")
        one = marked.where("again").groupBy(*bucket, "n", "copies", "id").agg(F.min("ord").alias("ord"), lines)
        dealt = marked.where("again IS NULL").select(*firsts.columns, "text", F.lit(False).alias("lines"))
        dealt = dealt.unionByName(one.withColumn("lines", F.lit(True)))
    # Texts of a bucket side by side: a block then meets most of its grams more than once.
    dealt = dealt.repartitionByRange(*bucket, "ord").sortWithinPartitions(*bucket, "ord")
    words, made = common_words(F.col("text"))
    dealt = dealt.select(
        *firsts.columns,
        F.xxhash64(*bucket).alias("seed"),
        F.when(F.col("lines"), F.col("text")).otherwise(words).alias("words"),
        (F.col("lines") | made).alias("made"),
        F.monotonically_increasing_id().alias("at"),
    ).withColumn("block", F.shiftright("at", TEXTS_IN_BLOCK.bit_length() - 1))
    schema = T.StructType([T.StructField("words", T.BinaryType()) if f.name == "words" else f for f in dealt.schema if f.name != "made"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = (
                text if made else words_apart(text)
                for text, made in zip(text_bytes(batch.column("words")), batch.column("made").to_pylist())
            )
            packs = pa.array([pa.compress(words, "zstd", asbytes=True) for words in folded], pa.binary())
            yield pa.RecordBatch.from_arrays([packs if c == "words" else batch.column(c) for c in schema.names], schema.names)

    return stage(in_batches(dealt, work, schema), "worded")


def _plain(packed: bytes) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(packed), "zstd").read()


def _codes(texts: list[bytes], seeds: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the 64-bit hashes of its different grams in its bucket, sorted, and how often each occurs."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BYTES_AT_ONCE):
            size += len(texts[end])
            end += 1
        yield from _codes_at_once(texts[at:end], seeds[at:end])
        at = end


def _codes_at_once(texts: list[bytes], seeds: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    hashes, starts = hash_words(b"\n".join(texts))
    raw = np.frombuffer(b"\n".join(texts) + b"    ", np.uint8)
    # A word has two characters at least; one may be several bytes.
    after = raw[starts + _SIGN_BYTES[raw[starts]]]
    long = (after != 32) & (after != 10)
    hashes, starts = hashes[long], starts[long]
    upto = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts]))
    # Words of different lines are no neighbours.
    paired = np.ones(len(starts), bool)
    last = np.searchsorted(starts, np.append(np.flatnonzero(raw == 10), len(raw))) - 1
    paired[last[last >= 0]] = False
    first = np.flatnonzero(paired)
    with np.errstate(over="ignore"):
        own = np.repeat(np.array(seeds, np.int64).astype(np.uint64), np.diff(upto, prepend=0))
        words = signed(mix(hashes + own, 1))
        pairs = signed(mix(hashes[first] * _FACTOR + hashes[first + 1] + own[first], 2))
    codes, cuts = np.empty(len(words) + len(pairs), np.int64), [0]
    i = j = 0
    for k, m in zip(upto.tolist(), np.searchsorted(first, upto).tolist()):
        of_text = codes[cuts[-1] : cuts[-1] + k - i + m - j]
        of_text[: k - i], of_text[k - i :] = words[i:k], pairs[j:m]
        of_text.sort()
        cuts.append(cuts[-1] + len(of_text))
        i, j = k, m
    new = np.ones(len(codes) + 1, bool)
    new[1:-1] = codes[1:] != codes[:-1]
    new[cuts] = True
    places = np.flatnonzero(new)
    codes, counts = codes[places[:-1]], np.diff(places)
    cuts = np.searchsorted(places, cuts).tolist()
    return [(codes[i:j], counts[i:j]) for i, j in zip(cuts, cuts[1:])]


def _packed(values: np.ndarray) -> bytes:
    """Numbers, the bytes of equal rank side by side: small or sorted ones so take little."""
    return pa.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), "zstd", asbytes=True) if len(values) else b""


def _unpacked(raw: bytes, n: int, kind: type) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    held = np.frombuffer(pa.decompress(raw, size * n, "zstd"), np.uint8)
    return np.ascontiguousarray(held.reshape(size, n).T).view(kind)[:, 0]


def _met_codes(worded: DataFrame, ranges: int) -> DataFrame:
    """(block, range, n, df, texts): the n packed counts of all codes of a block, in their order, over all texts wherever
    these are; 0 for a code that one text alone has."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int]] = []
        here = None

        def block() -> Iterator[pa.RecordBatch]:
            texts, seeds, copies = ([x[k] for x in held] for k in range(3))
            made = [codes for codes, _ in _codes([_plain(words) for words in texts], seeds)]
            codes, copies = np.concatenate(made), np.repeat(copies, [len(c) for c in made])
            by = np.argsort(codes)
            codes = codes[by]
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
            if not len(starts):
                return
            texts = np.diff(np.concatenate([starts, [len(codes)]]))
            df, codes = np.add.reduceat(copies[by], starts), codes[starts]
            place = _range_of(codes, ranges)
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            ends = [*first[1:], len(codes)]
            held_in = (codes, df.astype(np.int32), texts.astype(np.int32))
            packs = [pa.array([_packed(c[i:j]) for i, j in zip(first, ends)], pa.binary()) for c in held_in]
            columns = [pa.array(place[first], pa.int32()), pa.array(np.full(len(first), here, np.int64)), pa.array(np.array(ends) - first), *packs]
            yield pa.RecordBatch.from_arrays(columns, ["range", "block", "n", "codes", "df", "texts"])

        for batch in batches:
            for words, seed, copies, at in zip(*(c.to_pylist() for c in batch.columns)):
                if at != here and held:
                    yield from block()
                    held.clear()
                here = at
                held.append((words, seed, copies))
        if held:
            yield from block()

    def count(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        kinds = (("codes", np.int64), ("df", np.int32), ("texts", np.int32))
        codes, df, texts = (np.concatenate([_unpacked(x.as_py(), n, k) for x, n in zip(table.column(c), sizes)]) for c, k in kinds)
        by = np.argsort(codes)
        first = np.concatenate([[True], codes[by[1:]] != codes[by[:-1]]])
        starts, group = np.flatnonzero(first), np.cumsum(first) - 1
        all_df, all_texts = (np.empty(len(codes), np.int64) for _ in range(2))
        all_df[by], all_texts[by] = np.add.reduceat(df[by], starts)[group], np.add.reduceat(texts[by], starts)[group]
        all_df[all_texts == 1] = all_texts[all_texts == 1] = 0
        at = np.concatenate([[0], np.cumsum(sizes)])
        packs = [pa.array([_packed(c[i:j]) for i, j in zip(at, at[1:])], pa.binary()) for c in (all_df.astype(np.int32), all_texts.astype(np.int32))]
        columns = [table.column(c) for c in ("block", "range", "n")]
        return pa.table([*columns, *packs], ["block", "range", "n", "df", "texts"])

    schema = "range int, block bigint, n bigint, codes binary, df binary, texts binary"
    partial = in_batches(worded.select("words", "seed", "copies", "block"), cut, schema)
    return partial.groupBy("range").applyInArrow(count, "block bigint, range int, n bigint, df binary, texts binary")


def _range_of(codes: np.ndarray, ranges: int) -> np.ndarray:
    """The equal share of all 64-bit numbers that a code lies in; ascending with the codes."""
    return ((codes >> 32) + (1 << 31)) * ranges >> 32


def _rounded_up(values: np.ndarray) -> np.ndarray:
    """In single precision, never less."""
    near = values.astype(np.float32)
    return np.where(near < values, np.nextafter(near, np.float32(np.inf)), near)


def _weighed(worded: DataFrame, bucket: list[str], threshold: float) -> DataFrame:
    """(bucket..., id, ord, seed, n, at, codes, weights, norm, prefix) of the texts that share enough with all others together:
    the vector over the shared grams as packed words and counts (see _vectors_of), its length over all grams, and the rarest
    codes that a match must touch, each with the squared length of the unit vector from there on."""
    least = threshold * threshold * (1 - _SLACK)
    names = [*bucket, "id", "ord", "seed", "n", "at"]
    schema = T.StructType([worded.schema[name] for name in names])
    schema = schema.add("codes", T.BinaryType()).add("weights", T.BinaryType()).add("norm", T.DoubleType())
    schema = schema.add("prefix", T.ArrayType(T.StructType().add("code", T.LongType()).add("left", T.FloatType())))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("range")
        sizes = right.column("n").to_pylist()
        df, texts = (
            np.concatenate([np.zeros(0, np.int64), *(_unpacked(x.as_py(), n, np.int32) for x, n in zip(right.column(c), sizes))])
            for c in ("df", "texts")
        )
        able, norms, packs, out = [], [], ([], []), ([], [])
        left = left.combine_chunks()
        seeds, ns, repeats = (left.column(c).to_pylist() for c in ("seed", "n", "copies"))
        packed = left.column("words").to_pylist()
        made = list(_codes([_plain(words) for words in packed], seeds))
        flat = np.concatenate([np.zeros(0, np.int64), *(codes for codes, _ in made)])
        by = np.argsort(flat)
        rank = flat[by]
        rank = np.cumsum(np.concatenate([[True], rank[1:] != rank[:-1]])[: len(rank)]) - 1
        # The counts are those of these codes, one for each.
        if len(df) != (rank[-1] + 1 if len(rank) else 0):
            raise RuntimeError(f"{len(df)} counts for {rank[-1] + 1 if len(rank) else 0} grams")
        place = np.empty(len(by), np.int32)
        place[by] = rank
        del flat, by, rank
        end = 0
        for i, ((codes, tf), n, copies) in enumerate(zip(made, ns, repeats)):
            at = place[end : end + len(codes)]
            end += len(codes)
            own = df[at]
            shared = own > 0
            at = at[shared]
            weight = tf[shared] * (np.log((1 + n) / (1 + own[shared])) + 1)
            # A gram of this text alone adds length, never a match.
            alone = np.log((1 + n) / (1 + copies)) + 1
            single = tf[~shared]
            shared2 = (weight * weight).sum()
            norm2 = shared2 + alone * alone * (single * single).sum()
            if not len(at) or shared2 < least * norm2:
                continue
            code, unit = codes[shared], weight / np.sqrt(norm2)
            # Keep the rarest grams while what is left, the current one included, could still reach the threshold.
            order = np.argsort(texts[at], kind="stable")  # the codes ascend
            rest = np.cumsum((unit[order] * unit[order])[::-1])[::-1]
            kept = np.count_nonzero(rest >= least)
            if kept:
                able.append(i)
                norms.append(np.sqrt(norm2))
                packs[0].append(packed[i])
                packs[1].append(_packed(own.astype(np.int32)))
                for column, value in zip(out, (code[order[:kept]], _rounded_up(rest[:kept]))):
                    column.append(value)
        ends = pa.array(np.cumsum([0, *map(len, out[0])]), pa.int32())
        flat = [pa.array(np.concatenate([np.zeros(0, kind), *column])) for kind, column in zip((np.int64, np.float32), out)]
        prefix = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, ["code", "left"]))
        rows = left.select(names).take(pa.array(able, pa.int64()))
        columns = [*rows.columns, *(pa.array(x, pa.binary()) for x in packs), pa.array(norms, pa.float64()), prefix]
        return pa.table(columns, [*names, "codes", "weights", "norm", "prefix"])

    blocks = -(-worded.count() // TEXTS_IN_BLOCK)
    met = _met_codes(worded, max(LEAST_RANGES, -(-blocks // 2)))
    if blocks > 8:
        # About a block a task, whatever AQE would merge, as their loads differ.
        worded, met = (x.repartition(2 * blocks, "block") for x in (worded, met))
    return worded.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(work, schema)


def _vectors_of(packed: list[bytes], counts: list[bytes], seeds: list[int], ns: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The shared codes of texts and their weights, from their words and the df of all their codes in their order (0: in no
    other text). Both together take a fraction of the hashes."""
    for (codes, tf), raw, n in zip(_codes([_plain(words) for words in packed], seeds), counts, ns):
        df = _unpacked(raw, len(codes), np.int32).astype(np.int64)
        shared = df > 0
        yield codes[shared], tf[shared] * (np.log((1 + n) / (1 + df[shared])) + 1)


def _postings(vectors: DataFrame, end: str) -> DataFrame:
    return vectors.select(F.col("at").alias(f"{end}_at"), F.explode("prefix").alias("gram")).select(
        f"{end}_at", "gram.code", F.col("gram.left").alias(f"{end}_left")
    )


def candidate_pairs(heads: DataFrame, rest: DataFrame, bucket: list[str], threshold: float, long: bool = True) -> DataFrame:
    """Staged (bucket..., a, a_ord, b, b_ord): every ``a`` of heads before ``b`` of rest that may be similar.
    Not ``long``: no gram is in too many prefixes for one task."""
    # Numbers meet, as there are far more postings than pairs. A hash tells the buckets of a gram apart.
    # Both sides have the same columns, so a table that meets itself is shuffled once.
    earlier, later = _postings(heads, "a"), _postings(rest, "b")
    # The rarest gram that two texts share starts all of their product.
    bound = F.col("a_left").cast("double") * F.col("b_left").cast("double") >= threshold * threshold * (1 - _SLACK)
    hot = hot_keys(_gram_counts(rest, []), ["code"], "rows") if long else None
    met = stage(
        salted_join(later, earlier, ["code"], hot, F.col("b_at")).where((F.col("a_at") < F.col("b_at")) & bound).select("a_at", "b_at").distinct(),
        "met",
    )
    ends = []
    for sides, table in ((("a", "b"), heads),) if heads is rest else ((("a",), heads), (("b",), rest)):
        ats = reduce(DataFrame.union, (met.select(F.col(f"{end}_at").alias("at")) for end in sides)).distinct()
        ends += [stage(table.join(ats, "at", "left_semi").select("at", *bucket, "id", "ord"), "ends")]
    ends = [
        x.select(F.col("at").alias(f"{end}_at"), *(F.col(c).alias(f"{end}_{c}") for c in bucket), F.col("id").alias(end), F.col("ord").alias(f"{end}_ord"))
        for end, x in (("a", ends[0]), ("b", ends[-1]))
    ]
    pairs = lookup_join(lookup_join(met, ends[0], ["a_at"], F.col("b_at")), ends[1], ["b_at"], F.col("a_at"))
    same = reduce(and_, (F.col(f"a_{c}") == F.col(f"b_{c}") for c in bucket), F.lit(True))
    return stage(pairs.where(same).select(*(F.col(f"a_{c}").alias(c) for c in bucket), "a", "a_ord", "b", "b_ord"), "candidates")


def similar_pairs(heads: DataFrame, rest: DataFrame, bucket: list[str], threshold: float, long: bool = True) -> DataFrame:
    """(bucket..., a, a_ord, b, b_ord, similarity): ``a`` of heads before ``b`` of rest, verified by the vectors rest holds."""
    candidates = candidate_pairs(heads, rest, bucket, threshold, long)
    return _similarities(candidates, rest, bucket).where(F.col("similarity") >= threshold)


def _similar(candidates: DataFrame, vectors: DataFrame, bucket: list[str], threshold: float, label: str) -> DataFrame:
    """Staged: the pairs that are similar, with their ``similarity``."""
    return stage(_similarities(candidates, vectors, bucket).where(F.col("similarity") >= threshold), label)


def _settled(candidates: DataFrame, vectors: DataFrame, bucket: list[str], threshold: float, effort: Effort) -> tuple[DataFrame, DataFrame]:
    """(pairs of items with leaders they are similar to, (id) of all that follow), by the greedy rule on staged candidates.

    The first leader of every follower is among its pairs. An item that is the later end of no open pair leads.
    """
    joined, led, before = [], [], None
    while (left := candidates.count()) > effort.pairs_at_once and (before is None or 2 * left <= before):
        before = left
        waiting = stage(candidates.select(F.col("b").alias("a")).distinct(), "waiting")
        with_leaders = stage(lookup_join(candidates, waiting, ["a"], F.col("b"), "left_anti"), "with-leaders")
        hits = _similar(with_leaders, vectors, bucket, threshold, "with-leaders-hits")
        joined.append(hits)
        first = stage(hits.groupBy("b").agg(F.min("a_ord").alias("first")), "first-leaders")
        led.append(first.select(F.col("b").alias("id")))
        # What follows is no leader, and only what comes before its leader may still take it.
        rest = lookup_join(candidates, waiting, ["a"], F.col("b"), "left_semi")
        rest = lookup_join(rest, stage(first.select(F.col("b").alias("a")), "following"), ["a"], F.col("b"), "left_anti")
        rest = lookup_join(rest, first, ["b"], F.col("a"), "left").where(F.col("first").isNull() | (F.col("a_ord") < F.col("first")))
        candidates = stage(rest.select(*candidates.columns), "open-pairs")
    pairs = _similar(candidates, vectors, bucket, threshold, "pairs")
    followers = _followers(pairs, bucket, effort)
    joined.append(pairs.join(followers.select(F.col("b").alias("a")), "a", "left_anti").select(*pairs.columns))
    led.append(followers.select(F.col("b").alias("id")))
    return reduce(DataFrame.unionByName, joined), reduce(DataFrame.union, led)


def _similarities(candidates: DataFrame, vectors: DataFrame, bucket: list[str]) -> DataFrame:
    """Adds the similarity to staged pairs (bucket..., a, a_ord, b, b_ord).

    The pairs of an item ``b`` stay together, beside those of all items with the same first ``a``. A group of items that
    are candidates of each other so moves each vector once. Larger groups are cut into parts.
    """
    names = [*bucket, "a", "a_ord", "b", "b_ord"]
    few = candidates.count() <= PAIRS_TOGETHER
    dealt = candidates.withColumn("group", F.lit(0).cast("long")) if few else _dealt(candidates, bucket)
    dealt = dealt.select("group", *names)
    ends = [dealt.select("group", *bucket, F.col(end).alias("id")) for end in ("a", "b")]
    needed = stage(ends[0].unionByName(ends[1]).distinct(), "needed")
    held = vectors.select(*bucket, "id", "seed", "n", "codes", "weights", "norm")
    # Only vectors of pairs move.
    held = held.join(F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed, [*bucket, "id"])
    rows = held.withColumn("pair", F.lit(False)).unionByName(dealt.withColumn("pair", F.lit(True)), allowMissingColumns=True)
    # Loads differ by the lengths of texts, so AQE is not left to merge groups by their sizes.
    tasks = 1 if few else -(-2 * candidates.count() // PAIRS_TOGETHER)
    rows = rows.repartition(tasks, "group").sortWithinPartitions("group", "pair")
    rows = rows.select("group", "pair", "id", "seed", "n", "codes", "weights", "norm", *names)
    schema = T.StructType([candidates.schema[name] for name in names]).add("similarity", T.DoubleType())

    def lists(found: list[tuple]) -> list[pa.ListArray]:
        ends = pa.array(np.cumsum([0, *(len(codes) for codes, _, _ in found)]), pa.int32())
        return [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[k] for x in found]))) for k in (0, 1)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, known = None, {}
        for batch in batches:
            group, pair = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            buckets = list(zip(*(batch.column(k).to_pylist() for k in range(8, 8 + len(bucket)))))
            ids, earlier, later = (batch.column(k).to_pylist() for k in (2, 8 + len(bucket), 10 + len(bucket)))
            cuts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (pair[1:] != pair[:-1])]))
            for start, end in zip(cuts, [*cuts[1:], len(group)]):
                if group[start] != here:
                    here, known = group[start], {}
                if not pair[start]:
                    seeds, ns, packed, counts, norms = (batch.column(k).slice(start, end - start).to_pylist() for k in range(3, 8))
                    for i, vector, norm in zip(range(start, end), _vectors_of(packed, counts, seeds, ns), norms):
                        known[buckets[i], ids[i]] = (*vector, norm)
                    continue
                for i in range(start, end, PAIRS_AT_ONCE):
                    at = range(i, min(i + PAIRS_AT_ONCE, end))
                    found = [[known[buckets[j], x[j]] for j in at] for x in (earlier, later)]
                    norms = [np.array([norm for _, _, norm in x]) for x in found]
                    products = _products(*lists(found[0]), *lists(found[1])) / norms[0] / norms[1]
                    columns = [c.slice(i, len(at)) for c in batch.columns[8:]]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(products, pa.float64())], [*names, "similarity"])

    return rows.mapInArrow(work, schema)


def _dealt(candidates: DataFrame, bucket: list[str]) -> DataFrame:
    """Staged: the pairs with the number of the group they are verified in."""
    of_b = candidates.groupBy(*bucket, "b").agg(F.min("a_ord")["id"].alias("home"), F.count(F.lit(1)).alias("pairs"))
    homes = stage(of_b, "homes")
    loads = homes.groupBy(*bucket, "home").agg(F.sum("pairs").alias("load")).where(F.col("load") > PAIRS_TOGETHER)
    parts = stage(loads.select(*bucket, "home", F.ceil(F.col("load") / PAIRS_TOGETHER).alias("parts")), "parts")
    groups = -(-candidates.count() // PAIRS_TOGETHER)
    part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1)))
    # A few neighbouring groups share a number; they are only told apart by it.
    placed = lookup_join(homes, parts, [*bucket, "home"], F.col("b"), "left")
    placed = stage(placed.select(*bucket, "b", F.pmod(F.xxhash64(*bucket, "home", part), F.lit(groups)).alias("group")), "homes-placed")
    return stage(lookup_join(candidates, placed, [*bucket, "b"], F.col("a")), "dealt")


def _products(a_codes: pa.ListArray, a_weights: pa.ListArray, b_codes: pa.ListArray, b_weights: pa.ListArray) -> np.ndarray:
    """Of each row, the product of two sparse vectors sorted by code: the shorter is looked up in the longer."""
    codes = [x.flatten().to_numpy() for x in (a_codes, b_codes)]
    weights = [x.flatten().to_numpy() for x in (a_weights, b_weights)]
    cuts = [np.cumsum([0, *x.value_lengths().to_pylist()]).tolist() for x in (a_codes, b_codes)]
    out = np.zeros(len(a_codes))
    for row, (i, j, k, m) in enumerate(zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])):
        short, long = (codes[0][i:j], weights[0][i:j]), (codes[1][k:m], weights[1][k:m])
        if len(short[0]) > len(long[0]):
            short, long = long, short
        if len(short[0]):
            at = np.minimum(np.searchsorted(long[0], short[0]), len(long[0]) - 1)
            same = long[0][at] == short[0]
            out[row] = (short[1][same] * long[1][at[same]]).sum()
    return out


def _gram_counts(vectors: DataFrame, bucket: list[str]) -> DataFrame:
    return (
        vectors.select(*bucket, F.explode("prefix.code").alias("code"))
        .groupBy(*bucket, "code")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _greedy(vectors: DataFrame, bucket: list[str], threshold: float, effort: Effort) -> DataFrame:
    """(id, leader_id) of every item that joins an earlier leader."""
    # Rounds copy prefixes only.
    joined, undecided = [], vectors.select(*bucket, "id", "ord", "seed", "at", "prefix")
    while True:
        head, rest, long = _take_head(undecided, bucket, effort)
        pairs, led = _settled(candidate_pairs(head, head, bucket, threshold, long), vectors, bucket, threshold, effort)
        joined.append(pairs)
        if rest is None:
            break
        leaders = lookup_join(head, stage(led.distinct(), "led-ids"), ["id"], F.col("id"), "left_anti")
        hits = _similar(candidate_pairs(leaders, rest, bucket, threshold, long), vectors, bucket, threshold, "hits")
        joined.append(hits)
        decided = stage(hits.select(F.col("b").alias("id")).distinct(), "decided")
        undecided = stage(lookup_join(rest, decided, ["id"], F.col("id"), "left_anti"), "undecided")
    return (
        reduce(DataFrame.unionByName, joined)
        .groupBy(F.col("b").alias("id"))
        .agg(F.min(F.struct("a_ord", "similarity")).alias("first"))
        .select("id", F.col("first.a_ord.id").alias("leader_id"), "first.similarity")
    )


def _take_head(undecided: DataFrame, bucket: list[str], effort: Effort) -> tuple[DataFrame, DataFrame | None, bool]:
    """Split off what can be settled now: whole buckets, or the head of an overfull one.

    ``rest`` is None when every bucket fits. The last value tells whether any gram is in too many prefixes for one task.
    """
    pairs = F.col("rows") * (F.col("rows") - 1) / 2
    items = undecided.groupBy(*bucket, "seed").agg(F.count(F.lit(1)).alias("items"))
    budget = F.greatest(F.lit(effort.pairs_per_bucket), F.col("items") * effort.pairs_per_item)
    loads = _gram_counts(undecided, ["seed"]).groupBy("seed").agg(F.sum(pairs).alias("pairs"), F.max("rows").alias("most"))
    large = (F.col("pairs") > F.col("budget")) | (F.col("most") > skew.HOT_ROWS)
    overfull = stage(loads.join(items, "seed").select(*bucket, "pairs", "most", budget.alias("budget")).where(large), "overfull")
    long = not overfull.where(F.col("most") > skew.HOT_ROWS).isEmpty()
    overfull = overfull.where(F.col("pairs") > F.col("budget")).select(*bucket, "budget")
    if overfull.isEmpty():
        return undecided, None, long

    full = lookup_join(undecided.select(*bucket, "at"), overfull, bucket, F.col("at"))
    ranked = number_rows(full, bucket, ["at"], "rank")
    # Slices double in size, so a bucket has a few dozen at most, each known by its last item.
    octave = F.greatest(F.ceil(F.log2(F.col("rank") / effort.head)), F.lit(0)).cast("int")
    ends = ranked.groupBy(*bucket, "budget", octave.alias("slice")).agg(F.max("at").alias("last"))
    sliced = stage(ends.groupBy(*bucket, "budget").agg(F.sort_array(F.collect_list("last")).alias("ends")), "sliced")
    place = F.size(F.filter("ends", lambda last: last < F.col("at")))
    within = Window.partitionBy("code").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("seed").orderBy("slice")
    # All that is counted by gram is so in one shuffle. Its hash tells buckets apart.
    placed = lookup_join(undecided, sliced.drop("budget"), bucket, F.col("id")).select("seed", place.alias("slice"), "prefix.code")
    loads = (
        placed.select("seed", "slice", F.explode("code").alias("code"))
        .repartition("code")
        .groupBy("code", "seed", "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("pairs", pairs + F.col("rows") * F.coalesce(F.sum("rows").over(within), F.lit(0)))
        .groupBy("seed", "slice")
        .agg(F.sum("pairs").alias("pairs"))
        .withColumn("total", F.sum("pairs").over(upto))
    )
    sliced = sliced.withColumn("seed", F.xxhash64(*bucket))
    cuts = loads.join(F.broadcast(sliced) if sliced.count() <= BROADCAST_ROWS else sliced, "seed")
    cuts = cuts.where((F.col("slice") == 0) | (F.col("total") <= F.col("budget"))).groupBy(*bucket, "ends").agg(F.max("slice").alias("cut"))
    cuts = stage(cuts.select(*bucket, F.expr("ends[cut]").alias("cut")), "split")
    marked = lookup_join(undecided, cuts, bucket, F.col("id"), "left")
    marked = marked.withColumn("later", F.coalesce(F.col("at") > F.col("cut"), F.lit(False)))
    columns = undecided.columns
    rest = marked.where("later").select(*columns)
    return marked.where(~F.col("later")).select(*columns), None if rest.isEmpty() else rest, long


def _followers(pairs: DataFrame, bucket: list[str], effort: Effort) -> DataFrame:
    """(b): the later ends that follow some leader, by the greedy rule on the similar pairs."""
    found, undecided = [], pairs.select(*bucket, "a", "b", "b_ord")
    while True:
        sizes = undecided.groupBy(*bucket).agg(F.count(F.lit(1)).alias("pairs"))
        if sizes.where(F.col("pairs") > effort.pairs_in_one_fold).isEmpty():
            found.append(_fold(undecided, bucket))
            return stage(reduce(DataFrame.union, found), "followers")
        sized = lookup_join(undecided, stage(sizes, "pair-counts"), bucket, F.col("b"))
        found.append(_fold(sized.where(F.col("pairs") <= effort.pairs_in_one_fold), bucket))
        large = sized.where(F.col("pairs") > effort.pairs_in_one_fold).drop("pairs")
        # An item that no earlier undecided item is similar to leads, and its neighbours follow.
        waiting = large.select(F.col("b").alias("a")).distinct()
        follow = large.join(waiting, "a", "left_anti").select("b")
        # The first pairs of a bucket only depend on each other.
        ranked = number_rows(large.select(*bucket, "b_ord", "a", "b"), bucket, ["b_ord", "a"], "rank")
        first = ranked.groupBy("b").agg(F.max("rank").alias("last")).where(F.col("last") <= effort.pairs_in_one_fold)
        follow = follow.union(_fold(large.join(first, "b", "left_semi"), bucket))
        follow = stage(follow.distinct(), "follow")
        found.append(follow)
        undecided = stage(
            large.join(follow, "b", "left_anti").join(follow.select(F.col("b").alias("a")), "a", "left_anti"), "open"
        )


def _fold(pairs: DataFrame, bucket: list[str]) -> DataFrame:
    """(b): the followers among pairs that hold all that is undecided of their buckets before each ``b``.

    Pairs stream by in the order of ``b``. Every earlier end is decided by then: it leads unless it is among the
    followers of its bucket, which are all that is remembered.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, followers = None, set()
        for batch in batches:
            *groups, a, b = (column.to_pylist() for column in batch.columns)
            out = []
            for group, earlier, later in zip(zip(*groups), a, b):
                if group != here:
                    here, followers = group, set()
                if earlier not in followers and later not in followers:
                    followers.add(later)
                    out.append(later)
            yield pa.RecordBatch.from_arrays([pa.array(out, batch.column(len(groups) + 1).type)], ["b"])

    ordered = pairs.repartition(*bucket).sortWithinPartitions(*bucket, "b_ord").select(*bucket, "a", "b")
    return ordered.mapInArrow(work, T.StructType([pairs.schema["b"]]))
