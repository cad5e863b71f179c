"""Phrase collocation mining over Rabin-Karp fingerprints.

A text is lower-cased (A to Z), split into pieces at ``.,;:!?`` and line ends and those into words at blanks and
tabs. Prefix polynomials over the words of a block give the fingerprint of every n-gram at once. Everything is
counted per language (null: ``und``).

1. Words, then pairs of frequent words, then triples of frequent pairs, then all longer n-grams of frequent triples are
   counted, each length once; a bitmap of fixed size says which of the last length are frequent.
2. N-grams are counted by block and told apart by the words themselves there. Each adds (fingerprint, check, uses, a
   document that holds it); a task adds up the uses of its blocks (of pairs, most of which are rare, the shuffle alone
   does), the shuffle those of all tasks.
3. Of fingerprints with enough uses the document is looked up. The phrase is what its text holds under that fingerprint
   and check. So only frequent phrases ever become text.

Bitmaps only let too much through, never too little. Phrases of different blocks are told apart by 64 bits
of fingerprint and 24 of an independent check.

Scores are exact: products are decimals of 38 digits, enough for corpora of up to 10^15 words. Null and
empty texts have no words. Rows equal in all of id, text and language count each. Null ids are ids
like any other. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietwire.llm.common import LOWER, hash_words, in_batches, mix, prepare, signed, text_bytes
from quietwire.operators.skew import lookup_join
from quietwire.session import stage

LONGEST = 5
LEAST_USES = 100
REPORTED = 2000
# Words that a task counts at a time.
BLOCK = 1_000_000
# Different n-grams whose uses a task adds up before it hands them on.
HELD = 2_000_000
# Places of the bitmap of frequent fingerprints; 2^26 are 8 MB for every worker, whatever the input.
BITS = 26

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_SPACED = bytes(32 if i in _BREAKS or i == 9 else i for i in range(256))
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(_BREAKS)] = True
_FACTOR = 0x9FB21C651E98DF25
_CHECK_FACTOR = 0xD1342543DE82EF95


def _powers(factor: int, n: int) -> np.ndarray:
    steps = np.full(max(n, 1), factor, np.uint64)
    steps[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(steps)


class Block:
    """The words of many texts, one after the other, with all that their n-grams need."""

    def __init__(self, texts: list[bytes], langs: list[str], mask: int) -> None:
        joined = b"\n".join(texts).translate(LOWER)
        spaced = joined.translate(_SPACED)
        raw = np.frombuffer(spaced, np.uint8)
        solid = raw != 32
        edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
        starts = edge[::2]
        # Exact numbers of the different words, and a hash of each.
        offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(edge[1::2] - starts)]).astype(np.int64))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(raw[solid])]).dictionary_encode()
        del solid, edge, offsets
        self.words = words.indices.to_numpy()
        self._dictionary = words.dictionary
        hashes, _ = hash_words(b" ".join(words.dictionary.to_pylist()))
        # A break between two words lies in front of the second.
        breaks = np.flatnonzero(_IS_BREAK[np.frombuffer(joined, np.uint8)])
        self.piece = np.searchsorted(breaks, starts).astype(np.int32)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])).astype(np.int32)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
        names, lang = np.unique(np.array(langs, object), return_inverse=True)
        self.lang = lang.astype(np.int32)[self.doc]
        self.first = first
        self.mask = np.uint64(mask)
        seeds = np.array([int.from_bytes(_digest(x), "little") for x in names], np.uint64)
        self.seed = seeds[self.lang]
        self.names = names
        n = len(starts)
        self._back = _powers(pow(_FACTOR, -1, 1 << 64), n)
        self._sums = self._prefix(hashes, _FACTOR)
        self._hashes = hashes
        self._checks: np.ndarray | None = None

    def _prefix(self, hashes: np.ndarray, factor: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = np.cumsum(hashes[self.words] * _powers(factor, len(self.words)), dtype=np.uint64)
        return np.concatenate([np.zeros(1, np.uint64), sums])

    def tags(self, n: int, at: np.ndarray) -> np.ndarray:
        """24 bits of a second fingerprint, and n."""
        if self._checks is None:
            self._checks = self._prefix(mix(self._hashes, 7), _CHECK_FACTOR)
            self._checks_back = _powers(pow(_CHECK_FACTOR, -1, 1 << 64), len(self.words))
        with np.errstate(over="ignore"):
            gram = (self._checks[at + n] - self._checks[at]) * self._checks_back[at]
        return ((mix(gram + self.seed[at], 8) >> np.uint64(40)).astype(np.int64) << 3 | n).astype(np.int32)

    def phrase(self, n: int, at: int) -> str:
        return b" ".join(self._dictionary[i].as_py() for i in self.words[at : at + n]).decode()

    def within(self, n: int) -> np.ndarray:
        """Whether the n words from each on lie in one piece; as long as there are such places."""
        last = len(self.words) - n + 1
        return self.piece[:last] == self.piece[n - 1 :] if last > 0 else np.zeros(0, bool)

    def fingerprints(self, n: int) -> np.ndarray:
        last = max(len(self.words) - n + 1, 0)
        with np.errstate(over="ignore"):
            gram = (self._sums[n:] - self._sums[:-n])[:last] * self._back[:last]
            return mix(gram + self.seed[:last], n) & self.mask

    def groups(self, n: int, where: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first places, uses) of the different n-grams at ``where``, by language; compared word by word."""
        while len(where):
            by = where[np.argsort(prints[where], kind="stable")]
            new = np.ones(len(by), bool)
            new[1:] = prints[by[1:]] != prints[by[:-1]]
            group = np.cumsum(new) - 1
            first = by[new]
            same = self.lang[by] == self.lang[first[group]]
            for k in range(n):
                same &= self.words[by + k] == self.words[first[group] + k]
            yield first, np.bincount(group[same], minlength=len(first))
            where = np.sort(by[~same])


def _digest(name: str) -> bytes:
    from hashlib import blake2b

    return blake2b(name.encode(), digest_size=8).digest()


def _blocks(batches: Iterator[pa.RecordBatch], mask: int, size: int) -> Iterator[tuple[Block, list]]:
    """Blocks of about ``size`` words from batches (text, lang, others...), with the rows of the others."""
    texts, langs, others, held = [], [], [], 0
    for batch in batches:
        rest = zip(*(c.to_pylist() for c in batch.columns[2:])) if batch.num_columns > 2 else iter(())
        for text, lang in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
            texts.append(text)
            langs.append(lang)
            others.append(next(rest, None))
            held += len(text) // 6 + 1
            if held >= size:
                block, texts, langs, held = Block(texts, langs, mask), [], [], 0
                yield block, others
                block, others = None, []
    if texts:
        yield Block(texts, langs, mask), others


def _has(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    place = prints & np.uint64(len(bits) * 64 - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bitmap(frequent: DataFrame, bits: int) -> np.ndarray:
    """The places of all fingerprints of ``frequent``; the driver gets 2^bits / 64 numbers at most."""
    place = F.col("print").bitwiseAND(F.lit((1 << bits) - 1))
    packed = frequent.groupBy(F.shiftright(place, 6).cast("int").alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    table = packed.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def _added_up(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """One row for each (print, tag): all its uses, and the least document."""
    prints, tags, uses, docs = (np.concatenate(c) for c in zip(*held))
    if not len(prints):
        return [prints, tags, uses, docs]
    by = np.lexsort((tags, prints))
    prints, tags = prints[by], tags[by]
    starts = np.flatnonzero(np.concatenate([[True], (prints[1:] != prints[:-1]) | (tags[1:] != tags[:-1])]))
    return [prints[starts], tags[starts], np.add.reduceat(uses[by], starts), np.minimum.reduceat(docs[by], starts)]


def _counts(rows: DataFrame, lengths: range, parts: np.ndarray | None, mask: int, size: int) -> DataFrame:
    """(print, tag, uses, doc) by task, of n-grams of ``lengths`` whose parts of one word less than the shortest are all among
    the frequent ``parts``; of all words without these, with the words per language besides (lang; print null)."""
    names = ["print", "tag", "uses", "doc"] + ["lang"] * (parts is None)
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()][: len(names)]
    # Most pairs of frequent words are rare: their uses are added up by the shuffle alone.
    most = 0 if lengths[0] == 2 else HELD

    def batch(columns: list) -> pa.RecordBatch:
        columns += [[None] * len(columns[0])] * (len(names) - len(columns))
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for block, others in _blocks(batches, mask, size):
            doc = np.array([x for (x,) in others], np.int64)
            if parts is None:
                totals = np.bincount(block.lang, minlength=len(block.names))
                seen = np.flatnonzero(totals)
                none = [None] * len(seen)
                yield batch([none, none, totals[seen], none, block.names[seen].tolist()])
                fit = block.within(1)
            else:
                part = lengths[0] - 1
                fit = block.within(part) & _has(parts, block.fingerprints(part))
            for n in lengths:
                if n > 1:
                    fit = fit[:-1] & fit[1:] & block.within(n)
                prints = block.fingerprints(n)
                for first, uses in block.groups(n, np.flatnonzero(fit), prints):
                    held.append([signed(prints[first]), block.tags(n, first), uses, doc[block.doc[first]]])
            # One block at a time is held.
            del block
            if held and most:
                held = [_added_up(held)]
            if sum(len(x[0]) for x in held) > most:
                for found in held:
                    yield batch(found)
                held = []
        for found in held:
            yield batch(found)

    schema = "print bigint, tag int, uses bigint, doc bigint" + ", lang string" * (parts is None)
    return in_batches(rows.select("text", "lang", "doc"), work, schema)


def _added(counts: DataFrame, *by: str) -> DataFrame:
    return counts.groupBy(*by, "print", "tag").agg(F.sum("uses").alias("uses"), F.min("doc").alias("doc"))


def _grams(rows: DataFrame, frequent: list[DataFrame], longest: int, bits: int, mask: int, size: int) -> DataFrame:
    """(print, tag, uses, doc) of the ``frequent`` n-grams of 1, 2... words, counted before, and by task of the longer ones
    up to ``longest`` words that hold none but frequent ones of the last of these lengths."""
    lengths = range(len(frequent) + 1, longest + 1)
    longer = [_counts(rows, lengths, _bitmap(frequent[-1], bits), mask, size)] if lengths else []
    return reduce(DataFrame.unionByName, [*frequent, *longer])


def _looked_up(rows: DataFrame, frequent: DataFrame, mask: int) -> DataFrame:
    """(lang, phrase, n, uses) of every (print, tag, uses, doc), as the text of the document has it."""
    wanted = stage(frequent.groupBy("doc").agg(F.collect_list(F.struct("tag", "print", "uses")).alias("wanted")), "wanted")
    # A short list goes to the texts; a long one is shuffled with them.
    met = lookup_join(rows, wanted, ["doc"], F.hash("text")).select("text", "lang", "wanted")
    names = ["lang", "phrase", "n", "uses", "print", "tag"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, out = batch.column(1).to_pylist(), []
            block = Block(list(text_bytes(batch.column(0))), langs, mask)
            ends = np.concatenate([[0], batch.column(2).value_lengths().to_numpy().cumsum()])
            tags, prints, uses = (batch.column(2).flatten().field(k).to_numpy() for k in range(3))
            size = tags & 7
            for n in np.unique(size).tolist():
                here, within = signed(block.fingerprints(n)), block.within(n)
                for i in range(batch.num_rows):
                    cells = ends[i] + np.flatnonzero(size[ends[i] : ends[i + 1]] == n)
                    at = block.first[i] + np.flatnonzero(within[block.first[i] : block.first[i + 1]])
                    at = at[np.isin(here[at], prints[cells])]
                    if len(at):
                        places = dict(zip(zip(here[at].tolist(), block.tags(n, at).tolist()), at.tolist()))
                        for p, tag, u in zip(prints[cells].tolist(), tags[cells].tolist(), uses[cells].tolist()):
                            if (p, tag) in places:
                                out.append((langs[i], block.phrase(n, places[p, tag]), n, u, p, tag))
            types = [pa.string(), pa.string(), pa.int8(), pa.int64(), pa.int64(), pa.int32()]
            columns = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    found = in_batches(met, work, "lang string, phrase string, n tinyint, uses bigint, print bigint, tag int")
    # A row that the table repeats is looked up as often.
    return found.dropDuplicates(["print", "tag"]).drop("print", "tag")


def counted(docs: DataFrame, least: int = LEAST_USES, longest: int = LONGEST, bits: int = BITS, mask: int = (1 << 64) - 1, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, n, uses) of all n-grams with ``least`` uses, (lang, words)), both written."""
    prepare(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))
    rows = docs.select("text", lang.alias("lang"), doc.alias("doc"))
    often = F.col("uses") >= least
    words = _added(_counts(rows, range(1, 2), None, mask, block), "lang")
    words = stage(words.where(F.col("lang").isNotNull() | often), "words")
    # Every length is counted once; what is frequent of it keeps its uses and its document.
    known = [words.where("lang is null").drop("lang")]
    for n in range(2, min(longest, 3) + 1):
        counts = _counts(rows, range(n, n + 1), _bitmap(known[-1], bits), mask, block)
        known.append(stage(_added(counts).where(often), f"frequent-{n}"))
    frequent = _added(_grams(rows, known, longest, bits, mask, block)).where(often)
    phrases = stage(_looked_up(rows, stage(frequent, "frequent"), mask), "phrases")
    return phrases, words.where("lang is not null").select("lang", F.col("uses").alias("words"))


def _part(phrase: str, first: str, last: str) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), F.expr(first), F.expr(last)), " ")


def _whole(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = LEAST_USES, top: int = REPORTED, longest: int = LONGEST, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), the first ``top`` of each language."""
    phrases, totals = counted(docs, least, longest, **how)
    candidates = phrases.where("n > 1").select("lang", "phrase", "n", F.col("uses").alias("a"))
    uses = phrases.select("lang", "phrase", "uses")
    # A phrase goes if one with a word more is as frequent; any longer one that is contains such a one.
    inside = F.array(_part("phrase", "1", "n - 1"), _part("phrase", "2", "n - 1"))
    longer = candidates.where("n > 2").select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    cuts = left.select("lang", "phrase", "a", "n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("phrase", "1", "k").alias("head"), _part("phrase", "k + 1", "n - k").alias("tail"))
    cuts = cuts.join(uses.select("lang", F.col("phrase").alias("head"), F.col("uses").alias("l")), ["lang", "head"])
    cuts = cuts.join(uses.select("lang", F.col("phrase").alias("tail"), F.col("uses").alias("r")), ["lang", "tail"])
    # Few languages: one row each.
    cuts = cuts.join(totals.select("lang", F.col("words").alias("n")), "lang")
    cuts = cuts.withColumn("up", (F.lit(1000) * F.col("a")).cast("decimal(19,0)") * _whole("n")).withColumn("down", _whole("l") * _whole("r"))
    best = cuts.withColumn("score", F.expr("up div down")).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase"))
    ranked = best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
