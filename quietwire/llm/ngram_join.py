"""Exact n-gram Jaccard join with prefix filters under several global orders.

Two sets that are similar enough share a token among the first few of each under ANY order of all
tokens (the prefix). Order 0 puts tokens known to be common last, the most common at the very end, and
generates candidates: documents that share a prefix token, of fitting lengths, with enough
tokens left after it. Two further orders, by token hash upwards and downwards, filter the candidates before any set is
moved: a candidate must share a prefix token under each of them as well, and the tokens in which the two prefixes
differ must be few enough for a link. Every text's prefixes under them are written once, as a signature of two
bytes a token. What passes all orders is verified by counting the intersection. Candidates across components of large
groups (below) are closer and nearly all pass, so they meet their sets at once and the further orders in the same task.

* Equal sets are one node of the graph from the start, so copies cost nothing.
* A token shared by more than a few nodes gives a star (each with the first) and a chain (each with
  the next), not all pairs. After these are verified, only pairs of such a group that lie in
  different components are left to check. A few of its members first meet all others, then more of them, which joins
  most components; then every pair still across components is checked. Links inside a component that are not
  needed for it may stay unverified; no component loses one.
* Tasks make the stars and chains of their own rows first, so a token in a third of all documents
  sends a few rows per task.
* Sets are made again from the texts for the nodes of pairs that are left; only prefixes are shuffled for all.

Words are runs without ASCII white space, A-Z lower-cased. A set holds the different runs of
``n`` words, or the whole text where it is shorter. Texts without words, and null texts, have an
empty set and are linked with nothing; their component is their own id. Rows repeated or with equal
texts are one node. Null ids are left out of the least id of a component. An empty table gives no
rows. Tokens and nodes are 64-bit hashes. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import LOWER, hash_words, in_batches, mix, rejoin, salt, signed, text_bytes
from quietwire.llm.components import components
from quietwire.operators.skew import BROADCAST_ROWS, lookup_join
from quietwire.session import stage

N = 5
PERCENT = 80
# Tokens that the first order knows to be common, the most common ones: a fixed number, so a fixed broadcast.
COMMON = 1 << 21
# Tokens a task counts at a time.
COUNTED = 4_000_000
# A token shared by up to this many nodes gives all their pairs, else a star and a chain.
SMALL = 4
# Before all pairs across components of a group are checked, some of its members meet all others, LOOKS times:
# PIVOTS of them, then WIDER times as many each time, as those still apart have few links.
LOOKS = 3
PIVOTS = 8
WIDER = 4
# First tokens in the order that a node carries along, to tell where it meets another one first.
FIRSTS = 32
# Bits that tell which texts are needed again: a fixed broadcast. More texts than that only cut more of them into words.
NEEDED_BITS = 24
# Prefix rows a task sorts at a time.
BLOCK = 1_000_000

_FACTOR = np.uint64(0x9FB21C651E98DF25)


def _node(tokens: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    value = xxh3_64_intdigest(tokens.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


class Shingles:
    """Sorted 64-bit hashes of the different runs of ``n`` words of a text."""

    def __init__(self, n: int) -> None:
        self.n = n

    def of(self, text: bytes) -> np.ndarray:
        h, _ = hash_words(text.translate(LOWER))
        if not len(h):
            return h
        size = min(self.n, len(h))
        with np.errstate(over="ignore"):
            run = h[: len(h) - size + 1].copy()
            for k in range(1, size):
                run = run * _FACTOR + h[k : len(h) - size + 1 + k]
        return np.unique(mix(run, size))


def prefix_length(n: int, percent: int) -> int:
    """Sets with this similarity share one of so many first tokens under any order."""
    return n - (percent * n + 99) // 100 + 1


def _own_first(node: int, seen: set) -> bool:
    if node in seen:
        return False
    seen.add(node)
    return True


def signature(tokens: np.ndarray, percent: int) -> bytes:
    """The upper 16 bits of the prefixes of sorted tokens under the two hash orders, upwards and downwards."""
    p = prefix_length(len(tokens), percent)
    return (np.concatenate([tokens[:p], tokens[len(tokens) - p :]]) >> np.uint64(48)).astype(np.uint16).tobytes()


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """The most tokens that two lists of upper bits can have in common."""
    a, of_a = np.unique(a, return_counts=True)
    b, of_b = np.unique(b, return_counts=True)
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return int(np.minimum(of_a[at_a], of_b[at_b]).sum())


def may_link(n_a: int, a: np.ndarray, n_b: int, b: np.ndarray, percent: int) -> bool:
    """False only for sets that cannot be linked, by their sizes and signatures.

    Linked sets share a token of their prefixes under either order. Up to the lesser end of two prefixes both are
    complete, so the tokens that only one of them holds there belong to the difference of the sets, which is bounded.
    """
    p_a, p_b = prefix_length(n_a, percent), prefix_length(n_b, percent)
    low_a, low_b, high_a, high_b = a[:p_a], b[:p_b], a[p_a:], b[p_b:]
    if not (np.isin(low_a, low_b).any() and np.isin(high_a, high_b).any()):
        return False
    most = n_a + n_b - 2 * -(-percent * (n_a + n_b) // (100 + percent))
    # Tokens with the upper bits of the end itself may be cut off, so they do not count.
    top, bottom = min(low_a[-1], low_b[-1]), max(high_a[0], high_b[0])
    differ = []
    for x, y in ((low_a[low_a < top], low_b[low_b < top]), (high_a[high_a > bottom], high_b[high_b > bottom])):
        differ.append(len(x) + len(y) - 2 * _shared(x, y))
    return max(differ) <= most and (top > bottom or sum(differ) <= most)


def shingled(docs: DataFrame, n: int, percent: int = PERCENT) -> DataFrame:
    """Written once. kind 0: (doc_id, node, size, salt, hash of the text); kind 1: (token as node, uses as size) of
    tokens that a task met more than once; kind 2: (node, size, signature). Copies within a task count once."""
    names = ["kind", "doc_id", "node", "size", "salt", "text_hash", "signature"]

    def rows_of(kind: int, **given) -> pa.RecordBatch:
        rows = len(given["node"])
        types = dict(zip(names, (pa.int8(), *(pa.int64(),) * 5, pa.binary())))
        given["kind"] = np.full(rows, kind, np.int8)
        columns = [pa.array(given[c], types[c]) if c in given else pa.nulls(rows, types[c]) for c in names]
        return pa.RecordBatch.from_arrays(columns, names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen = Shingles(n), set()
        fresh: list[np.ndarray] = []
        held = 0

        def common() -> pa.RecordBatch:
            tokens, uses = np.unique(np.concatenate(fresh), return_counts=True)
            return rows_of(1, node=signed(tokens[uses > 1]), size=uses[uses > 1])

        for batch in batches:
            nodes, sizes, first = [], [], []
            for text in text_bytes(batch.column(1)):
                tokens = make.of(text)
                node = _node(tokens) if len(tokens) else None
                nodes.append(node)
                sizes.append(len(tokens))
                if node is not None and _own_first(node, seen):
                    fresh.append(tokens)
                    held += len(tokens)
                    first.append((node, len(tokens), signature(tokens, percent)))
            if held > COUNTED:
                yield common()
                fresh.clear()
                held = 0
            yield rows_of(0, doc_id=batch.column(0), node=nodes, size=sizes, salt=batch.column(2), text_hash=batch.column(3))
            if first:
                yield rows_of(2, **dict(zip(("node", "size", "signature"), zip(*first))))
        if fresh:
            yield common()

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", salt(F.col("text")).cast("bigint"), F.xxhash64("text"))
    schema = "kind tinyint, doc_id bigint, node bigint, size bigint, salt bigint, text_hash bigint, signature binary"
    return stage(in_batches(rows, work, schema), "shingled")


def _common(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most used tokens, at most COMMON of them, sorted, and how often each is known to be used.

    All that are used as often as a level are taken or none, so few numbers tell where to stop.
    """
    used = stage(rows.where("kind = 1").groupBy("node").agg(F.sum("size").alias("uses")), "token-uses")
    level = F.when(F.col("uses") < 64, F.col("uses")).otherwise(F.pow(2, F.floor(F.log2("uses"))).cast("long"))
    levels = used.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = 1 << 62, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        total += r["n"]
        if total > COMMON:
            break
        least = r["level"]
    found = used.where(level >= least).toArrow()
    tokens = found.column("node").to_numpy().astype(np.uint64)
    by = np.argsort(tokens)
    return tokens[by], found.column("uses").to_numpy()[by].astype(np.int32)


def _uses(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    if not len(common[0]):
        return np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(common[0], tokens), len(common[0]) - 1)
    return np.where(common[0][at] == tokens, common[1][at], 0)


class _Pairs:
    """Candidates among rows (token, size, place, node) sorted by token, size and node."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def fits(self, n_a, n_b, at_a, at_b) -> np.ndarray:
        """Lengths are close enough, and enough tokens are left from the shared one on."""
        left = np.minimum(n_a - at_a, n_b - at_b)
        return (100 * n_a >= self.percent * n_b) & (left * (100 + self.percent) >= self.percent * (n_a + n_b))

    def of(self, token, size, place, node, large) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a, b) positions of candidates, and which rows are in groups too large for all pairs: by what
        is here, or because a row is marked as one of a ``large`` group elsewhere."""
        empty = np.zeros(0, np.int64)
        if not len(token):
            return empty, empty, np.zeros(0, bool)
        first = np.concatenate([[True], token[1:] != token[:-1]])
        group = np.cumsum(first) - 1
        starts = np.flatnonzero(first)
        count = np.diff(np.concatenate([starts, [len(token)]]))[group]
        big = (count > SMALL) | np.logical_or.reduceat(large, starts)[group]
        a, b = [], []
        for off in range(1, SMALL):
            left = np.flatnonzero((group[:-off] == group[off:]) & (~big[off:] | (off == 1))) if len(token) > off else empty
            a.append(left)
            b.append(left + off)
        rest = np.flatnonzero(big & ~first)
        a.append(starts[group[rest]])
        b.append(rest)
        a, b = np.concatenate(a), np.concatenate(b)
        fit = self.fits(size[a], size[b], place[a], place[b])
        return a[fit], b[fit], big


def _sorted_unique(token, size, place, node, large):
    by = np.lexsort((~large, node, size, token))
    token, size, place, node, large = token[by], size[by], place[by], node[by], large[by]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    return token[new], size[new], place[new], node[new], large[new]


def _info(size: np.ndarray, place: np.ndarray, large: np.ndarray) -> np.ndarray:
    return size << 32 | large.astype(np.int64) << 31 | place


# kind 0 and 2: a prefix row, info = size, mark of a large group, place; kind 1: a pair (node, info), token spreads it.
_ROWS = "kind tinyint, token bigint, node bigint, info bigint"


def _out(kind: int, token: np.ndarray, node: np.ndarray, info: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.full(len(node), kind, np.int8)), *map(pa.array, (token, node, info))]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "token", "node", "info"])


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.minimum(a, b), np.maximum(a, b)
    by = np.lexsort((high, low))
    low, high = low[by], high[by]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return low[new], high[new]


def _prefixes(docs: DataFrame, n: int, percent: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """kind 0: prefix rows to meet those of other tasks; 1: pairs; 2: rows of large groups, kept for the second look."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen, pairs = Shingles(n), set(), _Pairs(percent)
        held: list[tuple] = []
        rows = 0

        def block() -> Iterator[pa.RecordBatch]:
            token, size, place, node, large = _sorted_unique(*(np.concatenate(c) for c in zip(*held)))
            a, b, big = pairs.of(token, size, place, node, large)
            inner = big[a] & big[b]
            low, high = _unique_pairs(node[a[inner]], node[b[inner]])
            yield _out(1, signed(mix(low)), low, high)
            # Of a large group only the two ends go on, marked: stars and chains across tasks hang on
            # them, and whatever meets them is in a large group as well.
            first = np.ones(len(token), bool)
            first[1:] = token[1:] != token[:-1]
            go = ~big | first | np.roll(first, -1)
            info = _info(size, place, big)
            yield _out(0, token[go], node[go], info[go])
            yield _out(2, token[big], node[big], info[big])

        for batch in batches:
            for text in text_bytes(batch.column(0)):
                tokens = make.of(text)
                if not len(tokens) or not _own_first(node := _node(tokens), seen):
                    continue
                p = prefix_length(len(tokens), percent)
                order = np.lexsort((tokens, _uses(tokens, common)))[:p]
                held.append((signed(tokens[order]), np.full(p, len(tokens), np.int64), np.arange(p), np.full(p, node, np.int64), np.zeros(p, bool)))
                rows += p
                if rows >= BLOCK:
                    yield from block()
                    held.clear()
                    rows = 0
        if held:
            yield from block()

    return in_batches(docs.select("text"), work, _ROWS)


def _meet(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (kind 1) and rows of large groups (kind 2): those of single tasks, and what prefix rows of all tasks give."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(percent)
        held: list[np.ndarray] = [np.zeros(0, np.int64) for _ in range(4)] + [np.zeros(0, bool)]

        def emit(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            token, size, place, node, large = _sorted_unique(*columns)
            a, b, big = pairs.of(token, size, place, node, large)
            low, high = _unique_pairs(node[a], node[b])
            yield _out(1, low, low, high)
            yield _out(2, token[big], node[big], _info(size, place, big)[big])

        for batch in batches:
            kind = batch.column(0).to_numpy()
            if (kind > 0).any():
                yield batch.filter(pa.array(kind > 0))
            table = batch.filter(pa.array(kind == 0))
            token, node, info = (table.column(i).to_numpy() for i in (1, 2, 3))
            new = [token, info >> 32, info & 0x7FFFFFFF, node, (info >> 31 & 1).astype(bool)]
            held = [np.concatenate(c) for c in zip(held, new)]
            token = held[0]
            if len(token) < BLOCK // 4:
                continue
            # The last token may go on in the next batch.
            whole = int(np.searchsorted(token, token[-1]))
            if whole:
                yield from emit([c[:whole] for c in held])
                held = [c[whole:] for c in held]
        if len(held[0]):
            yield from emit(held)

    ordered = rows.repartition("token").sortWithinPartitions("token")
    return stage(in_batches(ordered, work, _ROWS), "met-prefixes")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """One bit per value of the given hashes: 2^NEEDED_BITS of them."""
    at = hashes.select(F.pmod("text_hash", F.lit(1 << NEEDED_BITS)).alias("at"))
    words = at.groupBy(F.expr("shiftright(at, 5)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 31 as int)))").alias("bits"))
    bits = np.zeros(1 << (NEEDED_BITS - 5), np.uint32)
    for r in words.toLocalIterator():
        bits[r["word"]] = r["bits"]
    return bits


def _sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, size, tokens) of the given nodes, made again from one of the texts of each."""
    one = rows.where("kind = 0").join(_small(nodes), "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    one = stage(one, "needed-texts")
    bits = _bitmap(one)
    mask = (1 << NEEDED_BITS) - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen = Shingles(n), set()
        for batch in batches:
            at = batch.column(1).to_numpy() & mask
            batch = batch.filter(pa.array((bits[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)))
            found: list[tuple[int, int, bytes]] = []
            for value, text in zip(batch.column(1).to_pylist(), text_bytes(batch.column(0))):
                if _own_first(value, seen) and len(tokens := make.of(text)):
                    found.append((_node(tokens), len(tokens), shortened(tokens)))
            columns = zip(*found) if found else [()] * 3
            types = [pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["node", "size", "tokens"])

    made = in_batches(docs.select("text", F.xxhash64("text")), work, "node bigint, size bigint, tokens binary")
    wanted = made.join(_small(one.select("node")), "node", "left_semi")
    return stage(wanted.dropDuplicates(["node"]), "sets")


def shortened(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of sorted tokens: two sets of thousands take one token for another once in some ten million pairs."""
    return tokens[:, None].view(np.uint8)[:, 2:].tobytes() if len(tokens) else b""


def lengthened(raw: memoryview | bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are linked."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _small(staged: DataFrame) -> DataFrame:
    """A staged table with a counted number of rows is broadcast; one with more is hashed where it meets the other side."""
    return F.broadcast(staged) if staged.count() <= BROADCAST_ROWS else staged.hint("shuffle_hash")


def _passing(pairs: DataFrame, facts: DataFrame, test: Callable[[int, memoryview, int, memoryview], bool], label: str) -> DataFrame:
    """The pairs (a, b) that pass ``test`` on (size, bytes) of both nodes, as ``facts`` (node, size, bytes) has them.
    A counted number of pairs goes to the facts, more are dealt by node."""
    few = F.broadcast if pairs.count() <= BROADCAST_ROWS else (lambda df: df)
    of_a, of_b = (facts.select(*(F.col(c).alias(f"{name}_{side}") for c, name in zip(facts.columns, ("node", "n", "held")))) for side in "ab")
    of_a, of_b = of_a.withColumnRenamed("node_a", "a"), of_b.withColumnRenamed("node_b", "b")
    of_b = of_b.join(few(pairs.select("b").distinct()), "b", "left_semi")
    both = of_a.join(few(pairs), "a").join(of_b, "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            stay = [test(i, x.as_buffer(), j, y.as_buffer()) for i, x, j, y in zip(n_a, batch.column(3), n_b, batch.column(5))]
            yield batch.select([0, 1]).filter(pa.array(stay, pa.bool_()))

    return stage(in_batches(both.select("a", "b", "n_a", "held_a", "n_b", "held_b"), work, "a bigint, b bigint"), label)


def _left(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the further orders, by their signatures alone."""

    def passes(n_a, a, n_b, b) -> bool:
        return may_link(n_a, np.frombuffer(a, np.uint16), n_b, np.frombuffer(b, np.uint16), percent)

    return _passing(pairs, signatures, passes, "pairs-left")


def _verified(docs: DataFrame, rows: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: first the further orders, then the count."""

    def links(n_a, a, n_b, b) -> bool:
        a, b = lengthened(a), lengthened(b)
        signed_a, signed_b = (np.frombuffer(signature(x, percent), np.uint16) for x in (a, b))
        return may_link(n_a, signed_a, n_b, signed_b, percent) and similar(a, b, percent)

    nodes = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "needed-nodes")
    return _passing(pairs, _sets(docs, rows, nodes, n), links, "links")


def _mixed(open_rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of large groups whose nodes lie in more than one component, with their component."""
    placed = lookup_join(open_rows, roots, ["node"], F.col("token"), "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    rows = stage(placed.join(mixed, "token", "left_semi"), "mixed-rows")
    in_order = F.slice(F.sort_array(F.collect_set(F.struct("place", "token"))), 1, FIRSTS)
    firsts = rows.groupBy("node").agg(F.transform(in_order, lambda x: x["token"]).alias("firsts"))
    return stage(rows.join(firsts, "node"), "open-rows")


def _across(left: DataFrame, right: DataFrame, percent: int, every: bool) -> DataFrame:
    """Candidates that share a token and lie in different components. Where ``every`` row of a token is
    on both sides, nodes with several tokens in common meet at the first in the order, mostly once;
    that is also the token at which what is left after it tells whether they can be similar."""
    right = right.select("token", *(F.col(c).alias(f"{c}_b") for c in ("node", "size", "place", "root", "firsts")))
    first = F.get(F.array_intersect("firsts", "firsts_b"), F.lit(0))
    rest = F.least(F.col("size") - F.col("place"), F.col("size_b") - F.col("place_b"))
    close = F.least("size", "size_b") * 100 >= F.greatest("size", "size_b") * percent
    fits = close & (rest * (100 + percent) >= (F.col("size") + F.col("size_b")) * percent)
    fits = fits & F.coalesce(first == F.col("token"), F.lit(True)) & (F.col("node") < F.col("node_b")) if every else fits
    met = left.join(right, "token").where((F.col("root") != F.col("root_b")) & fits)
    return met.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def node_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, size, salt) of every document, and (node, root) of every node that is linked."""
    rows = shingled(docs, n, percent)
    met = _meet(_prefixes(docs, n, percent, _common(rows)), percent)
    pairs = stage(met.where("kind = 1").select(F.col("node").alias("a"), F.col("info").alias("b")).where("a <> b").distinct(), "pairs")
    large = met.where("kind = 2").select("token", "node", F.expr("shiftright(info, 32)").alias("size"), F.col("info").bitwiseAND(F.lit(0x7FFFFFFF)).alias("place"))
    open_rows = stage(large.distinct(), "large-groups")
    needed = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidate-nodes")
    signatures = rows.where("kind = 2").select("node", "size", "signature").join(_small(needed), "node", "left_semi")
    signatures = stage(signatures.dropDuplicates(["node"]), "signatures")
    links = _verified(docs, rows, _left(pairs, signatures, percent), n, percent)
    roots = components(links)
    checked = pairs
    for look in range(LOOKS + 1):
        left = _mixed(open_rows, roots)
        if left.isEmpty():
            break
        right = left
        if look < LOOKS:
            # A few members of each group, the same in every group they share, meet all the others.
            number = F.xxhash64("node", F.lit(look))
            member = F.struct(number.alias("number"), *(F.col(c) for c in left.columns))
            right = left.groupBy("token", F.pmod(number, F.lit(PIVOTS * WIDER**look)).alias("of")).agg(F.min(member).alias("m")).select("m.*").drop("number")
            right = right.select(*left.columns)
        more = stage(_across(left, right, percent, every=look == LOOKS).join(checked, ["a", "b"], "left_anti"), "pairs-across")
        if not more.isEmpty():
            links = links.unionByName(_verified(docs, rows, more, n, percent))
            checked = checked.unionByName(more)
            roots = components(links)
    return rows.where("kind = 0").select("doc_id", "node", "size", "salt"), roots


def least_row() -> Column:
    """Orders the rows of a component: ids first, nulls last, then nodes."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("node").alias("node"), F.col("salt").alias("salt"))


def join(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, node, salt, and whether the row stands for its component."""
    rows, roots = node_components(docs, n, percent)
    nodes = rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(least_row()).alias("least"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = nodes.groupBy("root").agg(F.sum("copies").alias("members"), F.min("least").alias("least")).where("members > 1")
    known = stage(nodes.join(groups.select("root", F.col("least").alias("first")), "root").select("node", "first"), "components")
    names = ("doc_id", "node", "salt")
    joined = lookup_join(rows, known, ["node"], F.col("doc_id"), "left")
    return joined.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        "node",
        "salt",
        (F.col("first").isNull() | (F.struct(*(F.col(f"first.{c}") for c in names)).eqNullSafe(F.struct(*names)))).alias("stands"),
    )


def representatives(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one for each; those without words all stay."""
    kept = join(docs, n, percent).where("stands")
    decided = kept.groupBy("doc_id", F.col("salt").alias("_salt")).agg(F.max(F.col("node").isNotNull()).alias("_linked"), F.count(F.lit(1)).alias("_rows"))
    met, row = rejoin(docs, stage(decided, "representatives"))
    again = row["_linked"] & (row["_rows"] > 1)
    once = met.where(again).dropDuplicates(["doc_id", "text"])
    return met.where(~again).unionByName(once).select(*docs.columns)
