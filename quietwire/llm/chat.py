"""Chat formatting: roles of transcript lines by a hidden Markov model, and canonical turns.

States are the roles. A line is seen as four features: which role a speaker marker at its start
names, its length, how many lines it holds, and what it ends with. Start, transition and feature
probabilities are counted on conversations with known roles, smoothed, or given. The likeliest roles
of a whole conversation (Viterbi) are those of its lines; turns are rendered one way for all.

A conversation may be of any length: it is cut into segments of SEGMENT lines. Each segment is
summed up as a small table, the best score from every state before it to every state at its end.
A pass over the tables of a conversation settles the states at the cuts, and every segment then
finds its own best path between them. The result is that of one pass over all lines.

Raw transcripts are cut into turns first. Their lines have two states per role: a turn of it begins,
or goes on. Blank lines are part of the line after them, which sees how many they are. Lines from a
beginning to the next one are joined into one turn, and the turns then get their roles like given ones.

Null and empty texts are lines without marker of length 0, rendered as empty turns. Conversations
with a null id are one conversation. Lines with equal or null turn numbers keep some fixed order by
text. Repeated rows are lines of their own. An empty table gives no rows. A role column is never
looked at when roles are recovered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietwire.llm.common import in_batches, numbered
from quietwire.session import stage

ROLES = ("system", "user", "assistant")
SEGMENT = 256
# Conversations the model is counted on, drawn by a hash of their id.
TRAIN_CONVERSATIONS = 5_000
# What a count starts from.
SMOOTHING = 0.5
# Probability of what cannot be: a turn goes on that has not begun.
_NEVER = 1e-12

# Names speakers are marked with.
MARKERS = {
    "system": ("system", "sys", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "me", "prompt"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "model", "response"),
}
_MARKER = re.compile(
    r"^\s*(?:[-*#>\[(<|]*\s*)(" + "|".join(sorted((n for names in MARKERS.values() for n in names), key=len, reverse=True)) + r")\s*(?:[\])>|*]+\s*:?|:+)\s*",
    re.IGNORECASE,
)
_ROLE_OF = {name: ROLES.index(role) for role, names in MARKERS.items() for name in names}

# Values of each feature: marker (none, or a role), length by powers of two, lines, last sign.
SIZES = (1 + len(ROLES), 16, 4, 5)
_ENDS = {"?": 1, ".": 2, ":": 3}


def marker_of(text: str) -> tuple[int, str]:
    """(0 or 1 + role named, the text without the marker)."""
    found = _MARKER.match(text[:80])
    return (1 + _ROLE_OF[found[1].lower()], text[found.end() :]) if found else (0, text)


def features(text: str) -> tuple[int, int, int, int]:
    marker, rest = marker_of(text)
    rest = rest.strip()
    lines = rest.count("\n") + 1
    return marker, min(len(rest).bit_length(), 15), min(lines.bit_length() - 1, 3), _ENDS.get(rest[-1:], 0 if rest else 4)


@dataclass(frozen=True)
class Model:
    """Logarithms of probabilities: of the first role, of each role after each, of feature values per role."""

    start: np.ndarray
    move: np.ndarray
    emit: tuple[np.ndarray, ...]

    def lines(self, seen: np.ndarray) -> np.ndarray:
        """Log-probability of each line under each role, from its features."""
        return sum(table[:, seen[:, i]].T for i, table in enumerate(self.emit))


def line_features(text: str) -> tuple[int, int, int, int]:
    """Like ``features``, for a line of a transcript and the blank lines before it, which take the place of the lines held."""
    line = text.lstrip()
    marker, size, _, end = features(line)
    return marker, size, min(text[: len(text) - len(line)].count("\n"), 3), end


def _marker_table() -> np.ndarray:
    """How often each role is marked, and with which name, where nothing else is known."""
    marker = np.full((3, SIZES[0]), 0.01)
    marker[:, 0] = 0.5
    marker[np.arange(3), np.arange(3) + 1] = 0.48
    return marker


# Of lines that go on with a turn: hardly any looks like a marker.
_ON_MARKER = np.array([0.97, 0.01, 0.01, 0.01])


def default_model() -> Model:
    """For transcripts without any known roles: markers decide, turns alternate, questions are asked."""
    move = np.array([[0.05, 0.9, 0.05], [0.01, 0.14, 0.85], [0.01, 0.79, 0.2]])
    ends = np.array([[0.2, 0.05, 0.6, 0.1, 0.05], [0.25, 0.4, 0.25, 0.05, 0.05], [0.2, 0.05, 0.6, 0.1, 0.05]])
    flat = [np.full((3, n), 1 / n) for n in SIZES[1:3]]
    return Model(np.log([0.3, 0.6, 0.1]), np.log(move), tuple(np.log(x) for x in (_marker_table(), *flat, ends)))


def default_line_model() -> Model:
    """Of transcript lines (a turn begins, or goes on): unmarked lines go on with the turn before them."""
    turns = default_model()
    goes_on = 0.7
    move = np.tile(np.concatenate([np.exp(turns.move) * (1 - goes_on), np.eye(len(ROLES)) * goes_on + _NEVER], axis=1), (2, 1))
    start = np.concatenate([np.exp(turns.start), np.full(len(ROLES), _NEVER)])
    marker = np.concatenate([_marker_table(), np.tile(_ON_MARKER, (len(ROLES), 1))])
    blank = np.repeat([[0.5, 0.3, 0.1, 0.1], [0.8, 0.12, 0.04, 0.04]], len(ROLES), axis=0)
    length, ends = (np.tile(np.exp(turns.emit[i]), (2, 1)) for i in (1, 3))
    return Model(np.log(start), np.log(move), tuple(np.log(x) for x in (marker, length, blank, ends)))


def _key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _seen(rows: DataFrame, keep: list[str], schema: str, see: Callable[[str], tuple[int, ...]] = features) -> DataFrame:
    """``keep`` columns and the features of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([see(t.as_py() or "") for t in batch.column(len(keep))], np.int32).reshape(-1, 4)
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(found[:, i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "f0", "f1", "f2", "f3"])

    return in_batches(rows.select(*keep, "text"), work, f"{schema}, f0 int, f1 int, f2 int, f3 int")


def _known(rows: DataFrame, most: int) -> DataFrame:
    """Turns with known roles, as _key, turn, text and _state, of at most ``most`` conversations."""
    drawn = rows.where(F.col("conv_id").isNotNull()).select("conv_id").distinct().orderBy(F.xxhash64("conv_id"), "conv_id").limit(most)
    known = rows.where(F.col("role").isin(*ROLES)).join(F.broadcast(drawn), "conv_id")
    known = known.withColumn("_state", F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1)
    return known.select(_key(F.col("conv_id")).alias("_key"), "turn", "text", "_state")


def _counted(lines: DataFrame, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]) -> Model:
    """Adds the counts of ``lines`` (_key, position, _state, features) to what counting starts from.

    Counting is one aggregation each; a handful of numbers reaches the driver.
    """
    for r in lines.where("position = 0").groupBy("_state").count().collect():
        start[r["_state"]] += r["count"]
    after = lines.select("_key", (F.col("position") - 1).alias("position"), F.col("_state").alias("_next"))
    for r in lines.join(after, ["_key", "position"]).groupBy("_state", "_next").count().collect():
        move[r["_state"], r["_next"]] += r["count"]
    for i in range(len(SIZES)):
        for r in lines.groupBy("_state", f"f{i}").count().collect():
            emit[i][r["_state"], r[f"f{i}"]] += r["count"]
    logs = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Model(logs(start), logs(move), tuple(map(logs, emit)))


def learn(rows: DataFrame, most: int = TRAIN_CONVERSATIONS) -> Model:
    """Counts start, transitions and features on at most ``most`` conversations with known roles."""
    order = [F.col("turn").asc_nulls_first(), F.col("text").asc_nulls_first()]
    lines = numbered(_known(rows, most), order, ["_key"], "position", "known-lines")
    lines = stage(_seen(lines, ["_key", "position", "_state"], "_key string, position bigint, _state bigint"), "known-features")
    s = len(ROLES)
    # Marks of speakers say what they say also where the conversations counted on have none.
    emit = [_marker_table() * SIZES[0] * SMOOTHING, *(np.full((s, n), SMOOTHING) for n in SIZES[1:])]
    return _counted(lines, np.full(s, SMOOTHING), np.full((s, s), SMOOTHING), emit)


def learn_lines(rows: DataFrame, most: int = TRAIN_CONVERSATIONS) -> Model:
    """The same for the lines of transcripts, counted on known conversations joined as ``joined_lines`` does."""
    s = len(ROLES)
    known = joined_lines(_known(rows, most), ["_key", "_state"], "_key string, _state bigint")
    known = known.withColumn("_state", F.col("_state") + F.when(F.col("begins"), 0).otherwise(s))
    lines = numbered(known, [F.col("turn")], ["_key"], "position", "known-transcripts")
    seen = _seen(lines, ["_key", "position", "_state"], "_key string, position bigint, _state bigint", line_features)
    begin, on = np.full((s, s), SMOOTHING), np.eye(s) * SMOOTHING + _NEVER
    marker = np.concatenate([_marker_table(), np.tile(_ON_MARKER, (s, 1))]) * SIZES[0] * SMOOTHING
    return _counted(
        stage(seen, "known-line-features"),
        np.repeat([SMOOTHING, _NEVER], s),
        np.tile(np.concatenate([begin, on], axis=1), (2, 1)),
        [marker, *(np.full((2 * s, n), SMOOTHING) for n in SIZES[1:])],
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """The columns of each run of rows with equal first ``keys`` columns, across batches."""
    held: list[list[np.ndarray]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        new = np.zeros(batch.num_rows, bool)
        for c in columns[:keys]:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns[:keys])
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = [c[a:b] for c in columns]
            if a == 0 and last == first:
                held.append(part)
                continue
            if held:
                yield [np.concatenate(c) for c in zip(*held)]
            held = [part]
        last = tuple(c[-1] for c in columns[:keys])
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def table_of(scores: np.ndarray, model: Model, first: bool) -> np.ndarray:
    """Best score from each state before the segment (rows) to each state of its last line (columns)."""
    s = len(model.start)
    best = np.tile(model.start + scores[0], (s, 1)) if first else model.move + scores[0]
    for line in scores[1:]:
        best = (best[:, :, None] + model.move[None]).max(axis=1) + line
    return best


def path_of(scores: np.ndarray, model: Model, before: int, last: int) -> np.ndarray:
    """The best states of a segment between the state before it (-1: none) and its last state."""
    best = (model.start if before < 0 else model.move[before]) + scores[0]
    came = np.zeros((len(scores), len(best)), np.int64)
    for i in range(1, len(scores)):
        ways = best[:, None] + model.move
        came[i] = ways.argmax(axis=0)
        best = ways.max(axis=0) + scores[i]
    states = np.empty(len(scores), np.int64)
    states[-1] = last
    for i in range(len(scores) - 1, 0, -1):
        states[i - 1] = came[i, states[i]]
    return states


def _cuts(tables: list[np.ndarray]) -> list[int]:
    """The last state of every segment on the best path through all of them."""
    best, came = tables[0][0], []
    for table in tables[1:]:
        ways = best[:, None] + table
        came.append(ways.argmax(axis=0))
        best = ways.max(axis=0)
    states = [int(best.argmax())]
    for back in reversed(came):
        states.append(int(back[states[-1]]))
    return states[::-1]


def _decoded(rows: DataFrame, model: Model, see: Callable[[str], tuple[int, ...]]) -> DataFrame:
    """Adds position, role, _key, _segment and _from to rows with conv_id, turn and text.

    _from is the position at which the row's turn begins, -1 where that is in an earlier segment.
    """
    keyed = rows.withColumn("_key", _key(F.col("conv_id")))
    order = [F.col("turn").asc_nulls_first(), F.col("text").asc_nulls_first()]
    lines = stage(
        numbered(keyed, order, ["_key"], "position", "lines").withColumn("_segment", F.floor(F.col("position") / SEGMENT)),
        "numbered-lines",
    )
    seen = stage(_seen(lines, ["_key", "_segment", "position"], "_key string, _segment bigint, position bigint", see), "features")
    ordered = seen.repartition("_key", "_segment").sortWithinPartitions("_key", "_segment", "position")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, segment, _, *f in _groups(batches, 2):
            table = table_of(model.lines(np.stack(f, axis=1)), model, segment[0] == 0)
            arrays = [pa.array([key[0]], pa.string()), pa.array([segment[0]], pa.int64()), pa.array([table.ravel().tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", "_segment", "best"])

    tables = stage(in_batches(ordered, sum_up, "_key string, _segment bigint, best array<double>"), "segments")
    s = len(model.start)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, segment, best in _groups(batches, 1):
            ends = _cuts([np.array(x).reshape(s, s) for x in best])
            arrays = [pa.array(key, pa.string()), pa.array(segment), pa.array([-1, *ends[:-1]], pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", "_segment", "before", "last"])

    at_cuts = tables.repartition("_key").sortWithinPartitions("_key", "_segment")
    ends = stage(in_batches(at_cuts, settle, "_key string, _segment bigint, before bigint, last bigint"), "cuts")
    bound = seen.join(ends, ["_key", "_segment"]).repartition("_key", "_segment").sortWithinPartitions("_key", "_segment", "position")
    bound = bound.select("_key", "_segment", "position", "before", "last", "f0", "f1", "f2", "f3")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, position, before, last, *f in _groups(batches, 2):
            states = path_of(model.lines(np.stack(f, axis=1)), model, int(before[0]), int(last[0]))
            begun = np.maximum.accumulate(np.where(states < len(ROLES), position, -1))
            arrays = [pa.array(key, pa.string()), pa.array(position), pa.array([ROLES[x % len(ROLES)] for x in states]), pa.array(begun)]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", "position", "found", "_from"])

    found = in_batches(bound, trace, "_key string, position bigint, found string, _from bigint")
    return lines.join(found, ["_key", "position"])


def decode(rows: DataFrame, model: Model) -> DataFrame:
    """Adds position and role to rows with conv_id, turn and text."""
    return _decoded(rows, model, features).drop("_key", "_segment", "_from")


def _rendered(texts: DataFrame, schema: str, columns: list[str]) -> DataFrame:
    """Adds the canonical form of every row's text under its found role."""
    text_at, role_at = columns.index("text"), columns.index("found")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                f"<|{role.as_py()}|>\n{marker_of(text.as_py() or '')[1].strip()}\n<|end|>\n"
                for role, text in zip(batch.column(role_at), batch.column(text_at))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*columns, "rendered"])

    return in_batches(texts.select(*columns), work, f"{schema}, rendered string")


def format_turns(rows: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, position, text, found (the recovered role) and rendered, a row per line."""
    lines = decode(rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "text"), model)
    columns = ["conv_id", "turn", "position", "text", "found"]
    return _rendered(lines, "conv_id bigint, turn bigint, position bigint, text string, found string", columns)


def transcript_lines(transcripts: DataFrame) -> DataFrame:
    """(conv_id, turn, text): the lines of raw transcripts (conv_id, text), blank ones left out."""
    split = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("turn", "line")
    return transcripts.select("conv_id", split).where(F.trim("line") != "").select("conv_id", F.col("turn").cast("bigint"), F.col("line").alias("text"))


def joined_lines(rows: DataFrame, keep: list[str], schema: str) -> DataFrame:
    """The lines of the transcripts that ``rows`` (_key, turn, text and ``keep`` columns) make when joined in order, a
    blank line between two: ``keep``, turn, begins and text.

    turn orders the lines: the row's place in its transcript, times 2**32, plus the line's number in the row. Blank lines
    are put before the next line of their row. begins tells the first line of a row; it is for counting only.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("text").asc_nulls_first()]
    places = numbered(rows, order, ["_key"], "_place", "joined-turns")
    n = len(keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, turn, begins, out = [], [], [], []
            for i, (place, text) in enumerate(zip(batch.column(n).to_pylist(), batch.column(n + 1))):
                blank = [""] if place else []
                first = True
                for number, line in enumerate((text.as_py() or "").split("\n")):
                    if not line.strip():
                        blank.append(line)
                        continue
                    row.append(i)
                    turn.append((place << 32) + number)
                    begins.append(first)
                    out.append("\n".join([*blank, line]))
                    blank, first = [], False
            arrays = [batch.column(i).take(pa.array(row, pa.int64())) for i in range(n)]
            arrays += [pa.array(turn, pa.int64()), pa.array(begins, pa.bool_()), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "turn", "begins", "text"])

    return in_batches(places.select(*keep, "_place", "text"), work, f"{schema}, turn bigint, begins boolean, text string")


def recover_turns(lines: DataFrame, line_model: Model) -> DataFrame:
    """(conv_id, turn, text): the turns that the lines of transcripts (conv_id, turn, text) make; turn is that of the first line."""
    found = stage(_decoded(lines.select("conv_id", "turn", "text"), line_model, line_features), "transcript-states")
    # What is open at the end of a segment goes on in the next ones: a row per segment.
    last = found.groupBy("_key", "_segment").agg(F.max("_from").alias("_last"))
    before = Window.partitionBy("_key").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    open_turns = last.select("_key", "_segment", F.max("_last").over(before).alias("_open"))
    placed = found.join(open_turns, ["_key", "_segment"]).withColumn("_from", F.greatest("_from", "_open"))
    turns = placed.groupBy("_key", "conv_id", "_from").agg(F.sort_array(F.collect_list(F.struct("position", "turn", "text"))).alias("_lines"))
    text = F.regexp_replace(F.array_join("_lines.text", "\n"), r"^\s+|\s+$", "")
    return turns.select("conv_id", F.col("_lines")[0]["turn"].alias("turn"), text.alias("text"))


def format_transcripts(transcripts: DataFrame, line_model: Model, model: Model) -> DataFrame:
    """``format_turns`` of the turns of raw transcripts (conv_id, text). Rows of one conv_id are parts of one transcript."""
    rows = transcripts.select(F.col("conv_id").cast("bigint"), "text").withColumn("_key", _key(F.col("conv_id")))
    lines = joined_lines(rows.withColumn("turn", F.lit(0)), ["conv_id"], "conv_id bigint")
    return format_turns(recover_turns(lines, line_model), model)


def format_joined(rows: DataFrame, line_model: Model, model: Model) -> DataFrame:
    """``format_turns`` of the turns found in the transcripts that ``rows`` (conv_id, turn, text) make when joined.

    turn is the place of the row in which a found turn begins. Where rows begin and end is not told to the model.
    """
    rows = rows.select(F.col("conv_id").cast("bigint"), "turn", "text").withColumn("_key", _key(F.col("conv_id")))
    turns = recover_turns(joined_lines(rows, ["conv_id"], "conv_id bigint"), line_model)
    return format_turns(turns, model).withColumn("turn", F.shiftright("turn", 32))
