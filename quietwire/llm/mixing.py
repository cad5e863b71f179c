"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: how often it is taken. Among all rates between 0 and ``most`` that give
each source its words, those closest to 1 in relative entropy are exponentially tilted,

    rate(d) = min(most, exp(tilt(source) * size(d) / mean size(source))),

so one tilt per source is all there is to find. It is the root of the convex dual's gradient, which
Newton steps find for all sources at once, each step one distributed aggregation; a bracket around
the root catches steps that overshoot. Documents of one size have one rate, so the steps run on
counts per (source, size), never on documents. Rates are then rounded into whole copies, size by
size from the largest down, each size making up for what the larger ones owe, so that a source ends
within about one short document of its target.

A source's target is its weight's share of all words, at most ``most`` times its own words; what is
above goes to the others by weight, until none is above. Sources weigh 1, 2, 3, 1, ... in code point
order, a null source last. Null and empty texts have size 0, are kept and taken with no words.
Repeated rows count each by itself. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import WORD, free, numbered, rejoin, salt
from quietwire.session import stage

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
# Relative error of a source's words at which its tilt is settled, and steps after which all are
# (a bracket halves at least every second step, so doubles are exhausted before).
CLOSE = 1e-9
STEPS = 60
# A tilt beyond which every document with words is at ``most``.
_STEEPEST = 1e6


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """The source as a key without nulls, which sort last."""
    return F.when(source.isNull(), F.lit("\U0010ffff")).otherwise(F.concat(F.lit("="), source))


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source key, words, target) from (source key, words) with one row per source."""
    placed = numbered(sizes, [F.col("_source")], [], "_place", "sources", few=True)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("_place", F.lit(len(WEIGHTS))) + 1).cast("int"))
    weighed = stage(placed.withColumn("_weight", weight), "weighed-sources")
    total = weighed.agg(F.sum("_words")).first()[0] or 0
    # Words a unit of weight gets. It grows while sources drop out at their limit, each at most once.
    unit, dropped = 0.0, -1
    while True:
        at_limit = F.lit(False) if dropped < 0 else F.col("_words") * most <= F.lit(unit) * F.col("_weight")
        row = weighed.agg(
            F.count_if(at_limit).alias("n"),
            F.sum(F.when(at_limit, F.col("_words") * most).otherwise(0)).alias("words"),
            F.sum(F.when(at_limit, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if row["n"] == dropped or not row["weight"]:
            break
        dropped = row["n"]
        unit = (total - (row["words"] or 0)) / row["weight"]
    target = F.least((F.col("_words") * most).cast("double"), F.lit(unit) * F.col("_weight"))
    return weighed.select("_source", "_words", target.alias("_target"))


def _tilts(counts: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """(source key, tilt, target) such that the tilted words of every source meet its target."""
    means = counts.groupBy("_source").agg((F.sum(F.col("_n") * F.col("_size")) / F.sum("_n")).alias("_mean"))
    state = stage(
        wanted.join(means, "_source")
        .where(F.col("_words") > 0)
        .select(
            "_source",
            "_target",
            "_mean",
            F.lit(0.0).alias("_tilt"),
            F.lit(-_STEEPEST).alias("_low"),
            F.lit(_STEEPEST).alias("_high"),
            (F.col("_target") >= F.col("_words") * most).alias("_full"),
        ),
        "tilts-0",
    )
    for step in range(1, STEPS + 1):
        # The gradient (words at this tilt) and its slope; sizes at the limit do not move any more.
        x = F.col("_size") / F.col("_mean")
        power = F.col("_tilt") * x
        free = power < F.log(F.lit(float(most)))
        words = F.col("_n") * F.col("_size") * F.when(free, F.exp(power)).otherwise(float(most))
        at = (
            counts.join(state.where(~F.col("_full")), "_source")
            .groupBy("_source", "_target", "_mean", "_tilt", "_low", "_high", "_full")
            .agg(F.sum(words).alias("_got"), F.sum(F.when(free, words * x).otherwise(0.0)).alias("_slope"))
        )
        off = F.col("_got") - F.col("_target")
        done = F.abs(off) <= CLOSE * F.col("_target")
        low = F.when(off < 0, F.col("_tilt")).otherwise(F.col("_low"))
        high = F.when(off > 0, F.col("_tilt")).otherwise(F.col("_high"))
        # Newton on the logarithm of the words, which is nearly linear in the tilt.
        newton = F.col("_tilt") - F.log(F.col("_got") / F.col("_target")) * F.col("_got") / F.col("_slope")
        inside = (newton > F.col("_low")) & (newton < F.col("_high")) & (F.col("_got") > 0)
        # A bracket without bounds yet is searched outwards from where it stands.
        middle = (
            F.when(F.col("_high") >= _STEEPEST, F.greatest(F.col("_low"), F.lit(0.0)) * 4 + 1)
            .when(F.col("_low") <= -_STEEPEST, F.least(F.col("_high"), F.lit(0.0)) * 4 - 1)
            .otherwise((F.col("_low") + F.col("_high")) / 2)
        )
        at = at.withColumns({"_low": low, "_high": high, "_done": done})
        at = at.withColumn("_tilt", F.when(F.col("_done"), F.col("_tilt")).when(inside, newton).otherwise(middle))
        columns = state.columns
        new = stage(at.select(*columns, "_done").unionByName(state.where("_full").withColumn("_done", F.lit(True))), f"tilts-{step}")
        state = new.select(*columns)
        if new.where(~F.col("_done")).isEmpty():
            break
    return state.select("_source", "_target", "_mean", "_tilt", "_full")


def _copies(counts: DataFrame, tilts: DataFrame, most: int) -> DataFrame:
    """(source key, size, documents, copies of all of them together).

    One task sees a source's sizes, which are as many as there are different sizes, not documents.
    """

    def round_off(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_size", ascending=False, ignore_index=True)
        n, size = rows["_n"].to_numpy(), rows["_size"].to_numpy()
        mean, tilt, full = rows["_mean"].iloc[0], rows["_tilt"].iloc[0], rows["_full"].iloc[0]
        rate = np.full(len(rows), float(most)) if full else np.exp(np.minimum(tilt * size / mean, np.log(most)))
        copies = np.zeros(len(rows), np.int64)
        owed = 0.0
        for i in range(len(rows)):
            if size[i]:
                owed += n[i] * size[i] * rate[i]
                copies[i] = min(max(0, round(owed / size[i])), int(n[i]) * most)
                owed -= int(copies[i]) * int(size[i])
        # What is still owed goes to the largest sizes that it can pay for or take back.
        for i in range(len(rows)):
            if size[i]:
                more = min(max(int(np.trunc(owed / size[i])), -int(copies[i])), int(n[i]) * most - int(copies[i]))
                copies[i] += more
                owed -= more * int(size[i])
        return pd.DataFrame({"_source": rows["_source"], "_size": size, "_n": n, "_copies": copies})

    return (
        counts.join(tilts, "_source")
        .groupBy("_source")
        .applyInPandas(round_off, "_source string, _size bigint, _n bigint, _copies bigint")
    )


def mix(docs: DataFrame, most: int = MOST, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document, and the columns to ``carry``.

    Documents of one size are taken equally often, up to one copy more for those first by a hash of doc_id.
    """
    sized = stage(docs.select("doc_id", *carry, _key(F.col("source")).alias("_source"), size_of(F.col("text")).alias("_size")), "sizes")
    counts = stage(sized.groupBy("_source", "_size").agg(F.count(F.lit(1)).alias("_n")), "size-counts")
    wanted = targets(counts.groupBy("_source").agg(F.sum(F.col("_n") * F.col("_size")).alias("_words")), most)
    wanted = stage(wanted, "targets")
    copies = _copies(counts, _tilts(counts, wanted, most), most)
    classes = stage(
        counts.join(copies.select("_source", "_size", "_copies"), ["_source", "_size"], "left")
        .join(wanted, "_source")
        .withColumn("_copies", F.coalesce("_copies", F.lit(0))),
        "classes",
    )
    # Which documents of a size get one copy more: numbered in the order of a hash, not of their ids.
    order = [F.xxhash64("doc_id"), F.col("doc_id").asc_nulls_first(), *map(F.col, carry)]
    ranked = numbered(sized, order, ["_source", "_size"], "_number", "numbered-sizes")
    each = F.floor(F.col("_copies") / F.col("_n"))
    more = (F.col("_number") < F.pmod("_copies", "_n")).cast("long")
    return (
        ranked.join(classes, ["_source", "_size"])
        .withColumn("copies", each + more)
        .select(
            "doc_id",
            F.col("_size").alias("size"),
            F.col("_words").alias("source_size"),
            F.col("_target").alias("target"),
            (F.col("copies") * F.col("_size")).alias("taken"),
            "copies",
            *carry,
        )
    )


def mixed(docs: DataFrame, most: int = MOST) -> DataFrame:
    """The mix itself: all columns of ``docs``, every row as often as it is taken; empty ones stay once."""
    rows = mix(docs.withColumn("_salt", salt(F.col("text"))), most, carry=("_salt",))
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))
    decided = rows.groupBy("doc_id", "_salt").agg(F.sum(times).alias("_times"), F.count(F.lit(1)).alias("_rows"))
    met, row = rejoin(docs, stage(decided.where("_times > 0"), "copies"))
    # Rows equal in id and text share what they are taken together.
    again = met.where(row["_rows"] > 1).dropDuplicates(["doc_id", "text"])
    every = met.where(row["_rows"] == 1).unionByName(again)
    copy = free("_copy", every.columns)
    return every.withColumn(copy, F.explode(F.sequence(F.lit(1), row["_times"].cast("int")))).select(*docs.columns)
