import zlib
from collections import Counter
from itertools import product

import pyarrow.parquet as pq
import pytest

from quietwire.llm import sharding

DOCS = "doc_id bigint, text string, source string, size string, place int, shard int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "s", -1, -2) for i, t, s in rows], DOCS)


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 4), (4, 2), (1, 4)])
def test_neighbours_on_the_curve_are_neighbours_on_the_grid(dimensions, bits):
    places = sharding.curve(dimensions, bits)
    cells = {place: cell for cell, place in places.items()}
    assert sorted(cells) == list(range((1 << bits) ** dimensions))
    assert set(places) == set(product(range(1 << bits), repeat=dimensions))
    assert all(sum(abs(a - b) for a, b in zip(cells[i], cells[i + 1])) == 1 for i in range(len(cells) - 1))


def corpus():
    rows = [(i, ("é" if i % 7 == 0 else "w ") * (i * 31 % 900), f"src{i % 9}") for i in range(700)]
    rows += [(i, "one text that many rows share", "src1") for i in range(700, 1100)]
    rows += [(None, None, None), (-(1 << 62), "low", ""), (1 << 62, "high", "é" * 20), (3, "again", "src3"), (3, "again", "src3"), (5, "x" * 100_000, None)]
    return rows


@pytest.mark.parametrize("shards", [40, 7])
def test_law_slots_and_checksums(spark, shards):
    rows = corpus()
    got = sharding.shard(docs_of(spark, rows).repartition(5), shards).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    per = Counter(r.shard for r in got)
    assert set(per) == set(range(shards)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per[s]))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    in_order = [r.place for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert in_order == sorted(in_order)


def test_few_and_no_rows(spark):
    got = sharding.shard(docs_of(spark, [(1, "a", "b"), (1, "a", "b"), (2, None, None)])).collect()
    assert len(got) == 3 and {r.slot for r in got} == {0} and len({r.shard for r in got}) == 3
    assert sharding.shard(docs_of(spark, [])).count() == 0


def test_files_prune_by_several_dimensions(spark, tmp_path):
    rows = [(i, "w " * (i * 53 % 700), f"src{i * 17 % 10}") for i in range(3000)]
    docs = docs_of(spark, rows).drop("shard")
    sharding.write_shards(docs, str(tmp_path / "out"), 20)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.drop("shard").collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert 20 <= len(files) <= 25

    def opened(column, value):
        hit = 0
        for f in files:
            meta = pq.ParquetFile(f).metadata
            at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            hit += any(s.min <= value <= s.max for s in stats)
        return hit

    assert opened("doc_id", 1500) <= len(files) * 0.6
    assert opened("source", "src4") <= len(files) * 0.6


def test_no_python_in_the_plan(spark):
    plan = sharding.shard(docs_of(spark, corpus()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sources_and_ids_spread_over_their_cells(spark):
    hosts = [f"https://host{i:02}.example.org/" for i in range(20)]
    rows = [(1 << 61 if i == 0 else i, "text", hosts[i % 20] if i % 21 else None) for i in range(2000)]
    sizes = sharding.measured(docs_of(spark, rows))
    cuts = sharding.grid(sizes)
    assert len(cuts.sources) == 14 and len(cuts.ids) == 14
    cells = {r.source: r.cell for r in docs_of(spark, rows).select("source", sharding._cell(sharding.F.col("source"), cuts.sources).alias("cell")).distinct().collect()}
    assert cells[None] == 0 and min(cells[h] for h in hosts) == 1 and len(set(cells.values())) == 16
    assert [cells[h] for h in hosts] == sorted(cells[h] for h in hosts)
    per = Counter(r.cell for r in sizes.select(sharding._cell(sharding.F.col("doc_id"), cuts.ids).alias("cell")).collect())
    assert len(per) == 15 and max(per.values()) < 2 * min(per.values())


def test_files_of_one_host(spark, tmp_path):
    rows = [(i, "w " * (i * 53 % 700), f"https://host{i * 17 % 20:02}.example.org/") for i in range(4000)]
    sharding.write_shards(docs_of(spark, rows), str(tmp_path / "out"), 40)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where("shard = -2").count() == 4000 and back.select("shard_").distinct().count() == 40
    files = list((tmp_path / "out").rglob("*.parquet"))
    hit = 0
    for f in files:
        sources = pq.read_table(f, columns=["source"]).column(0).to_pylist()
        hit += min(sources) <= "https://host07.example.org/" <= max(sources)
    assert hit <= len(files) * 0.6
