from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tracemill.llm import slots


def check_places(rows, shards):
    places = defaultdict(list)
    for row in rows:
        places[row.shard].append(row.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert set(places) <= set(range(shards))


def test_shards_are_even_and_gapless(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    rows = slots.shard_records(docs, 8).collect()
    assert sorted(r.doc_id for r in rows) == list(range(5000))
    check_places(rows, 8)
    sizes = defaultdict(int)
    for row in rows:
        sizes[row.shard] += row.size
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 8


def test_a_hot_id_is_divided(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("text").alias("text"))
    rows = slots.shard_records(docs, 4, slots=64).collect()
    assert len(rows) == 3000
    check_places(rows, 4)
    counts = defaultdict(int)
    for row in rows:
        counts[row.shard] += 1
    assert max(counts.values()) < 1.1 * 750


def test_odd_rows(odd_documents, no_documents):
    rows = slots.shard_records(odd_documents, 3).collect()
    assert len(rows) == odd_documents.count()
    check_places(rows, 3)
    null = next(r for r in rows if r.doc_id == 0)
    assert (null.size, null.text_crc32) == (1, 0)
    assert slots.shard_records(no_documents, 3).collect() == []


def test_rebalancing_moves_little(spark, tmp_path):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    measured = slots.measure(docs, "doc_id", "text", 512)
    totals = slots.slot_totals(slots.placed(measured, slots.slot_parts(measured, 512)))
    first = slots.initial_map(totals, 8)
    slots.save_map(first, str(tmp_path / "map"))
    slots.save_map(slots.rebalance(first, totals, 9), str(tmp_path / "map"))
    old = {(r.virtual_slot, r.part): r for r in slots.load_map(spark, str(tmp_path / "map"), 1).collect()}
    new = {(r.virtual_slot, r.part): r for r in slots.load_map(spark, str(tmp_path / "map")).collect()}
    assert old.keys() == new.keys() and {r.version for r in new.values()} == {2}
    total = sum(r.slot_bytes for r in new.values())
    moved = sum(r.slot_bytes for k, r in new.items() if old[k].shard != r.shard)
    assert moved < 1.2 * total / 9
    sizes = defaultdict(int)
    for r in new.values():
        sizes[r.shard] += r.slot_bytes
    assert len(sizes) == 9 and max(sizes.values()) < 1.1 * total / 9


def test_whole_records_are_written(spark, odd_documents, tmp_path):
    slots.write_shards(odd_documents, str(tmp_path / "shards"), 2)
    back = spark.read.parquet(str(tmp_path / "shards")).drop("_shard")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, odd_documents.select(back.columns).collect()))


def test_native(spark, odd_documents):
    plan = slots.shard_records(odd_documents, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_stored_map_takes_all_later_rows(spark):
    """Later rows lie in slots, and in parts of a divided slot, that were empty before."""
    before = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    long = spark.createDataFrame([(7, "x" * 5000)], "doc_id long, text string")
    before = before.unionByName(long)
    measured = slots.measure(before, "doc_id", "text", 64)
    parts = slots.slot_parts(measured, 64)
    slot_map = slots.first_map(slots.placed(measured, parts), parts, 4)
    rows = slot_map.collect()
    held = {(r.virtual_slot, r.part) for r in rows}
    assert held == {(r.virtual_slot, p) for r in rows for p in range(r.parts)}
    assert {r.virtual_slot for r in rows} == set(range(64)) and max(r.parts for r in rows) > 10
    later = spark.range(3000).select((F.col("id") % 300).alias("doc_id"), F.lit("text").alias("text"))
    later = later.unionByName(spark.range(500).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x").alias("text")))
    found = slots.shard_records(later, 4, slots=64, slot_map=slot_map).collect()
    assert len(found) == 3500
    check_places(found, 4)
    next_map = slots.rebalance(slot_map, slots.slot_totals(slots.placed(measured, parts)), 5).collect()
    assert {(r.virtual_slot, r.part) for r in next_map} == held and len(next_map) == len(rows)


def test_a_missing_owner_is_an_error(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    measured = slots.measure(docs, "doc_id", "text", 64)
    parts = slots.slot_parts(measured, 64)
    slot_map = slots.first_map(slots.placed(measured, parts), parts, 4)
    for lacking in (slot_map.filter("virtual_slot <> 5"), slot_map.withColumn("parts", F.lit(2))):
        with pytest.raises(Exception, match="no owner of slot"):
            slots.shard_records(docs, 4, slots=64, slot_map=lacking).count()


def test_layout_of_the_table_does_not_matter(spark):
    """One stored map, two layouts: the same records in every shard, those of divided slots too."""
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id") % 700).alias("text"),
    )
    rows = rows.unionByName(spark.range(900).select(F.lit(8).cast("long").alias("doc_id"), F.lit("a copy").alias("text")))
    measured = slots.measure(rows, "doc_id", "text", 64)
    parts = slots.slot_parts(measured, 64)
    slot_map = slots.first_map(slots.placed(measured, parts), parts, 4)
    assert slot_map.filter("parts > 1").count() > 5
    found = []
    for layout in (rows.coalesce(1), rows.repartition(7, "text"), rows.orderBy(F.rand(3))):
        sharded = slots.shard_records(layout, 4, slots=64, slot_map=slot_map)
        found.append(sorted(map(tuple, sharded.drop("slot").collect())))
    assert found[0] == found[1] == found[2]


def test_a_column_of_the_folders_name(spark, tmp_path):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("mine").alias("_shard"))
    slots.write_shards(docs, str(tmp_path / "shards"), 2)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 50 and back.filter("_shard = 'mine'").count() == 50 and "__shard" in back.columns
