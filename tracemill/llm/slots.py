"""Shards from virtual slots, in DataFrame functions only.

Records are hashed into thousands of virtual slots. Slots, not records, belong to
shards: a small map says which, by the bytes each slot holds, and has a version.
Rebalancing edits the map and moves no more slots than it must.

A slot with far more bytes than the others, as one id with very many rows makes, is
dealt into parts that the map treats as slots of their own. A record's part follows from its
key and text, and among exact copies from their number, so with a stored map a record's
shard does not depend on how a table is laid out. The map therefore has at
most twice as many rows as there are slots, whatever the data. It has every slot and every
part, those without rows too, so that later rows find an owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracemill.operators.running import running_start
from tracemill.sources.staging import stage

SLOTS = 4096
MAP_FIELDS = ("version", "virtual_slot", "part", "parts", "slot_rows", "slot_bytes", "shard")


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes plus one for the record's end; one for a null text."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0).cast("long"))


def slot_of(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def measure(docs: DataFrame, key: str, text: str, slots: int) -> DataFrame:
    """The key, size, checksum and slot of every row, stored with a row number.

    The number only tells rows apart. It is stored, so a task that runs again
    cannot number rows differently.
    """
    narrow = docs.select(
        F.col(key).alias("record"),
        utf8_size(F.col(text)).alias("size"),
        text_crc32(F.col(text)).alias("text_crc32"),
        slot_of(F.col(key), slots).alias("virtual_slot"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stage(narrow, "slot-records")


def slot_parts(measured: DataFrame, slots: int) -> DataFrame:
    """``virtual_slot, parts`` of every slot: those beyond twice the mean size are dealt into parts."""
    sums = measured.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    total = sums.agg(F.sum("bytes").alias("total"))
    share = F.greatest(F.ceil(F.col("total") / slots), F.lit(1))
    whole = F.col("bytes") <= 2 * share
    parts = F.when(whole, 1).otherwise(F.ceil(F.col("bytes") / share)).cast("int")
    every = measured.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    # At most `slots` rows, and one row beside them.
    filled = sums.join(F.broadcast(total)).select("virtual_slot", parts.alias("parts"))
    return every.join(F.broadcast(filled), "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("parts", F.lit(1)).alias("parts")
    )


IDENTITY = ("record", "text_crc32", "size")


def placed(measured: DataFrame, parts: DataFrame) -> DataFrame:
    """Measured rows with the part of their slot; ``parts`` has a row per slot.

    Rows of divided slots are dealt out by key, checksum and size, copies of one record by
    their number among them; which copy has which number makes no difference. Only these
    rows are numbered. Rows of a slot that is not there get part -1, which no map has.
    """
    joined = measured.join(F.broadcast(parts), "virtual_slot", "left")
    divided = F.coalesce(F.col("parts") > 1, F.lit(False))
    part = F.when(F.col("parts").isNull(), -1).otherwise(0)
    rest = joined.filter(~divided).select("*", part.alias("part"))
    light = joined.filter(divided).select(*IDENTITY, "row", F.lit(1).alias("one"))
    copies = running_start(light, IDENTITY, ["row"], "one", "copy").select("row", "copy")
    whole = joined.filter(divided).join(copies, "row").select(*joined.columns, "copy")
    part = F.pmod(F.xxhash64(*IDENTITY, "copy"), F.col("parts")).cast("int")
    return rest.unionByName(whole.withColumn("part", part).drop("copy"))


def owned(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Placed rows with their shard; a row whose slot or part the map lacks is an error."""
    # At most 2 * slots rows.
    owners = slot_map.select("virtual_slot", "part", F.col("shard").alias("owner"))
    joined = rows.join(F.broadcast(owners), ["virtual_slot", "part"], "left")
    missing = F.concat(F.lit("the map has no owner of slot "), F.col("virtual_slot").cast("string"))
    shard = F.when(F.col("owner").isNull(), F.raise_error(missing)).otherwise(F.col("owner"))
    return joined.select(*rows.columns, shard.cast("int").alias("shard"))


def slot_totals(rows: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Rows and bytes by slot and part; with ``parts`` of every slot also where there are none."""
    totals = rows.groupBy("virtual_slot", "part", "parts").agg(
        F.count("*").alias("slot_rows"), F.sum("size").alias("slot_bytes")
    )
    return totals if parts is None else every_part(totals, parts)


def every_part(totals: DataFrame, parts: DataFrame) -> DataFrame:
    """Totals with a row for each part from 0 on, of size 0 where nothing is known."""
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    every = parts.select("virtual_slot", part, "parts")
    count = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return every.join(F.broadcast(totals.drop("parts")), ["virtual_slot", "part"], "left").select(
        *every.columns, count("slot_rows"), count("slot_bytes")
    )


def initial_map(totals: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """Deal the slots out by size, back and forth over the shards.

    Shards then differ by no more than the largest slot. The ranking is one task
    over the map, whose size is bounded by the number of slots.
    """
    order = Window.orderBy(F.desc("slot_bytes"), "virtual_slot", "part")
    rank = F.row_number().over(order) - 1
    place, turn = F.pmod("rank", F.lit(shards)), F.floor(F.col("rank") / shards)
    shard = F.when(turn % 2 == 0, place).otherwise(shards - 1 - place)
    dealt = totals.select("*", rank.alias("rank"))
    return dealt.select(
        F.lit(version).alias("version"), *MAP_FIELDS[1:-1], shard.cast("int").alias("shard")
    )


def rebalance(current: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for new totals and perhaps more shards.

    Each shard keeps its slots, largest first, while they fit into an even share;
    the rest, and slots new to the map, fill what room the shards have left. Room
    and moving slots are laid out along one line of bytes, and a slot goes to the
    shard at its middle. Slots that stay are not touched, nor are empty ones with a shard;
    empty ones without are dealt out in turn. Slots of the map that ``totals`` lacks are empty.
    """
    lacking = current.join(F.broadcast(totals.select("virtual_slot")), "virtual_slot", "left_anti")
    fields = ["virtual_slot", "parts"]
    totals = every_part(totals, totals.select(*fields).unionByName(lacking.select(*fields)).distinct())
    known = current.select("version", "virtual_slot", "part", "shard")
    version = current.agg((F.max("version") + 1).alias("next"))
    keys = ["virtual_slot", "part"]
    state = totals.join(F.broadcast(known.drop("version")), keys, "left")
    state = state.withColumn("shard", F.when(F.col("shard") < shards, F.col("shard")))
    everything = Window.partitionBy()
    share = (F.sum("slot_bytes").over(everything) / shards).alias("share")
    held = Window.partitionBy("shard").orderBy(F.desc("slot_bytes"), *keys)
    upto = F.sum("slot_bytes").over(held.rowsBetween(Window.unboundedPreceding, 0))
    state = state.select("*", share, upto.alias("upto"))
    empty = F.col("slot_bytes") == 0
    stays = F.col("shard").isNotNull() & (empty | (F.col("upto") <= F.col("share")))
    staying, moving = state.filter(stays), state.filter(~stays & ~empty)
    dealt = state.filter(~stays & empty).withColumn("shard", F.pmod(F.col("virtual_slot") + F.col("part"), F.lit(shards)))

    spark = totals.sparkSession
    used = staying.groupBy("shard").agg(F.sum("slot_bytes").alias("used"))
    even = totals.agg((F.sum("slot_bytes") / shards).alias("share"))
    room = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    room = room.join(F.broadcast(used), "shard", "left").join(F.broadcast(even))
    room = room.select("shard", (F.col("share") - F.coalesce("used", F.lit(0))).alias("room"))
    line = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    room = room.select("shard", F.sum("room").over(line).alias("to"), "room")
    start, last = F.col("to") - F.col("room"), F.col("shard") == shards - 1
    end = F.when(last, F.lit(float("inf"))).otherwise(F.col("to"))
    room = room.select("shard", end.alias("to"), start.alias("from"))
    along = Window.orderBy(F.desc("slot_bytes"), *keys)
    middle = F.sum("slot_bytes").over(along.rowsBetween(Window.unboundedPreceding, 0))
    moving = moving.drop("shard").select("*", (middle - F.col("slot_bytes") / 2).alias("middle"))
    within = (F.col("middle") >= F.col("from")) & (F.col("middle") < F.col("to"))
    moved = moving.join(F.broadcast(room), within)
    fields = MAP_FIELDS[1:]
    edited = staying.select(*fields).unionByName(moved.select(*fields)).unionByName(dealt.select(*fields))
    return edited.join(F.broadcast(version)).select(F.col("next").alias("version"), *fields)


def first_map(rows: DataFrame, parts: DataFrame, shards: int) -> DataFrame:
    """The stored map of placed rows: dealt out, then evened out once."""
    totals = stage(slot_totals(rows, parts), "slot-totals")
    return stage(rebalance(initial_map(totals, shards, version=0), totals, shards), "slot-map")


def save_map(slot_map: DataFrame, folder: str) -> None:
    """Add a version to the folder; versions that are there stay as they are."""
    version = slot_map.first()["version"]
    slot_map.drop("version").write.parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """One version of the map, or the last."""
    versions = spark.read.parquet(folder)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == version).select(*MAP_FIELDS)


def number_rows(rows: DataFrame) -> DataFrame:
    """Places in the shards, gapless from 0.

    Rows are numbered inside their part of a slot; the parts of a shard follow each
    other. No task sees more than one part.
    """
    unit = ["virtual_slot", "part"]
    numbered = Window.partitionBy(*unit).orderBy("record", "row")
    before = Window.partitionBy("shard").orderBy(*unit)
    starts = rows.groupBy("shard", *unit).agg(F.count("*").alias("held"))
    start = F.sum("held").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("held")
    starts = starts.select(*unit, start.alias("start"))
    placed = rows.select("*", (F.row_number().over(numbered) - 1).alias("inner"))
    return placed.join(F.broadcast(starts), unit).select(
        "*", (F.col("start") + F.col("inner")).cast("long").alias("slot")
    ).drop("inner", "start")


def shard_records(
    docs: DataFrame,
    shards: int = 8,
    key: str = "doc_id",
    text: str = "text",
    slots: int = SLOTS,
    slot_map: DataFrame | None = None,
) -> DataFrame:
    """Every row's ``size, text_crc32, virtual_slot, part, shard, slot``.

    Shards are near equal in bytes. Without ``slot_map`` a first one is made from
    the data. A map without the slot or part of a row is an error. A null text has size 1 and checksum 0; rows with a null key share a
    slot, which is dealt into parts if it is large. Copied rows each get a place of
    their own. Columns of ``docs`` other than the two named are not looked at.
    """
    measured = measure(docs, key, text, slots)
    if slot_map is None:
        parts = slot_parts(measured, slots)
        rows = placed(measured, parts)
        slot_map = first_map(rows, parts, shards)
    else:
        rows = placed(measured, slot_map.select("virtual_slot", "parts").distinct())
    return number_rows(owned(rows, slot_map)).select(
        F.col("record").alias(key), "size", "text_crc32", "virtual_slot", "part", "shard", "slot"
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = 8, key: str = "doc_id", text: str = "text",
    slots: int = SLOTS,
) -> DataFrame:
    """Write whole records into folders ``_shard=0`` and so on; returns the slot map.

    Tasks write what they have read; only rows of divided slots are moved. Null texts and
    keys, copies and columns of any name are written as they are; if there is a column
    ``_shard``, the folders' name gets another ``_`` in front. Without rows nothing but an
    empty folder is written.
    """
    numbered = docs.select(
        F.struct(*docs.columns).alias("_record"),
        F.col(key).alias("record"),
        text_crc32(F.col(text)).alias("text_crc32"),
        slot_of(F.col(key), slots).alias("virtual_slot"),
        utf8_size(F.col(text)).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    folder = "_shard"
    while folder in docs.columns:
        folder = f"_{folder}"
    whole = stage(numbered, "slot-documents")
    measured = whole.drop("_record")
    parts = slot_parts(measured, slots)
    slot_map = first_map(placed(measured, parts), parts, shards)
    dealt = placed(whole, slot_map.select("virtual_slot", "parts").distinct())
    sharded = owned(dealt, slot_map).select("_record.*", F.col("shard").alias(folder))
    sharded.write.partitionBy(folder).parquet(path)
    return slot_map
