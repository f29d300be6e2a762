"""Sharding on a consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

The ring has ``RING`` places. Each shard owns ``virtual_nodes`` of them, drawn by a hash; a place without a node belongs
to the next node clockwise. A row's id hashes to a place. Every shard takes a fixed number of rows (its share, so that
counts differ by one at most: law ``rows``); the rows of a place that no longer fit continue clockwise to the next node
whose shard has room, in ring order. Only the number of rows at each place decides how many of them go where, so the
plan is made from ``RING`` counts, whatever the number of rows; a row finds its shard and slot by its rank at its place.
Most rows stay at their first node; only the overflow moves.

Defined results: null text has size 1 and the checksum of the empty text; a null id hashes like any other value;
repeated rows are placed each; an empty table gives an empty table; other columns are ignored.
"""
from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, texts, written

RING = 4096
VIRTUAL_NODES = 64


def ring_nodes(spark, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Sorted (place, shard) of the virtual nodes; of two nodes at one place the smaller shard owns it."""
    nodes = spark.range(shards * virtual_nodes).select(
        F.expr(f"pmod(xxhash64('node', id div {virtual_nodes}, id % {virtual_nodes}), {RING})").alias("place"),
        F.expr(f"cast(id div {virtual_nodes} as int)").alias("shard"))
    return sorted((r["place"], r["shard"]) for r in nodes.groupBy("place").agg(F.min("shard").alias("shard")).collect())


def clockwise_plan(counts: dict[int, int], nodes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(place, first rank, end rank, shard, first slot): which ranks of a place go to which shard.

    ``counts`` has at most ``RING`` entries. Shard i takes ``n // shards`` rows, the first ``n % shards`` one more."""
    n = sum(counts.values())
    room = [n // shards + (i < n % shards) for i in range(shards)]
    # a shard whose nodes all lost their places still takes its share, after all others
    owners = nodes + [(RING + s, s) for s in range(shards) if s not in {s for _, s in nodes}]
    places, used, plan, over = [p for p, _ in owners], [0] * shards, [], []
    order = {}
    for i in range(len(owners)):  # shards in the order in which their nodes come, clockwise from node i
        order[i] = list(dict.fromkeys(s for _, s in owners[i:] + owners[:i]))

    def put(place: int, first: int, end: int, shard: int) -> int:
        take = min(end - first, room[shard])
        if take:
            plan.append((place, first, first + take, shard, used[shard]))
            room[shard] -= take
            used[shard] += take
        return first + take

    for place in sorted(counts):
        node = bisect_left(places, place) % len(owners)
        rest = put(place, 0, counts[place], owners[node][1])
        if rest < counts[place]:
            over.append((place, rest, counts[place], node))
    for place, first, end, node in over:
        for shard in order[node][1:]:
            first = put(place, first, end, shard)
    return plan


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
               virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """One row for each input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, moved``.

    ``moved``: the row overflowed its first node. ``grown_shard`` is null: law ``rows`` bounds counts, not movement."""
    raw = texts(docs, id_col, text_col)
    d = raw.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
                   F.crc32(F.col("text").cast("binary")).cast("long").alias("text_crc32"))
    d = d.withColumn("_h", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    d = written(d.withColumn("place", F.pmod("_h", F.lit(RING))), "ring-rows")
    spark = d.sparkSession
    counts = {r["place"]: r["n"] for r in d.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}  # RING rows
    nodes = ring_nodes(spark, shards, virtual_nodes)
    plan = clockwise_plan(counts, nodes, shards)
    home = {p: nodes[bisect_left([x for x, _ in nodes], p) % len(nodes)][1] for p in counts}
    schema = "place long, first long, end long, shard int, first_slot long, home int"
    table = spark.createDataFrame([(*r, home[r[0]]) for r in plan], schema)
    spread = F.pmod(F.xxhash64(F.col("_h"), F.col("text_crc32"), F.col("size"), F.lit("cell")), F.lit(1 << 62))
    r = ranked(d, ["place"], ["doc_id", "size", "text_crc32"], spread, sum(counts.values()) // RING, "rank")
    r = r.join(F.broadcast(table), "place").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    return r.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("first_slot") + F.col("rank") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), (F.col("shard") != F.col("home")).alias("moved"))
