"""Exact dedup by deterministic block naming (DataFrame functions only).

A normalised text (A-Z lower-cased, nothing else) is cut into blocks of ``block_bytes`` bytes. The distinct blocks are
sorted - by a 64-bit hash first, by content inside equal hashes - and numbered in that order: the number is the block's
name, equal for equal blocks and different for different ones, whatever the hash does. Then neighbours are named: the
distinct pairs of names of a level are sorted and numbered, until every document has one name. Two texts are equal if
and only if they needed as many levels and ended with the same name.

Block contents move once, as distinct blocks (combined before the shuffle); everything after that moves integers. A
block that a third of all documents hold is one row of the name table, and its occurrences are small rows of a join
that Spark can split.

Defined results: null text = empty text; the empty text is one empty block; a repeated row (same id, same text) counts
as often as it occurs and each occurrence is returned; a null id never stays unless its whole group has none; an empty
table gives an empty table; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import texts, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 4096


def lower_az(text: Column) -> Column:
    """A-Z lower-cased and no other letter; pure ASCII takes the quicker built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _blocks(norm: DataFrame, block_bytes: int) -> DataFrame:
    """One row for each block: ``doc_id, text_sha256, idx, n_blocks, block, h``; the empty text has one empty block.

    The outer explode keeps the optimizer from adding a filter that would cut every text a second time."""
    b = int(block_bytes)
    cut = F.expr(f"transform(sequence(0L, greatest(0L, (length(bin) - 1L) div {b}L)), "
                 f"i -> substring(bin, cast(i * {b} + 1 as int), {b}))")
    d = norm.select("doc_id", "text_sha256", cut.alias("blocks"))
    return d.select("doc_id", "text_sha256", F.size("blocks").alias("n_blocks"),
                    F.posexplode_outer("blocks").alias("idx", "block")).withColumn("h", F.xxhash64("block"))


def _names(distinct: DataFrame, cols: list[str], rows: int) -> DataFrame:
    """Distinct rows of ``cols`` sorted and numbered from 0: ``cols, name``."""
    # the top bits of a hash cut the order into ranges of like size; one row for each range carries the running count
    cells = 1 << max(0, min(14, (max(1, rows) // 1024).bit_length()))
    d = distinct.withColumn("_range", F.pmod(F.xxhash64(*cols), F.lit(cells)))
    sizes = d.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most 16,384 rows
    first = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*cols)) - 1
    return d.withColumn("_local", local).join(F.broadcast(first), "_range").select(
        *cols, (F.col("_first") + F.col("_local")).cast("long").alias("name"))


def block_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """``doc_id, text_sha256, times, level, name`` of each distinct (id, text), ``times`` being the rows that have it:
    equal texts have equal (level, name).

    ``hash_bits`` shortens the sort hash; the result does not depend on it (tests use 2 bits)."""
    t = texts(docs, id_col, text_col).withColumn("norm", lower_az(F.col("text")))
    norm = t.select("doc_id", F.col("norm").cast("binary").alias("bin"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
    occ = _blocks(norm, block_bytes)
    if hash_bits < 64:
        occ = occ.withColumn("h", F.shiftrightunsigned("h", 64 - hash_bits))
    # rows without content; the distinct blocks carry the content once
    slim = written(occ.groupBy("doc_id", "text_sha256", "n_blocks", "idx", "h").agg(F.count(F.lit(1)).alias("times")), "block-rows")
    sorted_blocks = occ.select("h", "block").distinct()
    per_hash = written(sorted_blocks.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "block-hashes")
    n_hashes = per_hash.count()
    if per_hash.where("n > 1").limit(1).count() == 0:
        names = _names(per_hash.select("h"), ["h"], n_hashes)
        cur = slim.join(names, "h")
    else:  # different blocks with one hash: those take their names from hash and content together
        clash = per_hash.where("n > 1").select("h")
        own = occ.join(clash, "h", "left_semi").groupBy("doc_id", "text_sha256", "n_blocks", "idx", "h", "block").agg(F.count(F.lit(1)).alias("times"))
        both = per_hash.where("n = 1").select("h", F.lit(None).cast("binary").alias("block")).unionByName(
            own.select("h", "block").distinct())
        names = written(_names(both, ["h", "block"], n_hashes), "block-names")
        lone, many = names.where("block is null").drop("block"), names.where("block is not null")
        cur = slim.join(lone, "h").select("doc_id", "text_sha256", "times", "n_blocks", "idx", "name").unionByName(
            own.join(many, ["h", "block"]).select("doc_id", "text_sha256", "times", "n_blocks", "idx", "name"))
    cur = written(cur.select("doc_id", "text_sha256", "times", F.col("n_blocks").cast("long").alias("n_blocks"),
                             F.col("idx").cast("long").alias("idx"), "name"), "names-0")
    done = cur.where("n_blocks = 1").select("doc_id", "text_sha256", "times", F.lit(0).alias("level"), "name")
    level, open_rows = 0, cur.where("n_blocks > 1")
    rows = open_rows.count()
    while rows:
        level += 1
        # what one block of this level covers: two of the level below; the last may stand alone (right = -1)
        pairs = written(open_rows.groupBy("doc_id", "text_sha256", "times", "n_blocks", F.expr("idx div 2").alias("pair")).agg(
            F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")), f"pairs-{level}")
        names = _names(pairs.select("a", "b").distinct(), ["a", "b"], rows)
        nxt = written(pairs.join(names, ["a", "b"]).select(
            "doc_id", "text_sha256", "times", F.expr("(n_blocks + 1) div 2").alias("n_blocks"), F.col("pair").alias("idx"), "name"), f"names-{level}")
        done = done.unionByName(nxt.where("n_blocks = 1").select("doc_id", "text_sha256", "times", F.lit(level).alias("level"), "name"))
        open_rows = nxt.where("n_blocks > 1")
        rows = open_rows.count()
    return done


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row for each input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal normalised texts the row with the largest id stays; of repeated rows with that id, all say ``kept``."""
    named = written(block_identities(docs, id_col, text_col, block_bytes, hash_bits), "identities")
    keys = ["level", "name"]
    groups = named.groupBy(*keys).agg(F.max("doc_id").alias("keep_id"), F.sum("times").cast("long").alias("group_size"))
    # a group with more than its share of the rows would be one task of a shuffled join: there are fewer such groups than
    # partitions, so their rows (one a group) are sent to all tasks, and only the other groups are shuffled
    parts = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = (named.agg(F.sum("times")).first()[0] or 0) / parts
    large = F.broadcast(groups.where(F.col("group_size") > share))
    small = named.join(large, keys, "left_anti").join(groups.where(F.col("group_size") <= share), keys)
    out = named.join(large, keys).select(*small.columns).unionByName(small)
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
