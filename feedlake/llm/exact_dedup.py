"""Exact de-duplication with a two-pass Bloom filter.

Pass 1 sets, for every row, ``K`` bits of a blocked Bloom filter and finds the
bits that rows set more than once; pass 2 looks every row's bits up, in place.  A
row with a bit that nobody else sets is unique for certain and passes straight
through; only possibly repeated rows are shuffled by hash, where the decision is
made exactly on SHA-256.

The filter takes ``BITS_PER_ROW`` bits a row at every size, in blocks of 32,768
bits (4 KB).  What pass 1 shuffles is (block, bit, count), at most ``K`` a distinct
text and task, combined map-side.  Pass 2 broadcasts the blocks with repeated bits,
at most ``BROADCAST_BYTES`` of them at a time: a larger filter is looked up in as
many turns, each over the rows of its own blocks, which are written apart once.  So
no row that is unique for certain crosses a shuffle, at any size.

Null text counts as empty.  Rows with equal normalised texts form a group, rows
repeated with the same id count each; the largest id stays (a null id only if
all are null).  Empty input gives no rows.  Columns of the input other than the
id and the text are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, join_groups, stage, without

BLOCK = 32768          # bits of one bitmap of bitmap_construct_agg
K = 2                  # bits a row sets, both in one block
BITS_PER_ROW = 16
BROADCAST_BYTES = 256 << 20      # bitmaps that one turn of pass 2 broadcasts


def normalised(text: Column) -> Column:
    return F.coalesce(ascii_lower(text), F.lit(""))


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sha) of every row; ``sha`` is the SHA-256 of the normalised text."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       _sha(F.col(text_col)).alias("sha"))


def _bits(sha: Column) -> Column:
    """The K bit positions inside the row's block."""
    return F.array_distinct(F.array(*[F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(BLOCK)) for i in range(K)]))


def possibly_repeated(prints: DataFrame, rows: int) -> DataFrame:
    """Staged ``prints`` with ``maybe``: true where all of the row's bits are set by more than one row."""
    blocks = max(1, -(-rows * BITS_PER_ROW // BLOCK))
    keyed = prints.withColumn("block", F.pmod(F.xxhash64("sha", F.lit(-1)), F.lit(blocks)))
    # Counting per bit combines map-side, so copies of one text cost one row a task.
    twice = stage(keyed.select("block", F.explode(_bits(F.col("sha"))).alias("bit"))
                  .groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                  .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "bitmaps")
    at_once = max(1, BROADCAST_BYTES // (BLOCK // 8))
    turns = -(-blocks // at_once)
    if turns == 1:
        return _looked_up(keyed, twice)
    keyed = stage(keyed.withColumn("turn", F.floor(F.col("block") / at_once)), "turns", partition_by="turn")
    out = None
    for t in range(turns):          # one after another: each broadcasts its own blocks
        own = (F.col("block") >= t * at_once) & (F.col("block") < (t + 1) * at_once)
        part = stage(_looked_up(keyed.where(F.col("turn") == t), twice.where(own)), f"turn{t}")
        out = part if out is None else out.unionByName(part)
    return out


def _looked_up(keyed: DataFrame, twice: DataFrame) -> DataFrame:
    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bitmap"), (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1

    joined = keyed.join(F.broadcast(twice), "block", "left")         # at most BROADCAST_BYTES
    maybe = F.coalesce(F.forall(_bits(F.col("sha")), is_set), F.lit(False))
    return joined.select("doc_id", "sha", maybe.alias("maybe"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    total = prints.count()
    marked = stage(possibly_repeated(prints, total), "marked")
    hexed = F.lower(F.hex("sha")).alias("text_sha256")

    alone = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), hexed)

    rest = marked.where("maybe")
    groups = stage(rest.groupBy("sha").agg(F.max("doc_id").alias("keep_id"),
                                           F.count(F.lit(1)).alias("group_size")), "groups")
    repeated = join_groups(rest, groups, "sha", "group_size", total).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), hexed)
    return alone.unionByName(repeated)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay: one per normalised text, with all their columns.

    A row leaves only if a row with its id and its text is not kept, so null or reused
    ids cost no other text; rows that share both id and text stay or go together.
    The texts of one id are told apart by a 64-bit hash of their SHA-256.
    """
    gone = stage(exact_groups(docs, id_col, text_col).where(~F.col("kept"))
                 .select(F.col("doc_id").alias("_gone"), F.xxhash64(F.unhex("text_sha256")).alias("_gone_mark")).distinct(), "gone")
    return without(docs, gone, id_col, F.xxhash64(_sha(docs[text_col])))
