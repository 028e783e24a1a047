"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, and of a text that has
none there its least hash alone, so that no text with words is blank. Which hashes it keeps never
depends on a document's length, so sketches merge: the sketch of a union is made from the union of
the sketches, and containment can be estimated between a page and a book. The fingerprint is the
sorted hashes in hex, joined by commas.

Shingles are five consecutive words; a text of one to four words is one shingle. Likeness is a
function of the two fingerprints alone: the share of the smaller sketch that the other one holds,
1 for equal ones.

Cases: a null or blank text has an empty fingerprint, which is like another empty one (1) and
nothing else (0); equal texts have equal fingerprints; rows that share a ``doc_id`` follow each
other by text; a null ``doc_id`` sorts first; the only row of a table is its own successor;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, range_bounds, range_bucket, table

#: Words of a shingle, and the share of the hash range that a sketch keeps (one in ``ONE_IN``).
SHINGLE, ONE_IN = 5, 2
#: Documents of a range: what one task sorts at once.
ROWS_PER_RANGE = 2_000


def _least(hashes: Column, one_in: int) -> Column:
    """Of hashes in order, those below the threshold, or the least one."""
    most = -(2**63) + 2**64 // one_in - 1
    low = F.filter(hashes, lambda h: h <= most)
    return F.when(F.size(low) == 0, F.slice(hashes, 1, 1)).otherwise(low) if one_in > 1 else hashes


def sketch(text: Column, shingle: int = SHINGLE, one_in: int = ONE_IN) -> Column:
    """Sorted distinct shingle hashes below the threshold, as ``array<bigint>``."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0)))
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]))
        kept = F.get(F.transform(F.array(F.array_sort(F.array_distinct(hashes))), lambda h: _least(h, one_in)), 0)
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(kept)

    # transform over a one-element array binds the words once.
    return F.get(F.transform(F.array(words), of), 0)


def fingerprint(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda h: F.lower(F.hex(h))), ",")


def containment(a: Column, b: Column) -> Column:
    """Share, estimated from the sketches, of the smaller document's shingles that are in the other one."""
    least = F.least(F.size(a), F.size(b))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).when(least == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def merged(sketches: Column, one_in: int = ONE_IN) -> Column:
    """Aggregate: the sketch of a union of documents, from their sketches."""
    return _least(F.array_sort(F.array_distinct(F.flatten(F.collect_list(sketches)))), one_in)


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id, text, sketch, next_text, next_sketch`` with one shuffle of the texts.

    Documents are dealt to ranges of ids. The first document of each range also goes, as a
    ghost, to the range before it (and the very first to the last), so that every range
    knows all its successors.
    """
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = range_bounds(slim, "doc_id", rows_per_range)
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    dealt = slim.withColumn("_range", range_bucket(F.col("doc_id"), bounds))
    heads = dealt.groupBy("_range").agg(F.min(key).alias("_head"))
    # One row for each range, at most 20,001.
    order = Window.orderBy("_range")
    heads = heads.select("_head", F.coalesce(F.lag("_range").over(order), F.max("_range").over(Window.partitionBy())).alias("_to"), F.lag("_range").over(order).isNull().alias("_wraps"))
    ghosts = dealt.withColumn("_key", key).join(F.broadcast(heads), F.col("_key") == F.col("_head")).select("doc_id", "text", F.col("_to").alias("_range"), F.lit(True).alias("_ghost"), "_wraps")
    rows = dealt.select("doc_id", "text", "_range", F.lit(False).alias("_ghost"), F.lit(False).alias("_wraps")).unionByName(ghosts)
    n = max(len(bounds) + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = Window.partitionBy("_range").orderBy("_wraps", F.col("doc_id").asc_nulls_first(), "text", "_ghost")
    return (
        rows.repartition(n, "_range")
        .withColumn("sketch", sketch(F.col("text")))
        .withColumn("next_text", F.lead("text").over(own))
        .withColumn("next_sketch", F.lead("sketch").over(own))
        .filter(~F.col("_ghost"))
        .select("doc_id", "text", "sketch", "next_text", "next_sketch")
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited")))

    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
