"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

All of it is DataFrame operations. Every source's documents are shuffled by hash into one stream of words, which is cut
into equal blocks; the stream starts again when the target is larger than the source, up to `MAX_REPEATS` times. Slot i
of the schedule draws the point frac((i + 1/2) * golden ratio), whose place among the cumulative target shares names the
source; the slots of a source, in order, take its blocks. Golden-ratio points fill the unit interval evenly, so that
every stretch of the schedule is close to the target mix. A source's slots share its target in equal blocks, so its
words meet the target whatever the rounding of slots.

Defined results: a null text has 0 words; a null source is a source of its own, last in the order; repeated rows are
documents of their own; if no text has a word, all targets and counts are 0; an empty table gives an empty result;
further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from arrivo.operators.running import running_totals
from arrivo.session import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 2048
CELLS = 1024
GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"
SLOT_BUCKET = 65536
HASH_BITS, STREAM_BUCKETS = 60, 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(id_col: str) -> Column:
    """Position of a document in the shuffle: the first 60 bits of md5 of the id as text."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """Per source: number (by code point, null last), source_size, target and the bounds of its share of [0, 1).

    Sources are filled like basins: in the order of size / weight, a source stops at `most` times its size as long as
    that is below the level that the remaining words give per unit of weight. The windows order one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    numbered = sources.withColumn("number", F.row_number().over(by_name) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = numbered.withColumn("weight", F.get(cycle, F.col("number") % len(weights))).withColumn("limit", F.col("source_size") * float(most))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    earlier, later = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    filled = weighed.withColumn("_level", level)
    target = F.least(F.col("limit"), F.col("weight") * F.max("_level").over(everything))
    shared = filled.withColumn("target", target).withColumn("words", F.round(target).cast("long"))
    upto = F.sum("words").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.greatest(F.sum("words").over(everything), F.lit(1))
    return shared.select("source", "number", "source_size", "target", "words", ((upto - F.col("words")) / whole).alias("low"), (upto / whole).alias("high"))


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """Slot, source number and the rank of the slot among those of its source.

    Point and share meet in one of `CELLS` cells of the unit interval, so that the join has a key. A source whose share
    no point hits gets one slot at the end.
    """
    spark = targets.sparkSession
    cells = F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))
    shares = targets.where("words > 0").select("number", "low", "high", F.explode(cells).alias("cell"))
    turn = (F.col("id") + 0.5) * GOLDEN
    points = spark.range(slots).select(F.col("id").alias("slot"), (turn - F.floor(turn)).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS))
    drawn = points.join(shares, "cell").where("point >= low AND point < high").select("slot", "number")
    missed = targets.where("words > 0").join(drawn.select("number").distinct(), "number", "left_anti")
    drawn = drawn.unionByName(missed.select((F.lit(slots) + F.col("number")).alias("slot"), "number")).withColumn("one", F.lit(1))
    ranked = running_totals(drawn, ["number"], "slot", F.floor(F.col("slot") / SLOT_BUCKET), ["one"])
    return ranked.select("slot", "number", F.col("before_one").alias("rank"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, weights=WEIGHTS, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The written table of documents (row, doc_id, source number, size, ...) and the pieces that the schedule takes.

    `row` numbers the documents; without it they are numbered as they are written.

    A piece is a run of words of one document in one slot: slot, number, row, doc_id, first (word of the document),
    length. Ordered by slot the pieces are the mixed corpus.
    """
    number = F.monotonically_increasing_id() if row is None else row
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), place("doc_id").alias("place"), number.alias("row"))
    sized = materialize(base, "sizes")
    targets = materialize(source_targets(sized, weights).coalesce(1), "targets")
    total = targets.agg(F.sum("words")).first()[0] or 0
    slots = materialize(schedule(targets, -(-total // block_words)), "schedule")
    per_source = slots.groupBy("number").agg(F.count("*").alias("slots"))
    blocks = targets.join(per_source, "number", "left").withColumn("block", F.ceil(F.col("words") / F.greatest(F.coalesce("slots", F.lit(1)), F.lit(1))))
    known = sized.join(blocks, sized["source"].eqNullSafe(blocks["source"])).select(sized["*"], "number", "source_size", "target", "words", "block")
    documents = materialize(known.drop("source"), "documents")
    order = documents.where("size > 0 AND words > 0").withColumn("key", F.struct("place", "doc_id", "size", "row"))
    bucket = F.shiftright("place", HASH_BITS - STREAM_BUCKETS.bit_length() + 1)
    streamed = running_totals(order, ["number"], "key", bucket, ["size"])
    # the stream begins again while the target reaches beyond the source
    turns = F.sequence(F.lit(0), F.ceil(F.col("words") / F.col("source_size")).cast("int") - 1)
    turned = streamed.withColumn("turn", F.explode(turns)).withColumn("begin", F.col("before_size") + F.col("turn") * F.col("source_size"))
    turned = turned.withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("words"))).where("begin < end")
    ranks = F.sequence(F.floor(F.col("begin") / F.col("block")), F.floor((F.col("end") - 1) / F.col("block")))
    cut = turned.withColumn("rank", F.explode(ranks))
    start, stop = F.greatest("begin", F.col("rank") * F.col("block")), F.least("end", (F.col("rank") + 1) * F.col("block"))
    cut = cut.select("number", "rank", "row", "doc_id", (start - F.col("begin")).alias("first"), (stop - start).alias("length"))
    return documents, cut.join(slots, ["number", "rank"]).select("slot", "number", "row", "doc_id", "first", "length")


def taken_words(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    taken = pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    joined = documents.join(taken, "row", "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "row")



def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, weights=WEIGHTS) -> DataFrame:
    """The mixed corpus by documents: each row, with all columns, as often as the schedule takes its words.

    Parts of a document are rounded to whole ones; only the last document of a source can be taken in part.
    """
    columns = docs.columns
    number = "_row"
    while number in columns:
        number = f"_{number}"
    stored = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    documents, pieces = mix(stored, block_words, weights, F.col(number))
    copies = taken_words(documents, pieces).where("taken > 0").select("row", F.round(F.col("taken") / F.col("size")).cast("int").alias("copies"))
    repeats = copies.where("copies > 0").select(F.col("row").alias(number), F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy")
    return stored.join(repeats, number).select(*columns)
