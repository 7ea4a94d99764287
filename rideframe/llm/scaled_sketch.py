"""Document fingerprints: every shingle hash below a fixed fraction of all hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rideframe.session import stage

WORDS = 5
#: One shingle hash in so many is retained; a power of two up to 16^4.
SCALE = 8
#: Hexadecimal digits of a hash that are kept.
DIGITS = 16
SPACES = " \t\n\x0b\f\r"
KEY = ["known", "id", "tie"]


def ceiling(scale: int) -> str:
    """The hexadecimal digits that a retained hash lies below, as text."""
    if scale < 1 or scale & (scale - 1) or scale > 1 << 16:
        raise ValueError("scale must be a power of two up to 65536")
    return "g" if scale == 1 else f"{(1 << 16) // scale:04x}"


def with_sketch(df: DataFrame, text: str, name: str, scale: int = SCALE, words: int = WORDS) -> DataFrame:
    """Add the sketch of a text column: a sorted array of hash texts.

    Words are runs of anything but ASCII white space, as they stand. A shingle is a run of
    ``words`` words, or all words of a shorter text; its hash is the first 16 hexadecimal digits
    of the MD5 of its words with one space between, the same in every engine. Hashes below the
    fraction 1 / ``scale`` of all hashes are retained, each once, or the smallest one where none
    is. Null and empty texts have an empty sketch.
    """
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))
    # Columns of their own, so that neither is worked out again for each shingle.
    held = df.withColumn("_words", split)
    starts = F.when(F.size("_words") == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.greatest(F.size("_words") - (words - 1), F.lit(1))))
    hashes = F.transform(starts, lambda i: F.left(F.md5(F.array_join(F.slice("_words", i, words), " ").cast("binary")), F.lit(DIGITS)))
    held = held.withColumn("_hashes", hashes).drop("_words")
    retained = F.array_sort(F.array_distinct(F.filter("_hashes", lambda h: h < ceiling(scale))))
    held = held.withColumn(name, retained)
    least = F.when(F.size("_hashes") > 0, F.array(F.array_min("_hashes"))).otherwise(F.col(name))
    return held.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(least)).drop("_hashes")


def merge_sketches(*sketches: Column, scale: int = SCALE) -> Column:
    """The sketch of all shingles of several texts, from their sketches alone."""
    together = F.array_sort(reduce(F.array_union, sketches))
    low = F.filter(together, lambda h: h < ceiling(scale))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(together, 1, 1))


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingles; two texts without a word are alike."""
    shared = _shared(a, b)
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has, however unequal they
    are in length; a text without a word lies in every text."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(_shared(a, b) / F.size(a))


def fingerprint(sketch: Column) -> Column:
    """The sketch as one text of hashes with commas between; ``read_fingerprint`` undoes it."""
    return F.array_join(sketch, ",")


def read_fingerprint(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def packed(sketch: Column) -> Column:
    """The sketch as bytes, eight for each hash, to be moved; ``unpacked`` undoes it."""
    return F.unhex(F.array_join(sketch, ""))


def unpacked(sketch: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.hex(sketch)), F.lit(f".{{{DIGITS}}}"), F.lit(0))


def next_keys(keys: DataFrame, ranges: int) -> DataFrame:
    """The key after each key in descending order of known, id and tie, the first one after the last.

    ``keys`` has distinct rows of known, id, tie and further columns, which stay. Keys are dealt
    out by range; the last key of a range is followed by the first key of the next range that
    has any, and of each range only that one is gathered.
    """
    order = [F.desc("known"), F.desc("id"), F.asc("tie")]
    dealt = stage(keys.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "key-ranges")
    own = F.struct(*KEY)
    inside = Window.partitionBy("part").orderBy(*order)
    placed = dealt.withColumn("following", F.lead(own).over(inside))
    firsts = dealt.withColumn("place", F.row_number().over(inside)).filter("place = 1").select("part", own.alias("first"))
    every = Window.orderBy("part")
    wrapped = F.first("first").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # One row per range: at most as many as there are shuffle partitions.
    firsts = stage(firsts.select("part", F.coalesce(F.lead("first").over(every), wrapped).alias("carried")), "range-starts")
    joined = placed.join(F.broadcast(firsts), "part").withColumn("following", F.coalesce("following", "carried"))
    return joined.select(*keys.columns, F.col("following.known").alias("next_known"), F.col("following.id").alias("next_id"), F.col("following.tie").alias("next_tie"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number = F.col("doc_id").cast("long")
    return docs.select(number.isNotNull().alias("known"), F.coalesce(number, F.lit(0)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def fingerprint_documents(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprint every whole text, and the same text with its last third replaced.

    Returns doc_id, n_chars, edited (the text whose last ``floor(n_chars / 3)`` code points are
    replaced by as many of the next document's first ones, or by all it has), sketch,
    edited_sketch, next_sketch, near_edited and near_next (``likeness`` of the sketch to the other two) and
    edited_holds (``containment`` of the sketch in that of the edited text) for every row. The next
    document is the one with the next smaller id, after the smallest the one with the largest;
    the only document is its own next one.

    Null ids come after all others, rows of one id in the order of a hash of their texts; rows
    that repeat id and text are one document and have the same result each. A null text is
    empty; an empty text stays empty when edited. Further columns are ignored; an empty table
    gives no rows.

    Texts move once, to a partition by their key; a document then sends its sketch and the
    part that is asked for, no more, to the document before it. The order is found on keys
    alone. No id, text or key needs a task of its own: equal rows are brought together before
    and after that one shuffle.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs)
    keys = keyed.select(*KEY, F.length("text").alias("n_chars")).groupBy(*KEY).agg(F.max("n_chars").alias("n_chars"))
    followed = next_keys(keys, ranges)
    asks = followed.select(
        F.col("next_known").alias("known"), F.col("next_id").alias("id"), F.col("next_tie").alias("tie"),
        F.struct("known", "id", "tie").alias("asker"), F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"),
    )
    held = with_sketch(keyed, "text", "sketch", scale).withColumn("sketch", packed(F.col("sketch")))
    unique = held.groupBy(*KEY).agg(F.first(F.struct("text", "sketch")).alias("doc")).select(*KEY, "doc.text", "doc.sketch")
    answers = unique.join(asks.hint("merge"), KEY).select("asker.*", F.substring("text", F.lit(1), F.col("wanted")).alias("head"), F.col("sketch").alias("next_sketch"))
    both = unique.join(answers.hint("merge"), KEY)
    n_chars = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - F.floor(n_chars / 3).cast("int")), F.col("head"))
    both = both.select(*KEY, n_chars.cast("long").alias("n_chars"), edited.alias("edited"), *[unpacked(F.col(s)).alias(s) for s in ("sketch", "next_sketch")])
    both = with_sketch(both, "edited", "edited_sketch", scale)
    found = keyed.select(*KEY).join(both.hint("merge"), KEY)
    return found.select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"),
        "n_chars", "edited", "sketch", "edited_sketch", "next_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("edited_holds"),
    )
