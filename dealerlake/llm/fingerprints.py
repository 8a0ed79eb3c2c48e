"""Document fingerprints by Order MinHash, whose likeness follows the edit distance rather than the set of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.llm.native import head, word_array
from dealerlake.llm.store import saved

#: Words in a k-mer; a text of fewer words is one k-mer.
K = 2
#: Tuples of a fingerprint (a power of two), and k-mers in a tuple. The code below writes out pairs.
TUPLES = 64
_TUPLE_BITS = 6
#: Bits of a place in the text, and of a k-mer's rank in its part.
_PLACE_BITS = 26
_RANK_BITS = 31
_VALUE_BITS = 34

_LAST_PLACE = (1 << _PLACE_BITS) - 1


def _some(x: Column) -> Column:
    return x.isNotNull()


def with_sketches(df: DataFrame, **texts: str) -> DataFrame:
    """``df`` plus, for each ``name=column``, ``name``: the column's fingerprint as an array of numbers.

    K-mers are K neighbouring words, each with the number of times it has occurred before in the text, so
    that they are all different. A hash of both puts each k-mer into one of TUPLES parts and ranks it there;
    one hash serves for all parts. A part's two smallest k-mers, put back into the order of the text, are hashed to the
    part's value. Parts without k-mers have none. A number holds the part and its value.

    Each step is a projection of its own, as its result is used several times.
    """
    names = list(texts)
    kept = df.columns

    def step(frame: DataFrame, made: dict[str, Column]) -> DataFrame:
        return frame.select(*kept, *[c.alias(name) for name, c in made.items()])

    shift = lambda c: F.shiftright(c, _PLACE_BITS)
    part = lambda c: F.shiftright(c, _PLACE_BITS + _RANK_BITS)
    out = step(df, {n: word_array(F.col(texts[n])) for n in names})

    def kmers(n: str) -> Column:
        # Sorted by hash, then place: the hash above, the place below.
        packed = lambda h, i: F.shiftleft(h.bitwiseAND(F.lit((1 << 37) - 1)), _PLACE_BITS).bitwiseOR(F.least(i, F.lit(_LAST_PLACE)).cast("long"))
        pairs = F.transform(head(F.col(n), F.size(n) - (K - 1)), lambda x, i: packed(F.xxhash64(x, F.get(n, i + 1)), i))
        return F.sort_array(F.when(F.size(n) >= K, pairs).otherwise(F.transform(n, lambda x, i: packed(F.xxhash64(x), i))))

    out = step(out, {n: kmers(n) for n in names})

    def begins(n: str) -> Column:
        return F.filter(F.transform(n, lambda x, j: F.when(shift(x) != F.coalesce(shift(F.get(n, j - 1)), F.lit(-1)), j)), _some)

    out = step(out, {n: F.col(n) for n in names} | {f"{n}_begins": begins(n) for n in names})

    def occurrence(n: str) -> Column:
        sizes = F.transform(f"{n}_begins", lambda b, i: F.coalesce(F.get(f"{n}_begins", i + 1), F.size(n)) - b)
        return F.flatten(F.transform(sizes, lambda z: F.sequence(F.lit(0), z - 1)))

    out = step(out, {n: F.col(n) for n in names} | {f"{n}_before": occurrence(n) for n in names})

    def ranked(n: str) -> Column:
        def key(x, before):
            hashed = F.xxhash64(shift(x), before).bitwiseAND(F.lit((1 << (_TUPLE_BITS + _RANK_BITS)) - 1))
            return F.shiftleft(hashed, _PLACE_BITS).bitwiseOR(x.bitwiseAND(F.lit(_LAST_PLACE)))

        # Both arrays as arguments: one that is named inside the function only would be computed again for each element.
        return F.sort_array(F.zip_with(n, f"{n}_before", key))

    out = step(out, {n: ranked(n) for n in names})
    # The first two of each part.
    def smallest(n: str) -> Column:
        return F.filter(n, lambda x, j: (j < 2) | (part(x) != part(F.get(n, j - 2))))

    out = step(out, {n: smallest(n) for n in names})

    def tuples(n: str) -> Column:
        def value(x, j):
            y = F.get(n, j + 1)
            in_order = (x.bitwiseAND(F.lit(_LAST_PLACE))) < (y.bitwiseAND(F.lit(_LAST_PLACE)))
            pair = F.when(in_order, F.xxhash64(shift(x), shift(y))).otherwise(F.xxhash64(shift(y), shift(x)))
            hashed = F.when(part(x) == part(y), pair).otherwise(F.xxhash64(shift(x)))
            number = F.shiftleft(part(x), _VALUE_BITS).bitwiseOR(hashed.bitwiseAND(F.lit((1 << _VALUE_BITS) - 1)))
            return F.when((j == 0) | (part(x) != part(F.get(n, j - 1))), number)

        return F.filter(F.transform(n, value), _some)

    return step(out, {n: tuples(n) for n in names})


def likeness(a: str, b: str) -> Column:
    """Share of equal values among the parts that either text has; 1 for two texts without words."""
    parts = lambda c: F.transform(c, lambda v: F.shiftright(v, _VALUE_BITS))
    either = F.size(F.array_union(parts(a), parts(b)))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_string(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda v: F.lower(F.hex(v))), " ")


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, prev_id, copies) of all ids: the next larger one, for the largest the smallest; how many rows have the id.

    Ids are put into ranges in one shuffle, and written, as cut points may change when they are computed again;
    the ends of ranges are joined by one row per range.
    """
    spark = docs.sparkSession
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("copies"))
    down = F.col("doc_id").desc_nulls_last()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = saved(ids.repartitionByRange(partitions, down).withColumn("range", F.spark_partition_id()))
    ends = ranges.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), -F.col("doc_id"))).alias("top"), F.max(F.struct(F.col("doc_id").isNull().alias("n"), -F.col("doc_id"), "doc_id")).alias("low"))
    ends = ends.select("range", F.col("low.doc_id").alias("low"))
    before = F.lag("low").over(Window.orderBy("range"))
    first = F.row_number().over(Window.orderBy("range")) == 1
    last = F.last("low").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("range", F.when(first, last).otherwise(before).alias("ahead"))
    inside = Window.partitionBy("range").orderBy(down)
    return ranges.withColumn("place", F.row_number().over(inside)).withColumn("above", F.lag("doc_id").over(inside)).join(ends, "range").select(
        "doc_id", F.when(F.col("place") == 1, F.col("ahead")).otherwise(F.col("above")).alias("prev_id"), "copies"
    )


def _key(doc_id: Column) -> Column:
    """An id to join by; a null one has a key of its own."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 3) code points replaced by as many first ones
    (or all) of the next document in descending order of ids; after the last comes the first. ``near_edited`` and ``near_next`` are the
    ``likeness`` of the text's fingerprint to those of the edited text and of the next document.

    Whole texts are shuffled once, to learn their neighbours; only as much of a text's beginning as the document before it takes travels on. Each
    text is sketched once; sketches are written, and meet by neighbour. So a filter on the result computes no sketch again.

    Null texts are empty ones. Equal texts have equal fingerprints. A null id comes after all others. Of rows that
    repeat an id, each has its own next document, the one with the next smaller id; if that id has several
    rows, the smallest text. Of two texts beyond 2^26 words, k-mers from there on count as if at one place: their order does not tell. An empty table
    gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Just these columns wherever texts are shuffled by their id, so that Spark does it once.
    keyed = docs.select(_key(F.col("doc_id")).alias("key"), "text")
    # How much of a text the document before it may take: a third of the longest row of that id.
    wanted = keyed.groupBy("key").agg(F.max(F.floor(F.length("text") / 3).cast("int")).alias("third"))
    links = neighbours(docs).select(_key(F.col("doc_id")).alias("key"), _key(F.col("prev_id")).alias("prev"), "copies")
    links = saved(links.join(wanted.withColumnRenamed("key", "prev"), "prev"))
    own = keyed.join(links, "key")
    once = own.where("copies = 1").select(F.col("prev").alias("key"), F.substring("text", F.lit(1), F.col("third")).alias("head"))
    many = own.where("copies > 1").groupBy("prev").agg(F.min("text").alias("text"), F.max("third").alias("third"))
    heads = once.union(many.select(F.col("prev").alias("key"), F.substring("text", F.lit(1), F.col("third")).alias("head")))
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - third), F.substring("head", F.lit(1), third))
    with_edit = own.join(heads, "key").withColumn("edited", edited).select(
        "key", "prev", size.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        # Of rows that repeat an id, the smallest text stands for it.
        F.when(F.col("copies") > 1, F.col("text")).alias("among"), "text", "edited",
    )
    sketched = saved(with_sketches(with_edit, own="text", changed="edited").drop("text", "edited"))
    following = sketched.where("among IS NULL").select(F.col("prev").alias("key"), F.col("own").alias("following"))
    chosen = sketched.where("among IS NOT NULL").groupBy("prev").agg(F.min_by("own", "among").alias("following"))
    met = sketched.drop("prev", "among").join(following.union(chosen.withColumnRenamed("prev", "key")), "key")
    return met.select(
        F.col("key").try_cast("long").alias("doc_id"), "n_chars", "edited_sha256", as_string("own").alias("fingerprint"), as_string("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )
