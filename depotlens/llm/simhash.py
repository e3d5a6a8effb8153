"""SimHash fingerprints and their Hamming neighbours, in DataFrame functions only.

Fingerprint: the terms of a text are its word pairs (each word with its
successor, the last word alone), lower-cased. A term's 64-bit hash votes on
every bit, +weight for a 1 and -weight for a 0; the weight of an occurrence is
the code points of its words, at most 16. A bit of the fingerprint is 1 if its
vote is positive. Two of the 64 vote counters share one long (32 bits each:
texts of up to 2^28 words), so a term costs 32 masked additions, and the terms
of a text are summed where the text is read, without a shuffle.

Neighbours: the 64 bits are cut in 6 blocks. Two fingerprints within Hamming
distance 3 agree on at least 3 of them, so they meet in one of the 20 tables
that each sort by another choice of 3 blocks (30 to 33 leading bits). Equal
fingerprints are one entry, and a pair is reported by the first table it
meets in.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored, tidy

BUCKET_ROWS = 1024  # documents per contiguous doc_id range, on average
MAX_BROADCAST_HEADS = 500_000  # with more ranges their first documents are found by a shuffle
MAX_WEIGHT = 16
BLOCKS = (11, 11, 11, 11, 10, 10)
RADIUS = 3
_LANES = (1 << 32) + 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, fingerprint as long) of each row; ``keys`` must identify the row.

    A text without words (or null) has the fingerprint 0.
    """
    words = F.array_remove(F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+"), "")
    rows = texts.select(*keys, words.alias("__w")).withColumn("__n", F.expr("slice(__w, 2, greatest(size(__w), 1))"))
    rows = rows.select(*keys, F.explode_outer(F.arrays_zip("__w", "__n")).alias("pair"))
    a, b = F.col("pair.__w"), F.col("pair.__n")
    weight = F.least(F.char_length(a) + F.coalesce(F.char_length(b), F.lit(0)), F.lit(MAX_WEIGHT)).cast("long")
    rows = rows.select(*keys, F.when(a.isNotNull(), F.xxhash64(a, b)).alias("h"), weight.alias("w"))
    votes = [F.sum(F.shiftright("h", i).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"v{i}") for i in range(32)]
    summed = rows.groupBy(*keys).agg(F.sum("w").alias("all"), *votes)
    bits = []
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"v{i}", 32)
        for n, half in ((i, low), (i + 32, high)):
            bits.append(F.when(half * 2 > F.col("all"), F.lit(_signed(1 << n))).otherwise(F.lit(0).cast("long")))
    whole = reduce(lambda x, y: x.bitwiseOR(y), bits)
    return summed.select(*keys, whole.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)).cast("double") / 64.0


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _masks() -> list[int]:
    at, parts = 0, []
    for width in BLOCKS:
        parts.append(((1 << width) - 1) << at)
        at += width
    return [_signed(sum(c)) for c in combinations(parts, len(BLOCKS) - RADIUS)]


def neighbours(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b, distance), a < b: all pairs within ``radius`` (at most 3) of the distinct longs ``distinct(fingerprint)``."""
    if radius > RADIUS:
        raise ValueError(f"the tables find pairs up to distance {RADIUS}")
    masks = _masks()
    entries = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])
    listed = distinct.select("fingerprint", F.explode(entries).alias("e")).select("fingerprint", "e.t", "e.key")
    met = stored(listed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key"), "tables")
    listed = stored(listed.join(met, ["t", "key"]), "entries")
    x, y = listed.alias("x"), listed.alias("y")
    differ = "(x.fingerprint ^ y.fingerprint)"
    first = "CASE " + " ".join(f"WHEN ({differ} & {m}L) = 0 THEN {t}" for t, m in enumerate(masks)) + " END"
    on = f"x.t = y.t AND x.key = y.key AND x.fingerprint < y.fingerprint AND bit_count({differ}) <= {radius} AND {first} = x.t"
    return x.join(y, F.expr(on)).select(F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"), F.expr(f"bit_count({differ})").alias("distance"))


def _with_next(docs: DataFrame) -> DataFrame:
    """(bucket, place, doc_id, text, next_text, last): documents by ascending doc_id with the text of the next.

    Documents are dealt to contiguous id ranges of about BUCKET_ROWS documents
    each; each range also gets the first document of the next one (``last``
    marks it), the last range the first of all. Rows without doc_id stand
    first; repeated ids follow each other.
    """
    least, most, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    shift = max(0, (((most - least) // max(n, 1) + 1) * BUCKET_ROWS).bit_length() - 1) if n else 0
    # the halves keep the difference within 64 bits whatever the ids are
    bucket = F.shiftright(F.shiftright("doc_id", 1) - F.lit((least or 0) >> 1), max(shift - 1, 0))
    dealt = docs.withColumn("bucket", F.coalesce(bucket, F.lit(0).cast("long")))
    heads = stored(dealt.where("doc_id IS NOT NULL").groupBy("bucket").agg(F.min("doc_id").alias("head")), "heads")
    every = Window.orderBy("bucket")  # one row per BUCKET_ROWS documents
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("head").over(every), F.min("head").over(whole))
    borders = heads.select("bucket", following.alias("head"))
    if heads.count() <= MAX_BROADCAST_HEADS:
        borders = F.broadcast(borders)
    guests = docs.join(borders, F.col("doc_id") == F.col("head")).select("bucket", "doc_id", "text", F.lit(True).alias("last"))
    rows = dealt.select("bucket", "doc_id", "text", F.lit(False).alias("last")).union(guests)
    order = Window.partitionBy("bucket").orderBy("last", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return rows.withColumn("place", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))


@tidy
def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near) for every row of ``docs(doc_id, text)``.

    The edited text ends in the first code points of the next document's text
    instead of its own last quarter (floor). Null texts are empty. n_near counts
    the other documents within Hamming distance 3.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = _with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("cut", cut)
    head = F.coalesce(F.expr("substring(next_text, 1, cut)"), F.lit(""))
    kept = F.expr("substring(text, 1, cast(n_chars AS int) - cut)")
    rows = rows.withColumn("edited", F.concat(kept, F.when(F.col("cut") > 0, head).otherwise(F.lit(""))))
    rows = rows.withColumn("sha", F.sha2(F.encode("edited", "UTF-8"), 256))
    versions = F.when(F.col("last"), F.array("text")).otherwise(F.array("text", "edited"))
    versions = rows.select("bucket", "place", "last", "doc_id", "n_chars", "sha", F.posexplode(versions).alias("version", "text"))
    keys = ["bucket", "place", "version", "last", "doc_id", "n_chars", "sha"]
    prints = fingerprints(versions, keys)
    order = Window.partitionBy("bucket").orderBy("place", "version")
    prints = prints.withColumn("edited", F.lead("fingerprint", 1).over(order)).withColumn("next", F.lead("fingerprint", 2).over(order))
    own = stored(
        prints.where("NOT last AND version = 0").select(
            "doc_id", "n_chars", F.col("sha").alias("edited_sha256"), F.col("fingerprint").alias("f"), as_hex(F.col("fingerprint")).alias("fingerprint"),
            as_hex(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.coalesce("next", "fingerprint")).alias("near_next"),
        ),
        "fingerprints",
    )
    classes = stored(own.groupBy("f").agg(F.count("*").alias("copies")), "classes")
    pairs = stored(neighbours(classes.select(F.col("f").alias("fingerprint"))), "neighbours")
    both = pairs.select("a", "b").union(pairs.select("b", "a")).toDF("f", "g")
    linked = both.join(classes.toDF("g", "others"), "g").groupBy("f").agg(F.sum("others").alias("others"))
    near = classes.join(linked, "f", "left").select("f", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_near"))
    return stored(own.join(near, "f").drop("f"), "with_neighbours")
