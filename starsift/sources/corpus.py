"""Import of an external review corpus into the review schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift.functions.coerce import number
from starsift.functions.text import strip
from starsift.schemas import CORPUS_SCHEMA, REVIEW_SCHEMA
from starsift.staging import stage

# Fixed value: longest headline kept.
HEADLINE_CHARS = 200
_BAD = "_malformed"
# Every field as text: a number written as text, or a count with a fraction, is no broken line.
_PARSE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in [*CORPUS_SCHEMA.names, _BAD]])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per input line, with the name of its file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))


def category_of(file_name: Column) -> Column:
    """File name without its extension, underscores as spaces."""
    return F.replace(F.regexp_replace(file_name, r"\.[^.]*$", ""), F.lit("_"), F.lit(" "))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``record`` (the parsed line) and ``usable``.

    Unusable: undecodable lines; rating, product, user or time missing; no text and no title.
    """
    read = F.from_json("value", _PARSE_SCHEMA, {"columnNameOfCorruptRecord": _BAD})
    numeric = {"rating": "double", "timestamp": "bigint", "helpful_vote": "int"}
    fields = [
        number(F.col(f"_read.{f.name}"), numeric[f.name]).alias(f.name) if f.name in numeric
        else F.col(f"_read.{f.name}").try_cast(f.dataType).alias(f.name)
        for f in CORPUS_SCHEMA
    ]
    decoded = F.when(F.col("_read").isNotNull() & F.col(f"_read.{_BAD}").isNull(), F.struct(*fields))
    parsed = lines.withColumn("_read", read).withColumn("record", decoded).drop("_read")
    return parsed.withColumn("usable", F.coalesce(usable(F.col("record")), F.lit(False)))


def usable(record: Column) -> Column:
    present = [record[c].isNotNull() for c in ("rating", "asin", "user_id", "timestamp")]
    some_text = F.length(F.concat(*[F.coalesce(record[c], F.lit("")) for c in ("text", "title")])) > 0
    return reduce(lambda a, b: a & b, present, record.isNotNull() & some_text)


def to_review(record: Column, category: Column) -> list[Column]:
    """The review columns of a corpus record.

    Ratings round half to even; the time is floored to seconds, also before
    1970; the id is a digest of the record, so a repeated import gives the same.
    """
    millis = record["timestamp"]
    seconds = ((millis - F.pmod(millis, F.lit(1000))) / 1000).cast("bigint")
    helpful = F.coalesce(record["helpful_vote"], F.lit(0))
    text = F.coalesce(record["text"], F.lit(""))
    title = F.coalesce(record["title"], F.lit(""))
    identity = F.to_json(F.struct(record["asin"], record["user_id"], millis, record["rating"], title, text))
    columns = {
        "review_id": F.sha2(identity, 256),
        "product_id": record["asin"],
        "reviewer_id": record["user_id"],
        "star_rating": F.bround(record["rating"], 0).try_cast("int"),
        "helpful_votes": helpful,
        "total_votes": helpful,
        "verified_purchase": F.coalesce(record["verified_purchase"], F.lit(False)),
        "review_headline": F.substring(strip(title), 1, HEADLINE_CHARS),
        "review_body": strip(text),
        "review_date": F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"),
        "product_category": category,
        "event_ts": seconds,
    }
    return [columns[name].alias(name) for name in REVIEW_SCHEMA.names]


def convert_records(records: DataFrame, category: Column) -> DataFrame:
    """Reviews from a frame that already has the corpus columns."""
    packed = records.select(F.struct(*[F.col(c) for c in CORPUS_SCHEMA.names]).alias("record"), category.alias("_cat"))
    return packed.where(usable(F.col("record"))).select(*to_review(F.col("record"), F.col("_cat")))


def import_corpus(spark: SparkSession, path: str, category: str | None = None, limit: int = 0) -> DataFrame:
    """Reviews from corpus files (JSON lines); ``limit`` > 0 keeps that many."""
    parsed = parse_lines(read_lines(spark, path)).where("usable")
    named = F.lit(category) if category else category_of(F.col("file_name"))
    kept = first_rows(parsed, limit) if limit > 0 else parsed
    return kept.select(*to_review(F.col("record"), named))


def first_rows(lines: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows in the order of the partitions, without moving any.

    Rows are counted by partition; partitions before the cut stay whole, the one
    that is cut keeps its first rows, the others are left out.
    """
    numbered = lines.withColumn("_at", F.monotonically_increasing_id())
    sizes = numbered.groupBy(F.shiftright("_at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.max("_at").alias("last"))
    left, cut = limit, None
    for row in sizes.orderBy("part").toLocalIterator():
        if row["n"] > left:
            cut = _nth_of_partition(numbered, row["part"], left)
            break
        left -= row["n"]
    return (numbered if cut is None else numbered.where(F.col("_at") < cut)).drop("_at")


def _nth_of_partition(numbered: DataFrame, part: int, n: int) -> int:
    """The smallest ``_at`` behind the first n rows of a partition; n rows reach one task as single numbers."""
    own = numbered.where(F.shiftright("_at", 33) == part).select("_at").orderBy("_at").limit(n)
    last = own.agg(F.max("_at")).first()[0]
    return (part << 33) if last is None else last + 1


def import_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines read, written and skipped, in one pass."""
    written = F.count_if(F.col("usable"))
    total = F.count(F.lit(1))
    return parse_lines(read_lines(spark, path)).agg(
        total.alias("read"), written.alias("written"), (total - written).alias("skipped")
    )


def import_table(spark: SparkSession, source: str, path: str, category: str | None = None, limit: int = 0) -> DataFrame:
    """Write the reviews of corpus files to ``path`` and return (read, written, skipped) of that same pass.

    Each line is parsed once: the counts are observed while the table is written. With a
    ``limit`` the lines are parsed into a staged table first, which is then cut; the
    counts are those of all lines there.
    """
    named = F.lit(category) if category else category_of(F.col("file_name"))
    parsed = parse_lines(read_lines(spark, source))
    if limit > 0:
        parsed = stage(parsed, "parsed-lines")
        kept = first_rows(parsed.where("usable"), limit)
        kept.select(*to_review(F.col("record"), named)).write.mode("overwrite").parquet(path)
        one = parsed.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("usable")).alias("usable")).first().asDict()
    else:
        seen = Observation("import")
        watched = parsed.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("usable")).alias("usable"))
        watched.where("usable").select(*to_review(F.col("record"), named)).write.mode("overwrite").parquet(path)
        one = seen.get
    row = (one["read"] or 0, one["usable"] or 0, (one["read"] or 0) - (one["usable"] or 0))
    return spark.createDataFrame([row], "read bigint, written bigint, skipped bigint")
