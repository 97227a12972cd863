"""Key sketches: which files of a segment may hold a name, a document key or an original id.

Beside a segment lies a Bloom filter for each of its files, as rows (file, word, bits, low,
high): 64 bits of the filter, and the range of the file's document keys. The rows are
sorted by word in small row groups, so a look-up reads the few words that its names touch
and not the filters. Filters have BITS_A_NAME bits for each name a file can hold at most, and HASHES places a name: about
one look-up in 300 opens a file in vain, and none misses one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_A_NAME = 12
HASHES = 8
ROW_GROUP = 1 << 20
SCHEMA = "file string, word long, bits long, low string, high string"


def _places(name: Column, bits: int) -> Column:
    """The bits that a name sets in a filter of so many bits, a power of two."""
    first, step = F.pmod(F.xxhash64(name), F.lit(bits)), F.pmod(F.xxhash64(name, F.lit(1)), F.lit(bits))
    return F.array(*[F.pmod(first + step * i, F.lit(bits)) for i in range(HASHES)])


def write(spark: SparkSession, segment: str, path: str) -> int:
    """Write the sketch of the segment's files; gives the size of the filters in bits."""
    rows = spark.read.parquet(segment).select(F.col("_metadata.file_name").alias("file"), "doc_key", "ext_id")
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_key").alias("low"), F.max("doc_key").alias("high"))
    most = files.agg(F.max("rows")).first()[0] or 1
    bits = max(1 << 10, 1 << (2 * BITS_A_NAME * most - 1).bit_length())
    names = rows.select("file", F.explode(F.array("doc_key", "ext_id")).alias("name")).filter("name IS NOT NULL")
    places = names.select("file", F.explode(_places(F.col("name"), bits)).alias("place"))
    words = places.groupBy("file", F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits"))
    ranged = words.join(files.select("file", "low", "high"), "file").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    ranged.repartitionByRange("word").sortWithinPartitions("word").write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return bits


def holding(spark: SparkSession, sketches: dict[str, tuple[str, int]], names: list[str], keys_only: bool) -> list[tuple[str, str]]:
    """(segment, file) of the files that may hold one of the names; sketches is {segment: (path, bits)}.

    With `keys_only` the names are document keys, and the ranges of keys count too."""
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    found: list[tuple[str, str]] = []
    for bits in sorted({b for _, b in sketches.values()}):
        paths = {p: segment for segment, (p, b) in sketches.items() if b == bits}
        place = F.explode(_places(F.col("name"), bits)).alias("place")
        places = asked.select("name", place).select(
            "name", F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bit")
        )
        known = places.collect()  # HASHES rows a name
        wanted = spark.createDataFrame(known, places.schema)
        rows = spark.read.schema(SCHEMA).parquet(*paths).filter(F.col("word").isin(sorted({r["word"] for r in known})))
        hits = rows.withColumn("folder", F.col("_metadata.file_path")).join(F.broadcast(wanted), "word").filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        if keys_only:
            hits = hits.filter(F.col("name").between(F.col("low"), F.col("high")))
        folder = F.regexp_extract("folder", "([^/]+)/[^/]+$", 1)  # the sketch's own folder
        full = hits.groupBy(folder.alias("sketch"), "file", "name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == HASHES)
        segment_of = {p.rsplit("/", 1)[1]: segment for p, segment in paths.items()}
        found += [(segment_of[r["sketch"]], r["file"]) for r in full.select("sketch", "file").distinct().collect()]
    return found
