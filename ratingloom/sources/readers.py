"""Scans. Text tables are read with a fixed layout and without quoting, so that a quote
character inside a review can never swallow the following tabs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ratingloom.sources import schemas


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store Spark reads it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One column ``value``, one row per line."""
    return spark.read.text(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType, escaped: bool) -> DataFrame:
    """Fields by position, cast to the schema's types; null where a field is missing or no number. Quotes mean
    nothing.

    ``escaped`` tables are those of ``writers.write_tsv``: backslash sequences are undone and ``\\N`` is null.
    In plain ones a backslash is a backslash, and a carriage return at the end of a line belongs to its end.
    """
    fields = F.split("value" if escaped else F.regexp_replace("value", r"\r\z", ""), "\t", -1)

    def value(i: int):
        field = F.get(fields, F.lit(i))
        if not escaped:
            return field
        plain = F.transform(F.split(field, r"\\\\", -1), lambda part: F.replace(F.replace(F.replace(
            part, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.when(field != "\\N", F.array_join(plain, "\\"))

    return spark.read.text(path, lineSep="\n").select(
        *[value(i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def read_raw(spark: SparkSession, path: str, escaped: bool) -> DataFrame:
    return read_tsv(spark, path, schemas.RAW, escaped)


def read_aggregated(spark: SparkSession, path: str, escaped: bool) -> DataFrame:
    return read_tsv(spark, path, schemas.AGGREGATED, escaped)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON object per line; malformed lines are skipped. ``judge_json_lines`` tells which and why."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def judge_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every line that is not blank: the schema's columns, ``file``, ``reject_reason`` (null: kept) and, of rejected
    lines, ``value``.

    Reasons: ``not_json`` (no JSON value), ``no_object`` (another value than an object), ``bad_field`` (a field
    that the schema's type cannot hold). Fields that are missing are null, others are not read. One pass over
    the lines.
    """
    whole = StructType([*schema.fields, StructField("_bad", StringType())])
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
             .where(F.trim("value") != ""))
    seen = lines.select("*", F.from_json("value", whole, {"columnNameOfCorruptRecord": "_bad"}).alias("row"),
                        F.schema_of_variant(F.try_parse_json("value")).alias("shape"))
    reason = (F.when(F.col("shape").isNull(), "not_json").when(~F.col("shape").startswith("OBJECT"), "no_object")
              .when(F.col("row._bad").isNotNull(), "bad_field"))
    kept = reason.isNull()
    return seen.select(*[F.when(kept, F.col("row")[f.name]).alias(f.name) for f in schema.fields], "file",
                       reason.alias("reject_reason"), F.when(~kept, F.col("value")).alias("value"))


def json_rejects(judged: DataFrame) -> DataFrame:
    """How many lines of each file were rejected, by reason; a file without any has no row."""
    return (judged.where("reject_reason IS NOT NULL").groupBy("file", "reject_reason")
            .agg(F.count("*").alias("lines")))


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files that each hold one JSON array. Each is one task; ``jobs`` publishes lines, which split."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_csv_header(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """A text file with one word per line."""
    return (spark.read.text(path)
            .select(F.lower(F.trim("value")).alias("word"))
            .where("word <> ''").distinct())


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated word and valence, one row per word; further columns are ignored."""
    parts = F.split("value", "\t")
    return (spark.read.text(path)
            .select(F.get(parts, F.lit(0)).alias("word"),
                    F.get(parts, F.lit(1)).try_cast("double").alias("valence"))
            .where("valence is not null")
            .groupBy("word").agg(F.max("valence").alias("valence")))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON documents (whole collections) as ``region`` and its outer ``ring``s. Each file
    is one task; ``parse_features`` reads the same features from lines, which split."""
    doc = spark.read.schema(
        schemas.T.StructType([schemas.T.StructField("features", schemas.T.ArrayType(schemas.FEATURE))])
    ).option("multiLine", True).json(path)
    return outer_rings(doc.select(F.explode("features").alias("f")).select("f.*"))


def parse_features(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same for a text column with one GeoJSON feature per row."""
    return outer_rings(lines.select(F.from_json(column, schemas.FEATURE).alias("f")).select("f.*"))


def outer_rings(features: DataFrame) -> DataFrame:
    """Region name and the points of the outer ring of each of its polygons.

    A Polygon lists its rings, outer ring first; a MultiPolygon lists polygons.
    """
    ring = "array<array<double>>"
    polygon = F.from_json("geometry.coordinates", f"array<{ring}>")
    multi = F.from_json("geometry.coordinates", f"array<array<{ring}>>")
    return features.select(
        F.col("properties.NAME").alias("region"),
        F.when(F.col("geometry.type") == "Polygon", F.get(polygon, F.lit(0)))
        .when(F.col("geometry.type") == "MultiPolygon",
              F.flatten(F.transform(multi, lambda p: F.get(p, F.lit(0)))))
        .alias("points"),
    )


def vertices(rings: DataFrame) -> DataFrame:
    """One row per vertex: region, lat, lng. GeoJSON points are (lng, lat)."""
    # Outer, as the size filter of a plain explode would parse every feature a second time.
    return (rings.select("region", F.explode_outer("points").alias("p"))
            .where(F.col("p").isNotNull())
            .select("region", F.col("p")[1].alias("lat"), F.col("p")[0].alias("lng")))
