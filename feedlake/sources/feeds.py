"""Feed readers and lookup frames."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.session import stage


CORRUPT, SOURCE_FILE = "_corrupt_record", "_source_file"
REJECTS = "feed string, source_file string, reason string, record string"


def read_feed(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """A directory of JSON documents with an explicit schema.

    A document that does not parse, or a value of another type in a column that is
    read, fails the job.  ``land_feed`` sets such documents aside instead.
    """
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)


def require_key(df: DataFrame, key: str, feed: str) -> DataFrame:
    """``df``; a row without ``key`` fails the job that reads it, as keyed steps would merge all such rows into one."""
    return df.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"feed {feed}: a document without {key}"))))


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def split_rejects(docs: DataFrame, feed: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sound rows, rejects) of parsed documents with ``CORRUPT`` and ``SOURCE_FILE`` columns.

    The frame must be staged: read from JSON, a plan that needs few columns would
    parse, and so find fault with, those alone.
    """
    columns = [c for c in docs.columns if c not in (CORRUPT, SOURCE_FILE)]
    keyless = F.col(key).isNull() if key else F.lit(False)
    fault = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(keyless, f"no {key}")
    rejects = docs.where(fault.isNotNull()).select(
        F.lit(feed).alias("feed"), F.col(SOURCE_FILE).alias("source_file"), fault.alias("reason"),
        F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*columns))).alias("record"))
    return docs.where(fault.isNull()).select(*columns), rejects


def land_feed(spark: SparkSession, path: str, schema: T.StructType, feed: str, multiline: bool = True,
              key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a directory of JSON documents, parsed once and staged.

    Every document is accounted for: it is a row, or a reject (``REJECTS``) because it
    does not fit the schema (``malformed``, with its text), has no ``key``, or is a
    file without any document (``empty``).
    """
    docs = (spark.read.schema(with_corrupt_record(schema)).option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    landed = stage(docs.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)), f"landed_{feed}_{uuid.uuid4().hex}")
    rows, rejects = split_rejects(landed, feed, key)
    # The listing that the reader made on the driver; scans pass over files without any byte.
    files = spark.createDataFrame([(f,) for f in docs.inputFiles()], f"{SOURCE_FILE} string")
    same = F.regexp_replace(SOURCE_FILE, "^([a-z0-9]+):/+", "$1:/")
    empty = (files.withColumn("_file", same).join(landed.select(same.alias("_file")).distinct(), "_file", "left_anti")
             .select(F.lit(feed).alias("feed"), SOURCE_FILE, F.lit("empty").alias("reason"), F.lit(None).cast("string").alias("record"))
             .withColumnRenamed(SOURCE_FILE, "source_file"))
    return rows, rejects.unionByName(empty)


# Most keys of a lookup that is made from run parameters and hinted for broadcast.
LOOKUP_MAX_KEYS = 10_000


def parameter_frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A lookup frame from run parameters, hinted for broadcast: its rows are
    driver-side values, at most ``LOOKUP_MAX_KEYS`` of them."""
    if len(rows) > LOOKUP_MAX_KEYS:
        raise ValueError(f"a parameter lookup takes at most {LOOKUP_MAX_KEYS} rows, got {len(rows)}; read it as a table")
    return F.broadcast(spark.createDataFrame(rows, schema))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame of the given schema."""
    return spark.createDataFrame([], schema)


def lookup_frame(spark: SparkSession, mapping: dict, languages, key_name: str = "key",
                 extra: dict | None = None, fallback: str = "fallback") -> DataFrame:
    """Lookup rows from an ``id -> {"name": {lang: text}, ...}`` dict.

    The dict is shipped as one row per key holding a ``map<string,string>``;
    the language fan-out, the fallback name and the blank filter run as Spark
    expressions.  Output: ``key_name, language_code, name`` plus ``extra``
    columns ({column: dict field}).  Rows whose resolved name is blank are
    dropped.  A mapping of more than ``LOOKUP_MAX_KEYS`` keys is refused.
    """
    if len(mapping) > LOOKUP_MAX_KEYS:
        raise ValueError(f"a parameter lookup takes at most {LOOKUP_MAX_KEYS} keys, got {len(mapping)}; read it as a table")
    extra = extra or {}
    schema = T.StructType(
        [T.StructField(key_name, T.StringType()), T.StructField("names", T.MapType(T.StringType(), T.StringType()))]
        + [T.StructField(c, T.StringType()) for c in extra])
    rows = [(str(k), dict(v.get("name") or {}), *[None if v.get(f) is None else str(v.get(f)) for f in extra.values()])
            for k, v in mapping.items()]
    base = spark.createDataFrame(rows, schema)
    return localized_rows(base, "names", languages, fallback).drop("names")


def localized_rows(df: DataFrame, names_col: str, languages, fallback: str = "fallback") -> DataFrame:
    """One row per input row and language with the name in that language,
    else the fallback name, trimmed; blank results are dropped (S4)."""
    out = df.withColumn("language_code", F.explode(F.array(*[F.lit(x) for x in languages])))
    m = F.col(names_col)
    name = F.trim(F.coalesce(F.nullif(m[F.col("language_code")], F.lit("")), m[F.lit(fallback)], F.lit("")))
    return out.withColumn("name", name).filter(F.col("name") != "")


@dataclass
class Reference:
    """All lookups of a run, loaded once (S6).  Dict lookups are bounded
    parameters; frames are joined as Spark's size estimates decide."""
    themes: dict = field(default_factory=dict)
    facilities: dict = field(default_factory=dict)
    facility_types: dict = field(default_factory=dict)
    bed_types: dict = field(default_factory=dict)
    amenity_synonyms: dict = field(default_factory=dict)
    locales: dict = field(default_factory=dict)
    keyword_lists: dict = field(default_factory=dict)
    property_types: dict = field(default_factory=dict)
    type_categories: dict = field(default_factory=dict)
    category_rules: dict = field(default_factory=dict)
    frames: dict = field(default_factory=dict)


def load_reference(spark: SparkSession, **lookups) -> Reference:
    """Collect the run's lookups in one object (S6).  Frames for joins are built
    where a plan needs them (``lookup_frame``), not eagerly.  A name that is no
    lookup is an error."""
    unknown = sorted(set(lookups) - set(Reference.__dataclass_fields__))
    if unknown:
        raise ValueError(f"no such lookups: {unknown}; there are {sorted(Reference.__dataclass_fields__)}")
    return Reference(**lookups)
