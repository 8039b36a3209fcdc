"""Landed snapshot JSON -> bronze rows, without losing anything of the feed."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.functions.exprs import ntz_literal
from snapflow.operators.flatten import flatten_structs, normalize_pair
from snapflow.schemas import BRONZE, COORDINATES


class LandingError(ValueError):
    """A landed file does not have the announced layout."""


def _parsed(texts: DataFrame) -> DataFrame:
    """``ok, pos, record``: the records of each text as VARIANT; ``ok`` is whether the text is one JSON value.

    Spark's JSON functions stop at the end of the first value.  Between brackets
    a text counts as one element, and as two with a further one behind it; what
    follows a first value breaks the syntax or one of the two counts.
    """
    text = F.col("value")
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    two = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]"))) == 2
    # Each record of an array is a VARIANT of its own, so a file may exceed the size limit of one.
    many = F.ltrim(F.regexp_replace(F.substring(text, 1, 64), r"\s+", " ")).startswith("[")
    records = F.when(many, F.from_json(text, "array<variant>")).otherwise(F.array(F.try_parse_json(text)))
    ok = F.coalesce(one & two, F.lit(False))
    return (
        texts.select(ok.alias("ok"), F.when(ok, records).alias("records"))
        .select((F.col("ok") & F.col("records").isNotNull()).alias("ok"), F.posexplode_outer("records").alias("pos", "record"))
    )


def _struct_of(variant_schema: str) -> T.StructType:
    """The type that ``schema_of_variant_agg`` names; a key that is always null is text."""
    quoted = variant_schema.split("`")  # odd places hold quoted names
    quoted[::2] = [re.sub(r"\bVOID\b", "STRING", part.replace("OBJECT<", "STRUCT<")) for part in quoted[::2]]
    return T.DataType.fromDDL("`".join(quoted))


def read_landed_json(spark: SparkSession, path: str, layout: str = "array") -> DataFrame:
    """Records of landed files, every key of the feed a column.

    ``layout="array"``: a file is one JSON value, an array of records or one
    record; a file with several values (one record per line, say) raises
    ``LandingError``, since only the first would be read.  ``layout="lines"``:
    one record per line, blank lines left out.

    Records are read as VARIANT, in the JVM.  A key takes the narrowest type
    that holds all its values: numbers stay numbers, objects and lists nested.
    A key whose kind changes between records is a VARIANT column, with every
    value.  Malformed text and records that are not objects raise
    ``LandingError``.  Files without records give a frame without columns; so do
    files of no bytes, which Spark's readers pass over.
    """
    if layout not in ("array", "lines"):
        raise ValueError(f"unknown layout {layout!r}")
    texts = spark.read.text(path, wholetext=layout == "array")
    if layout == "lines":
        texts = texts.where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
    parsed = _parsed(texts)
    is_object = F.coalesce(F.schema_of_variant("record").startswith("OBJECT<"), F.lit(False))
    malformed, others, schema = parsed.agg(
        F.count_if(~F.col("ok")),
        F.count_if(F.col("pos").isNotNull() & ~is_object),
        F.schema_of_variant_agg("record"),
    ).first()
    if malformed:
        what = "file(s)" if layout == "array" else "line(s)"
        raise LandingError(f"{malformed} {what} at {path} do not hold exactly one JSON value; one record per line is layout='lines'")
    if others:
        raise LandingError(f"{others} value(s) at {path} are not records")
    records = parsed.where(F.col("pos").isNotNull())
    if schema is None or not schema.startswith("OBJECT<"):
        return records.select()
    kind = _struct_of(schema)
    return records.select(F.col("record").cast(kind).alias("record")).select(
        *[F.col("record").getField(f).alias(f) for f in kind.fieldNames()]
    )


def _pair(records: DataFrame, parent: str, children: tuple[str, ...]) -> DataFrame:
    """Coordinates nested, flat, or some records one way and some the other."""
    flat = [f"{parent}.{c}" for c in children]
    given = {name: F.col(f"`{name}`") for name in flat if name in records.columns}
    kept = records.withColumns({f"__{i}": c for i, c in enumerate(given.values())}).drop(*given)
    kind = kept.schema[parent].dataType if parent in kept.columns else None
    if isinstance(kind, T.StructType):  # other fields of the object stay, too
        kept = kept.withColumns(
            {f"{parent}.{f}": F.col(parent)[f] for f in kind.fieldNames() if f not in children and f"{parent}.{f}" not in kept.columns}
        )
    out = normalize_pair(kept, parent, children)
    merged = {}
    for name in flat:
        nested = F.col(f"`{name}`")
        here = [F.col(f"__{i}").cast("double") for i, g in enumerate(given) if g == name]
        merged[name] = F.coalesce(nested, *here)
    return out.withColumns(merged).drop(*[f"__{i}" for i in range(len(given))])


def normalize_records(records: DataFrame) -> DataFrame:
    """Flatten nested objects to dotted names; coordinates nested or flat, never both."""
    parent = "coordonnees_geo"
    kind = records.schema[parent].dataType if parent in records.columns else None
    if isinstance(kind, T.VariantType):  # objects in some records, other values in others
        records = records.withColumn(parent, F.from_json(F.to_json(parent), COORDINATES))
    elif kind is not None and not isinstance(kind, T.StructType):  # an object in no record
        records = records.withColumn(parent, F.lit(None).cast(COORDINATES))
    return flatten_structs(_pair(records, parent, ("lat", "lon")))


def stamp_ingestion(records: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """One ingest stamp for the whole batch, and the ``date`` partition taken from it
    (one clock, so the stamp and its partition never straddle midnight)."""
    ts = ntz_literal(ingested_at)
    return records.withColumn("ingested_at", ts).withColumn("date", ts.cast("date"))


def _text(c: Column, kind: T.DataType) -> Column:
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")


def to_bronze(records: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """Landed records -> bronze columns in storage order, then every other key of the feed.

    Missing bronze columns are NULL.  Other keys keep their flattened name and
    are text (lists as JSON), so snapshots of different days stay readable
    together whatever the feed adds.
    """
    stamped = stamp_ingestion(normalize_records(records), ingested_at)
    declared = {f.name: f.dataType for f in BRONZE.fields}
    cols = [
        (F.col(f"`{n}`") if n in stamped.columns else F.lit(None)).cast(kind).alias(n) for n, kind in declared.items()
    ]
    others = [f for f in stamped.schema.fields if f.name not in declared]
    return stamped.select(*cols, *[_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in others])


__all__ = ["LandingError", "normalize_records", "read_landed_json", "stamp_ingestion", "to_bronze"]
