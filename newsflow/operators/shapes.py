"""Union of records of unlike shapes.

A fixed schema nulls a field that a site writes in another type, and drops one it
does not name. Here records are parsed to VARIANT, and the schema is what they hold:

* :func:`field_kinds` counts by site and field the kinds of values, in one
  aggregation with map-side sums.
* :func:`widened` gives each field the narrowest type that takes all its values:
  its own if they are of one kind; an exact decimal for whole numbers and decimals
  together (if 38 digits are enough); else text, in which numbers and truth values
  are spelt out and lists and objects are JSON.
* :func:`union_shapes` reads all records by that schema into the struct ``fields``.
  The record itself stays as the VARIANT ``record``, so nothing is lost by a cast.

Records are parsed once for the kinds and once for the rows; no row is shuffled.

Defined results: a text that is no JSON object (null, cut off, a list) has null
``fields`` and ``record`` and stays as ``unread``; an absent field and a null one are
null; a field that is always null is text; of names that differ only in case the later
ones (by code point) get ``_2``, ``_3``; a name with both kinds of quotes cannot be
looked up and stays in ``record`` only; more than ``max_fields`` names raise an error,
since they are data and not columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FIELDS = 1_000
LONG_DIGITS, MOST_DIGITS = 19, 38


def parsed(text: Column) -> Column:
    """The VARIANT of a JSON object; null for anything else."""
    v = F.try_parse_json(text)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def field_kinds(records: DataFrame, site: str = "site", text: str = "json") -> DataFrame:
    """``site, field, kind, n, whole, scale``: values by kind, and the most digits
    before and after the point of decimals."""
    spark = records.sparkSession
    v = records.select(F.col(site).alias("site"), parsed(F.col(text)).alias("v")).where("v is not null")
    each = v.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("site", F.col("key").alias("field"), F.schema_of_variant("value").alias("t"))
    digits = F.regexp_extract("t", r"^DECIMAL\((\d+),(\d+)\)", 1).try_cast("int"), F.regexp_extract("t", r"^DECIMAL\((\d+),(\d+)\)", 2).try_cast("int")
    plain = {"BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "double", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}
    kind = F.when(F.col("t").startswith("DECIMAL"), "decimal")
    for name, to in plain.items():
        kind = kind.when(F.col("t") == name, to)
    return (each.select("site", "field", kind.otherwise("json").alias("kind"), (digits[0] - digits[1]).alias("whole"), digits[1].alias("scale"))
            .groupBy("site", "field", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("whole").alias("whole"), F.max("scale").alias("scale")))


def widened(kinds: DataFrame) -> DataFrame:
    """``field, type``: the type that takes all values of a field."""
    has = {k: F.bool_or(F.col("kind") == k).alias(f"has_{k}") for k in ("bigint", "decimal", "double", "string", "boolean", "json")}
    by = kinds.groupBy("field").agg(*has.values(), F.coalesce(F.max("whole"), F.lit(0)).alias("whole"), F.coalesce(F.max("scale"), F.lit(0)).alias("scale"))
    held = sum((F.col(f"has_{k}").cast("int") for k in has), F.lit(0))
    whole = F.greatest("whole", F.when(F.col("has_bigint"), LONG_DIGITS).otherwise(1))
    numbers = F.col("has_decimal") & (held - F.col("has_bigint").cast("int") == 1) & (whole + F.col("scale") <= MOST_DIGITS)
    decimal = F.format_string("decimal(%d,%d)", whole + F.col("scale"), F.col("scale"))
    kind = F.when(numbers, decimal)
    for k in ("bigint", "double", "boolean"):
        kind = kind.when((held == 1) & F.col(f"has_{k}"), k)
    return by.select("field", kind.otherwise("string").alias("type"))


def shape_report(records: DataFrame, site: str = "site", text: str = "json") -> DataFrame:
    """``site, field, kinds, n, type``: what each site wrote, and the field's type
    in the union."""
    from newsflow.session import materialize
    kinds = materialize(field_kinds(records, site, text), "field_kinds")
    by_site = kinds.groupBy("site", "field").agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"), F.sum("n").alias("n"))
    return by_site.join(widened(kinds), "field").select("site", "field", "kinds", "n", "type")


def _path(name: str) -> str | None:
    quote = next((q for q in "'\"" if q not in name), None)
    return quote and f"$[{quote}{name}{quote}]"


def columns(names: list[str]) -> dict[str, str]:
    """A column name for each field, told apart where only case differs."""
    taken: set[str] = set()
    out = {}
    for name in sorted(names):
        column, k = name, 1
        while column.lower() in taken:
            k += 1
            column = f"{name}_{k}"
        taken.add(column.lower())
        out[name] = column
    return out


def union_shapes(records: DataFrame, report: DataFrame, text: str = "json", max_fields: int = MAX_FIELDS) -> DataFrame:
    """``records`` without their text, with ``fields`` by the types of ``report``
    (:func:`shape_report`), ``record`` and ``unread``."""
    types = {r["field"]: r["type"] for r in report.select("field", "type").distinct().limit(max_fields + 1).toLocalIterator()}
    if len(types) > max_fields:
        raise ValueError(f"more than {max_fields} field names: read them from the record")
    read = records.withColumn("record", parsed(F.col(text)))
    found = [F.try_variant_get("record", _path(name), types[name]).alias(column) for name, column in columns(list(types)).items() if _path(name)]
    fields = F.when(F.col("record").isNotNull(), F.struct(*found)) if found else F.lit(None).cast("struct<>")
    return read.select(*[c for c in records.columns if c != text], fields.alias("fields"), "record",
                       F.when(F.col("record").isNull(), F.col(text)).alias("unread"))
