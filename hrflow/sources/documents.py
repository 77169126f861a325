"""Nested source documents and their child arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Every field of a document is kept, declared or not.
DOCUMENT = "map<string,variant>"


def read_documents(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One row per document: ``doc map<string,variant>``, or its text as ``reject`` where it is not one JSON object.

    Line-delimited files are split like any text, and a bad line is a reject of its own. A file that is one JSON array
    (``multiline``) is read by a single task, element by element, so its size is not limited; a first pass collects the
    names of the fields. An array that is cut off, malformed or followed by other text, an empty file, and an element that is
    not an object raise an error: nothing is lost in silence.
    """
    if multiline:
        return _array_elements(spark, path)
    lines = spark.read.text(path).where(F.trim("value") != "")
    # In brackets, text that follows the first value is an error and not passed over.
    found = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), f"array<{DOCUMENT}>")
    docs = lines.select("value", F.when(F.size(found) == 1, F.element_at(found, 1)).alias("doc"))
    return docs.select("doc", F.when(F.col("doc").isNull(), F.col("value")).alias("reject"))


def _array_elements(spark: SparkSession, path: str) -> DataFrame:
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), place.alias("_place"))
    ends = lines.where(F.trim("value") != "").groupBy("_file").agg(
        F.left(F.ltrim(F.min_by("value", "_place")), F.lit(1)).alias("first"),
        F.right(F.rtrim(F.max_by("value", "_place")), F.lit(1)).alias("last"),
    )
    wrong = ends.where("first <> '[' or last <> ']'").select("_file").take(1)
    if wrong or not ends.take(1):
        raise ValueError(f"not one JSON array per file: {wrong[0][0] if wrong else path}")
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    names = reader.option("primitivesAsString", True).json(path).columns
    if not names:
        return spark.createDataFrame([], f"doc {DOCUMENT}, reject string")
    values = reader.schema(", ".join(f"`{n.replace('`', '``')}` variant" for n in names)).json(path)
    fields = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(f"`{n.replace('`', '``')}`") for n in names]))
    return values.select(F.map_filter(fields, lambda _, v: v.isNotNull()).alias("doc"), F.lit(None).cast("string").alias("reject"))


def as_documents(df: DataFrame) -> DataFrame:
    """Rows of typed columns as documents, nulls included."""
    text = F.to_json(F.struct(*[column(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(F.from_json(text, DOCUMENT).alias("doc"))


def column(name: str) -> Column:
    """Column whose name may hold dots."""
    return F.col(f"`{name.replace('`', '``')}`")


#: Types whose JSON text is the same from a column and from a document.
PLAIN = (T.StringType, T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.BinaryType)


def _plain(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_plain(f.dataType) for f in kind.fields)
    return isinstance(kind, PLAIN)


def _in_order(value: Column, kind: T.DataType) -> Column:
    """The value with the fields of its structs in the order of their names."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _in_order(x, kind.elementType))
    if not isinstance(kind, T.StructType):
        return value
    fields = [_in_order(value.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
    return F.when(value.isNotNull(), F.struct(*fields))


def _as_variant(value: Column) -> Column:
    text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.variant_get(F.parse_json(text), "$.v", "variant")


def canonical_json(schema: T.StructType) -> Column:
    """A typed row as JSON text with all keys in order: the text that its document has.

    One ``to_json`` over sorted structs. Only columns that hold fractions or maps go through a variant, which
    writes numbers and keys in one form whatever type they had.
    """
    fields = sorted(schema.fields, key=lambda f: f.name)
    values = [
        (_in_order(column(f.name), f.dataType) if _plain(f.dataType) else _as_variant(column(f.name))).alias(f.name) for f in fields
    ]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})


def typed_text(schema: T.StructType, name: str, value: Column | None = None) -> Column:
    """Scalar field of a typed row as the text that :func:`field_text` gives for its document; null where there is no such field."""
    if name not in schema.names:
        return F.lit(None).cast("string")
    value = column(name) if value is None else value
    if isinstance(schema[name].dataType, (T.StringType, T.IntegralType, T.BooleanType)):
        return value.cast("string")
    return F.try_variant_get(_as_variant(value), "$", "string")


def field_text(name: str, doc: str = "doc") -> Column:
    """Scalar field of an open document as text; null when missing or JSON null."""
    return F.try_variant_get(F.col(doc)[name], "$", "string")


def without_field(df: DataFrame, name: str) -> DataFrame:
    """Documents without one of their fields; other columns stay."""
    return df.withColumn("doc", F.map_filter("doc", lambda k, _: k != name))


def unfurl(
    df: DataFrame,
    array_field: str,
    parent_keys: Sequence[str],
    child_id: tuple[str, Sequence[str]],
    updated_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split nested documents into (parents without the array, children).

    Each array element becomes a document with the parent's keys, unless it carries its own, and an id joined by ``|``
    from the fields that ``child_id`` names. Parents with a missing or empty array have no children.
    ``updated_at`` becomes ``source_updated_at`` of the children; by default they inherit the parent's.

    Typed rows (no column ``doc``, the array of structs) stay typed on both sides: the array is exploded, and fields keep
    their types.
    """
    name, id_parts = child_id
    if "doc" not in df.columns:
        return _unfurl_typed(df, array_field, parent_keys, name, id_parts, updated_at)
    parents = without_field(df, array_field).select("doc")
    items = F.try_variant_get(F.col("doc")[array_field], "$", f"array<{DOCUMENT}>")
    stamp = field_text("source_updated_at") if updated_at is None else updated_at
    # Elements carry what children take from the parent, not the whole parent.
    kept = F.map_filter("doc", lambda k, _: k.isin(list(parent_keys)))
    taken = df.where(F.col("doc")[array_field].isNotNull()).select(kept.alias("_parent"), stamp.cast("string").alias("_stamp"), items.alias("_items"))
    # A plain ``explode`` would have the array made again, for conditions on its size.
    exploded = taken.select("_parent", "_stamp", F.explode_outer("_items").alias("_item")).where(F.col("_item").isNotNull())
    inherited = F.map_filter("_parent", lambda k, _: ~F.map_contains_key(F.col("_item"), k))
    own = F.map_filter("_item", lambda k, _: ~k.isin([name, "source_updated_at"]))
    merged = exploded.select("_stamp", F.map_concat(inherited, own).alias("doc"))
    key = F.concat_ws("|", *[field_text(p) for p in id_parts])
    added = F.create_map(
        F.lit(name), key.cast("variant"), F.lit("source_updated_at"), F.col("_stamp").cast("variant")
    )
    # Elements are no nulls here. Said so, a later condition on the document does not make it a second time.
    none = F.create_map().cast(DOCUMENT)
    return parents, merged.select(F.coalesce(F.map_concat("doc", added), none).alias("doc"))


def _unfurl_typed(
    df: DataFrame, array_field: str, parent_keys: Sequence[str], name: str, id_parts: Sequence[str], updated_at: Column | None
) -> tuple[DataFrame, DataFrame]:
    element = df.schema[array_field].dataType.elementType
    added = (name, "source_updated_at")
    stamp = typed_text(df.schema, "source_updated_at") if updated_at is None else updated_at.cast("string")
    inherited = [k for k in df.columns if k in parent_keys and k not in element.names and k not in added]
    own = [f.name for f in element.fields if f.name not in added]
    exploded = df.select(*map(column, inherited), stamp.alias("_stamp"), F.explode(column(array_field)).alias("_item"))
    merged = exploded.where(F.col("_item").isNotNull()).select(
        *map(column, inherited), *[F.col("_item").getField(k).alias(k) for k in own], "_stamp"
    )
    key = F.concat_ws("|", *[typed_text(merged.schema, p) for p in id_parts])
    children = merged.select(*map(column, inherited + own), key.alias(name), F.col("_stamp").alias("source_updated_at"))
    return df.drop(array_field), children
