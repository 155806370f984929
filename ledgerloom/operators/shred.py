"""Deeply nested records: one merged schema, then one flat child table per array level that it lists.

Records are parsed once to VARIANT, so a field whose type varies from record to record never has
to fit one Spark type. Each array level is exploded into rows that carry the parent's path as
surrogate key and their own ordinal; all of it stays in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from ..session import settle

#: The arrays of report records, as a selection of what a merged schema lists.
LABEL_ARRAYS = ("tables", "column_metadata", "period_labels", "row_labels", "sub_labels")


def kind(v: Column) -> Column:
    """array, object, null or scalar, of a variant."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (s == "VOID"), "null")
        .when(s.startswith("ARRAY"), "array")
        .when(s.startswith("OBJECT"), "object")
        .otherwise("scalar")
    )


def _exploded(df: DataFrame, col: str, names: tuple[str, str, str]) -> DataFrame:
    """Fields of an object or elements of an array in variant col, as columns (pos, key, value) under names."""
    inner = df.sparkSession.tvf.variant_explode(F.col(col).outer()).toDF(*names)
    return df.lateralJoin(inner)


def parsed(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """The root level: id, path and level null, element as variant; `rejected` has the rows that don't parse."""
    return df.select(
        F.col(id_col),
        F.lit(None).cast("string").alias("path"),
        F.lit(None).cast("string").alias("level"),
        F.try_parse_json(json_col).alias("element"),
    ).filter(F.col("element").isNotNull())


def rejected(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, reason) of the records that `flatten_levels` can't read: missing (null), not_json, or repeated_field."""
    text = F.col(json_col)
    reason = F.when(text.isNull(), "missing").when(F.get_json_object(text, "$").isNull(), "not_json").otherwise("repeated_field")
    return df.filter(F.try_parse_json(json_col).isNull()).select(F.col(id_col), reason.alias("reason"))


def merged_schema(df: DataFrame, json_col: str) -> DataFrame:
    """The schema merged over all records, a row per field and kind it is met with: level, name, kind, type, n.

    level is the field names from the root, joined by a point (array places left out); kind is array, object, scalar or
    null; type is a scalar's type, else null; n counts the values. A field of clashing types has several rows. Each depth
    is aggregated map-side; the rows are as many as there are different fields. Records that don't parse are left out.
    """
    level = df.select(F.lit(None).cast("string").alias("level"), F.try_parse_json(json_col).alias("element")).filter(kind(F.col("element")) == "object")
    parts: list[DataFrame] = []
    while True:
        held = _exploded(level, "element", ("_p", "name", "value")).filter(F.col("name").isNotNull())
        held = held.select(F.concat_ws(".", "level", "name").alias("level"), "name", kind(F.col("value")).alias("kind"), "value")
        parts.append(settle(held.groupBy("level", "name", "kind", F.when(F.col("kind") == "scalar", F.schema_of_variant("value")).alias("type")).agg(F.count("*").alias("n"))))
        many = F.col("kind") == "array"
        inner = F.when(many, F.variant_get("value", "$", "array<variant>")).otherwise(F.array("value"))
        level = settle(held.filter(F.col("kind").isin("array", "object")).select("level", F.explode(inner).alias("element")).filter(kind(F.col("element")) == "object"))
        if level.isEmpty():
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def listed_arrays(df: DataFrame, json_col: str) -> tuple[str, ...]:
    """Names that are arrays in every record that has them, by one map-side aggregate; `schema_arrays` also has those of clashing types."""
    text = df.select(F.try_parse_json(json_col).alias("v")).agg(F.schema_of_variant_agg("v").alias("s")).first().s or ""
    return tuple(sorted(set(re.findall(r"[<,] ?`?([^`<>,:]+)`?: ARRAY<", text))))


def schema_arrays(schema: DataFrame) -> tuple[str, ...]:
    """Names that the merged schema lists as an array somewhere."""
    return tuple(sorted(r.name for r in schema.filter("kind = 'array'").select("name").distinct().collect()))


def schema_fields(schema: DataFrame, arrays: tuple[str, ...]) -> dict[str, dict[str, str]]:
    """Scalar fields of each array's elements with a Spark type that holds every type they were met with."""
    parent = F.try_element_at(F.split("level", r"\."), F.lit(-2))
    rows = schema.filter("kind = 'scalar'").select(parent.alias("array"), "name", "type").filter(F.col("array").isin(*arrays)).distinct().collect()
    met: dict[str, dict[str, set[str]]] = {a: {} for a in arrays}
    for r in rows:
        met[r.array].setdefault(r.name, set()).add(r.type)
    one = lambda kinds: "bigint" if kinds == {"BIGINT"} else "boolean" if kinds == {"BOOLEAN"} else "double" if all(k == "BIGINT" or k.startswith(("DECIMAL", "DOUBLE")) for k in kinds) else "string"
    return {a: {f: one(k) for f, k in sorted(fields.items())} for a, fields in met.items()}


def flatten_levels(df: DataFrame, id_col: str, json_col: str, arrays: tuple[str, ...] | None = None) -> DataFrame:
    """All elements of the arrays that the merged schema lists, or of those named, at any depth, as rows.

    Columns: id_col, path (zero-based from the root), parent_path (path of the nearest enclosing
    element, null at the root), name (of the array), ordinal, level (array names from the root,
    joined by a point), element (variant).

    A null element gives no row but keeps its ordinal; a lone value where an array is expected is
    element 0; a lone null, a null record and one that isn't JSON (or repeats a field name) give no
    row; `rejected` tells which. Repeated records give repeated rows. Other columns of df aren't carried; join on id_col.
    Objects and arrays under other names are walked through. Each level is settled before the next
    one is exploded; the recursion ends at the first empty level, whatever the depth.
    """
    if arrays is None:
        arrays = schema_arrays(merged_schema(df, json_col))
    level = parsed(df, id_col, json_col).withColumn("owner", F.lit(None).cast("string"))
    parts: list[DataFrame] = []
    while True:
        held = _exploded(level, "element", ("_p", "key", "value")).filter(F.col("key").isNotNull())
        named = F.col("key").isin(*arrays)
        base = F.concat_ws(".", "path", "key")
        held = held.withColumn("what", kind(F.col("value"))).filter((F.col("what") != "null") & (named | F.col("what").isin("array", "object")))
        many = F.col("what") == "array"
        # One branch for arrays and lone values, so that partitions don't double from level to level.
        elements = F.when(many, F.variant_get("value", "$", "array<variant>")).otherwise(F.array("value"))
        held = held.select(
            F.col(id_col), F.col("owner"), F.col("key").alias("name"), named.alias("named"), F.concat_ws(".", "level", "key").alias("level"), base.alias("base"), many.alias("many"),
            F.posexplode(elements).alias("ordinal", "element"),
        )
        place = F.when(F.col("named") | F.col("many"), F.concat(F.lit("["), F.col("ordinal").cast("string"), F.lit("]"))).otherwise("")
        got = held.withColumn("path", F.concat("base", place)).drop("base", "many")
        got = settle(got.filter(kind(F.col("element")) != "null"))
        parts.append(got.filter("named"))
        if got.isEmpty():
            break
        level = got.select(id_col, "path", "level", "element", F.when(F.col("named"), F.col("path")).otherwise(F.col("owner")).alias("owner"))
        level = level.filter(kind(F.col("element")) == "object")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(id_col, "path", F.col("owner").alias("parent_path"), "name", "ordinal", "level", "element")


def child_tables(levels: DataFrame, id_col: str, wanted: dict[str, dict[str, str]]) -> dict[str, DataFrame]:
    """Typed child tables by array name. wanted: array -> {field: Spark type}; a value that doesn't fit is null.

    A lone value that isn't an object lands in column `value`.
    """
    return {
        array: levels.filter(F.col("name") == array).select(
            id_col, "path", "parent_path", "ordinal", *[F.try_variant_get("element", f"$.{f}", t).alias(f) for f, t in types.items()], F.when(kind(F.col("element")) == "scalar", F.try_variant_get("element", "$", "string")).alias("value")
        )
        for array, types in wanted.items()
    }


def flatten_typed(df: DataFrame, id_col: str, array_col: str, parent_key: Column | None = None) -> DataFrame:
    """Array of structs of a typed table as child rows: id, parent key, ordinal and the struct's fields.

    Null arrays and null elements give no row; ordinals are those of the stored array. Arrays inside the
    struct stay as they are; `flatten_nested` has them as tables.
    """
    keyed = df.select(F.col(id_col), (parent_key if parent_key is not None else F.col(id_col)).alias("parent_key"), F.posexplode(array_col).alias("ordinal", "e"))
    return keyed.filter(F.col("e").isNotNull()).select(id_col, "parent_key", "ordinal", "e.*")


def flatten_nested(df: DataFrame, id_col: str, array_col: str, parent_key: Column | None = None) -> dict[str, DataFrame]:
    """A typed array and all arrays nested in its elements, at any depth, as child tables by path (array names joined by a point).

    Columns: id_col, parent_key, one `<array>_ordinal` of each enclosing array from the outermost on (a name
    met before gets its depth in front), ordinal, then the element's fields without nested arrays, or `value`
    where the element is no struct; structs stay whole. The enclosing ordinals together with id_col are the parent's key. Arrays in
    structs inside the element are found too. Null arrays and elements give no row; ordinals are those stored.
    """
    out: dict[str, DataFrame] = {}

    def walk(held: DataFrame, path: tuple[str, ...], above: list[str]) -> None:
        # held: id_col, parent_key, enclosing ordinals, and array _a.
        level = held.select(id_col, "parent_key", *above, F.posexplode("_a").alias("ordinal", "_e")).filter(F.col("_e").isNotNull())
        kind = level.schema["_e"].dataType
        nested: list[tuple[tuple[str, ...], Column]] = []

        def arrays(at: Column, t: StructType, names: tuple[str, ...]) -> None:
            for f in t.fields:
                if isinstance(f.dataType, ArrayType):
                    nested.append(((*names, f.name), at[f.name]))
                elif isinstance(f.dataType, StructType):
                    arrays(at[f.name], f.dataType, (*names, f.name))

        if isinstance(kind, StructType):
            arrays(F.col("_e"), kind, ())
            fields = [F.col("_e")[f.name].alias(f.name) for f in kind.fields if not isinstance(f.dataType, ArrayType)]
        else:
            fields = [F.col("_e").alias("value")]
            if isinstance(kind, ArrayType):
                nested.append((("element",), F.col("_e")))
                fields = []
        out[".".join(path)] = level.select(id_col, "parent_key", *above, "ordinal", *fields)
        own = f"{path[-1]}_ordinal" if f"{path[-1]}_ordinal" not in above else f"{len(above)}_{path[-1]}_ordinal"
        for names, array in nested:
            walk(level.select(id_col, "parent_key", *above, F.col("ordinal").alias(own), array.alias("_a")), (*path, *names), [*above, own])

    walk(df.select(F.col(id_col), (parent_key if parent_key is not None else F.col(id_col)).alias("parent_key"), F.col(array_col).alias("_a")), (array_col,), [])
    return out
