"""Schema inference, typed parsing and rescue of JSON lines through VARIANT."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

RESCUE = "_rescued_data"


def _entries(lines: DataFrame) -> DataFrame:
    """One row per field of every line."""
    parsed = F.from_json("value", "map<string,variant>", {"mode": "PERMISSIVE"})
    return lines.select(F.explode(parsed).alias("field", "v"))


def field_types(lines: DataFrame) -> DataFrame:
    """Fields of JSON lines with their common type; ``VARIANT`` marks conflicting types."""
    return _entries(lines).groupBy("field").agg(
        F.schema_of_variant_agg("v").alias("kind"), F.count("*").alias("row_count"))


def infer_schema(lines: DataFrame, typed: bool = True, hints: Mapping[str, str] | None = None,
                 most: int | None = None) -> T.StructType:
    """Fields of JSON lines in order of name, typed by all their values or all strings.

    A field whose values have different types, or a nested one, becomes a string. Only one row per
    field reaches the driver. Where the data choose the names, as in maps written out as fields, ``most``
    bounds these rows: the fields that most lines have (of equal ones the first by name) get columns.
    The others are not lost, as ``parse`` leaves them in the rescue column. Hints count on top.
    """
    hints = hints or {}
    types = field_types(lines)
    if most is not None:
        types = types.orderBy(F.desc("row_count"), "field").limit(most)
    found = {r["field"]: r["kind"] for r in types.collect()}
    fields = {name: _type_of(kind) if typed else "string" for name, kind in found.items()}
    fields.update(hints)
    return T.StructType([T.StructField(n, T.DataType.fromDDL(fields[n])) for n in sorted(fields)])


def _type_of(kind: str) -> str:
    if kind.startswith("DECIMAL"):
        return "double"
    return {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}.get(kind, "string")


def new_fields(lines: DataFrame, known: T.StructType) -> list[str]:
    """Names of fields that occur in the lines but not in the schema."""
    names = lines.select(F.explode(F.expr(
        "json_object_keys(value)")).alias("field")).filter(~F.col("field").isin(known.names))
    return sorted(r["field"] for r in names.distinct().collect())


def _typed(v: Column, kind: T.DataType) -> Column:
    """Value of a variant as ``kind``, NULL when its JSON type does not fit."""
    value = F.try_variant_get(v, "$", kind.simpleString())
    json_type = F.schema_of_variant(v)
    if isinstance(kind, T.IntegralType):
        return F.when(json_type == "BIGINT", value)
    if isinstance(kind, T.NumericType):
        return F.when((json_type == "BIGINT") | (json_type == "DOUBLE")
                      | json_type.startswith("DECIMAL"), value)
    if isinstance(kind, T.BooleanType):
        return F.when(json_type == "BOOLEAN", value)
    return value


def parse(lines: DataFrame, schema: T.StructType, rescue: bool = True,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines as typed columns.

    With ``rescue`` whatever does not fit goes to ``_rescued_data`` as JSON text: unknown fields,
    values of another type, and whole lines that are not JSON. An entry is looked up by its name in
    the fields of each type and tested against the one type it has, however many fields there are.
    """
    fields = F.from_json("value", "map<string,variant>", {"mode": "PERMISSIVE"})
    rows = lines.withColumn("_fields", fields)

    def get(f: T.StructField) -> Column:
        return _typed(F.try_element_at("_fields", F.lit(f.name)), f.dataType)

    columns = [get(f).alias(f.name) for f in schema.fields]
    if rescue:
        by_type: dict[str, list[T.StructField]] = {}
        for f in schema.fields:
            by_type.setdefault(f.dataType.simpleString(), []).append(f)

        def left_over(name: Column, v: Column) -> Column:
            lost = F.lit(True)  # a name that no type has
            for same in by_type.values():
                misfit = _typed(v, same[0].dataType).isNull() & ~F.is_variant_null(v)
                lost = F.when(name.isin([f.name for f in same]), misfit).otherwise(lost)
            return lost

        rest = F.map_filter("_fields", left_over)
        broken = F.col("_fields").isNull() & (F.trim("value") != "")
        columns.append(F.when(broken, F.col("value")).when(F.size(rest) > 0, F.to_json(rest))
                       .alias(RESCUE))
    return rows.select(*columns, *keep)


def unrescue(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Typed values taken back out of the rescue column, one column per field."""
    return df.withColumns({
        f"rescued_{name}": F.get_json_object(RESCUE, f"$.{name}").try_cast(kind)
        for name, kind in fields.items()})
