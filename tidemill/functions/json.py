"""JSON text through the variant type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Type codes of opened JSON values; anything else is 0.
TYPE_CODES = {"STRING": 1, "BIGINT": 2, "DECIMAL": 2, "DOUBLE": 2, "FLOAT": 2, "BOOLEAN": 3, "ARRAY": 4, "OBJECT": 5}


def type_code(value: Column) -> Column:
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    code = F.lit(0)
    for name, number in TYPE_CODES.items():
        code = F.when(kind == name, number).otherwise(code)
    return code


def open_json(df: DataFrame, column: str, path: str = "$") -> DataFrame:
    """Rows (key, value, type) of the object or array at a path; an array counts from 0."""
    held = F.try_variant_get(F.try_parse_json(column), path, "variant")
    opened = df.withColumn("__v", held).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__v").outer()))
    return opened.select(
        *df.columns,
        F.coalesce("key", F.col("pos").cast("string")).alias("key"),
        F.col("value").cast("string").alias("value"),
        type_code(F.col("value")).alias("type"),
    )


def project_json(column: str, fields: list[tuple[str, str, str]]) -> list[Column]:
    """Typed columns from (name, path, type); a value that does not fit the type is null."""
    v = F.try_parse_json(column)
    return [F.try_variant_get(v, path, dtype).alias(name) for name, path, dtype in fields]


def json_array(column: str, path: str = "$") -> Column:
    """Array at the path; anything else gives an empty array."""
    found = F.try_variant_get(F.try_parse_json(column), path, "array<variant>")
    return F.coalesce(found, F.array().cast("array<variant>"))


def json_scalars(column: str, path: str = "$") -> Column:
    """Array of scalars at the path as text; null when an element is null, an object or an array."""
    found = F.try_variant_get(F.try_parse_json(column), path, "array<variant>")
    scalar = F.forall(found, lambda v: type_code(v).isin(1, 2, 3))
    return F.when(scalar, F.transform(found, lambda v: v.cast("string")))


def keep_paths(column: str, paths: list[str]) -> Column:
    """JSON text of the object with only the dotted paths that exist."""
    v = F.try_parse_json(column)
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = path

    def build(node: dict) -> tuple[Column, Column]:
        fields, there = [], F.lit(False)
        for name in sorted(node):
            if isinstance(node[name], dict):
                value, found = build(node[name])
            else:
                value = F.try_variant_get(v, f"$.{node[name]}", "variant")
                found = value.isNotNull()
            fields.append(F.when(found, value).alias(name))
            there = there | found
        return F.struct(*fields), there

    return F.to_json(build(tree)[0])


def set_paths(column: str, values: dict[str, Column]) -> Column:
    """JSON text of the object with values set at dotted paths, parents made where absent."""

    def put(v: Column, names: list[str], value: Column) -> Column:
        fields = F.coalesce(
            F.try_variant_get(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")
        )
        head, rest = names[0], names[1:]
        inner = put(F.try_variant_get(v, f"$.{head}", "variant"), rest, value) if rest else value
        others = F.map_filter(fields, lambda k, _: k != head)
        return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(head), inner)))

    out = F.try_parse_json(column)
    for path, value in values.items():
        wrapped = F.try_parse_json(F.to_json(F.struct(value.alias("x"))))
        out = put(out, path.split("."), F.try_variant_get(wrapped, "$.x", "variant"))
    return F.to_json(out)
