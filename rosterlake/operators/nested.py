"""Deeply nested records into flat, linked rows.

Method: a higher-order projection. Nested ``transform`` calls attach ancestor
keys and positions to every element, ``flatten`` combines the arrays of one
level, and one ``inline`` per target table emits the rows. No Python touches a
row, and nothing is shuffled: rows are emitted in the partition of their record.

Two inputs are understood: columns with a declared nested schema
(``child_tables`` / ``typed_children``) and JSON text whose shape varies
(``json_records`` / ``json_children``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.session import spread

#: Characters that may stand before a body without making it unreadable.
INVISIBLE = "\\u0000-\\u0020\\u00A0\\u00AD\\u200B-\\u200F\\u2028-\\u202F\\u2060-\\u2064\\uFEFF"


def _quote(path: str) -> str:
    return ".".join(f"`{p}`" for p in path.split("."))


def array_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Every path of ``schema`` that holds an array of structs, parents before children."""
    found: list[tuple[str, ...]] = []
    for f in schema.fields:
        kind, here = f.dataType, (*prefix, f.name)
        if isinstance(kind, T.StructType):
            found += array_paths(kind, here)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            found.append(here)
            found += array_paths(kind.elementType, here)
    return found


def _elements(schema: T.StructType, path: tuple[str, ...]) -> Column:
    """array<struct<pos string, parent_pos string, item struct>> of the elements at ``path``.

    Null elements are left out but keep their position.
    """

    def open_level(base: Column, kind: T.DataType, rest: tuple[str, ...], pos: Column | None) -> Column:
        while True:
            name, rest = rest[0], rest[1:]
            base, kind = base.getField(name), kind[name].dataType
            if isinstance(kind, T.ArrayType):
                break
        items = F.coalesce(base, F.lit(None).cast(kind))

        def attach(x: Column, i: Column) -> Column:
            at = i.cast("string") if pos is None else F.concat_ws(".", pos, i.cast("string"))
            if rest:
                return open_level(x, kind.elementType, rest, at)
            return F.struct(at.alias("pos"), (pos if pos is not None else F.lit(None).cast("string")).alias("parent_pos"), x.alias("item"))

        out = F.transform(items, attach)
        if rest:
            return F.flatten(F.filter(out, lambda x: x.isNotNull()))
        return F.filter(out, lambda x: x["item"].isNotNull())

    head = F.struct(*[F.col(f"`{f.name}`").alias(f.name) for f in schema.fields])
    return open_level(head, schema, path, None)


def typed_children(df: DataFrame, key: Column, parent_type: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """One row (parent_type, parent_id, child_path, child_pos) per array element of a typed table.

    Null or empty arrays and null elements give no row; elements behind a null
    element keep their position; extra columns are looked at like any other,
    and ``skip`` names the top-level ones to leave out. An empty table gives no rows.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name not in skip])

    def link(path: tuple[str, ...]) -> Column:
        return F.transform(_elements(schema, path), lambda x: F.struct(F.lit(".".join(path)).alias("child_path"), x["pos"].alias("child_pos")))

    links = [link(p) for p in array_paths(schema)]
    kind = "array<struct<child_path:string,child_pos:string>>"
    every = F.flatten(F.filter(F.array(*links), lambda x: x.isNotNull())) if links else F.array().cast(kind)
    return df.select(F.lit(parent_type).alias("parent_type"), key.cast("string").alias("parent_id"), F.inline(every))


def child_tables(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """The related flat tables of a typed nested table: '' for the parent, else one per array path.

    Each child has ``parent_id``, ``pos`` (own position with those of its
    ancestors), ``parent_pos`` (the position of the enclosing element, null
    directly below the record) and the element's own fields; arrays of structs
    inside it are in their own table. Field names that clash with the link
    columns get the prefix ``item_``. Null arrays and elements give no row.
    """

    def flat(kind: T.StructType, base: str) -> list[Column]:
        cols = []
        for f in kind.fields:
            inner = f"{base}.`{f.name}`" if base else f"`{f.name}`"
            if isinstance(f.dataType, T.StructType):
                cols += [F.col(f"{inner}.`{g.name}`").alias(f"{f.name}_{g.name}") for g in f.dataType.fields if not _is_nested(g.dataType)]
            elif not _is_nested(f.dataType):
                cols.append(F.col(inner).alias(f"item_{f.name}" if f.name in ("parent_id", "pos", "parent_pos") else f.name))
        return cols

    tables = {"": df.select(*flat(df.schema, ""))}
    for path in array_paths(df.schema):
        rows = df.select(F.col(f"`{key}`").cast("string").alias("parent_id"), F.inline(_elements(df.schema, path)))
        tables[".".join(path)] = rows.select("parent_id", "pos", "parent_pos", *flat(rows.schema["item"].dataType, "item"))
    return tables


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def json_records(df: DataFrame, body: str, out: str = "record", mark: str = "resourceType") -> DataFrame:
    """Parse ``body`` into the object ``out`` (map<string, variant>), NULL where it can't be read in full.

    Invisible characters before the text are dropped. A record may lie one
    level down: as JSON text in a JSON string, or in an envelope, that is, in
    a field of an object that has no field ``mark`` itself.
    """
    as_map = "map<string,variant>"
    text = F.regexp_replace(F.col(body), f"^[{INVISIBLE}]+", "")
    text = F.regexp_replace(text, f"[{INVISIBLE}]+$", "")
    # The JSON reader stops after one value: what follows it is caught by the last character.
    whole = F.when(text.rlike(r'(?s)^\{.*\}$|^".*"$|^\[.*\]$'), text)
    step = df.withColumn("__v", F.try_parse_json(whole))
    step = step.withColumn("__v", _unwrap_text(F.col("__v")))
    step = step.withColumn("__o", F.try_variant_get("__v", "$", as_map))
    inner = F.filter(
        F.transform(F.map_values("__o"), lambda v: F.try_variant_get(_unwrap_text(v), "$", as_map)),
        lambda o: o.isNotNull() & F.map_contains_key(o, mark),
    )
    own = F.when(F.col("__o").isNotNull() & ~F.map_contains_key("__o", mark), F.coalesce(F.get(inner, F.lit(0)), F.col("__o")))
    return step.withColumn(out, F.coalesce(own, F.col("__o"))).drop("__v", "__o")


def _unwrap_text(v: Column) -> Column:
    """A variant that is a string holding JSON becomes that JSON; anything else stays."""
    is_text = F.schema_of_variant(v) == "STRING"
    return F.when(is_text, F.try_parse_json(F.try_variant_get(v, "$", "string"))).otherwise(v)


def shape_of(records: DataFrame, record: str = "record") -> tuple[list[str], int]:
    """Names of fields that hold an array in any record, and how many objects and arrays lie inside each other at most.

    The list is as long as the schema, not as the data; both come from one
    pass with map-side aggregation. Without records it is empty and 0.
    """
    text = F.to_json(record)
    names = F.array_distinct(F.regexp_extract_all(text, F.lit(r'"([^"\\]+)":\['), F.lit(1)))
    brackets = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"|[^\[\]{}]+', "")
    # Records of one shape are looked at once.
    shapes = records.select(names.alias("names"), brackets.alias("brackets")).distinct()
    step = F.aggregate(
        F.split("brackets", ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda at, x: F.struct((at["now"] + F.when(x.isin("{", "["), 1).when(x.isin("}", "]"), -1).otherwise(0)).alias("now"), F.greatest(at["most"], at["now"] + F.when(x.isin("{", "["), 1).otherwise(0)).alias("most")),
    )
    rows = shapes.select(F.explode_outer("names").alias("n"), step["most"].alias("depth")).groupBy("n").agg(F.max("depth").alias("depth")).collect()
    return sorted(r.n for r in rows if r.n is not None), max((r.depth or 0 for r in rows), default=0)


def json_children(records: DataFrame, keys: list[Column], record: str, lists: list[str], levels: int) -> DataFrame:
    """One row (keys, child_path, child_pos) per object that is an element of an array, at any depth.

    ``lists`` names fields whose lone object counts as element 0. Null
    elements and plain values give no row but keep their position. ``levels``
    is the depth of the deepest record (``shape_of``); one that is deeper
    raises an error, none is cut silently.
    """

    def opened(value: Column) -> list[Column]:
        return [F.try_variant_get(value, "$", "array<variant>").alias("arr"), F.try_variant_get(value, "$", "map<string,variant>").alias("obj")]

    def some(n: Column) -> Column:
        return n["arr"].isNotNull() | n["obj"].isNotNull()

    def below(n: Column, i: Column) -> Column:
        return F.when(n["pos"] == "", i).otherwise(F.concat_ws(".", n["pos"], i))

    def children(n: Column) -> Column:
        # Values are opened once; plain ones are dropped before paths and positions are made.
        items = F.filter(F.transform(n["arr"], lambda x, i: F.struct(i.alias("i"), *opened(x))), some)
        in_array = F.transform(items, lambda x: F.struct(n["path"].alias("path"), below(n, x["i"].cast("string")).alias("pos"), x["arr"].alias("arr"), x["obj"].alias("obj"), F.lit(True).alias("elem")))
        fields = F.filter(F.transform(F.map_entries(n["obj"]), lambda e: F.struct(e["key"].alias("key"), *opened(e["value"]))), some)

        def field(e: Column) -> Column:
            lone = e["obj"].isNotNull() & (e["key"].isin(lists) if lists else F.lit(False))
            path = F.when(n["path"] == "", e["key"]).otherwise(F.concat_ws(".", n["path"], e["key"]))
            return F.struct(path.alias("path"), F.when(lone, below(n, F.lit("0"))).otherwise(n["pos"]).alias("pos"), e["arr"].alias("arr"), e["obj"].alias("obj"), lone.alias("elem"))

        return F.when(n["arr"].isNotNull(), in_array).when(n["obj"].isNotNull(), F.transform(fields, field))

    first = F.array(F.struct(F.lit("").alias("path"), F.lit("").alias("pos"), F.lit(None).cast("array<variant>").alias("arr"), F.col(record).alias("obj"), F.lit(False).alias("elem")))
    names = [f"__k{i}" for i in range(len(keys))]
    step = records.where(F.col(record).isNotNull()).select(*[k.alias(n) for k, n in zip(keys, names)], first.alias("__open"), F.array().cast("array<struct<child_path:string,child_pos:string>>").alias("__out"))
    for _ in range(levels):
        step = step.select(*names, F.flatten(F.transform("__open", children)).alias("__open"), "__out")
        found = F.transform(F.filter("__open", lambda n: n["elem"] & n["obj"].isNotNull()), lambda n: F.struct(n["path"].alias("child_path"), n["pos"].alias("child_pos")))
        step = step.select(*names, "__open", F.concat("__out", found).alias("__out"))
    checked = F.when(F.size("__open") > 0, F.raise_error(F.lit(f"a record is nested deeper than {levels} levels"))).otherwise(F.col("__out"))
    return step.select(*names, F.inline(checked))


def latest_records(spool: DataFrame) -> DataFrame:
    """Per (resource_type, resource_id) the readable record with the latest spooled_at (ties: spool_seq).

    Rows without a type or id, and rows whose body can't be read, are left out.
    """
    read = json_records(spread(spool).where("resource_type is not null and trim(resource_id) <> ''"), "body").where("record is not null")
    return read.groupBy("resource_type", "resource_id").agg(F.max_by("record", F.struct("spooled_at", "spool_seq")).alias("record"))


def spool_children(spool: DataFrame) -> DataFrame:
    """Rows (parent_type, parent_id, child_path, child_pos) of a spool of JSON resources.

    Fields that hold arrays are looked for in every readable body, also in
    those that are not the latest of their resource. Unreadable bodies, null
    bodies and null ids give no rows; an empty spool gives an empty result.
    """
    spool = spread(spool.select("resource_type", "resource_id", "body", "spooled_at", "spool_seq"))
    readable = json_records(spool.where("body is not null"), "body").where("record is not null")
    lists, depth = shape_of(readable)
    rows = json_children(latest_records(spool), [F.col("resource_type"), F.col("resource_id")], "record", lists, depth)
    return rows.select(F.col("__k0").alias("parent_type"), F.col("__k1").alias("parent_id"), "child_path", "child_pos")
