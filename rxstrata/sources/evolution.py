"""Reading data of older and newer contracts as one contract asks for it.

Contracts are Avro record schemas as JSON objects. A writer's contract says how rows were
written, the reader's how they are wanted; between them the public schema resolution
rules hold: fields match by name or by an alias of the reader, missing ones take the
reader's default, others are ignored, numbers widen (int, long, float, double), strings
and bytes stand for each other, and an enum's unknown symbol takes the reader's default.
A contract that cannot be read is refused as a whole, with every reason; a row that
cannot (a null, or a symbol without default) is set aside with its reasons.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Contract = Mapping[str, object]

# fixed values: primitive types, and into which others each may widen
PRIMITIVES = {
    "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(),
}
WIDENS = {
    "int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",),
    "string": ("bytes",), "bytes": ("string",),
}


class Incompatible(ValueError):
    """A contract that cannot be read as another; ``problems`` has every reason."""

    def __init__(self, problems: Sequence[str]):
        super().__init__("; ".join(problems))
        self.problems = list(problems)


def branches(kind: object) -> tuple[object, bool]:
    """(type, may be null) of a field's type; a union may join null and one other."""
    if not isinstance(kind, (list, tuple)):
        return kind, kind == "null"
    others = [k for k in kind if k != "null"]
    if len(others) != 1:
        raise Incompatible([f"unions of {len(others)} types besides null are not supported: {kind}"])
    return others[0], "null" in kind


def _word(kind: object) -> str:
    """The kind of a type: a primitive's name, ``enum``, ``array`` or ``record``."""
    return str(kind["type"]) if isinstance(kind, Mapping) else str(kind)


def spark_type(kind: object) -> T.DataType:
    kind, _ = branches(kind)
    match _word(kind):
        case "enum":
            return T.StringType()
        case "array":
            items, null = branches(kind["items"])
            return T.ArrayType(spark_type(items), null)
        case "record":
            return schema_of(kind)
        case word if word in PRIMITIVES:
            return PRIMITIVES[word]
        case word:
            raise Incompatible([f"unknown type {word}"])


def schema_of(contract: Contract) -> T.StructType:
    """The columns of a contract."""
    return T.StructType(
        [T.StructField(f["name"], spark_type(f["type"]), branches(f["type"])[1]) for f in contract["fields"]]
    )


def contract_of(schema: T.StructType, name: str = "inferred") -> Contract:
    """The contract that a table's columns amount to; every column may be null."""
    words = {t.simpleString(): w for w, t in PRIMITIVES.items()}

    def kind(of: T.DataType) -> object:
        if isinstance(of, T.ArrayType):
            return {"type": "array", "items": ["null", kind(of.elementType)]}
        if isinstance(of, T.StructType):
            return contract_of(of, "inner")
        if of.simpleString() not in words:
            raise Incompatible([f"no contract type for {of.simpleString()}"])
        return words[of.simpleString()]

    return {"type": "record", "name": name, "fields": [{"name": f.name, "type": ["null", kind(f.dataType)]} for f in schema.fields]}


def _writer_field(reader: Mapping, writer: Contract) -> Mapping | None:
    """The writer's field for a reader's: of its name, else of its first alias there."""
    by_name = {f["name"]: f for f in writer["fields"]}
    for name in (reader["name"], *reader.get("aliases", ())):
        if name in by_name:
            return by_name[name]
    return None


def _type_problems(writer: object, reader: object, at: str) -> list[str]:
    (old, _), (new, _) = branches(writer), branches(reader)
    a, b = _word(old), _word(new)
    if a == b == "array":
        return _type_problems(old["items"], new["items"], f"{at}[]")
    if a == b == "record":
        return problems(old, new, f"{at}.")
    if a == b or b in WIDENS.get(a, ()) or (a, b) in (("enum", "string"), ("string", "enum")):
        return []
    return [f"{at}: {a} cannot be read as {b}"]


def problems(writer: Contract, reader: Contract, prefix: str = "") -> list[str]:
    """Why rows of ``writer`` cannot be read as ``reader``; empty where they can."""
    found = []
    for field in reader["fields"]:
        at, old = f"{prefix}{field['name']}", _writer_field(field, writer)
        if old is not None:
            found += _type_problems(old["type"], field["type"], at)
        elif "default" not in field:
            found.append(f"{at}: not written, and without default")
    return found


def _default(field: Mapping) -> Column:
    value, kind = field["default"], spark_type(field["type"])
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.from_json(F.lit(json.dumps(value)), kind)
    return F.lit(value).cast(kind)


def _read(value: Column, writer: object, reader: object, at: str) -> tuple[Column, list[Column]]:
    """(value as the reader wants it, reasons why a row's value is none)."""
    (old, _), (new, null) = branches(writer), branches(reader)
    reasons = [] if null else [F.when(value.isNull(), f"{at}: null")]
    word = _word(new)
    if word == "enum":
        known = value.isin(*new["symbols"])
        if "default" in new:
            return F.when(value.isNull() | known, value).otherwise(F.lit(new["default"])), reasons
        return F.when(known, value), [*reasons, F.when(~known, F.concat(F.lit(f"{at}: unknown symbol "), value))]
    if word == "array":
        def item(x):
            return _read(x, old["items"], new["items"], f"{at}[]")[0]

        _, broken = _read(F.col("x"), old["items"], new["items"], f"{at}[]")
        if broken:
            def bad(x):
                return reduce(lambda a, b: a | b, [r.isNotNull() for r in _read(x, old["items"], new["items"], at)[1]])

            reasons.append(F.when(F.exists(value, bad), f"{at}: an item cannot be read"))
        return F.transform(value, item), reasons
    if word == "record":
        parts, inner = [], []
        for field in new["fields"]:
            part, why = _field(lambda name: value[name], old, field, f"{at}.")
            parts.append(part.alias(field["name"]))
            inner += [F.when(value.isNotNull(), r) for r in why]
        return F.when(value.isNotNull(), F.struct(*parts)), reasons + inner
    return value.cast(spark_type(new)), reasons


def _field(get, writer: Contract, field: Mapping, prefix: str) -> tuple[Column, list[Column]]:
    old = _writer_field(field, writer)
    if old is None:
        return _default(field), []
    return _read(get(old["name"]), old["type"], field["type"], f"{prefix}{field['name']}")


def resolve(rows: DataFrame, writer: Contract, reader: Contract) -> DataFrame:
    """The reader's columns and ``reject_reasons``, an empty array for rows that can be
    read. ``original`` has what was written as JSON, for a replay, where they cannot.

    Raises ``Incompatible`` where no row could be. Columns that the writer's contract
    does not name are ignored; one that it names must be there.
    """
    found = problems(writer, reader)
    lacking = [f["name"] for f in writer["fields"] if f["name"] not in rows.columns]
    found += [f"{name}: named by the writer's contract, but not in the table" for name in lacking]
    if found:
        raise Incompatible(found)
    columns, reasons = [], []
    for field in reader["fields"]:
        column, why = _field(lambda name: F.col(f"`{name}`"), writer, field, "")
        columns.append(column.alias(field["name"]))
        reasons += why
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    written = F.to_json(F.struct(*[F.col(f"`{f['name']}`") for f in writer["fields"]]))
    return rows.select(
        *columns, listed.alias("reject_reasons"), F.when(F.size(listed) > 0, written).alias("original")
    )


def read_versions(
    spark: SparkSession, parts: Sequence[tuple[str, Contract | None]], reader: Contract
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of Parquet parts, each with the contract it was written by.

    A part without contract is read by that of its own columns. The rejects table has
    part, reject_reasons and original. Every part is checked before any row is read.
    """
    read, found = [], []
    for path, writer in parts:
        rows = spark.read.parquet(path)
        try:
            read.append(resolve(rows, contract_of(rows.schema) if writer is None else writer, reader).withColumn("part", F.lit(path)))
        except Incompatible as error:
            found += [f"{path}: {p}" for p in error.problems]
    if found:
        raise Incompatible(found)
    every = reduce(lambda a, b: a.unionByName(b), read)
    good = every.where(F.size("reject_reasons") == 0).select(*[f"`{f['name']}`" for f in reader["fields"]])
    return good, every.where(F.size("reject_reasons") > 0).select("part", "reject_reasons", "original")
