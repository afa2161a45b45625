"""What has to change before rows of one schema fit a table of another, and what must not."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeload.functions.nested import quoted

VARCHAR = "__CHAR_VARCHAR_TYPE_STRING"
#: What is done with a column: nothing, the rows cast, the table's column widened or added, NULLs put in, or no load.
KEEP, CAST, WIDEN, ADD, FILL, REFUSE = "keep", "cast", "widen", "add", "fill", "refuse"

#: Bits of whole numbers, and decimal digits that hold them.
WHOLE = {T.ByteType: (8, 3), T.ShortType: (16, 5), T.IntegerType: (32, 10), T.LongType: (64, 20)}
#: Bits of whole numbers that a floating type holds exactly.
EXACT = {T.FloatType: 24, T.DoubleType: 53}


@dataclass(frozen=True)
class Step:
    column: str
    action: str
    source_type: str | None
    target_type: str | None
    result_type: str | None


def held_type(field: T.StructField) -> T.DataType:
    """A field's type with its text width, which Spark keeps beside it."""
    width = re.fullmatch(r"varchar\((\d+)\)", field.metadata.get(VARCHAR, ""))
    return T.VarcharType(int(width[1])) if width else field.dataType


def fits(one: T.DataType, other: T.DataType) -> bool:
    """Whether every value of ``one`` is a value of ``other``: the order of the lattice of types."""
    kinds = type(one), type(other)
    if one == other or isinstance(one, T.NullType):
        return True
    if kinds[0] in WHOLE and kinds[1] in WHOLE:
        return WHOLE[kinds[0]][0] <= WHOLE[kinds[1]][0]
    if kinds[0] in WHOLE and kinds[1] in EXACT:
        return WHOLE[kinds[0]][0] <= EXACT[kinds[1]]
    if kinds[0] in WHOLE and isinstance(other, T.DecimalType):
        return other.precision - other.scale >= WHOLE[kinds[0]][1]
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        return one.scale <= other.scale and one.precision - one.scale <= other.precision - other.scale
    if kinds == (T.FloatType, T.DoubleType) or kinds == (T.DateType, T.TimestampNTZType):
        return True
    if isinstance(one, (T.VarcharType, T.CharType)):
        return isinstance(other, T.StringType) or (isinstance(other, T.VarcharType) and one.length <= other.length)
    return False


def least_common(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both, or None: the lattice's join."""
    if fits(one, other):
        return other
    if fits(other, one):
        return one
    decimals = [
        T.DecimalType(WHOLE[type(k)][1], 0) if type(k) in WHOLE else k if isinstance(k, T.DecimalType) else None for k in (one, other)
    ]
    if None not in decimals:
        scale = max(d.scale for d in decimals)
        precision = scale + max(d.precision - d.scale for d in decimals)
        return T.DecimalType(precision, scale) if precision <= 38 else None
    kinds = {type(one), type(other)}
    # The narrowest floating type for whole numbers that a float does not hold.
    if kinds & set(EXACT) and kinds & set(WHOLE):
        whole = max(WHOLE[k][0] for k in kinds & set(WHOLE))
        return T.DoubleType() if whole <= EXACT[T.DoubleType] else None
    return None


def drift(source: T.StructType, target: T.StructType, widen: bool = True, add: bool = True) -> list[Step]:
    """A step for every column, in the order of the table, new ones last. Names match whatever their case.

    Nested types have to be equal. ``widen=False`` and ``add=False`` say that the table cannot change, so a
    column it would have to be changed for is refused. Whether a column's values would fit a narrower one is not looked at.
    """
    given = {f.name.lower(): f for f in source}
    if len(given) < len(source.fields):
        raise ValueError("columns of the source have names that differ by case only")
    steps = []
    for field in target:
        mine, own = given.pop(field.name.lower(), None), held_type(field)
        if mine is None:
            action = FILL if field.nullable else REFUSE
            steps.append(Step(field.name, action, None, own.simpleString(), own.simpleString() if field.nullable else None))
            continue
        theirs = held_type(mine)
        if theirs == own:
            result, action = own, KEEP
        else:
            result = least_common(theirs, own)
            action = REFUSE if result is None else CAST if result == own else WIDEN if widen else REFUSE
        shown = None if action == REFUSE else result.simpleString()
        steps.append(Step(field.name, action, theirs.simpleString(), own.simpleString(), shown))
    for field in given.values():
        kind = held_type(field).simpleString()
        steps.append(Step(field.name, ADD if add else REFUSE, kind, None, kind if add else None))
    return steps


def drift_frame(spark: SparkSession, steps: Sequence[Step]) -> DataFrame:
    """The steps as rows: column_name, action, source_type, target_type, result_type."""
    rows = [(s.column, s.action, s.source_type, s.target_type, s.result_type) for s in steps]
    return spark.createDataFrame(rows, "column_name string, action string, source_type string, target_type string, result_type string")


def refused(steps: Sequence[Step]) -> None:
    bad = [f"{s.column}: {s.source_type or 'absent'} into {s.target_type or 'no column'}" for s in steps if s.action == REFUSE]
    if bad:
        raise ValueError(f"rows do not fit the table: {'; '.join(bad)}")


def adapted(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """``df`` with the columns of the table after its change: cast, or NULL where the rows have none."""
    refused(steps)
    given = {c.lower(): c for c in df.columns}
    columns = []
    for s in steps:
        mine = given.get(s.column.lower())
        value = F.lit(None) if mine is None else F.col(quoted(mine))
        # Widths are the table's to enforce.
        kind = "string" if s.result_type.startswith("varchar") else s.result_type
        columns.append(value.cast(kind).alias(s.column))
    return df.select(*columns)


def apply_drift(df: DataFrame, name: str) -> DataFrame:
    """Change the catalog table ``name`` so that it holds the rows of ``df``, and return them as it wants them.

    Refuses before anything changes. New columns are added in place. For a wider column Spark's catalog has no
    statement, so the table is written once with its new types and takes the old one's name.
    """
    from placeload.sources.tables import rebuilt

    spark = df.sparkSession
    steps = drift(df.schema, spark.table(name).schema)
    refused(steps)
    table = ".".join(map(quoted, name.split(".")))
    new = [s for s in steps if s.action == ADD]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{quoted(s.column)} {s.result_type}' for s in new)})")
    if any(s.action == WIDEN for s in steps):
        rebuilt(spark, name, {s.column: s.result_type for s in steps})
    return adapted(df, steps)
