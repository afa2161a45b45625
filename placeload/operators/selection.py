"""The first rows in an order, by selection: the row where the limit falls is found, then rows are compared with it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from decimal import Context, Decimal
from functools import reduce
from os.path import commonprefix
from typing import Any

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeload.functions.nested import is_text

#: So many rows are sorted at most, in one task. More are narrowed down first.
SORTED = 10_000
#: Size of the quantile sketches, and three times the part of the rows by which their ranks are off.
SKETCH, OFF = 1000, 0.01
#: Ranks taken from a sketch.
GRID = 512
#: Groups of tasks whose sketches are merged before they are merged with those of the other groups.
GROUPS = 64
#: Bytes of a text that make one number, which also has their count.
BYTES = 6

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


@dataclass(frozen=True)
class Term:
    """One column of the order, and its name while rows are narrowed down."""

    column: Column
    name: str
    kind: T.DataType
    descending: bool = False
    nulls_first: bool = True

    @property
    def key(self) -> Column:
        return F.col(self.name)

    def floating(self) -> bool:
        return isinstance(self.kind, (T.FloatType, T.DoubleType))

    def text(self) -> bool:
        return isinstance(self.kind, T.BinaryType) or is_text(T.StructField("k", self.kind))

    def value(self, key: Column) -> Column:
        """The key as a value that Python takes and gives back unchanged."""
        if isinstance(self.kind, T.DateType):
            return F.unix_date(key)
        if isinstance(self.kind, T.TimestampType):
            return F.unix_micros(key)
        if isinstance(self.kind, T.TimestampNTZType):
            return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, {self.name})")
        return key

    def literal(self, value: Any) -> Column:
        """A constant of the key's own type, so that comparisons with it reach the scan."""
        if isinstance(self.kind, T.DateType):
            return F.date_from_unix_date(F.lit(value))
        if isinstance(self.kind, T.TimestampType):
            return F.timestamp_micros(F.lit(value))
        if isinstance(self.kind, T.TimestampNTZType):
            return F.expr(f"timestampadd(MICROSECOND, {value}L, {EPOCH})")
        return F.lit(value).cast(self.kind)

    def before(self, key: Column, value: Any, nan: bool) -> Column:
        """Whether ``key`` comes strictly before ``value`` (or before NaN)."""
        if nan:
            inside = F.when(key.isNotNull(), F.lit(False) if self.descending else ~F.isnan(key))
        elif value is None:
            return F.lit(False) if self.nulls_first else key.isNotNull()
        else:
            inside = key > self.literal(value) if self.descending else key < self.literal(value)
        return F.coalesce(inside, F.lit(self.nulls_first))

    def upto(self, value: Any, nan: bool, nulls: bool, nans: bool) -> Column:
        """A condition that scans understand, which holds for all keys not after ``value``.

        Scans leave row groups out by their largest value, of which NaN is no part.
        """
        if nan or (self.descending and nans) or (value is None and not self.nulls_first):
            return F.lit(True)
        if value is None:
            return self.column.isNull()
        inside = self.column >= self.literal(value) if self.descending else self.column <= self.literal(value)
        return self.column.isNull() | inside if self.nulls_first and nulls else inside

    def equals(self, key: Column, value: Any, nan: bool) -> Column:
        if nan:
            return F.isnan(key)
        return key.isNull() if value is None else key == self.literal(value)


def terms_of(df: DataFrame, order: Sequence[str | Column]) -> list[Term]:
    """The order's columns with direction; names and plain columns ascend, NULL first."""
    found = []
    for n, given in enumerate(order):
        column, descending, nulls_first = _taken_apart(F.col(given) if isinstance(given, str) else given)
        kind = df.select(column.alias("k")).schema[0].dataType
        term = Term(column, f"_placeload_{n}", kind, descending, nulls_first)
        plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
        if not isinstance(kind, plain) and not term.text():
            raise ValueError(f"rows cannot be chosen in the order of {kind.simpleString()}")
        if isinstance(kind, T.StringType) and kind.collation != "UTF8_BINARY":
            raise ValueError(f"rows cannot be chosen in the order of the collation {kind.collation}")
        found.append(term)
    return found


def _taken_apart(column: Column) -> tuple[Column, bool, bool]:
    """A column without ``asc`` or ``desc``, whether it descends, whether NULL comes first."""
    node = column._jc.node()
    if node.getClass().getSimpleName() != "SortOrder":
        return column, False, True
    plain = type(column)(SparkContext._active_spark_context._jvm.org.apache.spark.sql.Column(node.child()))
    return plain, "Descending" in node.sortDirection().toString(), "NullsFirst" in node.nullOrdering().toString()


def first_rows(df: DataFrame, limit: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``limit`` rows in the given order, of a DataFrame that reads files.

    Rows that are equal in the order are told apart by file and place in it, so the same rows are
    kept whatever the limit. No row is shuffled, sorted or written: the row at which the limit falls
    is found, see ``nth_row``, and the result is a filter on the scan that compares each row with it.
    """
    if limit < 0:
        raise ValueError(f"limit must not be negative, got {limit}")
    if limit == 0:
        return df.where(F.lit(False))
    terms = terms_of(df, order)
    terms.append(Term(F.col("_metadata.file_path"), "_placeload_file", T.StringType()))
    terms.append(Term(F.col("_metadata.row_index"), "_placeload_index", T.LongType()))
    view = df.select(*[t.column.alias(t.name) for t in terms])
    all_rows = _summary(view, terms[0], Part(F.lit(True), limit, 0))
    if all_rows["n"] <= limit:
        return df
    last = nth_row(view, terms, limit, all_rows)
    kept = F.lit(True)
    for term, (value, nan) in reversed(list(zip(terms, last, strict=True))):
        kept = term.before(term.column, value, nan) | (term.equals(term.column, value, nan) & kept)
    return df.where(terms[0].upto(*last[0], all_rows["nulls"] > 0, all_rows["nans"] > 0)).where(kept)


@dataclass(frozen=True)
class Part:
    """Rows among which the wanted one is: the condition, its place among them, their number; what all keys have in common.

    That is for texts the number of their first bytes, for decimals a value close below, so that the
    rest is told apart by the numbers of the sketch.
    """

    inside: Column
    place: int
    rows: int
    shared: int = 0
    base: Decimal = Decimal(0)


def nth_row(view: DataFrame, terms: Sequence[Term], place: int, all_rows) -> list[tuple[Any, bool]]:
    """The row at ``place`` (from 1) in the order: value, and whether it is NaN, by term.

    Column by column, the rows among which it must be are narrowed down: a mergeable quantile sketch of one pass
    gives two values close below and above the wanted rank, a second pass counts the rows below, at, between
    and above them, which says exactly where it is. So a pass leaves about a fiftieth of the rows, and conditions
    on the leading column reach the scan. Of the last few thousand rows the one at its place is taken.
    """
    part, found = Part(F.lit(True), place, all_rows["n"]), all_rows
    for term in terms:
        done = False
        while not done:
            found = found or _summary(view.where(part.inside), term, part)
            if found["n"] <= SORTED:
                return _taken(view.where(part.inside), terms, part.place)
            part, done = _narrowed(view, term, part, found)
            found = None
            if part.rows <= SORTED:
                return _taken(view.where(part.inside), terms, part.place)
        part = replace(part, shared=0, base=Decimal(0))
    return _taken(view.where(part.inside), terms, part.place)


def _ordered(term: Term) -> Column:
    name = "desc" if term.descending else "asc"
    return getattr(term.key, f"{name}_nulls_{'first' if term.nulls_first else 'last'}")()


def _taken(rows: DataFrame, terms: Sequence[Term], place: int) -> list[tuple[Any, bool]]:
    nan = [F.isnan(t.key) if t.floating() else F.lit(False) for t in terms]
    given = rows.orderBy(*map(_ordered, terms)).offset(place - 1).limit(1)
    given = given.select(*[t.value(t.key).alias(t.name) for t in terms], F.array(*[F.coalesce(n, F.lit(False)) for n in nan]).alias("nan"))
    row = given.first()
    return list(zip(row[:-1], row["nan"], strict=True))


def _number(term: Term, part: Part) -> tuple[Column, str]:
    """A number that never falls along the order of the keys, for the sketch and where the keys are text."""
    if term.text():
        some = F.substring(term.key.cast("binary"), part.shared + 1, BYTES)
        return F.conv(F.rpad(F.hex(some), 2 * BYTES, "0"), 16, 10).cast("bigint") * 16 + F.octet_length(some), "bigint"
    if isinstance(term.kind, T.DecimalType):
        return (term.key - term.literal(part.base)).cast("double"), "double"
    if term.floating():
        return term.key.cast("double"), "double"
    return term.value(term.key).cast("bigint"), "bigint"


def _summary(rows: DataFrame, term: Term, part: Part):
    """Rows, NULLs, NaNs, least and largest value, and quantiles, by one pass."""
    number, kind = _number(term, part)
    nan = F.coalesce(F.isnan(term.key), F.lit(False)) if term.floating() else F.lit(False)
    plain = ~term.key.isNull() & ~nan
    value, sketch = F.when(plain, term.value(term.key)), F.expr(f"kll_sketch_agg_{kind}(number, {SKETCH})")
    grouped = (
        rows.select(value.alias("value"), F.when(plain, number).alias("number"), term.key.isNull().alias("null"), nan.alias("nan"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("null").alias("nulls"),
            F.count_if("nan").alias("nans"),
            F.min("value").alias("least"),
            F.max("value").alias("most"),
            sketch.alias("sketch"),
            F.count("number").alias("numbers"),
        )
    )
    # A sketch of nothing has no quantiles.
    merged = F.expr(f"kll_merge_agg_{kind}(sketch) FILTER (WHERE numbers > 0)")
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "nulls", "nans")]
    whole = grouped.agg(*total, F.min("least").alias("least"), F.max("most").alias("most"), merged.alias("sketch"))
    ranks = ",".join(f"{i / GRID}D" for i in range(GRID + 1))
    grid = F.expr(f"CASE WHEN least IS NOT NULL THEN kll_sketch_get_quantile_{kind}(sketch, array({ranks})) END")
    return whole.select("n", "nulls", "nans", "least", "most", grid.alias("grid")).first()


def _narrowed(view: DataFrame, term: Term, part: Part, found) -> tuple[Part, bool]:
    """The rows that can still be the wanted one, and whether all of them are equal in this column."""
    values = found["n"] - found["nulls"] - found["nans"]
    null, nan = term.key.isNull(), F.isnan(term.key) if term.floating() else F.lit(False)
    kinds = [(nan, found["nans"]), (None, values)] if term.descending else [(None, values), (nan, found["nans"])]
    kinds = [(null, found["nulls"]), *kinds] if term.nulls_first else [*kinds, (null, found["nulls"])]
    inside, place = part.inside, part.place
    for condition, rows in kinds:
        if place <= rows:
            if condition is not None:
                return Part(inside & condition, place, rows), True
            break
        place -= rows
    if found["nulls"] or found["nans"]:
        inside = inside & ~null & ~nan
    least, most = found["least"], found["most"]
    if least == most:
        return Part(inside & (term.key == term.literal(least)), place, values), True
    bounded = inside & (term.key >= term.literal(least)) & (term.key <= term.literal(most))
    if term.text():
        shared = len(commonprefix([_bytes(least), _bytes(most)]))
        if shared > part.shared:
            return Part(bounded, place, values, shared), False
    # Doubles have 53 bits: take off what the values have in common while 30 of them are left to it.
    if isinstance(term.kind, T.DecimalType) and abs(least - part.base) > (most - least) * 2**30:
        return Part(bounded, place, values, base=least), False
    rising = values - place + 1 if term.descending else place
    low, high = _pivots(term, found, rising / values, part.base)
    key = _number(term, part)[0] if term.text() else term.key
    low_, high_ = (F.lit(low), F.lit(high)) if term.text() else (term.literal(low), term.literal(high))
    cuts = [key < low_, key == low_, (key > low_) & (key < high_), (key == high_) & (key > low_), key > high_]
    counts = view.where(bounded).agg(*[F.count_if(c) for c in cuts]).first()
    for cut, rows in zip(cuts, counts, strict=True):
        if rising <= rows:
            place = rows - rising + 1 if term.descending else rising
            return Part(bounded & cut, place, rows, part.shared, part.base), False
        rising -= rows
    raise RuntimeError("the table changed while its rows were counted")


def _pivots(term: Term, found, rank: float, base: Decimal) -> tuple[Any, Any]:
    """Values close below and above the rank, inside least and most."""
    grid, least, most = found["grid"], found["least"], found["most"]
    low, high = int((rank - OFF) * GRID), int((rank + OFF) * GRID) + 1
    low, high = grid[max(low, 0)], grid[min(high, GRID)]
    if term.text():
        return low, high
    if isinstance(term.kind, T.DecimalType):
        step, digits = Decimal(1).scaleb(-term.kind.scale), Context(prec=400)
        low, high = (digits.add(base, Decimal(x)).quantize(step, context=digits) for x in (low, high))
    return min(max(low, least), most), min(max(high, least), most)


def _bytes(value: str | bytes) -> bytes:
    return value.encode() if isinstance(value, str) else bytes(value)
