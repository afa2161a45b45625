import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from placeload import stringify_nested
from placeload.functions.nested import row_hash


def texts(spark, sql):
    return stringify_nested(spark.sql(sql)).collect()


def test_null_and_empty_structs(spark):
    found = texts(
        spark,
        """SELECT * FROM VALUES (1, named_struct('a', 1, 'b', 'x')), (2, named_struct('a', NULL, 'b', NULL)),
           (3, NULL) AS t(id, s) ORDER BY id""",
    )
    assert [r.s for r in found] == ['{"a":1,"b":"x"}', "{}", None]


def test_arrays_and_maps(spark):
    found = texts(spark, "SELECT array(1, NULL, 2) a, map() m, map(1, 'x') n, array(named_struct('d', 1)) h")[0]
    assert tuple(found) == ("[1,null,2]", "{}", '{"1":"x"}', '[{"d":1}]')


def test_text_is_escaped(spark):
    found = texts(spark, "SELECT array('\"', '\\n', 'é', '\\\\') AS a")[0].a
    assert json.loads(found) == ['"', "\n", "é", "\\"]


def test_number_and_time_text(spark):
    found = texts(
        spark,
        """SELECT array(CAST('NaN' AS DOUBLE), 1e20D) d, array(CAST(1.50 AS DECIMAL(5,2))) c,
           array(TIMESTAMP_NTZ '2023-03-14 01:02:03.456789') n, array(TIMESTAMP '2023-03-14 01:02:03.456789') t,
           array(X'0102') b""",
    )[0]
    assert tuple(found) == (
        '["NaN",1.0E20]',
        "[1.50]",
        '["2023-03-14T01:02:03.456"]',
        '["2023-03-14T01:02:03.456Z"]',
        '["AQI="]',
    )


def test_variant(spark):
    found = texts(spark, """SELECT parse_json('{"a":[1,null]}') AS v""")[0].v
    assert json.loads(found) == {"a": [1, None]}


def test_scalars_keep_their_type_and_place(spark):
    df = spark.sql("SELECT 1 i, 'x' s, struct(1 AS a) n, 1.5D d, DATE '2023-03-14' t, true b")
    found = stringify_nested(df)
    assert found.dtypes == [
        ("i", "int"), ("s", "string"), ("n", "string"), ("d", "double"), ("t", "date"), ("b", "boolean"),
    ]


def test_scalars_can_be_refused(spark):
    with pytest.raises(ValueError, match="'i'"):
        stringify_nested(spark.sql("SELECT 1 i, 'x' s"), scalars="error")
    assert stringify_nested(spark.sql("SELECT 'x' s, array(1) a"), "error").count() == 1
    with pytest.raises(ValueError, match="scalars"):
        stringify_nested(spark.sql("SELECT 1 i"), scalars="drop")


def test_dotted_names(spark):
    df = spark.sql("SELECT struct(1 AS x) AS `a.b`, 'p' AS `c.d`, struct(2 AS b) AS a, 't' AS `e``f`")
    assert rows(stringify_nested(df)) == [('{"x":1}', "p", '{"b":2}', "t")]
    assert stringify_nested(df).columns == ["a.b", "c.d", "a", "e`f"]


def test_char_and_varchar_pass_through(spark, name):
    spark.sql(f"CREATE TABLE {name} (a VARCHAR(3), b CHAR(2)) USING parquet")
    spark.sql(f"INSERT INTO {name} VALUES ('abc', 'de')")
    assert rows(stringify_nested(spark.table(name), "error")) == [("abc", "de")]


items = st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1))
words = st.one_of(st.none(), st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=8))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(words, items, st.one_of(st.none(), st.lists(words, max_size=3))), min_size=1, max_size=20))
def test_json_reads_back(spark, values):
    schema = "struct<w:string,i:int,l:array<string>>"
    df = spark.createDataFrame([(v,) for v in values], f"s {schema}")
    back = stringify_nested(df).select(F.from_json("s", schema).alias("s"))
    assert [tuple(r.s) for r in back.collect()] == values


def test_row_hash_tells_which_columns_are_null(spark):
    both = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    first, second = (r[0] for r in both.select(row_hash(both.schema)).collect())
    assert first != second
