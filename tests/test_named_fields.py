"""Stops with the fields that are named, and values dropped between steps."""

import pytest
from pyspark.sql import functions as F

from loadlens.operators import stops
from loadlens.operators.extract import stop_rows
from loadlens.plans import fixtures as fx
from loadlens.plans import rulesets as rs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fields", [("customer",), ("address", "city", "state", "zipcode"), ("start_datetime", "city")])
def test_only_the_parts_of_named_fields_are_parsed(spark, fields):
    docs = fx.confirmations(spark, SF)
    some, every = stop_rows(docs, rs.CY, fields=fields), stop_rows(docs, rs.CY)
    key = ["source_file", "type", "rk", *fields]
    assert some.columns == key
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.select(*key).collect()))
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    marks = {"customer": "acility\\s+(.+?)", "city": "ddress\\s+(.+?)", "start_datetime": "rom\\s+"}
    for mark, own in zip(marks.values(), stops.PARTS):
        assert (mark in plan) == any(f in own for f in fields)


def test_a_value_is_dropped_after_its_last_reader(spark):
    steps = [lambda c: {"a": F.upper(c("block"))}, lambda c: {"b": F.length(c("a"))}, lambda c: {"city": c("b").cast("string")}]
    df = spark.createDataFrame([(["xy", "z"],)], "v array<string>").select(stops.run_steps(stops._as_structs(F.col("v")), steps, ("city",)).alias("x"))
    assert [r.city for r in df.first().x] == ["2", "1"]
    assert "prev" not in df._jdf.queryExecution().analyzed().toString()
