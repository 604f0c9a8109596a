import json

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from foliomill.functions import plugins as P


def test_provider(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k bigint, t string")
    got = P.evaluate(df, P.constant_provider({"p": 0.25}, "k"), "k bigint, p double, missing string", ["k", "t"])
    assert rows(got) == [(1, 0.25, None), (2, 0.25, None)]
    with pytest.raises(Exception, match="answered"):
        P.evaluate(df, lambda: lambda asked: [], "k bigint", ["k"]).collect()


def test_json_text():
    tree = {"body": {"children": [{"ref": "#/items/0"}, {"ref": "#/items/0"}, {"text": "end"}]}, "items": [{"text": "one", "cells": [{"row": 1, "text": "c"}, {"row": 0, "col": 1, "text": "b"}, {"row": 0, "text": "a"}]}]}
    assert P.tree_text(json.dumps(tree)) == "one\na\nb\nc\nend"
    assert P.tree_text(None) is None and P.tree_text("{}") == ""
    assert P.parts_text([{"text": "a"}, "b", {"content": [{"text": "c"}]}, None]) == "abc"


def test_columns(spark):
    df = spark.createDataFrame([('```{"a": {"b": 1}}```',), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(P.json_cut(F.col("t"))).collect()] == ['{"a": {"b": 1}}', None, None]
    assert [r[0] for r in df.select(P.bounded(F.col("t"), 4)).collect()] == ["```…", "none", None]
    assert [r[0] for r in spark.createDataFrame([('{"body":{"text":"x"}}',)], "t string").select(P.tree_text_of("t")).collect()] == ["x"]
