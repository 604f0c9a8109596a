from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from foliomill.functions import fidelity, hashing, ratios, text
from foliomill.operators import ledger, lineage, relational, retrieval, sequence


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


def test_percentiles(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    got = df.agg(
        ratios.linear_percentile("x", 0.5), ratios.floor_percentile("x", 0.5), ratios.rounded_percentile("x", 0.5)
    ).first()
    assert tuple(got) == (2.5, 2.0, 3.0)  # 1.5 rounds to the even rank 2
    empty = df.where("x > 9").agg(ratios.linear_percentile("x", 0.5, 0.0), ratios.floor_percentile("x", 0.5)).first()
    assert tuple(empty) == (0.0, None)


def test_ratio_families(spark):
    zero, two = F.lit(0), F.lit(2)
    got = spark.range(1).select(
        ratios.ratio_or_null(two, zero),
        ratios.ratio_or(two, zero, 1.0),
        ratios.overlap_precision(zero, zero, zero),
        ratios.overlap_precision(zero, zero, two),
        ratios.overlap_recall(zero, zero),
        ratios.f1(F.lit(0.0), F.lit(0.0)),
    ).first()
    assert tuple(got) == (None, 1.0, 1.0, 0.0, 1.0, 0.0)


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        ("x y", "x y", "exact"),
        ("x y", "x\n y", "whitespace"),
        ("Sala", "sala", "case"),
        ("acción", "accion", "accent"),
        ("a, b", "a b", "punctuation"),
        ("art 5", "art 6", "digits"),
        ("uno", "dos", "substantive"),
    ],
)
def test_change_class(spark, a, b, want):
    assert one(spark, text.change_class(F.col("a"), F.col("b")), a=a, b=b) == want


def test_dates(spark):
    assert one(spark, text.spanish_date(F.lit("3"), F.lit("Marzo"), F.lit("2001")), a="") == date(2001, 3, 3)
    assert one(spark, text.spanish_date(F.lit("31"), F.lit("febrero"), F.lit("2001")), a="") is None
    assert one(spark, text.spanish_date(F.lit("3"), F.lit("march"), F.lit("2001")), a="") is None
    assert one(spark, text.numeric_date(F.col("a")), a="7/4/1999") == date(1999, 4, 7)
    assert one(spark, text.numeric_date(F.col("a")), a="77/4/1999") is None


def test_lines_and_flags(spark):
    assert one(spark, text.lines(F.col("a")), a="x\r\ny\x0bz\n") == ["x", "y", "z"]
    assert one(spark, text.lines(F.col("a")), a="") == []
    assert one(spark, text.quality_flags(F.col("a")), a=None) == ["empty"]
    assert one(spark, text.quality_flags(F.col("a")), a=" \n ") == ["empty"]
    assert one(spark, text.quality_flags(F.col("a")), a="uno d�s") == ["replacement"]


def test_python_folds(spark):
    df = spark.createDataFrame([("  STRASSE ß ﬁn ",), (None,)], "a string")
    assert [r[0] for r in df.select(text.nfkc_fold("a")).collect()] == ["strasse ss fin", None]
    assert [r[0] for r in spark.createDataFrame([("Ñandú",)], "a string").select(text.strip_marks("a")).collect()] == ["Nandu"]


def test_fidelity():
    assert fidelity.edit_distance("a b c".split(), "a x c d".split()) == 2
    assert fidelity.common_subsequence("a b c d".split(), "b d e".split()) == 2
    assert fidelity.common_subsequence([], ["a"]) == 0


def test_hashing(spark):
    assert one(spark, hashing.canonical_json(b=F.col("a"), a=F.lit(None).cast("string")), a="x") == '{"a":null,"b":"x"}'
    shas = spark.createDataFrame([("f" * 64,), ("0" * 64,)], "s string")
    assert [r[0] for r in shas.select(hashing.in_hash_sample(F.col("s"), 0.5)).collect()] == [False, True]
    assert [r[0] for r in shas.select(hashing.in_hash_sample(F.col("s"), 1.0)).collect()] == [True, True]
    assert [r[0] for r in shas.select(hashing.hash_shard(F.col("s"), 7)).collect()] == [(2**64 - 1) % 7, 0]
    assert one(spark, hashing.object_key("p", F.lit("s"), F.lit("c"), F.lit("zz"), F.lit("pdf")), a="") is None


def test_key_page(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert rows(relational.key_page(df, "k", 3, 3)) == [(4, True), (5, True), (6, True)]
    assert rows(relational.key_page(df, "k", 7, 3)) == [(8, False), (9, False)]
    assert rows(relational.key_page(df, "k", 99, 3)) == []


def test_joins(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "i int, p string")
    b = spark.createDataFrame([(None, 7), ("x", 8)], "p string, v int")
    assert rows(relational.null_safe(a, b, ["p"])) == [(1, None, 7), (2, "x", 8)]
    edges = spark.createDataFrame([(1, 2), (2, 2), (3, 1)], "s int, t int")
    nodes = spark.createDataFrame([(2,), (1,)], "n int")
    assert rows(relational.either_end(edges, nodes, "s", "t", "n").select("n", "s", "t")) == [(1, 1, 2), (1, 3, 1), (2, 1, 2), (2, 2, 2)]
    assert rows(relational.matched(spark.range(2), spark.range(1, 3), ["id"])) == [(0, "left"), (1, "both"), (2, "right")]


def test_runs_and_bridges(spark):
    df = spark.createDataFrame([("d", i) for i in (1, 2, 4, 4, 7)], "d string, p int")
    assert rows(sequence.runs(df, ["d"], "p")) == [("d", 1, 2, 2), ("d", 4, 4, 1), ("d", 7, 7, 1)]
    labels = ["a", None, "a", None, None, "a", None, "b", None]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(labels)], "d string, p int, l string")
    got = [r["l"] for r in sequence.bridged(df, ["d"], "p", "l", 1).orderBy("p").collect()]
    assert got == ["a", "a", "a", None, None, "a", None, "b", None]


def test_segments_and_packing(spark):
    df = spark.createDataFrame([("d", i, x) for i, x in ((1, "a"), (2, "a"), (4, "a"), (5, "b"))], "d string, p int, x string")
    got = rows(sequence.change_segments(df, ["d"], "p", "x"))
    assert got == [("d", 1, "a", 1, 2, 2), ("d", 2, "a", 4, 4, 1), ("d", 3, "b", 5, 5, 1)]
    df = spark.createDataFrame([("d", i, c) for i, c in enumerate((5, 5, 9, 1, 1, 1))], "d string, p int, c int")
    assert [r["batch"] for r in sequence.pack(df, "d", "p", "c", 10, 2).orderBy("p").collect()] == [0, 0, 1, 1, 2, 2]
    assert sequence.halves(1, 8, lambda a, b: b - a + 1, 3) == [(1, 2), (3, 4), (5, 6), (7, 8)]


def test_merge_and_history(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, w string")
    new = spark.createDataFrame([(1, None, "y"), (3, "c", "z")], "k int, v string, w string")
    assert rows(ledger.upsert(old, new, ["k"])) == [(1, "a", "y"), (2, "b", "x"), (3, "c", "z")]
    assert rows(ledger.insert_missing(old, new, ["k"])) == [(3, "c", "z")]
    t = [datetime(2024, 1, d) for d in range(1, 5)]
    df = spark.createDataFrame([("k", v, a) for v, a in zip(["x", "x", "y", "x"], t)], "k string, v string, at timestamp")
    assert [tuple(r)[1:] for r in ledger.history(df, ["k"], "v", "at").orderBy("valid_from").collect()] == [
        ("x", t[0], t[2]), ("y", t[2], t[3]), ("x", t[3], None)
    ]


def test_resolution(spark):
    df = spark.createDataFrame(
        [("a", 1, True, "c"), ("a", 2, False, "c"), ("b", 1, False, "c"), ("b", 1, False, "e"), ("c", 1, False, "c"), ("d", None, True, "c")],
        "g string, v int, ok boolean, ch string",
    )
    got = rows(ledger.resolved(df, ["g"], "v", F.col("ok"), "ch"))
    assert got == [("a", "conflict", None), ("b", "corroborated", 1), ("c", "unverified", 1)]


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (None, 1)], "src int, dst int")
    pairs = lineage.closure(edges)
    assert pairs.count() == 12 and rows(lineage.on_cycles(pairs)) == [(1,), (2,), (3,)]
    assert lineage.closure(edges.where("src > 9")).count() == 0


def test_retrieval(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None)], "k int, v array<float>")
    assert rows(retrieval.nearest(df, "k", "v", [1.0, 0.0], 5)) == [(1, 1.0), (2, 0.707107)]
    docs = spark.createDataFrame([(1, "casa casa roja"), (2, "casa azul"), (3, "nada")], "k int, t string")
    assert [r["k"] for r in retrieval.lexical_rank(docs, "k", "t", ["casa", "azul"], 5).collect()] == [2, 1]
