"""Scores, layouts and records of sources on small fixtures."""

import datetime
import json
import random

from pyspark.sql import functions as F
from tests.conftest import rows

from foliomill.functions import fidelity, layouts, patterns, plugins, schema
from foliomill.operators import ledger, lineage
from foliomill.sources import files, observations, sinks


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def subsequence(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(best[j - 1] + 1 if x == y else max(best[j], new[-1]))
        best = new
    return best[-1]


def test_recurrences_against_tables():
    rng = random.Random(1)
    word = lambda: [rng.choice("abc") for _ in range(rng.randrange(90))]
    for _ in range(300):
        a, b = word(), word()
        assert fidelity.edit_distance(a, b) == distance(a, b) and fidelity.common_subsequence(a, b) == subsequence(a, b)


def test_scores(spark):
    assert fidelity.scores("", "") == (0.0, 0.0, 1.0, 1.0, 1.0, 1.0)
    assert fidelity.scores("", "ab cd")[:4] == (5.0, 2.0, 1.0, 0.0)
    cer, wer, recall, precision, f1, order = fidelity.scores("la Ley núm. 5-07 rige", "la ley núm. 5-07")
    assert wer == 2 / 5 and recall == 4 / 5 and precision == 1.0 and order == 4 / 5 and abs(f1 - 8 / 9) < 1e-12 and cer == 6 / 21
    df = spark.createDataFrame([("a", None), (None, "a"), ("a b", "a c")], "e string, c string")
    assert [r[0] is None or r[0]["wer"] for r in df.select(fidelity.fidelity("e", "c")).collect()][2] == 0.5


def test_critical_spans(spark):
    text = "Artículo 5 y artículo  5, Ley núm. 108-05, RD$ 1,250.50, 12/03/2004; parcela núm. 12-B; expediente 2004-55."
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    got = {k: df.select(patterns.folded(F.col("t"), p)).first()[0] for k, p in patterns.CRITICAL.items()}
    assert got["article"] == ["artículo 5", "artículo 5"] and got["law"] == ["ley núm. 108-05"] and got["date"] == ["12/03/2004"]
    assert got["money"] == ["rd$ 1,250.50,"] and got["case_id"] == ["expediente 2004-55"] and got["decree"] == []
    pairs = spark.createDataFrame([(["a", "a", "b"], ["a", "c", "a", "a"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in pairs.select(patterns.bag_overlap(F.col("a"), F.col("b"))).collect()] == [2, 0]
    runs = spark.createDataFrame([(["x", "x", "y", "y", "y", "x"],), ([],), ([None, None],)], "a array<string>")
    assert [r[0] for r in runs.select(patterns.longest_run(F.col("a"))).collect()] == [3, 0, 2]


PAGES = {
    "old": ("SENTENCIA DEL 7 DE JUNIO DE 2023, NÚM. SCJ-PS-23-1234\nVisto", "principales_2023_2024_sentence", "SCJ-PS-23-1234", datetime.date(2023, 6, 7)),
    "dated": ("RESOLUCIÓN DEL 31 DE SETIEMBRE DE 2023, NÚM. SCJ-PL-23-12", "principales_2023_2024_resolution", "SCJ-PL-23-12", None),
    "plain": ("texto\nRESOLUCIÓN NÚM. 2023-7, sobre plazos", "principales_2023_2024_resolution", "2023-7", None),
    "third": ("Exp. 001-033\nMateria: Laboral\nDecisión: Rechaza\nRecurrente: Ana\ncita SCJ-TS-24-99", "principales_2025_tercera_sala", "001-033", None),
    "second": ("Exp. núm. 12\nRec. Luis\nFecha: 3 de enero de 2025\nSentencia núm. SCJ-SS-25-0001", "principales_2025_segunda_sala", "12 | Luis | Fecha: 3 de enero de 2025", datetime.date(2025, 1, 3)),
    "full": ("Resolución núm. 45-2025\nExpediente núm.: 2025-1", "principales_2025_pleno_resolution", "45-2025 | 2025-1", None),
    "first": ("SCJ-PS-25-0042\nPartes: A y B\nMateria: Civil\nPonente: Juez", "principales_2025_primera_sala", "SCJ-PS-25-0042", None),
    "none": ("se cita la sentencia núm. SCJ-PS-25-0042 y la resolución núm. 7", "unknown", None, None),
    "deep": ("x" * 2400 + "\nResolución núm. 45-2025\nExpediente núm.: 2025-1", "unknown", None, None),
}


def test_page_layouts(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in PAGES.items()], "k string, t string")
    got = {r["k"]: r["x"] for r in df.select("k", layouts.page_layout(F.col("t")).alias("x")).collect()}
    assert {k: (x["family"], x["key"], x["day"]) for k, x in got.items()} == {k: v[1:] for k, v in PAGES.items()}


def test_places_and_markers(spark):
    df = spark.createDataFrame([("ñ12 x 345",), ("",), (None,), ("7",)], "t string")
    got = [r[0] for r in df.select(layouts.places(F.col("t"), r"\d+")).collect()]
    assert [[tuple(x) for x in r] if r is not None else None for r in got] == [[(1, 3, "12"), (6, 9, "345")], [], None, [(0, 1, "7")]]
    pages = spark.createDataFrame([("12\ntexto\n- 13 -",), ("sin número",), ("0\n9999",), (None,)], "t string")
    assert [r[0] for r in pages.select(layouts.printed_marker(F.col("t"))).collect()] == [13, None, None, None]


def test_observations(spark):
    records = [
        ("decisions", {"idExpediente": "7", "guidBlob": " g ", "urlBlob": "https://h/a"}),
        ("decisions", {"idExpediente": "7", "urlBlob": "http://h/a"}),
        ("decisions", {"guidBlob": "g", "urlBlob": "https://h/a"}),
        ("historical", {"ano": 1999, "partes": "A  y\nB", "rutaDoc": "https://h/b"}),
        ("historical", {"rutaDoc": "https://h/b"}),
        ("bulletins", {"idCuerpo": 3, "idCabecera": 2, "urlCuerpo": "NULLhttps://h/c"}),
        ("bulletins", {"idCuerpo": 3, "idCabecera": 2, "urlCuerpo": "null"}),
        ("bulletins", {"idCuerpo": 3, "idCabecera": 2, "urlCuerpo": "ftp://h"}),
        ("other", {}),
        (None, {}),
    ]
    df = spark.createDataFrame([(s, json.dumps(r)) for s, r in records], "surface string, row string")
    got = [tuple(r) for r in observations.observations(df).collect()]
    assert got[0] == ("decisions", "expediente:7:g", "decisions\t7\tg", "https://h/a", "available", None)
    assert [r[5] for r in got] == [None, "no_address", "no_id", None, "no_metadata", None, None, "no_address", "unknown_surface", "unknown_surface"]
    assert got[3][2] == "historical\t1999\t\tA y B" and got[3][1].startswith("historical-url-sha256:")
    assert got[5][1:5] == ("bulletin:2:3", None, "https://h/c", "available") and got[6][3:5] == (None, "not_published")


def test_compare_and_set(spark):
    stored = spark.createDataFrame([("a", 3), ("b", 4)], "k string, revision int")
    asked = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "k string, expected int")
    assert rows(ledger.compare_and_set(stored, asked, ["k"], "revision", "expected")) == [("a", "applied", 4), ("b", "conflict", 4), ("c", "unknown", None)]


def test_put_immutable_within_a_batch(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "k string, sha string"
    assert sinks.put_immutable(spark.createDataFrame([("a", "1")], schema), path, "k", "sha").count() == 0
    bad = sinks.put_immutable(spark.createDataFrame([("b", "1"), ("b", "2"), ("a", "1")], schema), path, "k", "sha")
    assert rows(bad) == [("b", "1", "2")] and spark.read.parquet(path).count() == 1


def test_printed_candidates(spark):
    word = lambda page, side, text, x, y: (page, side, text, x, y, x + 10.0, y + 10.0, 1000.0, 1000.0)
    words = [
        word(1, "left", "17", 10.0, 20.0), word(1, "left", "18", 900.0, 20.0), word(1, "left", "1999", 10.0, 20.0), word(1, "left", "0", 10.0, 20.0), word(1, "left", "3", 10.0, 500.0),
        word(2, "right", "21", 950.0, 100.0), word(2, "right", "x2", 950.0, 100.0), word(2, "right", "21", 950.0, 30.0), word(3, "right", None, 950.0, 30.0),
    ]
    df = spark.createDataFrame(words, "page int, side string, text string, x0 double, y0 double, x1 double, y1 double, width double, height double")
    assert rows(files.printed_candidates(df)) == [(1, [17]), (2, [21]), (3, [])]


def test_member_pages(spark):
    members = spark.createDataFrame([("a/page-0007.txt", "t7"), ("page-12.txt", None), ("notes.txt", "n")], "member string, text string")
    labels = spark.createDataFrame([('{"page_index": 7, "classification": "body"}',), ("broken",), (None,)], "line string")
    assert rows(files.member_pages(members, labels)) == sorted([(7, "t7", "body"), (12, None, None)], key=repr)


def test_provider_response(spark):
    raw = ['{"choices": [{"message": {"content": "yes"}}], "usage": {"prompt_tokens": 5, "completion_tokens": 2, "cost": 0.5}}', '{"answers": {"a": 1}, "usage": {"input_tokens": "x", "output_tokens": 3}, "cost": 1}', "none", None]
    got = [tuple(r[0]) for r in spark.createDataFrame([(x,) for x in raw], "t string").select(plugins.provider_response(F.col("t"))).collect()]
    assert got == [("yes", 5, 2, 0.5), ('{"a":1}', None, 3, 1.0), (None,) * 4, (None,) * 4]


def test_edges_that_close_cycles(spark):
    old = spark.createDataFrame([(1, 2), (2, 3)], "src int, dst int")
    new = spark.createDataFrame([(3, 1), (3, 4), (5, 5), (6, 7), (7, 6), (None, 1), (3, 4)], "src int, dst int")
    assert rows(lineage.without_cycles(old, new)) == [(3, 1, False), (3, 4, True), (5, 5, False), (6, 7, False), (7, 6, False)]


def test_schema_failures_say_where(spark):
    inner = {"type": "object", "required": ["id"], "properties": {"id": {"type": "integer", "minimum": 1}, "tags": {"type": "array", "maxItems": 2, "items": {"type": "string", "minLength": 1}}}, "additionalProperties": False}
    rule = {"type": "object", "properties": {"items": {"type": "array", "items": inner}, "kind": {"enum": ["a", None]}}}
    value = {"kind": "b", "items": [{"id": 1, "tags": ["x"]}, {"id": 0, "more": 1}, {"tags": ["x", "", 3]}, 7, {"id": True}]}
    want = [("$.kind", "enum"), ("$.items[1].more", "unknown"), ("$.items[1].id", "range"), ("$.items[2].id", "required"), ("$.items[2].tags", "items")]
    want += [("$.items[2].tags[1]", "length"), ("$.items[2].tags[2]", "type"), ("$.items[3]", "type"), ("$.items[4].id", "type")]
    assert schema.failures(value, rule) == want and schema.failures([], rule) == [("$", "type")]
    lines = spark.createDataFrame([(json.dumps(value),), ("{",), (None,), ("{}",), ("[" * 5000,)], "t string")
    got = [r[0] if r[0] is None else len(r[0]) for r in lines.select(schema.json_failures(F.col("t"), rule)).collect()]
    assert got == [9, 1, None, 0, 1]
