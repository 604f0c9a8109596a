import random

from tests.conftest import rows

from foliomill.llm import scan_repair as sr

SCHEMA = "table_name string, record_id bigint, text string, n int"
WORDS = "la sentencia impugnada casa el recurso interpuesto por la parte recurrente contra una decisión de la corte que rechaza su demanda original sobre derechos adquiridos".split()


def lexicon(**more):
    words = {w: 500 for w in WORDS} | {w: 500 for w in ("histórico-jurídico,", "Análisis", "teórico")} | more
    return sr.Lexicon(words, 3.0).ready()


LEX = lexicon()
HEADS = frozenset(sr.line_names("BOLETÍN JUDICIAL NÚM. 1"))


def test_clean_texts_have_no_traces():
    clean = [
        "la sentencia impugnada\ncasa el recurso",
        "Relación de folios:\n12\n14\n1901\nla sentencia",
        "la parte \f recurrente",
        "Nolvenez Trifón casa el recurso",
        "",
        "Análisis histórico-\njurídico, la parte",
    ]
    assert [sr.traces(t, LEX) for t in clean] == [False] * len(clean)


def test_each_trace_is_found():
    marks = ["- 7 -", "12", "[ 9 ]", "Pág. 3", "Página 2 de 40", "3/44", "| 5 |", "BOLETÍN JUDICIAL NÚM. 83", "BOLETÍN JUDICIAL NÚM. 83 | 4", "BOLFTÍN JUDICIAL NÚM. 83", "8OLETÍN JUDICIAL NÚM. 83", "BOLETÃ\xadN JUDICIAL NÃšM. 83"]
    for m in marks:
        assert sr.traces(f"la parte recurrente\n{m}\ncontra una", LEX, HEADS), m
    for t in ("la senten-\ncia", "la senten¬\ncia", "la senten\xad\n cia", "la sentericia", "la 5entencia", "el recur5o,", "la c0rte"):
        assert sr.traces(t, LEX), t


def test_repair():
    text = (
        "BOLETÍN JUDICIAL NÚM. 83\nla sentencia impugnada casa el recur-\nso interpuesto por la parte recurrente\n- 7 -\n"
        "contra una dec!sión de la corte.\nla parte recurrente\n12"
    )
    got = sr.repair(text, LEX, HEADS)
    assert "recurso interpuesto por la parte recurrente contra una decisión de la corte." in got
    assert "BOLETÍN" not in got and "7" not in got and "12" not in got
    assert sr.repair("Análisis histórico-\njurídico, la parte", LEX) == "Análisis histórico-jurídico, la parte"


def test_paragraphs_of_flat_text_stay():
    flat = "\n".join("la sentencia impugnada casa el recurso interpuesto por la parte recurrente contra una decisión de la corte que rechaza su demanda." for _ in range(3))
    assert sr.repair(flat, LEX).count("\n\n") == 2


def test_decode_is_joint():
    read = lambda *lines: sr.decode(list(lines), LEX)
    assert read("recursointerpuesto") == ("recurso interpuesto", {"word"})
    assert read("la senten cia,") == ("la sentencia,", {"space"})
    assert read("la senten", "cia.") == ("la sentencia.", {"line"})
    assert read("xyzzyq") == ("xyzzyq", frozenset())
    assert read("la «senten-", "cia», casa") == ("la «sentencia», casa", {"line"})
    # a divided word with a confusion in it, and a confusion beside a missing space
    assert read("la senten-", "c!a impugnada") == ("la sentencia impugnada", {"line", "confusion"})
    assert read("la parte recurr-", "ente casa el recur5o") == ("la parte recurrente casa el recurso", {"line", "confusion"})
    # a half that is a word of its own
    assert read("la recurren", "te contra") == ("la recurrente contra", {"line"})


def test_long_words_and_texts():
    long = "x" * 5000
    assert sr.decode([long], LEX) == (long, frozenset())
    assert sr.decode(["a" * 300 + "-", "b" * 300], LEX)[1] == {"line"}
    assert sr.decode([], LEX) == ("", frozenset())


def test_on_tables(spark):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice(WORDS) for _ in range(60))
    data = [("t", i, text(), 1) for i in range(300)]
    data += [("t", 1000, text() + "\nla senten-\ncia " + text(), 1), ("t", 1001, text() + " recur5o " + text(), 1), ("t", None, text() + "\n- 4 -\n", 1)]
    data += [("t", 1200, None, 1), ("t", 1201, "", 1), ("t", 1202, " \n", 1)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(sr.scanned(df)) == [("t", 1000), ("t", 1001), ("t", None)]
    fixed = {r["record_id"]: r["text"] for r in sr.scanned(df, repaired=True).collect()}
    assert "sentencia" in fixed[1000] and "recurso" in fixed[1001] and "- 4 -" not in fixed[None]
    assert rows(sr.scanned(spark.createDataFrame([], SCHEMA))) == []


def test_running_heads_are_learned(spark):
    rng = random.Random(2)
    long = lambda: " ".join(rng.choice(WORDS) for _ in range(40))
    data = [("t", i, f"{long()}\nGACETA DE FALLOS {i}\n{long()}", 1) for i in range(10)]
    data += [("t", 20, f"{long()}\nGACFTA DE FALLOS 7\n{long()}", 1), ("t", 21, f"{long()}\nOTRA COSA DICE 7\n{long()}.", 1)]
    _, held = sr.learn(spark.createDataFrame(data, SCHEMA))
    assert held.count() == 11 and {k for r in held.collect() for k in r["heads"]} == set(sr.line_names("GACETA DE FALLOS 1"))
