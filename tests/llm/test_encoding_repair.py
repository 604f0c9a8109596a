import random

import pytest

from foliomill.llm import encoding_repair as er

WORDS = (
    "según declaró la decisión del artículo único de la ley núm. sobre el interés público, después de la oposición "
    "técnica; ¿procede que la garantía subsidiaria del niño motive la acción? la compañía señaló además razón jurídica"
).split()


def text(rng, n=60):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    docs = [(i, text(rng, 80), "es") for i in range(300)] + [(1000, None, "es"), (1001, "x", None)]
    return er.fit(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))


@pytest.mark.parametrize(
    ("written", "read"), [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"), ("cp850", "cp1252"), ("cp1252", "cp850")]
)
def test_restores(model, written, read):
    right = text(random.Random(2), 40)
    table = {b: c for c, b in er._table(read).items()}
    wrong = "".join(c if c < "\x80" else "".join(table[b] for b in c.encode(written)) for c in right)
    out, chain = er.Repairer(model).repair(wrong)
    assert chain and out == right


def test_twice_and_in_part(model):
    r = er.Repairer(model)
    right = text(random.Random(3), 40)
    twice = right.encode().decode("cp1252", "replace").encode().decode("cp1252", "replace")
    if "�" not in twice:
        assert r.repair(twice)[0] == right
    part = text(random.Random(4), 30)
    mixed = part + " " + "declaró según".encode().decode("cp1252") + " " + part
    assert r.repair(mixed)[0] == f"{part} declaró según {part}"


def test_names_with_a_capital_among_small_letters(model):
    right = text(random.Random(6), 30) + " Wenverés, pagaré Kelsamés " + text(random.Random(7), 30)
    for read in ("mac_roman", "cp850"):
        table = {b: c for c, b in er._table(read).items()}
        wrong = "".join(c if c < "\x80" else table[c.encode("cp1252")[0]] for c in right)
        assert er.Repairer(model).repair(wrong)[0] == right


def test_a_chain_of_many_links(model):
    right = text(random.Random(8), 60)
    table = {b: c for c, b in er._table("cp1252").items()}
    wrong = right
    for _ in range(5):
        wrong = "".join(table[b] for b in wrong.encode("utf-8"))
    out, chain = er.Repairer(model).repair(wrong)
    assert out == right and len(chain) == 5


def test_right_texts_stay(model):
    r = er.Repairer(model)
    for t in ["", "plain", text(random.Random(5)), "el lema «Ceci n’est qu’un vœu»", "PADARIA DO IRMÃO E DA IRMÃ", "35 ¢ y £ 715", "Ærøvik", "— 7 —"]:
        assert r.repair(t) == (t, [])


def test_on_tables(spark, model):
    data = [(1, "declaraciÃ³n segÃºn la decisiÃ³n del artÃ\xadculo", 1), (2, "seg�n", 1), (3, "según", 1), (4, None, 1), (5, "", 1), (5, "", 1)]
    df = spark.createDataFrame(data, "text_id bigint, text string, restored int")
    got = {r["record_id"]: (r["restored"], r["lost"]) for r in er.repaired(df, model).collect()}
    assert got == {1: ("declaración según la decisión del artículo", False), 2: ("seg�n", True)}
    assert er.repaired(df.where("text_id > 9"), model).count() == 0
    empty = er.fit(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert er.Repairer(empty).repair("segÃºn") == ("segÃºn", [])
