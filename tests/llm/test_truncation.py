import random

from tests.conftest import rows

from foliomill.llm import truncation as tr

SCHEMA = "table_name string, record_id bigint, source string, text string"
SUBJECTS = ["la sala", "el juez", "la corte", "el tribunal", "la parte", "el perito"]
VERBS = ["acoge", "rechaza", "confirma", "revoca", "pondera", "examina"]
OBJECTS = ["la demanda", "el recurso", "la sentencia", "el medio", "la prueba", "el acto"]
ENDS = ["con distracción de las costas", "previo avalúo del bien", "por falta de interés", "conforme a la Ley núm. 12-04"]


def whole(rng):
    sentence = lambda: f"{rng.choice(SUBJECTS)} {rng.choice(VERBS)} {rng.choice(OBJECTS)}, {rng.choice(ENDS)}."
    text = " ".join(sentence().capitalize() for _ in range(rng.randrange(5, 9)))
    end = rng.randrange(4)
    return text + ["", "\nFirmado: Ana Ruiz, Jueza ponente", "\nValdoro, 3 de mayo de 1999", "\n- 7 -"][end]


def test_cut_and_whole(spark):
    rng = random.Random(1)
    data = [("t", i, "s", whole(rng)) for i in range(600)]
    cuts = {}
    for i, end in enumerate(["la demanda, con", "la sentencia, previo ava", "conforme a la Ley núm.", "el recurso, por falta...", "rechaza la […]", "examina el med"]):
        cuts[1000 + i] = f"{whole(rng).splitlines()[0]} La sala {'acoge ' if end[:2] in ('la', 'el') else ''}{end}"
    data += [("t", i, "s", t) for i, t in cuts.items()]
    data += [("t", 2000, None, None), ("t", 2001, None, ""), ("t", 2002, None, " \n ")]
    got = {r[1] for r in tr.truncated(spark.createDataFrame(data, SCHEMA)).where("cut").collect()}
    assert set(cuts) <= got and len(got - set(cuts)) <= 2


def test_report_and_empty(spark):
    rng = random.Random(2)
    data = [("t", i, "s" if i % 2 else None, whole(rng)) for i in range(300)] + [("t", 900, None, None)]
    report = {r["source"]: (r["n_records"], r["n_cut"]) for r in tr.truncation_report(spark.createDataFrame(data, SCHEMA)).collect()}
    assert report["s"][0] == 150 and report[None][0] == 151
    assert rows(tr.truncated(spark.createDataFrame([], SCHEMA))) == []


def test_very_long_words_and_tails(spark):
    rng = random.Random(3)
    data = [("t", i, "s", whole(rng)) for i in range(300)]
    data += [("t", 1000, "s", "la sala acoge " + "x" * 5000), ("t", 1001, "s", whole(rng).splitlines()[0] + " La sala acoge la demanda, con" + "\n" * 3000), ("t", 1002, "s", "y" * 3000)]
    judged = {r["record_id"]: r["cut"] for r in tr.truncated(spark.createDataFrame(data, SCHEMA)).collect()}
    assert len(judged) == 303 and judged[1001]


def test_one_ending_of_a_third_of_all_texts(spark):
    rng = random.Random(4)
    data = [("t", i, "s", whole(rng) if i % 3 else whole(rng).splitlines()[0] + " La sala acoge la demanda, con") for i in range(900)]
    judged = tr.truncated(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(judged) == 900


def test_ending_behind_much_that_is_set_aside(spark):
    body = "La sala examina el recurso.\n" * 60 + "La sala acoge la demanda, con"
    after = ["", " " * 1500, "\n" * 3000, "\n- 7 -" * 250, "\nTotal 12\n\n" * 150 + " " * 1300, "\n- 7 -" * 30_000]
    df = spark.createDataFrame([(i, body + x) for i, x in enumerate(after)], "i int, text string")
    got = dict(df.select("i", tr._ending(df["text"])).collect())
    assert {i: t.strip()[-500:] for i, t in got.items()} == {i: body[-500:] for i in range(len(after))}
