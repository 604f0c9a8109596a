from collections import Counter

import pandas as pd

from foliomill.llm import encoding_repair as er

LETTERS = "αβγδεζηθλξπφψωбдж"
SCHEMA = "doc_id bigint, text string, lang string"


def documents():
    """Each letter stands in two of 3,000 texts; a short text, a long one and a label in capitals have letters of their own."""
    docs = [(i, f"el tribunal declara en la causa {i} " + "que procede la demanda " * 5, "es") for i in range(3000)]
    for j, c in enumerate(LETTERS):
        for i in (170 * j, 170 * j + 85):
            docs[i] = (i, docs[i][1] + f"le{c}ra", "es")
    return docs + [
        (4001, "año tras año", "es"),
        (4002, "según la frase larga úes " * 1000, "es"),
        (4003, "la acción y la decisión", "ES "),
        (4004, None, "es"),
        (4005, "", "es"),
        (4006, "ййй", "und"),
    ]


def test_every_labelled_text_counts(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    model = er.fit(docs)
    assert set(LETTERS) | set("ñúó") <= model.alphabet and "й" not in model.alphabet
    assert len(model.dictionaries) == 1 and "según la frase".encode() in model.dictionaries[0]
    assert er.fit(docs.repartition(7).orderBy("text")) == model


def test_counts_add_up_over_flushes(monkeypatch):
    texts = [("es", "a b\na b  c"), ("fr", "a b c"), ("es", " "), ("es", "b c a b")]
    monkeypatch.setattr(er, "FLUSH", 6)
    parts = list(er._counted(iter([pd.DataFrame(texts[:2], columns=["lang", "t"]), pd.DataFrame(texts[2:], columns=["lang", "t"])])))
    got = pd.concat(parts).groupby(["lang", "unit"])["n"].sum().to_dict()
    want = Counter()
    for lang, t in texts:
        w = t.split()
        want.update((lang, " ".join(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert len(parts) > 2 and got == dict(want)
