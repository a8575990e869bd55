"""Raking, sampling and shares; the network's held-out accuracy; segments and labels."""

import random

import numpy as np
import pytest

from albaran.llm import language as L
from albaran.llm import mixing as M


def test_rake_reaches_all_marginals_and_respects_caps():
    rng = np.random.default_rng(1)
    t = rng.integers(10, 100, (3, 2, 2)).astype(float)
    goal = [np.array([30.0, 40, 30]), np.array([60.0, 40]), np.array([50.0, 50])]
    w = M.rake(t, goal, np.array([5.0, 5, 5]))
    for axis in range(3):
        assert np.allclose(w.sum(axis=tuple(i for i in range(3) if i != axis)), goal[axis], rtol=1e-4)
    w = M.rake(t, [t.sum(axis=(1, 2)) * 2, t.sum(axis=(0, 2)) * 2, t.sum(axis=(0, 1)) * 2], np.array([2.0, 2, 2]))
    assert (w <= 2 * t + 1e-6).all() and np.allclose(w, 2 * t)


def test_mix_shares_and_repeats(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["pipe", "cable", "steel", "lamp", "bolt"])
    docs = []
    for i in range(900):
        s = "a" if i % 10 < 7 else "b" if i % 10 < 9 else rng.choice(["c", None, "other"])
        docs.append((i, " ".join(word() for _ in range(rng.randint(5, 60))), rng.choice(["en", "es", None, "Spanish"]), s, rng.choice(["clean", "edge", None])))
    docs += [(1000, None, "en", "a", "clean"), (1001, "", "en", "b", "clean")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, category string")
    goal = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 3), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    drawn, report, marginals = M.mix(df, goal)
    got = [r for r in marginals.collect() if r.value != "gone"]
    assert {r.marginal for r in got} == {"source", "lang", "topic"}
    assert all(abs(r.target_share - r.raked_share) < 0.01 and abs(r.actual_share - r.raked_share) < 0.03 for r in got)
    rep = {r.source: r for r in report.collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert rep[s].actual_share == pytest.approx(share / 0.9, abs=0.02)
        assert rep[s].repeats <= rep[s].max_repeats
    assert rep["gone"].actual_share == 0 and rep["gone"].copies == 0
    assert drawn.where("source not in ('a','b','c')").count() == 0
    assert drawn.groupBy("doc_id").count().where("count > 1").count() == 0
    empty = M.mix(df.limit(0), goal)
    assert empty[0].count() == 0 and empty[1].count() == 4


WORDS = {
    "en": "the goods must be stored in a dry place and kept away from direct heat before delivery".split(),
    "es": "el material debe guardarse en un lugar seco y lejos del calor antes de la entrega".split(),
    "pt": "o material tem de ser guardado em lugar seco e longe do calor antes da entrega não".split(),
    "fr": "le produit doit être rangé dans un endroit sec et loin de la chaleur avant la livraison".split(),
    "de": "die Ware muss trocken gelagert und vor der Lieferung von direkter Wärme ferngehalten werden".split(),
    "it": "il materiale deve essere conservato in un luogo asciutto e lontano dal calore prima della consegna".split(),
    "nl": "de goederen moeten droog worden bewaard en uit de buurt van warmte blijven voor de levering".split(),
}


def sentence(rng, lang):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(14)).capitalize() + "."


@pytest.fixture(scope="module")
def net(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        lang = rng.choice(L.LANGS)
        said = lang if rng.random() > 0.08 else rng.choice(L.LANGS)  # some labels are wrong
        rows.append((i, " ".join(sentence(rng, lang) for _ in range(3)), rng.choice([said, said.upper(), f"{said}-XX"])))
    return L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_held_out_accuracy(net):
    rng = random.Random(99)
    cases = [(lang, sentence(rng, lang)) for lang in L.LANGS for _ in range(40)]
    p = [net.proba(L.windows(s)).mean(axis=0) for _, s in cases]
    right = sum(L.LANGS[int(x.argmax())] == lang for (lang, _), x in zip(cases, p))
    assert right / len(cases) > 0.97


def test_segments_and_corrections(spark, net):
    rng = random.Random(5)
    s = lambda k: sentence(rng, k) + " " + sentence(rng, k)
    rows = [
        (1, s("en"), "en"), (2, s("es"), "en"), (3, s("fr"), None), (4, s("de"), "Deutsch"), (5, s("it") + "\n \n" + s("nl") + "\n\n\n1 | x | 2\n\n" + s("it"), "it"),
        (6, None, "en"), (7, "", "en"), (8, " \n ", None), (9, "INV-0001", None), (10, "1 | lamp | 3 | 4", "xx"), (11, s("pt"), "ru"), (2, s("es"), "es-PE"), (12, s("en") * 200, "mul"),
    ]
    seg = L.segments(spark.createDataFrame(rows, "doc_id long, text string, lang string"), net)
    got = sorted((r.doc_id, r.seg_no, r.lang) for r in L.corrections(seg).collect())
    assert got == [(2, 0, "es"), (3, 0, "fr"), (5, 1, "it"), (5, 2, "nl"), (5, 4, "it"), (11, 0, "pt"), (12, 0, "en")]
    assert all(0 < r.confidence <= 1 for r in seg.collect())


def test_labels():
    assert [L.label_code(x) for x in ("es-PE", "Spanish", "castellano", "ENG", "", None, "und", "?", "ru", "pt_BR")] == ["es", "es", "es", "en", None, None, None, None, "other", "pt"]


def test_wrapped_lines_are_one_sentence():
    wrapped = "The goods must be kept\nin a dry place away\nfrom direct heat."
    assert L.sentences_of(wrapped) == wrapped
    assert L.sentences_of("Invoice no 12\nDate 3 May\nSupplier Bolts Ltd") == ""
    assert L.sentences_of("a | b | c\nthe goods must be\n1 | x | y | z\nkept in a dry place") == ""
