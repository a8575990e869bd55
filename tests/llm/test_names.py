"""Name variants: parsing, comparison, and classes against all pairs compared one by one."""

import itertools
import random

import numpy as np
import pytest

from albaran.llm import names as N
from albaran.llm.graph import components


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("Logística Brutrogrevo S.L.", "log. brutrogrevo", True),
        ("Logística Brutrogrevo S.L.", "Brutr0grevo Logística Sociedad Limitada", True),
        ("Logística Brutrogrevo S.L.", "Catering Brutrogrevo S.L.", False),
        ("Building Materials Drifle Drabe", "Drifle Drabe Bldg Mat. Ltd.", True),
        ("Kutronegi Building Materials, S.R.Ltda.", "Kutronegi Bldg Materials", True),
        ("Obras Civiles Babrocrucra S.A.R.L.", "OO.CC. Babrocrucra", True),
        ("Supplier: Ing. Roje Gagro", "Roje Gagro Ingeniería S.L. (Villa Cerr", True),
        ("José Crutefafli Naruz", "pepe crutefafli naruz", True),
        ("José Crutefafli Naruz", "Naruz, J. Crutefafli", True),
        ("José Crutefafli Naruz", "Francisco Crutefafli Naruz", False),
        ("José Crutefafli Naruz", "José Crutefafli Remos", False),
        ("José Crutefafli Naruz", "José Crutefafli", True),
        ("Ing. William Trefozopu Prupon", "W. Trefozopu Prupon", True),
        ("E. Brelanocu Peguz", "Enrique Brelanocu Peguz", True),
        ("Lostabruque Ingeniería e Hijos", "LOSTABRUQUE INGENIERÍA & HIJOS", True),
    ],
)
def test_pairs(a, b, same):
    assert (N.similarity(N.parse(a), N.parse(b)) >= 0.8) is same
    assert N.similarity(N.parse(a), N.parse(b)) == pytest.approx(N.similarity(N.parse(b), N.parse(a)))


def test_lcs_ratio_against_the_table():
    rng = random.Random(2)

    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return 2 * t[-1][-1] / (len(a) + len(b))

    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(2))
        assert N.lcs_ratio(a, b) == pytest.approx(plain(a, b))


def test_components_against_union_find(spark):
    rng = random.Random(6)
    links = [(f"n{rng.randint(0, 60)}", f"n{rng.randint(0, 60)}") for _ in range(45)] + [(f"p{i}", f"p{i + 1}") for i in range(30)] + [("s", "s")]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "src string, dst string")).collect()}
    assert got == {x: find(x) for x in up}
    assert components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_classes_of_a_small_table_with_hot_blocks(spark):
    base = ["Brutrogrevo", "Lagrifleto", "Plurebrepu", "Tecostagre", "Sestucodro", "Cristupabi"]
    names = []
    for w in base:
        names += [f"Logística {w} S.L.", f"log. {w.lower()}", f"{w.upper()} LOGISTICA", f"{w} Catering Ltd.", f"Proveedor: {w} Cat."]
    df = spark.createDataFrame([(n,) for n in names + names + [None, "", "  ", "--", "¿¿¿"]], "name string")
    got = {(r.name_a, r.name_b) for r in N.variants(df, common=3).collect()}  # every index key is too common here
    want = {
        tuple(sorted(p))
        for p in itertools.combinations(sorted(set(names)), 2)
        if N.similarity(N.parse(p[0]), N.parse(p[1])) >= 0.8
    }
    assert got == want and len(got) == 6 * (3 + 1)
    assert N.variants(df.limit(0)).count() == 0


def test_all_suffixes_are_keys():
    keys = [k for k, _ in N.block_keys(N.parse("Ferretería Brutrogrevo S.L."))]
    assert {"s:revo", "s:grevo", "s:brutrogrevo"} <= set(keys)


def test_unseen_trades_are_learned_from_the_corpus(spark):
    """Bakers and fishmongers are in no list: as common words of the corpus they part names that are alike but for them."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(4))
    own = [word() for _ in range(40)]
    rows = [f"{t} {w}" for w in own for t in ("Panaderia", "Pescaderia")] + [f"PANADERIA {own[0]}", f"Panad. {own[0]}", f"Panaderai {own[1]} S.A."]
    df = spark.createDataFrame([(r,) for r in rows], "name string")
    assert N.learned_words(df.distinct()) == {"panaderia", "pescaderia"}
    got = {tuple(r) for r in N.variants(df).collect()}
    assert not {p for p in got if ("escad" in p[0]) != ("escad" in p[1])}
    assert {tuple(sorted(p)) for p in ((f"Panaderia {own[0]}", f"PANADERIA {own[0]}"), (f"Panaderia {own[0]}", f"Panad. {own[0]}"), (f"Panaderia {own[1]}", f"Panaderai {own[1]} S.A."))} <= got


def _written(spark) -> int:
    """Bytes of all shuffles so far."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_what_is_written_grows_as_the_names_not_as_their_pairs(spark):
    """1,200 companies of one refined block: 719,400 pairs, of which only the planted ones are alike."""
    rng = random.Random(5)
    own = sorted({"ba" + "".join(rng.choice("cdfghjklmnpqrstvwxz") + rng.choice("aeiou") for _ in range(6)) for _ in range(1_200)})
    df = spark.createDataFrame([(f"Logística {w} S.L.",) for w in own] + [(f"log. {w}",) for w in own[:3]], "name string")
    before = _written(spark)
    got = {tuple(r) for r in N.variants(df).collect()}
    assert {(f"Logística {w} S.L.", f"log. {w}") for w in own[:3]} <= got
    assert _written(spark) - before < 2_000_000


def test_no_pair_that_reaches_the_ratio_is_passed_over():
    rng = random.Random(4)
    base = ["José Crutefafli Naruz", "Naruz, J. Crutefafli", "pepe crutefafli", "Logística Brutrogrevo S.L.", "Grevobru Tro Logística", "Obras Civiles Babrocrucra", "Babrocrucra", "Drifle Drabe Bldg Mat", "J. Na", "Panaderia Luna", "Mar 7 a", "x" * 70 + " Ltd", "Cate " + "y" * 66]
    slip = lambda s: "".join(rng.choice([c, c, c, c, c, c, c, c, c, "", c + c, rng.choice("aeioxn")]) for c in s)[: rng.choice([99, 99, 8])]
    names = [n for n in (N.parse(slip(rng.choice(base))) for _ in range(400)) if n.core]
    left, right = (np.array(x) for x in zip(*itertools.combinations(range(len(names)), 2)))
    can = set(N.Filter(names, 0.8)(left, right).tolist())
    good = {k for k, (i, j) in enumerate(zip(left, right)) if N.similarity(names[i], names[j]) >= 0.8}
    assert len(good) > 1_000 and good <= can and len(can) < len(left) / 2
    block = np.array([1, 1, 1, 2, 3, 3])
    for most in (1, 2, 100):
        assert [(int(a), int(b)) for p, q in N._pairs(block, most) for a, b in zip(p, q)] == [(0, 1), (0, 2), (1, 2), (4, 5)]


def test_a_parsed_name_is_read_back():
    for raw in ("José Crutefafli Naruz", "Naruz, J. Crutefafli", "OO.CC. Babrocrucra", "Building Materials Drifle Drabe", "¿¿a"):
        a, b = N.parse(raw), N._read(N._told(N.parse(raw)))
        assert all(getattr(a, k) == getattr(b, k) for k in N.Name.__slots__)
