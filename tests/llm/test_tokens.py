"""The transducer against the public libraries, and exact round trips."""

import base64
import random

import pytest

from albaran.llm import tokens as K

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return K.read_ranks()


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "", " ", "\n", "Hello  world", "naïve café – 12,50 €", "漢字とかな", "😀👍🏽 é", "​​", "<|endoftext|> is text", "a" * 5000, " " * 3000 + "x", "don't I'll we've",
    "F001-9490691\r\n\t 3 | Schutzhelm | 363", "\x00\x01\x7f", "זה עברית ועוד", "x" * 64 + "é" * 65,
]


def test_equals_the_public_encoder(ranks, public):
    tok = K.Tokenizer(ranks)
    rng = random.Random(4)
    alphabet = "abc xyzéñ漢😀\n\t.,-_0189ABſ"
    cases = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    assert [c for c in cases if tok.encode(c) != public.encode_ordinary(c)] == []
    assert tok.count("Hello world") == 2 and tok.encode(None) == []


def test_dropping_the_automaton_changes_nothing(ranks, public):
    t = K.Transducer(ranks, max_states=50, max_pieces=20)
    for w in ["Rechnungsnummer", " Lieferant", " 9490691", " Schweißdraht"] * 5:
        assert t.piece(w) == public.encode_ordinary(w)


def test_utf8_machine_equals_the_codec():
    rng = random.Random(9)
    for _ in range(3000):
        raw = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xED, 0xF0, 0xF4, 0xA0, 0x90, 0xFF, 0xC3]) for _ in range(rng.randint(0, 9)))
        m = K.Utf8Stream()
        cut = rng.randint(0, len(raw))
        assert m.feed(raw[:cut]) + m.feed(raw[cut:]) + m.end() == raw.decode("utf-8", "replace")


def test_spark_round_trip_with_nulls_ties_and_clashing_names(spark):
    rows = [(i, t, "k") for i, t in enumerate(TEXTS)] + [(98, None, "k"), (99, TEXTS[3], "k"), (99, TEXTS[3], "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    enc = K.encode(docs, "doc_id", "text")
    assert enc.count() == len(rows)
    assert {r.doc_id: r.ids for r in enc.collect()}[98] == []
    back = {r.doc_id: r.text for r in K.decode(enc, "doc_id").collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert K.encode(docs.limit(0), "doc_id", "text").count() == 0
    counts = {r.doc_id: r.tokens for r in K.token_counts(docs, ["doc_id"], "text").collect()}
    assert counts == {r.doc_id: len(r.ids) for r in enc.collect()}


def test_vocabulary_file_is_what_is_read(tmp_path):
    f = tmp_path / "v"
    f.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)))
    assert K.Tokenizer(K.read_ranks(str(f))).encode("hé") == [104, 195, 169]


def test_long_pieces_take_linear_time_and_bounded_memory(ranks, public):
    import time

    rng = random.Random(8)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzñéαβ漢字かな") for _ in range(60_000))
    for w in ("a" * 40_000, "ab" * 20_000, letters, " " * 30_000, "-=" * 9_000, "0123456789" * 2_000):
        t = K.Transducer(ranks, room=64)
        out, ends = [], 0
        for part in t.run(w.encode()):
            out += part
            ends = max(ends, len(part))
        assert out == public.encode_ordinary(w)
        assert ends < 2_000  # parts come out on the way
    t = K.Transducer(ranks, max_states=5_000)
    t.piece(letters[:1000])
    took = []
    for n in (10_000, 40_000):
        began = time.perf_counter()
        t.piece("".join(rng.choice(letters) for _ in range(n)))
        took.append(time.perf_counter() - began)
        assert len(t.step) <= 5_002
    assert took[1] < 12 * took[0]


def test_states_are_merged(ranks):
    t = K.Transducer(ranks)
    t.piece("ab" * 5_000)
    assert len(t.step) < 200
