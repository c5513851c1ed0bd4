"""Problems 8 to 10."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from solarloom.llm import bpe, encoding, mixing, reading
from solarloom.llm.automaton import Lexicon, build, dumps

SF = "/root/testdata/sf0.001"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 50000), max_size=3), max_size=60), st.lists(st.binary(max_size=8), max_size=20))
@settings(max_examples=150, deadline=None)
def test_automaton_is_exact(words, others):
    lexicon = Lexicon(dumps(build(list(words), list(words.values()))))
    asked = list(words) + others
    for w, n in zip(asked, lexicon.numbers(asked).tolist()):
        assert (lexicon.ids_of(n) if n >= 0 else None) == words.get(w)


def test_automaton_is_minimal(tmp_path):
    a = build([b"tops", b"taps", b"top", b"tap"], [[1], [2], [3], [4]])
    assert len(a["final"]) == 5 and len(a["keys"]) == 5  # t, o|a, p, s: two paths share all that follows
    (tmp_path / "x").write_bytes(dumps(a))
    assert isinstance(Lexicon(str(tmp_path / "x")).keys, np.memmap)


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_any_text_as_the_public_tokenizer(public, text):
    ids, _ = encoding.Encoder(None).encode([text])
    assert ids.tolist() == public([text])[0]
    rank = {v: k for k, v in bpe.ranks().items()}
    assert b"".join(rank[i] for i in ids.tolist()).decode() == text


def docs(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], "doc_id bigint, text string, source string, ids string")


def test_encoding(spark, public):
    r = random.Random(0)
    texts = ["", None, " ", "Hello <|endoftext|> world", "ok " * 500, "x" * 30000, "".join(chr(r.randrange(32, 0x2FFF)) for _ in range(2000)), "Το πάρκο είναι κλειστό.\r\n\tÄÖÜ 12345", "a b​c", "'LL we'll"]
    df = docs(spark, [(i, t) for i, t in enumerate(texts)] + [(None, "again"), (0, "")])
    for size in (100_000, 0, 5):
        got = encoding.encoded(df, ["doc_id"], size=size).collect()
        assert len(got) == len(texts) + 2
        by = {r["doc_id"]: list(r["ids"]) for r in got}
        assert by == dict(enumerate(public([t or "" for t in texts]))) | {None: public(["again"])[0]}
    assert encoding.encoded(docs(spark, []), ["doc_id"]).count() == 0


def test_whole_corpus(spark, public):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    got = {r["doc_id"]: list(r["ids"]) for r in encoding.encoded(df, ["doc_id"]).collect()}
    assert got == {r["doc_id"]: i for r, i in zip(rows, public([r["text"] or "" for r in rows]))}


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_mixing(spark):
    r = random.Random(1)
    rows = [(i, "word " * r.randrange(1, 80), r.choice(["A", " a", "b", "B-c", "b_c", "zzz", None])) for i in range(3000)] + [(9001, None, "a"), (9002, "", "b"), (9003, "again", "A")]
    df = docs(spark, rows)
    want = targets(spark, [("a", 0.5, 3), ("b", 0.2, 2), ("b_c", 0.3, 4), ("missing", 0.0, 1), ("absent", 0.1, 2)])
    mix = mixing.mixed(df, want).collect()
    assert len({r["doc_id"] for r in mix}) == len(mix)
    tokens = {s: sum(r["n_tokens"] * r["repeats"] for r in mix if r["source"] == s) for s in ("a", "b", "b_c")}
    total = sum(tokens.values())
    for s, p in (("a", 0.5), ("b", 0.2), ("b_c", 0.3)):
        assert tokens[s] / total == pytest.approx(p, rel=0.01)
    caps = {"a": 3, "b": 2, "b_c": 4}
    assert all(1 <= r["repeats"] <= caps[r["source"]] for r in mix) and all(r["n_tokens"] > 0 for r in mix)
    for s in caps:  # all documents of a source are repeated equally, but for one step
        assert len({r["repeats"] for r in mix if r["source"] == s}) <= 2
    report = {r["source"]: r for r in mixing.shares(df, want).collect()}
    assert report["absent"]["tokens"] == 0 and report["a"]["actual_share"] == pytest.approx(0.5, rel=0.01) and sum(r["actual_share"] for r in report.values()) == pytest.approx(1)


def test_mixing_edges(spark):
    want = targets(spark, [("a", 1.0, 2), (None, 0.5, 1), ("b", None, 1), ("c", 0.5, None)])
    assert mixing.mixed(docs(spark, []), want).count() == 0
    assert mixing.mixed(docs(spark, [(1, "x", "a")]), targets(spark, [])).count() == 0
    one = mixing.mixed(docs(spark, [(1, "x y z", "a"), (2, None, None)]), want).collect()
    assert [(r["doc_id"], r["repeats"]) for r in one] == [(1, 2)]
    big = mixing.mixed(docs(spark, [(1, "w " * 5000, "a"), (2, "w", "a"), (3, "w w", "a"), (4, "w " * 100, "b")]), targets(spark, [("a", 0.5, 9), ("b", 0.5, 1)])).collect()
    assert {(r["doc_id"], r["repeats"]) for r in big if r["source"] == "b"} == {(4, 1)}


def test_a_rest_is_filled_past_documents_that_are_too_large(spark):
    """Of many large documents only small ones behind them fit what is left."""
    sizes = [3000] * 60 + [700] * 40 + [150] * 40 + [30] * 60 + [5] * 60
    rows = [(i, "w " * n, "a") for i, n in enumerate(sizes)] + [(9000, "w " * 11_000, "b")]
    report = {r["source"]: r for r in mixing.shares(docs(spark, rows), targets(spark, [("a", 0.5, 1), ("b", 0.5, 1)])).collect()}
    assert report["a"]["tokens"] >= (1 - mixing.NEAR) * report["a"]["wanted_tokens"] - 5 and report["a"]["tokens"] <= report["a"]["wanted_tokens"]


def test_more_sources_than_a_driver_would_list(spark):
    n = 10_050
    df = docs(spark, [(i, "some words here", f"s{i}") for i in range(n)])
    got = mixing.mixed(df, targets(spark, [(f"s{i}", 1.0 / n, 1) for i in range(n)]))
    assert got.count() == n and got.filter("repeats = 1").count() == n


def test_prose():
    assert not reading.prose_words("ts;signal;value;unit\n2024-01-08 12:40:11;INV-05;870.464;kwh") and not reading.prose_words("time | inverter | kW | state\n2024 | INV-1 | 3 | OK")
    assert not reading.prose_words(None) and not reading.prose_words("") and not reading.prose_words("Status: closed")
    assert set(reading.prose_words("<p>The SUN&nbsp;is up​ today.</p>")) == {"the", "sun", "is", "up", "today"}
    assert reading.prose_words("word " * 50000)["word"] == 50000


def test_reading_levels_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    documents, grades = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "reading_grades"))
    half = grades.filter("doc_id % 2 = 0")
    levels = {r["doc_id"]: r["level"] for r in reading.reading_levels(documents, half).collect()}
    seen = {r["doc_id"] for r in half.collect()}
    rest = [(levels[r["doc_id"]], r["grade_level"]) for r in grades.filter("grade_level is not null").collect() if r["doc_id"] in levels and r["doc_id"] not in seen]
    a, b = np.array(rest).T
    assert len(rest) > 400 and np.corrcoef(a, b)[0, 1] > 0.9 and ((a > 3.5) == (b > 3.5)).mean() > 0.95


def test_words_have_their_greatest_likelihood():
    """Newton's answer against a search, and words of any length count."""
    rng = np.random.default_rng(2)
    weights = rng.dirichlet(np.ones(len(reading.GRID)))
    n, mean = np.array([50.0, 5.0, 400.0]), np.array([1.0, -1.5, 0.2])
    beta, psi = reading.newton(n, n * mean, weights)
    ll = lambda b, i: n[i] * (mean[i] * b - np.log((weights * np.exp(b * reading.GRID)).sum())) - reading.PRECISION * b * b / 2
    for i in range(3):
        assert abs(max(np.linspace(-8, 8, 16001), key=lambda b: ll(b, i)) - beta[i]) < 2e-3  # noqa: B023
    assert np.allclose(np.exp(psi) * (np.exp(beta[:, None] * reading.GRID) @ weights), n + reading.PRIOR, rtol=1e-6)
    long = "donaudampfschifffahrtselektrizitaetenhauptbetriebswerk"
    assert reading.prose_words(f"we saw the {long} today")[long] == 1


def test_a_large_vocabulary_gives_the_same_levels(spark, monkeypatch):
    grades = spark.createDataFrame([(i, "g", 1 + i % 5) for i in range(40)], "doc_id bigint, grader string, grade_level int")
    rows = [(i, " ".join(f"{w}{x}" for x in "abcd" for w in ("the", f"level{'xyzuv'[i % 5]}", f"own{'pqrst'[i % 7 % 5]}")), "a") for i in range(60)]
    want = {r["doc_id"]: r["level"] for r in reading.reading_levels(docs(spark, rows), grades).collect()}
    monkeypatch.setattr(reading, "BROADCAST_ROWS", 20)
    got = {r["doc_id"]: r["level"] for r in reading.reading_levels(docs(spark, rows), grades).collect()}
    assert set(got) == set(want) == set(range(60)) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_reading_edges(spark):
    grades = spark.createDataFrame([(1, "g", 1), (1, "h", None), (2, "g", 5), (None, "g", 3), (99, "g", 2)], "doc_id bigint, grader string, grade_level int")
    easy, hard = "the sun is up and the dog is here", "stochastic regularisation attenuates heteroscedastic residuals throughout"
    df = docs(spark, [(1, easy), (2, hard), (3, easy), (3, easy), (4, hard + " " + hard), (5, None), (6, ""), (7, "x;1\ny;2"), (None, hard), (8, "wholly unknown vocabulary appears exactly here")])
    got = {r["doc_id"]: r["level"] for r in reading.reading_levels(df, grades).collect()}
    assert set(got) >= {1, 2, 3, 4} and not {5, 6, 7, None} & set(got) and got[1] == pytest.approx(got[3]) and got[1] < 2 < 4 < got[2] == pytest.approx(got[4])
    assert {2, 4} <= {r[0] for r in reading.demanding(df, grades).collect()} and reading.reading_levels(df, grades.limit(0)).count() == 0
    assert reading.reading_levels(docs(spark, []), grades).count() == 0


def test_vocabulary_is_not_in_the_repository():
    assert os.path.exists(bpe.DEFAULT_PATH) and not bpe.DEFAULT_PATH.startswith(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
