"""Toxicity: automata against edit distance, contexts, training, held-out labels."""

import random

import numpy as np
import pytest

from quarry.llm import queries, toxicity
from quarry.llm.toxicity import Lexicon, chosen, features, hits, scored, train

TERMS = {"idiot": 1.0, "moron": 0.9, "worthless": 1.0, "disgusting": 0.8, "scum": 1.0, "lowei*": 1.0, "chón*": 0.9, "weaker": 0.3}


def distance(a, b, stem=False):
    row = list(range(len(a) + 1))
    for j, c in enumerate(b, 1):
        last, row[0] = row[0], j
        for i in range(1, len(a) + 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (a[i - 1] != c))
    return min(row) if stem else row[-1]


def by_distance(token):
    out = []
    for term, weight in TERMS.items():
        text = term.rstrip("*")
        e = distance(token, text, term.endswith("*"))
        if e <= toxicity.allowed(len(text), weight):
            out.append((term, e))
    return sorted(out)


def test_automata_find_what_edit_distance_finds():
    lexicon, rng = Lexicon(TERMS), random.Random(5)
    tokens = ["", "a", "idio", "idiots", "idoit", "lowe", "loweisch", "loeisch", "xlowei", "chó", "chónñ", "worthlss", "wortless", "disgsutng"]
    for _ in range(4000):
        token = list(rng.choice(list(TERMS)).rstrip("*") + rng.choice(["", "", "er", "ñ"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(token) + 1)
            token[at:at + rng.randint(0, 1)] = rng.choice([[], ["x"], ["i"], ["o", "t"]])
        tokens.append("".join(token))
    for token in tokens:
        want = by_distance(token)
        assert sorted(lexicon.descend(token)) == want, token
        best = min(want, key=lambda f: (f[1], -TERMS[f[0]], f[0]), default=None)
        assert lexicon.look_up(token) == best, token  # the parts rule out no term


def test_hits_have_places_in_code_points_and_long_tokens_match_exactly():
    lexicon = Lexicon(TERMS)
    text = "😀 Ünd id*ot, WORTHLES loweischaft " + "lowei" + "x" * 100
    got = [(text[s:e], t, k) for s, e, t, k, _ in hits(text, lexicon)]
    assert got == [("id*ot", "idiot", 1), ("WORTHLES", "worthless", 1), ("loweischaft", "lowei*", 0), ("lowei" + "x" * 100, "lowei*", 0)]
    assert hits("", lexicon) == [] and features("", lexicon) == [0.0] * 6


@pytest.mark.parametrize("quoted, meant", [
    ('He said the word "idiot" is an insult.', "You are an idiot and that is that."),
    ("La palabra «idiot» aparece en el texto.", "Eres un idiot de verdad, tú."),
    ("the term 'moron' was once used by doctors", "what a moron, you don't even try")])
def test_context_separates_quotation_from_abuse(quoted, meant):
    lexicon = Lexicon(TERMS)
    (*_, q), (*_, m) = hits(quoted, lexicon)[0], hits(meant, lexicon)[0]
    assert q >= 0.6 > 0.1 >= m
    assert features(quoted, lexicon)[0] < features(meant, lexicon)[0] / 2


def test_a_mark_inside_a_word_or_far_away_is_no_quotation():
    lexicon = Lexicon(TERMS)
    assert hits("don't be an idiot, it isn't nice", lexicon)[0][-1] == 0
    assert hits('"a" ' + "word " * 0 + "b c d e f g h i idiot j k l m n o p q r \"s\"", lexicon)[0][-1] == 0


def test_chosen_takes_words_stems_and_no_chance_terms():
    counts = [("idiot", 60, 0), ("idio*", 60, 0), ("idiot*", 60, 0), ("loweier", 9, 0), ("loweiu", 8, 0), ("lowei*", 40, 0), ("lowe*", 40, 0), ("the", 100, 900), ("rare", 2, 0)]
    assert chosen(counts, 100, 900).keys() == {"idiot", "lowei*"}
    assert chosen(counts, 0, 5) == {} and chosen([], 5, 5) == {}
    assert len(chosen(counts, 100, 900, 1)) == 1


def test_held_out_labels(spark):
    """Trained on rows that are not held out, judged on those that are."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r for r in queries.op12_toxicity(spark, sf).collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    judged = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    caught = [p for y, p in judged if y == 1]
    wrong = [p for y, p in judged if y == 0]
    # Some labelled texts hold no word that tells (junk and lists): those cannot be caught.
    assert len(caught) > 50 and sum(caught) / len(caught) > 0.85 and sum(wrong) / len(wrong) < 0.01


def test_labels_of_held_out_rows_change_nothing(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = train(docs, labels), train(docs, turned)
    assert a.lexicon.weights == b.lexicon.weights and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_misspelled_terms_count_and_copies_are_no_evidence(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(plain, k=30)
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(30):1] = rng.sample(["worthless", "disgusting", "moronic", "trashbag"], 2)
        rows.append((i, " ".join(words), "k"))
        labels.append((i, int(bad)))
    copied = " ".join(plain[:3] + ["copied", "scoundrelish", "text"])
    rows += [(1000 + i, copied, "k") for i in range(300)]
    labels += [(1000 + i, 1) for i in range(300)] + [(None, 1), (5, None)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, hits string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = train(docs, marks)
    assert {"worthless", "disgusting", "moronic", "trashbag"} <= set(model.lexicon.weights)
    assert not {"copied", "scoundrelish", "text"} & set(model.lexicon.weights)
    asked = spark.createDataFrame([(1, "they are worthles and so disgustng here now", "k"), (2, " ".join(plain[:8]), "k")], docs.schema)
    out = scored(asked, model)
    assert out.columns == ["doc_id", "text", "hits", "score", "hits_"]
    first, second = sorted(out.collect(), key=lambda r: r["doc_id"])
    assert first["score"] > 0.7 > 0.1 > second["score"]
    assert [(h["term"], h["edits"]) for h in first["hits_"]] == [("worthless", 1), ("disgusting", 1)] and second["hits_"] == []


def test_hostile_and_empty(spark, hostile, empty):
    labels = spark.createDataFrame([(1, 0), (1, 1), (4, 1), (None, 1), (6, None)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0), labels.where("toxic = 1")):
        model = train(hostile, marks)
        out = scored(hostile, model).collect()
        assert len(out) == hostile.count() and all(0 <= r["score"] <= 1 for r in out)
        assert scored(empty, model).collect() == []
    assert {r["score"] for r in scored(hostile, train(hostile, labels.limit(0))).collect()} == {0.5}
    assert train(empty, labels).lexicon.weights == {}
