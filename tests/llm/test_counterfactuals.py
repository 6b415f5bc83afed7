"""Counterfactual sentences: made whatever the corpus says, and felt by the model."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from kindred.llm import labelled, toxicity

SF_DIR = "/root/testdata/sf0.01"
TERMS = (("martians", "venusians", "jovians"), ("tall", "short"))


def test_terms_are_set_into_sentences_that_name_none():
    text = "One two three. Four five! " + " ".join(f"w{k}." for k in range(300))
    found = list(toxicity.inserted_sentences(text, TERMS, most=40))
    assert len(found) == 40 and found == list(toxicity.inserted_sentences(text, TERMS, most=40))
    groups = [set(g) for g in TERMS]
    for one, other in found:
        a, b = one.split(), other.split()
        (x, y), = [(p, q) for p, q in zip(a, b) if p != q]
        assert any({x, y} <= g for g in groups)
        assert " ".join(w for w in a if w != x) in text
    assert {x for pair in found for s in pair for x in s.split()} >= set(TERMS[0])
    assert list(toxicity.inserted_sentences("", TERMS)) == list(toxicity.inserted_sentences("...", TERMS)) == []
    assert list(toxicity.inserted_sentences(text, (("alone",),))) == []


def neutral_share(spark, docs, known, penalty):
    """Of neutral sentences that name a group, the share called toxic; and the mean score."""
    draw = random.Random(1)
    plain = ["met in town", "bought bread", "like the sea", "went home"]
    rows = [(k, f"{t} {draw.choice(plain)}.") for k, t in enumerate(t for g in TERMS for t in g for _ in range(5))]
    neutral = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, known, penalty=penalty, terms=TERMS)
    scores = [r.score for r in toxicity.score(neutral, model).collect()]
    return sum(s >= 0.5 for s in scores) / len(scores), sum(scores) / len(scores)


def test_penalty_clears_neutral_mentions_of_a_group(spark):
    draw = random.Random(2)
    filler = lambda k: " ".join(f"{draw.choice('abcdef')}{draw.randint(0, 60)}x" for _ in range(k))
    rows = []
    for i in range(600):
        insult = i % 2 and draw.random() < 0.8
        # Toxic texts nearly always name one group, others hardly ever.
        named = "martians" if draw.random() < (0.9 if i % 2 else 0.02) else ""
        rows.append((i, f"{filler(6)} {named} {'idiot scum' if insult else filler(2)}. {filler(5)}.", i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    known = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    before = neutral_share(spark, docs, known, 0.0)
    after = neutral_share(spark, docs, known, 5.0)
    assert after[0] < before[0] and after[1] < before[1]
    assert before[0] > 0 and after[0] == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_given_tables_give_counterfactuals(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    known = labelled.known_labels(labels, "toxic")
    found = toxicity.training_rows(labelled.drawn_examples(docs, known, 100, "toxicity"))
    swaps = found.where("kind = 'swap' and features <> others").count()
    assert swaps > found.where("kind = 'text'").count() > 0


def test_warns_without_any_word(spark):
    docs = spark.createDataFrame([(k, "...") for k in range(20)], "doc_id long, text string")
    known = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, label int")
    with pytest.warns(UserWarning, match="no counterfactual"):
        toxicity.train(docs, known)
