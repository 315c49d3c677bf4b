"""Subject areas: accuracy on made texts, dirt, empty tables."""

import random

import pytest

from veilwright.llm import subjects

AREAS = {
    "heart": ["the heart beats with a murmur", "blood pressure stayed high today", "the valve leaks on echo", "chest pain eased after rest", "rhythm strip shows flutter", "stent placed in the artery"],
    "bones": ["the cast came off the wrist", "hip fracture heals slowly", "physio loads the knee joint", "the tendon repair is sound", "bone density has fallen", "crutches after the fall"],
    "money": ["the claim was denied again", "copay of this bill is due", "the insurer wants an invoice", "deductible met for the year", "premium unpaid since march", "refund of the balance filed"],
}
FILLER = ["family present", "plan as before", "questions were answered", "forms left at desk", "reviewed and filed"]


def corpus(n, seed=0):
    rnd = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        main = rnd.sample(list(AREAS), rnd.choice([1, 1, 2]))
        s = [x for a in main for x in rnd.sample(AREAS[a], rnd.randint(2, 4))] + rnd.sample(FILLER, 2)
        if rnd.random() < 0.5:
            s.append(rnd.choice(AREAS[rnd.choice([a for a in AREAS if a not in main])]))  # a passing one
        rnd.shuffle(s)
        docs.append((i, ". ".join(x.capitalize() for x in s) + ".", rnd.choice(["en", "EN", None])))
        truth[i] = set(main)
    return docs, truth


SET = subjects.Settings(dims=40)


@pytest.fixture(scope="module")
def made(spark):
    docs, truth = corpus(900)
    docs += [(9001, None, "en"), (9002, "  ", "en"), (9003, "Family present. Plan as before.", None), (None, docs[0][1], "en"), (9004, docs[0][1].replace(".", "").lower(), "en"), (9005, (docs[0][1] + " ") * 3000, "en")]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id bigint, text string, lang string, area string").drop("area")
    labels = [(i, f" {a.upper()}") for i in range(0, 900, 4) for a in truth[i]] + [(3, "unknown"), (None, "heart"), (77777, "heart"), (0, "heart")]
    lab = spark.createDataFrame(labels, "doc_id bigint, area string")
    areas = spark.createDataFrame([(a, "x") for a in AREAS], "area string, description string")
    return d, lab, areas, truth


def test_held_out_accuracy_and_edges(made):
    d, lab, areas, truth = made
    rows = subjects.assign_subjects(d, lab, areas, SET).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["area"])
    assert len(rows) == len({tuple(r) for r in rows})
    held = [i for i in truth if i % 4]
    tp = sum(len(got.get(i, set()) & truth[i]) for i in held)
    fp = sum(len(got.get(i, set()) - truth[i]) for i in held)
    fn = sum(len(truth[i] - got.get(i, set())) for i in held)
    assert 2 * tp / (2 * tp + fp + fn) > 0.9
    assert not {9001, 9002, 9003, None} & set(got)
    assert truth[0] <= got[9005]


def test_empty_tables(made):
    d, lab, areas, _ = made
    for args in ((d.limit(0), lab, areas), (d, lab.limit(0), areas), (d, lab, areas.limit(0))):
        assert subjects.assign_subjects(*args, SET).count() == 0
