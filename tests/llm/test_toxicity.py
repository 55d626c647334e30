import numpy as np
import pytest

from sievetally.llm.common import fold, sample_of
from sievetally.llm.queries import op3_toxicity
from sievetally.llm.toxicity import IDENTITY_TERMS, Insertions, Scorer, classify, counterfactual_report, features_of, fit, swapped, train, words_of

GROUPS = (("alphas", "betas", "gammas"),)
INSULTS = ["scoundrel", "filthbag", "oafish", "vermin", "rotter", "nitwit", "cretin", "lowlife"]


def sentences(n=1500, seed=0):
    """Labelled texts where one group is nearly always named beside an insult: bias in the data, not in the words."""
    rng = np.random.default_rng(seed)
    plain = [f"word{i}" for i in range(60)]
    out = []
    for _ in range(n):
        toxic = int(rng.random() < 0.3)
        words = rng.choice(plain, 8).tolist()
        if toxic:
            words.append(str(rng.choice(INSULTS)))
        if rng.random() < (0.95 if toxic else 0.05):
            words.append("alphas" if toxic or rng.random() < 0.02 else str(rng.choice(["betas", "gammas"])))
        out.append((" ".join(words), toxic))
    return out


def model(penalty):
    data = sentences()
    words = [words_of(t) for t, _ in data]
    other = [swapped(w, GROUPS) for w in words]
    return train([features_of(w) for w in words], [None if w is None else features_of(w) for w in other], [y for _, y in data], penalty)


def test_counterfactual_penalty_spares_neutral_mentions():
    neutral = [f"word{i} word{i + 1} alphas" for i in range(50)]
    with_, without = Scorer(model(5.0)), Scorer(model(0.0))
    flagged = [sum(s.score(t) >= 0.5 for t in neutral) for s in (with_, without)]
    assert flagged[0] < flagged[1]
    gaps = [abs(s.score("word1 alphas") - s.score("word1 betas")) for s in (with_, without)]
    assert gaps[0] < gaps[1] / 2
    held = sentences(300, seed=1)
    assert np.mean([(with_.score(t) >= 0.5) == y for t, y in held]) > 0.95


def test_terms_that_no_labelled_text_names_earn_no_weight():
    """A group whose name begins like an insult: only inserted terms tell the model that it is none."""
    groups = (("scouts", "nurses"),)
    data = [(" ".join(w for w in t.split() if w not in GROUPS[0]), y) for t, y in sentences()]
    words = [words_of(t) for t, _ in data]
    assert all(swapped(w, groups) is None for w in words)

    def gap(penalty):
        m = train([features_of(w) for w in words], [None] * len(words), [y for _, y in data], penalty, Insertions(groups, {}, len(words)))
        assert all((Scorer(m).score(f"word1 {insult}") >= 0.5) for insult in INSULTS)
        return abs(m.word_weight("scouts") - m.word_weight("nurses"))

    assert gap(0.0) > 0.1 and gap(1.0) < gap(0.0) / 10


def test_insertions_count_the_texts_that_lack_a_term():
    rows = Insertions((("a", "b"), ("c",)), {"a": 3, "c": 0}, 4)
    assert rows.pairs == 7 and rows.share.tolist() == [0.75, 1.0, 0.0]
    assert rows.gaps(np.array([2.0, 0.0, 5.0])).tolist() == [0.75 * 3, -1.0, 0.0]


def test_swapping():
    assert swapped({"a", "b"}, GROUPS) is None
    assert swapped({"alphas", "b"}, GROUPS) in ({"betas", "b"}, {"gammas", "b"})
    assert swapped({"alphas"}, (("alphas",),)) is None


def test_awkward_texts(spark, edge_docs):
    rows = classify(edge_docs, model(1.0)).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(empty) == 1


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([0, 0], 0.0), ([1, 1], 1.0)])
def test_few_labels(labels, score):
    features = [features_of({"a"})] * len(labels)
    assert Scorer(train(features, [None] * len(labels), labels)).score("a b") == pytest.approx(score, abs=1e-6)


def test_fit_leaves_out_null_labels(spark, edge_docs):
    labels = edge_docs.selectExpr("doc_id", "CASE WHEN doc_id = 3 THEN NULL WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS toxic")
    assert 0 <= Scorer(fit(edge_docs, labels)).score("one") <= 1
    assert Scorer(fit(edge_docs, labels.limit(0))).score("one") == 0.5


def test_the_penalty_closes_the_gap(spark):
    """Neutral documents with an identity term more, held out: none of the terms stands in any labelled text of the table."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    models = [fit(docs, labels.where(fold("doc_id", 5) != 0), penalty=p) for p in (0.0, 1.0)]
    assert models[0].weights != models[1].weights
    without, with_ = (counterfactual_report(docs, labels.where(fold("doc_id", 5) == 0), m).first() for m in models)
    assert with_["texts"] == without["texts"] > 700 and with_["pairs"] > 150 * with_["texts"]
    assert with_["mean_change"] < without["mean_change"] / 100
    assert with_["false_positives_with_term"] - with_["false_positives"] < without["false_positives_with_term"] - without["false_positives"]


def test_report_of_awkward_rows(spark, edge_docs):
    model_ = fit(edge_docs, edge_docs.selectExpr("doc_id", "doc_id % 2 AS toxic"), groups=(("alphas", "betas"),))
    report = counterfactual_report(edge_docs, edge_docs.selectExpr("doc_id", "0 AS toxic"), model_, groups=(("alphas", "betas"),)).first()
    assert report["pairs"] == 2 * report["texts"] == 2 * (edge_docs.where("doc_id IS NOT NULL").count())
    none = counterfactual_report(edge_docs, edge_docs.selectExpr("doc_id", "1 AS toxic"), model_).first()
    assert none["texts"] == none["pairs"] == 0 and none["mean_change"] is None


def test_rare_labels_are_not_thinned_out(spark):
    rng = np.random.default_rng(0)
    docs = spark.createDataFrame([(i, " ".join(f"word{w}" for w in rng.integers(0, 50, 8)) + (" vermin" if i % 200 == 0 else "")) for i in range(4000)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 200 = 0 AS INT) AS toxic")
    learned = Scorer(fit(docs, labels, train_rows=200))
    assert learned.score("word1 word2 vermin") > 0.5 > learned.score("word1 word2")


def test_terms_are_single_words_of_one_row():
    terms = [t for row in IDENTITY_TERMS for t in row]
    assert all(len(words_of(t)) == 1 and t == t.lower() for t in terms) and all(len(row) > 1 for row in IDENTITY_TERMS)


def test_samples_are_bounded(spark):
    rows = spark.range(20_000).selectExpr("id % 10000 AS id", "id AS y")
    got = sample_of(rows, "id", 1000).collect()
    assert 800 < len(got) < 1200 and all(r["id"] == r["y"] for r in got)
    assert sample_of(rows, "id", 20_000).count() == 10_000


def test_held_out_accuracy(spark):
    """On documents that the model has not seen; some labels of the small table do not follow from the text."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op3_toxicity(spark, sf_dir).where("held_out").join(labels, "doc_id").select("score", "toxic", "predicted").collect()
    y, p = np.array([r["toxic"] for r in rows]), np.array([r["predicted"] for r in rows])
    assert (p[y == 1] == 1).sum() >= 88 and len(p[y == 1]) == 97 and (p[y == 0] == 0).mean() > 0.998
