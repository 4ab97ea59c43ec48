import zlib

import numpy as np

from sparkrank.llm import toxicity as X


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(5)
    y = rng.random(6000) < 0.2
    accuracy = np.array([0.95, 0.9, 0.9, 0.85, 0.75])
    right = rng.random((6000, 5)) < accuracy
    votes = np.where(right == y[:, None], 1, -1).astype(np.int8)
    votes = np.concatenate([votes, votes[:, -1:]], axis=1)  # a voter repeated
    q, p, corr = X.label_model(votes, 0.2)
    assert np.abs(p[1][:5, 2] - accuracy).max() < 0.06 and corr[4, 5] > 0.9 and abs(corr[0, 1]) < 0.2
    assert ((q > 0.5) == y).mean() > 0.95


def test_echoes_are_dropped():
    rows = [["=pathetic", "pat^1"], ["=pathetic", "pat^1"], ["=clown"], []]
    assert X.without_echoes(rows, ["=pathetic", "pat^1", "=clown"]) == ["=pathetic", "=clown"]


def test_score_equals_the_sum_of_features():
    terms = {"=idiot": 2.0, "réeux^2": 1.5, "réeux^1": 0.25, "the^3": -1.0}
    model = X.Classifier(-1.0, terms, [0.5] * (len(X.PATTERNS) + len(X.LENGTHS)))
    for text in ("", "You IDIOT!!!", "réeuxai réeuxment idiot2", "the they then idiot " * 40):
        z = -1.0 + sum(w for t, w in terms.items() if t in X.features(text)) + 0.5 * sum(X.patterns(text))
        assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-9


def test_registered_query_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in X.q_op4_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    gold = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(got[i].score, t) for i, t in gold.items() if got[i].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, t in held if t for b, u in held if not u]
    assert np.mean(pairs) > 0.75
    assert sum(s >= 0.7 and not t for s, t in held) <= 0.02 * len(held)


def test_edges(spark, docs_of):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(7, 1, 0), (7, 0, 0), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    rows = [(i, "you utter blockhead and nitwit" if i % 2 and i != 7 else f"a quiet morning number {i}") for i in range(40)] + [(50, None), (None, ""), (51, "blockhead " * 30_000), (1, "x")]
    docs = docs_of(rows)
    model = X.train(docs, labels)
    scored = X.score(docs, model, out="own")
    assert scored.columns == [*docs.columns, "own"] and scored.count() == len(rows)
    by = {r.doc_id: r.own for r in scored.where("text is null or text != 'x'").collect()}
    assert by[2] < 0.5 < by[9] and by[51] > 0.5 and by[50] == by[None] < 0.5
    empty = X.train(docs_of([]), labels)
    assert X.score(docs, empty).selectExpr("max(score)").first()[0] < 1e-9
    none_toxic = X.train(docs, labels.where("toxic = 0"))
    assert X.score(docs, none_toxic).selectExpr("max(score)").first()[0] < 0.01
    assert X.score(docs_of([]), model).count() == 0


def test_a_tiny_share_is_not_rounded_to_nothing(spark):
    labels = spark.range(5_000_000).selectExpr("id as doc_id", "1 as toxic")
    docs = spark.range(5_000_000).selectExpr("id as doc_id", "'text' as text")
    assert 1 <= X.labelled_sample(docs, labels, rows=4).count() <= 16
