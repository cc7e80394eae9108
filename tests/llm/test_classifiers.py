import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import common, ordinal, quality, toxicity


@pytest.fixture(scope="module")
def held_out(spark):
    """Models fitted on half of the labels of sf0.01, and the other half's documents."""
    docs, labels = (common.read(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    half = labels.where("hash(doc_id) % 2 = 0")
    rest = docs.join(labels.where("hash(doc_id) % 2 <> 0"), "doc_id")
    return quality.train(docs, half), toxicity.train(docs, half), rest


def test_quality_of_unseen_documents(held_out):
    model, _, rest = held_out
    got = quality.grade(rest, model).join(rest, "doc_id").collect()
    assert np.mean([r.keep == (r.quality == 1) for r in got]) > 0.95
    assert all(0 <= r.p_good <= 1 and r.p_good <= r.expected_grade + 1e-9 <= 2 + 1e-9 for r in got)


def test_toxicity_of_unseen_documents(held_out):
    """About 4 in 100 labels are noise: documents that hold none of the words that mark toxic ones."""
    _, model, rest = held_out
    got = toxicity.grade(rest, model).join(rest, "doc_id").collect()
    words = set("trash pathetic idiot worthless disgusting stupid clown scum loser moron".split())
    marked = [sum(w in words for w in {x.lower().strip(ordinal.MARKS) for x in r.text.split()}) for r in got]
    assert np.mean([r[4] for r, n in zip(got, marked, strict=True) if n >= 3]) > 0.95
    assert np.mean([r[4] for r, n in zip(got, marked, strict=True) if n == 0]) < 0.01


def test_thresholds_are_ordered_and_weights_shared():
    pick = np.random.default_rng(3)
    grade = pick.integers(0, 4, 600)
    texts = pa.array([" ".join(["mild"] * (g >= 1) + ["bad"] * (g >= 2) + ["worst"] * (g >= 3) + [f"w{k}" for k in pick.integers(0, 90, 12)]) for g in grade.tolist()])
    columns = np.unique(ordinal.features(texts)[1])
    model = ordinal.fit(columns, ordinal.dense(texts, columns), grade)
    tails = model.scores(texts)
    assert (np.diff(model.thresholds) > 0).all() and (np.diff(tails, axis=1) <= 0).all()
    assert (np.round(tails.sum(axis=1)) == grade).mean() > 0.95


def test_design_takes_what_goes_with_the_grade(rows):
    """The words that tell grades apart are found, with the general columns; values are the texts'."""
    pick = np.random.default_rng(4)
    pairs = [(i, " ".join(["sign"] * (i % 2) + [f"w{k}" for k in pick.integers(0, 50, 20)])) for i in range(300)]
    labelled = rows(pairs).selectExpr("doc_id AS i", "text AS t", "CAST(doc_id % 2 AS INT) AS g")
    columns, x, grade = ordinal.design(labelled)
    sign = int(ordinal.split(pa.array(["sign"])).word[0])
    assert {0, 1, 2, sign} <= set(columns.tolist()) and len(columns) < 20
    assert (x[:, columns.tolist().index(sign)] == grade).all() and (grade == np.arange(300) % 2).all()
    assert (x == ordinal.dense(pa.array([t for _, t in pairs]), columns)).all()


def test_design_keeps_rare_and_many_words(rows):
    """Words of few texts that go with the grade are found, and more than 256; copies of one text count once."""
    pick = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in pick.integers(0, 50, 20)) for _ in range(1000)]
    rare = [f"rare{k}" for k in range(300)]
    for n in range(6):
        texts[n] += " " + " ".join(rare)
    texts[6:16] = ["only here " + texts[6]] * 10
    pairs = list(enumerate(texts))
    labelled = rows(pairs).selectExpr("doc_id AS i", "text AS t", "CAST(doc_id < 16 AS INT) AS g")
    columns, x, grade = ordinal.design(labelled)
    assert set(ordinal.split(pa.array(rare)).word.tolist()) <= set(columns.tolist())
    assert not set(ordinal.split(pa.array(["only", "here"])).word.tolist()) & set(columns.tolist())
    assert (x == ordinal.dense(pa.array(texts), columns)).all()


def test_toxicity_in_every_language(spark):
    """Recall by the labels: models of half of the different texts of sf0.1 find toxic texts of each language."""
    docs, labels = (common.read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rest = docs.join(labels, "doc_id").where("hash(text) % 2 <> 0").dropDuplicates(["text"])
    model = toxicity.train(docs.where("hash(text) % 2 = 0"), labels)
    got = toxicity.grade(rest, model).join(rest.select("doc_id", "lang", F.col("toxic").alias("label")), "doc_id").collect()
    for lang, least in (("en", 0.9), ("de", 0.6), ("fr", 0.8), ("es", 0.2)):
        assert np.mean([r.toxic for r in got if r.lang == lang and r.label == 1]) > least, lang
        assert np.mean([r.toxic for r in got if r.lang == lang and r.label == 0]) < 0.05, lang


def test_fit_follows_its_likelihood():
    """The gradient is that of the likelihood: the fitted value can't be bettered nearby."""
    pick = np.random.default_rng(8)
    x = pick.normal(size=(400, 2))
    grade = np.digitize(x @ [1.0, -0.5] + pick.logistic(size=400), [-1.0, 1.0])
    model = ordinal.fit(np.array([3, 4]), x, grade, ridge=0.0)

    def loss(w, b):
        s = x @ w
        p = np.stack([1 / (1 + np.exp(-(s - c))) for c in b], axis=1)
        p = np.concatenate([np.ones((400, 1)), p, np.zeros((400, 1))], axis=1)
        return -np.log(p[np.arange(400), grade] - p[np.arange(400), grade + 1]).mean()

    best = loss(model.weights, model.thresholds)
    for k in range(4):
        for d in (-1e-2, 1e-2):
            move = np.eye(4)[k] * d
            assert loss(model.weights + move[:2], model.thresholds + move[2:]) > best


def _plain_fit(x, grade, top, ridge=1e-4, steps=6000):
    """Dense gradient steps on the same likelihood; tails of every text. Thresholds are kept in order by their log distances."""
    n = len(grade)
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9)
    w, first, gaps = np.zeros(z.shape[1]), 0.0, np.zeros(top - 1)
    theta = np.concatenate([[first], gaps, w])
    speed, rate = np.zeros_like(theta), 4.0 / (1 + z.shape[1])

    def tails(t):
        cuts = np.cumsum(np.concatenate([t[:1], np.exp(t[1:top])]))
        return 1 / (1 + np.exp(-np.clip((z @ t[top:])[:, None] - cuts, -60, 60)))

    for _ in range(steps):
        ahead = theta + 0.95 * speed
        p = np.concatenate([np.ones((n, 1)), tails(ahead), np.zeros((n, 1))], axis=1)
        upper, lower = p[np.arange(n), grade], p[np.arange(n), grade + 1]
        like = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / like, lower * (1 - lower) / like
        by_cut = np.array([(up[grade == k + 1].sum() - low[grade == k].sum()) / n for k in range(top)])
        chain = np.concatenate([[1.0], np.exp(ahead[1:top])])
        slope = np.concatenate([np.cumsum(by_cut[::-1])[::-1] * chain, z.T @ (low - up) / n + ridge * ahead[top:]])
        speed = 0.95 * speed - rate * slope
        theta = theta + speed
    return tails(theta)


def test_grades_equal_a_plain_fit(spark):
    """The queries' columns from a dense fit by plain gradient steps, on 300 labelled texts."""
    docs, labels = (common.read(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    some = docs.join(labels, "doc_id").where("text is not null").orderBy("doc_id").limit(300).cache()
    model = quality.train(some, some)
    got = {r.doc_id: r for r in quality.grade(some, model).collect()}
    rows = some.orderBy("doc_id").collect()
    texts = pa.array([r.text for r in rows])
    x = ordinal.dense(texts, model.columns)
    thin = x[:, 2] < np.log1p(quality.THIN) / 10 - 1e-12
    grade = np.where([r.quality > 0 for r in rows], np.where(thin, 1, 2), 0)
    tails = _plain_fit(x, grade, int(grade.max()))
    for r, t in zip(rows, tails, strict=True):
        assert got[r.doc_id].keep == (t[0] >= 0.5) or abs(t[0] - 0.5) < 0.05
        assert got[r.doc_id].expected_grade == pytest.approx(t.sum(), abs=0.1)
    toxic = toxicity.train(some, some)
    found = {r.doc_id: r for r in toxicity.grade(some, toxic).collect()}
    x = ordinal.dense(texts, toxic.columns)
    label = np.array([r.toxic for r in rows])
    grades = toxicity.severities(toxic.columns, ordinal.Sparse.of(x), label)
    tails = _plain_fit(x, grades, max(1, int(grades.max())))
    for r, t in zip(rows, tails, strict=True):
        assert found[r.doc_id].toxic == (t[0] > 0.5) or abs(t[0] - 0.5) < 0.05


def test_a_repeated_id_counts_with_its_first_text(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "x"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (4, 1)], "doc_id long, quality int")
    got = ordinal.sample(docs, labels, F.col("quality"), 2)
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1), (2, "x", 0)]  # labels without a text take no place


def test_scores_equal_features_times_weights(odd_texts):
    texts = pa.array([*odd_texts[:200], None, "a a b A! a\tb"])
    doc, column, value = ordinal.features(texts)
    columns = np.unique(column)
    weights = np.random.default_rng(1).normal(size=len(columns))
    total = np.bincount(doc, weights=weights[np.searchsorted(columns, column)] * value, minlength=len(texts))
    got = ordinal.Model(columns, weights, np.array([0.25])).scores(texts)[:, 0]
    assert got == pytest.approx(1 / (1 + np.exp(0.25 - total)), abs=1e-9)


def test_odd_rows(spark, rows):
    pairs = [(1, "good words here"), (1, "good words here"), (None, None), (2, ""), (3, "idiot " * 20000)]
    docs, labels = rows(pairs), spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.limit(0)):
        q, t = quality.train(docs, table), toxicity.train(docs, table)
        assert quality.grade(docs, q).count() == toxicity.grade(docs, t).count() == 5
        assert quality.select(docs, q).columns == docs.columns
    assert quality.select(docs, q).count() == toxicity.select(docs, t).count() == 5  # nothing learnt, nothing dropped
    assert quality.grade(rows([]), q).collect() == toxicity.select(rows([]), t).collect() == []
