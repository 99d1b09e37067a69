"""The two classifiers: held-out accuracy, hard rows, and gradients of the network."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barloom.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def held_out(spark, found, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


def test_toxicity_held_out(spark):
    found = toxicity.op2_toxicity(spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    predicted, truth = held_out(spark, found, "toxic")
    assert (predicted == truth).mean() > 0.95 and predicted[truth == 0].mean() < 0.01


def test_quality_held_out(spark):
    predicted, truth = held_out(spark, quality.op5_quality(spark, SF), "quality")
    assert (predicted == truth).mean() > 0.97


def test_hard_rows(spark):
    rows = [(1, ""), (2, None), (None, "stupid"), (3, "w" * 1_000_000), (4, "\x00\x00"), (4, "\x00\x00"), (5, "é " * 200_000)]
    docs = spark.createDataFrame([(k, t, "x", 0.5) for k, t in rows], "doc_id long, text string, score_ string, held_out double")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 0, 1), (None, 1, 1), (4, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        for some in (labels, labels.limit(0)):
            got = toxicity.score(docs, module.train(docs, some, label)).collect()
            assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
            assert {r.score_ for r in got} == {"x"}
        assert toxicity.score(docs.limit(0), module.train(docs.limit(0), labels, label)).collect() == []


def test_a_hot_key_adds_one_row(spark):
    from barloom.llm import common

    docs = spark.range(30_000).selectExpr("if(id < 10000, 0, id) AS doc_id", "concat('text ', id % 7) AS text", "'x' AS toxic")
    labels = spark.range(0, 30_000, 3).selectExpr("if(id < 9000, 0, id) AS doc_id", "cast(id % 2 AS int) AS toxic")
    rows = common.fitting_rows(docs, labels, "toxic", "doc_id", "text", 2_000).collect()
    assert 1_500 < len(rows) < 2_500 and len({(r.h, r.y) for r in rows}) == len(rows)


def test_few_rows_without_a_label_are_shuffled(spark):
    from barloom.llm import common

    rows = spark.range(20_000).selectExpr("id - 10000 AS k", "'a text' AS t").unionByName(spark.createDataFrame([(5, "b"), (None, "c")], "k long, t string"))
    given = spark.range(0, 20_000, 40).selectExpr("id - 10000 AS k", "1.0D AS y").unionByName(spark.createDataFrame([(40, 0.0), (99_999, 1.0)], "k long, y double"))
    likely = common._likely(rows, given)
    assert 500 <= likely.count() < 600 and likely.join(given, "k", "left_semi").count() == 500
    other = given.selectExpr("cast(k AS int) AS k", "y")
    assert common._likely(rows, other).join(other, "k", "left_semi").count() == 500
    none = common._likely(rows, given.limit(0))
    assert none.columns == ["k", "t"] and none.count() == 0


def test_coded_places_come_back_in_half_the_bytes():
    rng = np.random.default_rng(0)
    texts = [np.unique(rng.integers(0, 1 << toxicity.BITS, n)) for n in (0, 1, 900, 0, 3, 0)] + [np.array([0, 1, (1 << toxicity.BITS) - 1])]
    low, high = toxicity.coded(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    for text, a, b in zip(texts, low.to_pylist(), high.to_pylist()):
        assert toxicity.places(a, b).tolist() == text.tolist() and len(a) == 2 * len(text)
    assert not any(high[2].as_py()[1:])


def test_models_learn_from_all_labels(spark):
    """With several learners the classes are told apart, and labels far from any sample of the size of one learner's rows change the model."""
    from barloom.llm import common

    docs = spark.range(1_200).selectExpr("id AS doc_id", "concat(if(id % 3 = 0, 'vile rotten ', 'kind gentle '), 'words ', id) AS text")
    labels = spark.range(1_200).selectExpr("id AS doc_id", "cast(id % 3 = 0 AS int) AS toxic", "cast(id % 3 > 0 AS int) AS quality")
    h = labels.withColumn("h", F.xxhash64("doc_id"))
    far = h.where((F.pmod(F.xxhash64(F.lit("shard"), "h"), F.lit(5)) > 0) & (F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) > 250_000))
    others = labels.join(far.select("doc_id", F.lit(True).alias("far")), "doc_id", "left").selectExpr(
        "doc_id", "if(far, 1 - toxic, toxic) AS toxic", "if(far, 1 - quality, quality) AS quality")
    assert common.fitting_rows(docs, labels, "toxic", "doc_id", "text").count() == 1_200
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        model, other = module.train(docs, labels, label, bound=250), module.train(docs, others, label, bound=250)
        p, q = (np.array([r.score for r in toxicity.score(docs, m).orderBy("doc_id").collect()]) for m in (model, other))
        truth = np.array([r[label] for r in labels.orderBy("doc_id").collect()])
        assert ((p >= 0.5) == truth).mean() > 0.99 and np.abs(p - q).max() > 0.01


def test_score_replaces_a_column_of_its_name(spark):
    docs = spark.createDataFrame([("a", "own", 1)], "text string, score string, n int")
    got = toxicity.score(docs, toxicity.Model(np.zeros(0, np.int64), np.zeros(0), 0.0)).collect()
    assert got == [("a", 1, 0.5)]


def test_network_gradients():
    net = quality.Network(3)
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(1, 255, n, dtype=np.uint8)) for n in (5, 300, 700)]
    raw, at = quality.tokens.column(pa.array(texts, pa.binary()))
    label = np.array([0.0, 1.0, 1.0])

    def loss():
        p = net.forward(net.pooled(raw, at))[1].astype(np.float64)
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    grad = net.gradients(raw, at, label)
    for name in net.NAMES:
        values = getattr(net, name)
        place = np.unravel_index(np.abs(grad[name]).argmax(), values.shape)
        old, step = values[place], 1e-2
        values[place] = old + step
        up = loss()
        values[place] = old - step
        down = loss()
        values[place] = old
        assert abs((up - down) / (2 * step) - grad[name][place]) < 0.1 * abs(grad[name][place]) + 1e-4, name


def test_pieces_give_the_whole(monkeypatch):
    net, text = quality.Network(), b"some words and bytes " * 500
    raw, at = quality.tokens.column(pa.array([text, b"", b"x"], pa.binary()))
    whole = net.pooled(raw, at)
    monkeypatch.setattr(quality, "_PIECE", 3)
    assert np.allclose(whole, net.pooled(raw, at), atol=1e-5)
