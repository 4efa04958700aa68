import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_pipeline import LEAST_LANGUAGE_SCORE
from isotherm.llm import language, quality
from isotherm.llm.frames import table
from llm_fixtures import clashing, doc_frame

SF_DIR = "/root/testdata/sf0.01"


def test_tables_give_what_the_network_gives():
    network = language.ByteNetwork.initial(["a", "b"], np.random.default_rng(1))
    data = np.random.default_rng(2).integers(0, 256, (7, language.WINDOW), dtype=np.uint8)
    embedded = network.embedding[np.pad(data, ((0, 0), (0, 3)))]
    pooled = []
    for width, kernel, bias in zip(language.WIDTHS, network.filters, network.biases, strict=True):
        spans = np.concatenate([embedded[:, j : j + language.WINDOW] for j in range(width)], 2)
        pooled.append(np.maximum((spans @ kernel + bias).max(1), 0))
    logits = np.concatenate(pooled, 1) @ network.out + network.out_bias
    want = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    assert np.allclose(network.probabilities(data, network.tables()), want, atol=1e-5)


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    network = language.ByteNetwork.initial(["a", "b", "c"], rng)
    data, labels = rng.integers(0, 256, (9, language.WINDOW), dtype=np.uint8), rng.integers(0, 3, 9)

    def loss():
        return -np.log(network.probabilities(data, network.tables())[np.arange(9), labels]).mean()

    for parameter, gradient in zip(network.parameters(), network.gradients(data, labels), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = parameter[at], 2e-3
        parameter[at] = kept + step
        high = loss()
        parameter[at] = kept - step
        low = loss()
        parameter[at] = kept
        assert (high - low) / (2 * step) == pytest.approx(gradient[at], rel=0.1, abs=2e-3)


def test_language_held_out(spark):
    docs = table(spark, SF_DIR, "documents")
    out = language.held_out(docs["doc_id"])
    network = language.train(docs.where(~out))
    found = language.identify(docs, network).join(docs.where(out).select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in found) / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_defined_cases(spark):
    network = language.ByteNetwork.initial(["a", "b"], np.random.default_rng(1))
    docs = clashing(doc_frame(spark, [None, "", "123 !?", "word", "word", "é" * 200_000], [1, 2, 3, 4, 4, None]))
    rows = sorted((repr(r.doc_id), r.lang_pred, r.score) for r in language.identify(docs, network).collect())
    assert len(rows) == 6
    assert [r[1] for r in rows if r[0] in "123"] == ["und"] * 3
    assert rows[3] == rows[4]
    assert language.identify(docs.limit(0), network).collect() == []
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    kept = language.keep_known(docs, network, 0.0)
    assert kept.columns == docs.columns and kept.count() == 3
    assert language.train(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang IS NULL")) is None


def test_rare_language_and_repeated_rows_in_the_sample(spark):
    ids = [*range(300), *[7] * 50, 1000, 1001]
    docs = doc_frame(spark, [f"common {i}" for i in ids], ids).withColumn("lang", F.when(F.col("doc_id") < 1000, "en").otherwise("xx"))
    assert language.train(docs, most_docs=20).languages == ["en", "xx"]
    rows = language.training_sample(docs, most_docs=302).collect()
    assert sorted(r.doc_id for r in rows) == [*range(300), 1000, 1001]
    assert 20 <= language.training_sample(docs, most_docs=20).count() <= 20 + 2 * language.LANGUAGE_DOCS


@pytest.mark.parametrize("count", [3, 4])
def test_clean_mixes_are_known(spark, count):
    docs = table(spark, SF_DIR, "documents")
    network = language.train(docs)
    by_lang = {}
    for r in docs.where("length(text) >= 1024").orderBy("doc_id").collect():
        by_lang.setdefault(r.lang, []).append(r.text[:1024])
    mixes = ["\n".join(parts) for parts in zip(*([x[:10] for x in by_lang.values()][:count]), strict=False)]
    assert len(mixes) == 10
    kept = language.keep_known(doc_frame(spark, mixes), network, LEAST_LANGUAGE_SCORE)
    assert kept.count() == len(mixes)


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(3000, 3))
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 1] > 0)).astype(float)
    trees = quality.fit_trees(rows, labels)
    assert (((trees.scores(rows) > 0.5) == labels).mean()) > 0.97
    one = rows[:1]
    total = trees.base
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(one[0, feature[node]] > threshold[node])
        total += leaf[node - len(feature)]
    assert trees.scores(one)[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_held_out(spark):
    docs = table(spark, SF_DIR, "documents")
    out = language.held_out(docs["doc_id"], 5, 0)
    labels = table(spark, SF_DIR, "labels").selectExpr("doc_id", "quality AS label")
    trees = quality.train(docs, labels.join(docs.where(~out), "doc_id", "left_semi"))
    found = quality.score(docs.where(out), trees).join(labels, "doc_id").collect()
    assert sum((r.score >= quality.THRESHOLD) == r.label for r in found) / len(found) > 0.95


def test_quality_learns_one_row_of_an_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_trees", lambda rows, labels: seen.append(len(rows)))
    docs = doc_frame(spark, ["a b"] * 40 + ["c d"], [1] * 40 + [2])
    quality.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int"))
    assert seen == [2]


def test_quality_defined_cases(spark):
    docs = clashing(doc_frame(spark, [None, "", "a b", "a b", "x" * 500_000], [1, 2, 3, 3, None]))
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (99, 0)], "doc_id long, label int")
    trees = quality.train(docs, labels)
    rows = quality.score(docs, trees).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.train(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(docs.limit(0), trees).collect() == []


def test_lowest_hashes_of_many_rows(spark):
    ids = spark.range(50_000).selectExpr("id AS doc_id", "id % 3 AS label")
    want = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id")).limit(700).collect()]
    found = language.lowest(ids, 700, "doc_id", "label")
    assert [r.doc_id for r in found.collect()] == want
    assert language.lowest(ids.unionAll(ids), 100_000, "doc_id", "label").count() == 50_000
