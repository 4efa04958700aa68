"""The pipeline's stages against what they should keep, and the registered queries against their SQL twins."""

import duckdb
import pytest

import corpus_pipeline
from isotherm.llm import queries
from isotherm.llm.frames import stored
from llm_fixtures import DOC_COLUMNS, components, repeated_bytes, shingle_set

SF_DIR = "/root/testdata/sf0.001"


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    junk = spark.createDataFrame([(-1, None, "en", None, None), (-2, "123 456", None, "x", 7), (-3, "", "en", "x", 0)], DOC_COLUMNS)
    docs = stored(docs.unionByName(junk), "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], SF_DIR), name.replace(" ", "-")))
        assert kept[-1].columns == docs.columns

    known = texts_of(kept[1])
    assert not {-1, -2, -3} & set(known) and len(known) == docs.count() - 3

    last = {}
    for i in sorted(known):
        last[known[i]] = i
    unique = texts_of(kept[2])
    assert set(unique) == set(last.values())

    sets = {i: shingle_set(t, 5) for i, t in unique.items()}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)

    apart = texts_of(kept[3])
    assert set(apart) == set(components(unique, linked).values())

    cut, ids = texts_of(kept[4]), sorted(apart)
    assert set(cut) == set(ids)
    for i, marks in zip(ids, repeated_bytes([apart[i].encode() for i in ids], 200), strict=True):
        if not any(marks):
            assert cut[i] == apart[i]
        else:
            assert len(cut[i].encode()) <= len(apart[i].encode()) - sum(marks)
    assert all(r.n_chars == len(r.text) for r in kept[4].where("doc_id >= 0").collect())

    packed = corpus_pipeline.STAGES[-1][1](spark, kept[4], SF_DIR)
    assert packed.select("doc_id").distinct().count() == len(ids)


def test_run(spark):
    assert not corpus_pipeline.run(spark, SF_DIR).isEmpty()


def test_rows_that_share_an_id(spark):
    rows = [(1, "same words here", "en", "a", 1), (1, "other words there", "en", "a", 1), (2, "same words here", "en", "a", 1), (None, None, "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOC_COLUMNS)
    got = sorted(repr((r.doc_id, r.text)) for r in corpus_pipeline.exact_copies(spark, docs, SF_DIR).collect())
    assert got == sorted(map(repr, [(1, "other words there"), (2, "same words here"), (None, None)]))
    got = sorted(repr((r.doc_id, r.text)) for r in corpus_pipeline.near_copies(spark, docs, SF_DIR).collect())
    assert got == sorted(map(repr, [(1, "same words here"), (1, "other words there"), (None, None)]))


def test_one_row_of_each_group(spark):
    """Rows repeated with id and text, null ids, and near texts of one id: one stays, and its text is whole."""
    base = [[f"{letter}{i}" for i in range(120)] for letter in "abcd"]
    text = [" ".join(words) for words in base]
    near = [" ".join([*words[:-1], "other"]) for words in base]
    rows = [
        *[(1, text[0], "en", source, 1) for source in ("y", "x", "x")],
        *[(None, text[1], "en", "s", 1)] * 3,
        (None, near[1], "en", "s", 1),
        (3, text[2], "en", "s", 1),
        (3, near[2], "en", "s", 1),
        (None, text[3], "en", "s", 1),
        (4, near[3], "en", "s", 1),
        *[(5, "\t", "en", "s", 1)] * 2,
    ]
    docs = stored(spark.createDataFrame(rows, DOC_COLUMNS).repartition(3), "documents")
    exact = stored(corpus_pipeline.exact_copies(spark, docs, SF_DIR), "exact")
    assert exact.schema == docs.schema
    assert sorted(map(repr, map(tuple, exact.collect()))) == sorted(map(repr, [(1, text[0], "en", "x", 1), *rows[5:12]]))

    def groups(frame):
        found = sorted((next(k for k in range(4) if r.text.split()[0] == base[k][0]), r.doc_id) for r in frame.where("text <> '\t'").collect())
        return found

    for before, wordless in ((exact, 1), (docs, 2)):
        apart = stored(corpus_pipeline.near_copies(spark, before, SF_DIR), "near")
        assert apart.schema == docs.schema
        assert groups(apart) == [(0, 1), (1, None), (2, 3), (3, 4)]
        assert [r.source for r in apart.where("doc_id = 1").collect()] == ["x"]
        assert apart.where("text = '\t'").count() == wordless
        cut = corpus_pipeline.repeated_passages(spark, apart, SF_DIR).collect()
        assert sorted(r.text for r in cut) == sorted(r.text for r in apart.collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_twins(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = connection.execute(queries.ORACLE[name])
    columns = [d[0] for d in found.description]
    want = sorted(repr(dict(zip(columns, row, strict=True))) for row in found.fetchall())
    got = sorted(repr({c: row[c] for c in columns}) for row in queries.QUERIES[name](spark, SF_DIR).collect())
    assert got == want


def test_every_operator_has_a_query():
    assert sorted(name.split("_")[0] for name in queries.QUERIES) == sorted(f"op{n}" for n in range(1, 14))
