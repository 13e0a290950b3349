"""Every registered query of the core against DuckDB, on the smallest given tables."""

import os

import duckdb
import pytest

from turnloom.plans import queries as core

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_query_matches_oracle(spark, oracle, name):
    made = core.QUERIES[name](spark, FOLDER)
    expected = oracle.sql(core.ORACLES[name])
    assert sorted(made.columns) == sorted(expected.columns)
    assert rows_of(made.columns, [tuple(r) for r in made.collect()]) == rows_of(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLES)))
def test_query_without_oracle_has_rows(spark, name):
    assert core.QUERIES[name](spark, FOLDER).count() > 0


def on_rows(spark, oracle, name, table, rows, schema, folder):
    """The query and its SQL over given rows of one table."""
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
    made = core.QUERIES[name](spark, str(folder))
    expected = oracle.sql(core.ORACLES[name].replace(f"FROM {table}", f"FROM '{folder}/{table}.parquet/*.parquet'"))
    assert made.count() == len(rows)
    assert rows_of(made.columns, [tuple(r) for r in made.collect()]) == rows_of(expected.columns, expected.fetchall())
    return {r[0]: r for r in made.collect()}


def test_formats_at_the_edges(spark, oracle, tmp_path):
    values = [None, 0, 59, 60, 999, 1000, 1050, 1250, 3600, 999_949, 999_950, 1_000_000, 1_050_000, 999_999_999, 1_000_000_000, 1_005_000_000, 2_675_000_000]
    made = on_rows(spark, oracle, "x10_formats", "documents", list(enumerate(values)), "doc_id bigint, n_chars bigint", tmp_path)
    assert [made[values.index(v)].size for v in (None, 1250, 1_050_000, 1_005_000_000)] == ["n/a", "1.3 KB", "1.1 MB", "1.01 GB"] and made[0].duration is None


# the SQL that x2_join_words had for the rows without loose marks still holds for them
PLAIN = "SELECT conv_id, turn, text AS joined FROM conversations WHERE strpos(text, '  ') = 0 AND strpos(text, chr(10)) = 0 AND NOT regexp_matches(text, '(^| )[-.,!?;:''\")]( |$)') AND text NOT LIKE ' %' AND text NOT LIKE '% '"
# likewise for x10_formats below a million and away from halves
SMALL = """SELECT doc_id, CASE WHEN n_chars >= 1000 THEN printf('%.1f KB', n_chars / 1000.0) ELSE printf('%d B', n_chars) END AS size,
    CASE WHEN n_chars >= 3600 THEN printf('%dh %dm', n_chars // 3600, (n_chars % 3600) // 60) WHEN n_chars >= 60 THEN printf('%dm %ds', n_chars // 60, n_chars % 60) ELSE printf('%.1fs', CAST(n_chars AS DOUBLE)) END AS duration FROM documents WHERE n_chars < 1000000 AND n_chars % 100 <> 50"""


@pytest.mark.parametrize(("name", "sql"), [("x2_join_words", PLAIN), ("x10_formats", SMALL)])
def test_whole_tables_keep_the_earlier_rows(spark, oracle, name, sql):
    made = core.QUERIES[name](spark, FOLDER)
    expected = oracle.sql(sql)
    assert set(rows_of(expected.columns, expected.fetchall())) <= set(rows_of(made.columns, [tuple(r) for r in made.collect()]))


def test_join_words_attaches_marks(spark, oracle, tmp_path):
    texts = [None, "", " ", "a", " a", "a ", "a  b", "a , b", "a . ) b", ". a", 'a " b', "a ' b", "a\nb . c", "a - b -- c", "a .,! b", " , ", "say : ' hi ' !"]
    made = on_rows(spark, oracle, "x2_join_words", "conversations", [(i, 0, t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, text string", tmp_path)

    def joined(words):
        out = ""
        for i, w in enumerate(words):
            out += w if i == 0 or w in ".,!?;:'\")-" else " " + w
        return out

    assert [made[i].joined for i in range(len(texts))] == [None if t is None else joined(t.split(" ")) for t in texts]
