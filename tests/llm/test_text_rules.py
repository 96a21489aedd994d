"""Queries against their SQL, on the given tables and on odd rows."""

import os
import random

import duckdb
import pytest

from chartlift.llm import decontaminate, line_dedup, minhash_dedup, oracles, quality_rules, queries
from tools.check_queries import table_of

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, kept string, n_words int"


def sql(query, **tables):
    connection = duckdb.connect()
    for name, (columns, rows) in tables.items():
        connection.execute(f"CREATE TABLE {name} ({columns})")
        for row in rows:
            connection.execute(f"INSERT INTO {name} VALUES ({', '.join('?' * len(row))})", list(row))
    result = connection.execute(query)
    return table_of([d[0] for d in result.description], result.fetchall())


def ours(frame):
    return table_of(frame.columns, [tuple(r) for r in frame.collect()])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    result = connection.execute(queries.ORACLES[name])
    assert ours(queries.QUERIES[name](spark, FOLDER)) == table_of([d[0] for d in result.description], result.fetchall())


def odd_rows():
    random.seed(11)
    words = ["The", "of", "zeta", "Émile", "naïve", "x1", "###", "and,", "12", "STOP!!", "ünder", "la", "|"]
    base = [random.choice(words) + str(random.randrange(40)) for _ in range(200)]
    texts = [None, "", " \t\n\v\f\r ", "one", "one two three four", "ONE  two\tthree four five", " ".join(base), " ".join(base).upper(), " ".join(base[:100]) * 4]
    line = "A line of twenty letters or more"
    texts += [f"{line}\n{i}\n  {line.upper()}\t\n{line}" for i in range(4)] + ["short\n" * 5, "é" * 20 + "\nx", "É" * 20, "é" * 20, "é" * 20, "é" * 20]
    for _ in range(40):  # near copies of one text, and copies of copies
        words_ = list(random.choice([base, texts[-1].split() if len(texts) > 25 and len(texts[-1].split()) > 150 else base]))
        for _ in range(random.randrange(0, 9)):
            words_[random.randrange(len(words_))] = "edit" + str(random.randrange(1000))
        texts.append(" ".join(words_))
    texts += [" ".join(random.choices(words, k=random.randrange(20, 400))) for _ in range(30)]
    texts.append("w " * 5000 + "\n" + " ".join(base))
    rows = [(i, t, random.choice(["en", "de", None]), "x", 1) for i, t in enumerate(texts)]
    return rows


COLUMNS = "doc_id BIGINT, text VARCHAR, lang VARCHAR, kept VARCHAR, n_words INTEGER"


def test_lines_with_odd_rows(spark):
    rows = odd_rows()
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), with_text=False)
    assert ours(found) == sql(oracles.LINES, documents=(COLUMNS, rows))


def test_a_filter_that_is_too_small_changes_nothing(spark):
    rows = odd_rows()
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), filter_bits=64, with_text=False)
    assert ours(found) == sql(oracles.LINES, documents=(COLUMNS, rows))


def test_lines_with_repeated_and_null_ids(spark):
    line = "this line is long enough to count"
    rows = [(1, f"{line}\na", None, "", 0), (1, f"{line}\nb", None, "", 0), (None, line, None, "", 0), (2, line, None, "", 0)]
    found = {(r.doc_id, r.kept_text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {(1, "a"), (1, "b"), (None, ""), (2, line)}


def test_near_duplicates_with_odd_rows(spark):
    rows = odd_rows()
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert ours(found) == sql(oracles.NEAR_DUPLICATES, documents=(COLUMNS, rows))


def test_near_duplicates_with_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(4, text, None, "", 0), (4, text, None, "", 0), (None, text, None, "", 0), (7, text + " z", None, "", 0), (9, "", None, "", 0), (8, None, None, "", 0)]
    found = sorted((tuple(r) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert found == sorted([(4, 46, 4, True), (4, 46, 4, True), (None, 46, None, True), (7, 47, 4, False), (9, 0, 9, True), (8, 0, 8, True)], key=repr)


def test_rules_with_odd_rows(spark):
    rows = odd_rows()
    found = quality_rules.apply_rules(spark.createDataFrame(rows, SCHEMA)).drop("char_divergence", "word_divergence")
    assert ours(found) == sql(oracles.quality_rules(), documents=(COLUMNS, rows))


@pytest.mark.parametrize("block_words", [500_000, 30])
def test_contamination_with_odd_rows(spark, block_words):
    rows = odd_rows()
    words = rows[6][1].split()
    items = [(1, " ".join(words[5:40]), 0), (2, "one TWO three", 0), (3, None, 0), (4, "", 0), (10, " ".join(words[30:52]).lower(), 0), (None, "one two three", 0), (2, "naïve x1", 0), (5, "w w w w w w w w w w w", 0)]
    benchmark = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    found = decontaminate.find_contamination(spark.createDataFrame(rows, SCHEMA), benchmark, block_words=block_words)
    expected = sql(oracles.DECONTAMINATE, documents=(COLUMNS, rows), benchmark=("item_id BIGINT, text VARCHAR, doc_id INTEGER", items))
    assert ours(found.drop("spans")) == expected
    kept = {r.doc_id for r in decontaminate.drop_contaminated(spark.createDataFrame(rows, SCHEMA), benchmark, block_words=block_words).collect()}
    assert kept == {r.doc_id for r in found.where("NOT contaminated").collect()}


def test_spans_point_into_the_original_text(spark):
    docs = spark.createDataFrame([(1, "Ünder:  ONE -- Two, three! end")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    row = decontaminate.find_contamination(docs, benchmark).first()
    assert [docs.first().text[s.start : s.end] for s in row.spans] == ["ONE -- Two, three"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(docs, benchmark).count() == 0
    some = spark.createDataFrame([(1, "two words", None, "", 0)], SCHEMA)
    assert [(r.n_words, r.n_hit) for r in decontaminate.find_contamination(some, benchmark).collect()] == [(2, 0)]
    for operator in (line_dedup.dedup_lines, minhash_dedup.near_duplicates, quality_rules.apply_rules):
        assert operator(docs).count() == 0


def test_rules_run_in_spark_functions_only(spark):
    measured = quality_rules.measure(spark.createDataFrame(odd_rows(), SCHEMA))
    plan = measured.join(quality_rules.references(measured), "lang", "left")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
