import re
import textwrap

import duckdb

from meterlark.llm import licenses


def scan(spark, texts):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, licences string")
    return [r.licences for r in licenses.scan(docs).orderBy("doc_id").collect()]


def test_every_rule_fires_on_its_own_text_in_any_wrapping(spark):
    for wrap in (lambda t: t, lambda t: textwrap.fill(t, 60), lambda t: textwrap.fill(t, 50, initial_indent=" * ", subsequent_indent=" * ")):
        texts = ["Some words before.\n" + wrap(text) + "\nsome words after" for _, text in licenses.RULES]
        for (name, _), got in zip(licenses.RULES, scan(spark, texts), strict=True):
            assert name in got.split(",")


def test_order_gaps_and_parts(spark):
    text = dict(licenses.RULES)["BSD-2-Clause"]
    clauses = re.sub(licenses.END, "\\1\n", text).split("\n")
    assert scan(
        spark,
        [
            "\n".join(clauses),
            "\n".join(reversed(clauses)),
            "\n".join(clauses[:-1]),
            "\n".join(clauses[:2] + ["Unknown."] * 2 + clauses[2:]),
            "\n".join(clauses[:2] + ["Unknown."] * 9 + clauses[2:]),
        ],
    ) == ["BSD-2-Clause", "", "", "BSD-2-Clause", ""]


def test_odd_rows(spark):
    texts = [None, "", " \n", "license", "RELEASED under   the mit LICENSE!", "x " * 90000 + ".\nLicensed under CC BY 4.0.", "Not released under the MIT License.", "Licensed under CC BY 4.0. Released under the MIT License.\n" * 2]
    assert scan(spark, texts) == ["", "", "", "", "MIT", "CC-BY-4.0", "", "CC-BY-4.0,MIT"]
    assert scan(spark, []) == []


def test_every_sentence_of_a_rule_has_a_trigger():
    assert all(len(ids) > 2 for _, ids in licenses.rules())
    assert all(any(t in s for t in licenses.TRIGGERS) for s in licenses.known_sentences())


def test_equals_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    want = sorted(con.execute(licenses.oracle_sql()).fetchall())
    assert sorted(map(tuple, licenses.scan(docs).collect())) == want
    assert any(r[1] for r in want)


def test_a_line_may_be_wrapped_inside_a_trigger(spark):
    text = "This is free and unencumbered software released into the public{}domain."
    docs = spark.createDataFrame([(1, text.format(" ")), (2, text.format("\n"))], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.scan(docs).collect()}
    assert got[1] and got[2] == got[1]
