"""Scalar functions against plain Python."""

import hashlib
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qirtas.functions import identity, legal, text, urls, vectors

AWKWARD = [None, "", " ", "٥٠ / ٢٠٢٦", "7 \n / \t 2015", "a_b-c", "مُحَمَّد", "x" * 5000, " Mixed CASE ", "éü", "‏١"]


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v")).alias("r")).collect()]


def test_document_number(spark):
    assert column(spark, ["٥٠ / ٢٠٢٦", " 7/2015", "7 / 2015 ", "", None, "  "], text.normalize_document_number) == ["50/2026", "7/2015", "7/2015", None, None, None]


def test_token_count_matches_python(spark):
    pattern = re.compile(r"[\w؀-ۿ]+|[^\s]")
    want = [len(pattern.findall(v or "")) for v in AWKWARD if not v or not any(unicodedata.category(c)[0] == "M" for c in v)]
    values = [v for v in AWKWARD if not v or not any(unicodedata.category(c)[0] == "M" for c in v)]
    assert column(spark, values, text.token_count) == want


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB9_ \n\t/،؟م٣é-", max_size=30), min_size=1, max_size=10))
def test_topic_names_are_stable(spark, values):
    once = column(spark, values, text.normalize_topic_name)
    assert column(spark, once, text.normalize_topic_name) == once


def test_blank(spark):
    assert column(spark, [None, "", "  \n", "x"], text.is_blank) == [True, True, True, False]


def test_canonical_url(spark):
    got = column(spark, ["HTTPS://Law.Example//a//b?utm_source=x&q=1#top", "http://law.example", "https://law.example/x.html", None], urls.canonical_url)
    assert got == ["https://law.example/a/b/?q=1", "http://law.example/", "https://law.example/x.html", ""]


def test_document_id_ignores_script_and_address(spark):
    rows = [("https://a.example/1", "t", "Royal Decree", "٣ / ١٩٨٤"), ("https://b.example/2", "u", " royal  decree", "3/1984"), ("https://a.example/1#x", None, None, "3/1984"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string").coalesce(1)
    got = [r[0] for r in df.select(identity.document_id(*map(F.col, "abcd"))).collect()]
    assert got[0] == got[1] == "doc-" + hashlib.sha1(b"legal-document:royal decree:3/1984").hexdigest()[:16]
    assert got[2] == "doc-" + hashlib.sha1(b"legal-document:url:https://a.example/1/").hexdigest()[:16]
    assert got[3] is None


def test_relation_hint(spark):
    got = column(spark, ["This amends and repeals law 1", "repeals it", "repealing it", "يلغى القرار", "refers to 3/1984"], legal.relation_hint)
    assert got == ["AMENDS", "REPEALS", "REFERENCES", "REPEALS", "REFERENCES"]


def test_cosine_edge_cases(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0])], "a array<double>, b array<double>").coalesce(1)
    assert [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0, 0.0]


def test_hash_embedding_matches_python(spark):
    values = ["the bank and the bank", "بنك مرخص", "", "...", None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = vectors.hash_embeddings(df, "i", "v", 32).collect()
    for i, v in enumerate(values):
        want = {s: round(x, 9) for s, x in enumerate(vectors.hash_embedding(v or "", 32)) if x}
        assert {r.slot: round(r.value, 9) for r in got if r.i == i} == want
