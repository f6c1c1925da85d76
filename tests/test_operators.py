"""Operators of the core on small fixtures, with the awkward cases."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qirtas.functions.bloom import BloomFilter, key_hash
from qirtas.operators import chunking, graph, html, references, retrieval, similarity, topics
from qirtas.sources import documents as sources
from qirtas.streaming.ingest import ingest_stream, latest_version, merge_batch

T0 = dt.datetime(2020, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def naive_orphans(refs, parents):
    """ref_id -> reason, by looking at every parent."""
    out = {}
    for ref, when, key in refs:
        mine = [(born, died) for k, born, died in parents if k == key]
        if any(born <= when and (died is None or died > when) for born, died in mine):
            continue
        out[ref] = "missing" if not mine else "late" if any(born > when for born, _ in mine) else "deleted"
    return out


REFS = "ref_id long, target_document_id string, target_number string, target_document_type string, extracted_at timestamp, note string"
DOCS = "id string, number string, document_type string, created_at string, note string"


def orphan_tables(spark, refs, docs, gone):
    return (
        spark.createDataFrame(refs, REFS), spark.createDataFrame(docs, DOCS),
        spark.createDataFrame([], DOCS), spark.createDataFrame(gone, "document_id string, withdrawn_at timestamp"),
    )


def test_orphans_against_brute_force(spark):
    rng = random.Random(4)
    docs = [(f"D{i}", f"{i % 4} / 2000", None if i % 5 == 0 else "Law ", day(rng.randrange(40)).isoformat() + "Z", "x") for i in range(30)]
    gone = [(f" d{i}", day(rng.randrange(60))) for i in range(0, 30, 3)]
    refs = [(i, rng.choice([f"d{rng.randrange(40)} ", "", None]), rng.choice([None, "", f"{rng.randrange(6)}/2000"]), rng.choice([None, "LAW"]), day(rng.randrange(60)), "y") for i in range(200)]
    refs += refs[:50]
    died = {k.strip(): w for k, w in gone}
    parents = []
    for i, n, k, b, _ in docs:
        key, born = i.lower(), dt.datetime.fromisoformat(b[:-1])
        parents += [(("id", key), born, died.get(key)), (("n", n.replace(" ", ""), None), born, died.get(key))]
        if k:
            parents.append((("n", n.replace(" ", ""), "law"), born, died.get(key)))
    cases = []
    for r, i, n, k, when, _ in refs:
        if (i or "").strip():
            cases.append((r, when, ("id", i.strip())))
        elif n:
            cases.append((r, when, ("n", n, "law" if k else None)))
    got = references.orphan_references(*orphan_tables(spark, refs, docs, gone)).collect()
    assert len(got) == len({r.ref_id for r in got})
    assert {r.ref_id: r.reason for r in got} == naive_orphans(cases, parents)


def test_orphans_of_empty_tables(spark):
    assert references.orphan_references(*orphan_tables(spark, [], [], [])).count() == 0
    got = references.orphan_references(*orphan_tables(spark, [(1, "d1", None, None, T0, "")], [], [])).collect()
    assert [(r.ref_id, r.period, r.reason) for r in got] == [(1, "2020-01", "missing")]


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(0, 5000).select(F.col("id").cast("string").alias("k"))
    bloom = BloomFilter(keys, key_hash("k"), 5000)
    probe = spark.range(0, 20000).select(F.col("id"), bloom.might_contain(key_hash(F.col("id").cast("string"))).alias("m"))
    hit = {r.id for r in probe.where("m").collect()}
    assert hit >= set(range(5000)) and len(hit) < 5600


def test_upsert_keeps_values_and_creation(spark):
    schema = "id string, title string, created_at string, seq int"
    old = spark.createDataFrame([("a", "old", "1", 0), ("b", None, "1", 0)], schema)
    new = spark.createDataFrame([("a", "x", "2", 1), ("a", None, "3", 2), ("c", "new", "2", 1), (None, "lost", "2", 1)], schema)
    got = {r.id: (r.title, r.created_at) for r in graph.upsert(old, new, "id", "seq").collect()}
    assert got == {"a": ("x", "1"), "b": (None, "1"), "c": ("new", "2")}


def test_cross_references(spark):
    df = spark.createDataFrame([("a", "This amends Royal Decree 50/2026; repeals law ٣ / ١٩٨٤"), ("b", None), ("c", "")], "id string, t string")
    got = {(r.id, r.relation, r.number, r.document_type) for r in graph.cross_references(df, "id", "t").collect()}
    assert got == {("a", "AMENDS", "50/2026", "Royal Decree"), ("a", "AMENDS", "50/2026", None), ("a", "REPEALS", "3/1984", "Law"), ("a", "REPEALS", "3/1984", None)}


def test_groups_of_a_long_chain(spark):
    df = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("z", "y")], "a string, b string")
    got = {r.name: r.root for r in topics.groups_of(df).collect()}
    assert len(got) == 63 and got["n060"] == "n000" and got["z"] == "y"


def test_groups_read_the_pairs_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("b", "a"), ("c", "b"), ("y", "z"), ("y", "z")], "a string, b string").mapInArrow(counted, "a string, b string")
    assert {r.name: r.root for r in topics.groups_of(df).collect()} == {"a": "a", "b": "a", "c": "a", "y": "y", "z": "y"}
    assert read.value == 4


def test_topic_json(spark):
    raws = ['{"topics":[{"name":"Tax Law","confidence":2}]}', 'x ```json\n[{"normalized_name":"ship","confidence":"bad"}]\n```', "nothing", None]
    df = spark.createDataFrame([(r,) for r in raws], "r string").coalesce(1)
    got = [r[0] and [(t.name, t.normalized_name, t.confidence) for t in r[0]] for r in df.select(topics.parse_topic_json(F.col("r"))).collect()]
    assert got == [[("Tax Law", "tax law", 1.0)], [("ship", "ship", 0.5)], None, None]


def test_communities_separate_two_cliques(spark):
    edges = [(f"{c}{i}", f"{c}{j}") for c in "ab" for i in range(5) for j in range(i)] + [("a0", "b0")]
    df = spark.createDataFrame(edges, "x string, y string")
    found = topics.communities(df)
    q = topics.modularity(df, found).first()
    assert q.modularity > 0.3 and q.n_communities <= 4


def test_min_max_and_terms(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 3.0), ("q", 0.0), ("r", 2.0)], "g string, s double")
    got = sorted((r.g, r.m) for r in df.select("g", retrieval.min_max(F.col("s"), "g").alias("m")).collect())
    assert got == [("p", 0.0), ("p", 1.0), ("q", 0.0), ("r", 1.0)]
    assert retrieval.query_terms("What about the Bank, the bank?") == ["bank", "bank"]


def test_chunks_respect_the_limit_and_keep_all_words():
    text = "# A\n\n" + "one two three. " * 30 + "\n\n## B\n\nshort\n\n" + "\n\n".join("four five six " * 8 for _ in range(5))
    chunks = chunking.chunks_of(text, chunking.Limits(10, 60, 5))
    assert all(chunking.count(t) <= 60 + 8 for t, _ in chunks)
    assert {"one", "three", "short", "six"} <= {w for t, _ in chunks for w in chunking.TOKEN.findall(t)}
    assert chunks[-1][1] == ["A", "B"] and chunking.chunks_of("  \n", chunking.Limits()) == [] == chunking.chunks_of(None, chunking.Limits())
    with pytest.raises(ValueError):
        chunking.Limits(10, 5, 1).checked()


def test_windows_native_and_plain_agree(spark):
    for n in (0, 1, 9, 10, 11, 25):
        words = [str(i) for i in range(n)]
        got = spark.createDataFrame([(words,)], "t array<string>").select(chunking.token_windows(F.col("t"), 10, 3)).first()[0]
        assert got == [words[i : i + 10] for i in chunking.window_starts(n, 10, 3)]


def test_markdown():
    page = "<html><title>T</title><body><nav><a href='/x'>Menu</a></nav><article><h1>Law</h1><p>Article 1</p><P>Text <a href='/y'>link</a><table><tr><th>A|B<th>C<tr><td colspan=2>d</table></article><footer>f</footer></body>"
    title, text = html.markdown_of(html.parse(page), "https://law.example/p/")
    assert title == "Law" and "### Article 1" in text and "[link](https://law.example/y)" in text
    assert "| A\\|B | C |\n| --- | --- |\n| d |  |" in text and "Menu" not in text
    assert html.markdown_of(html.parse(""), "") == (None, "")


def test_deep_html_keeps_its_structure():
    deep = "<div>" * 3000 + "<h1>Top</h1>" + "<b>" * 3000 + "bold" + "</b>" * 3000 + "<table><tr><td>a</table>"
    title, text = html.markdown_of(html.parse(deep), "")
    assert title == "Top" and "# Top" in text and "bold" in text and "| a |" in text


def test_only_whole_labels_become_headings():
    blocks = lambda t: html.blocks_of(html.parse(f"<p>{t}</p>"), "")
    for label in ("Article 5", "Section 5", "CHAPTER two", "المادة الأولى", "الباب الثاني"):
        assert blocks(label) == ["### " + label]
    for text in ("Section 5 shall not apply to licensed banks.", "Article", "See Article 5", "المادة الأولى من القانون"):
        assert blocks(text) == [text]


def folded(sizes, room, overlap):
    """``chunking.fill`` item by item."""
    out, start, held, carried = [], 0, 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > room:
            out.append((start, i, carried))
            lent = min(overlap, held)
            carried = lent if lent + n <= room else 0
            start, held = i, carried
        held += n
    return [*out, (start, len(sizes), carried)] if sizes else []


@given(st.lists(st.integers(1, 30), max_size=40), st.integers(30, 60), st.integers(0, 25))
def test_fill_against_a_fold(sizes, room, overlap):
    assert chunking.fill(sizes, room, overlap) == folded(sizes, room, overlap)


@given(st.lists(st.sampled_from(["# A", "## B", "### C", "", "one two three.", "word " * 40, "| t |", "ن ص"]), max_size=25))
def test_chunks_quote_every_token_in_order(lines):
    text, limits = "\n".join(lines), chunking.Limits(5, 30, 0)
    quoted = []
    for chunk, context in chunking.chunks_of(text, limits):
        head = chunking.head_line(tuple(context))
        assert chunking.count(chunk) <= max(limits.most, chunking.LEAST_ROOM + chunking.count(head))
        quoted += [w for line in chunk.split("\n") if not line.startswith("Context: ") for w in chunking.TOKEN.findall(line)]
    assert quoted == chunking.TOKEN.findall(text)


def test_similar_pairs_against_all_pairs(spark, monkeypatch):
    """Few pivots, small cells and a hot vector lose no pair."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 400)] + 0.35 * rng.normal(size=(400, 16))
    x[:60] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(f"t{i:03d}", [float(v) for v in x[i]]) for i in range(400)] + [("bad", None), ("zero", [0.0] * 16), (None, [1.0] * 16), ("t000", [float(v) for v in x[0]])]
    df = spark.createDataFrame(rows, "normalized_name string, embedding array<double>")
    s = x[60:] @ x[60:].T
    want = {(f"t{i + 60:03d}", f"t{j + 60:03d}") for i, j in zip(*np.nonzero(s >= 0.8)) if i < j} | {("t000", f"t{j + 60:03d}") for j in np.flatnonzero(x[60:] @ x[0] >= 0.8)} | {("t000", f"t{i:03d}") for i in range(1, 60)}
    for pivots, cell in ((2048, 20_000), (3, 40)):
        monkeypatch.setattr(similarity, "MAX_PIVOTS", pivots)
        monkeypatch.setattr(similarity, "CELL_ROWS", cell)
        got = [(r.a, r.b) for r in topics.topic_pairs(df, 0.8, 16).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert topics.topic_pairs(df.limit(0), 0.8, 16).count() == 0


def test_vectors_in_all_directions_go_to_few_blocks(spark, monkeypatch):
    """Where pivots rule nothing out, a vector is sent once to a block, not once to a cell; all pairs of a dense cone come out."""
    from pyspark.sql.pandas.group_ops import PandasGroupedOpsMixin

    rng, sent, real = np.random.default_rng(5), [], PandasGroupedOpsMixin.applyInArrow
    monkeypatch.setattr(PandasGroupedOpsMixin, "applyInArrow", lambda self, *a: (sent.append(self._df.count()), real(self, *a))[1])
    monkeypatch.setattr(similarity, "CELL_ROWS", 500)
    x = rng.normal(size=(3000, 64))
    x[:300] = x[0] + 0.1 * rng.normal(size=(300, 64))
    x[300:1200] = x[1200:2100] + 0.6 * rng.normal(size=(900, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(f"t{i:04d}", [float(v) for v in x[i]]) for i in range(3000)], "k string, v array<double>")
    got = {(r.a, r.b): r.similarity for r in similarity.threshold_pairs(df, "k", "v", 0.85, 64).collect()}
    i, j = np.nonzero(np.triu(x @ x.T >= 0.85, 1))
    assert len(i) > 300 * 299 // 2 and got.keys() == {(f"t{a:04d}", f"t{b:04d}") for a, b in zip(i, j)}
    assert max(abs(got[f"t{a:04d}", f"t{b:04d}"] - x[a] @ x[b]) for a, b in zip(i, j)) < 1e-12
    assert sent[0] <= 13 * 3000


def test_json_source_and_quarantine(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": "a", "title": "T", "source_url": "https://x.example/", "language": "en", "markdown": "# m"}))
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text(json.dumps({"id": "c", "title": " ", "source_url": "x", "language": "xx"}))
    good, bad = sources.validate(sources.with_markdown(sources.read_json_documents(spark, str(tmp_path))), sources.document_errors())
    assert [(r.id, r.contentEn) for r in good.collect()] == [("a", "# m")]
    assert sorted(len(r.errors) for r in bad.collect()) == [3, 3]


def test_first_batch_is_an_upsert_too(spark, tmp_path):
    rows = [("a", "x", "1", "1"), ("a", None, "2", "2"), (None, "n", "1", "1"), ("b", "z", "1", "1"), ("b", "z", "1", "1")]
    batch = spark.createDataFrame(rows, "id string, title string, created_at string, updated_at string")
    for number in (0, 0):  # a batch that is run again
        merge_batch(spark, str(tmp_path / "t"), batch, number)
    assert sorted((r.id, r.title, r.updated_at) for r in latest_version(spark, str(tmp_path / "t")).collect()) == [("a", "x", "2"), ("b", "z", "1")]
    merge_batch(spark, str(tmp_path / "t"), batch.where("id = 'b'").limit(1).withColumn("title", F.lit("new")), 1)
    assert sorted((r.id, r.title) for r in latest_version(spark, str(tmp_path / "t")).collect()) == [("a", "x"), ("b", "new")]
    assert len(list((tmp_path / "t" / "version=1").glob("bucket=*"))) == 1


def test_streaming_upsert(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    schema = "id string, title string, created_at string, updated_at string"
    for n, row in enumerate([{"id": "a", "title": "x", "created_at": "1", "updated_at": "1"}, {"id": "a", "title": "y", "created_at": "2", "updated_at": "2"}]):
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps(row))
        ingest_stream(spark, source, schema, target, check).awaitTermination(60)
    assert [(r.id, r.title, r.created_at) for r in latest_version(spark, target).select("id", "title", "created_at").collect()] == [("a", "y", "1")]
