"""The operators for training data against brute force, with the awkward cases."""

import itertools
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qirtas.llm import alignment, boilerplate, components, mixing, neighbours, packing, queries, scans, splitting, subjects

DATA = "/root/testdata/sf0.001"


# Components -----------------------------------------------------------------

def union_find(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["random", "chain", "star"])
def test_components(spark, kind):
    rng = random.Random(1)
    pairs = {
        "random": [(f"v{rng.randrange(60):02d}", f"v{rng.randrange(60):02d}") for _ in range(45)],
        "chain": [(f"c{i:03d}", f"c{i + 1:03d}") for i in rng.sample(range(70), 70)],
        "star": [("hub", f"s{i}") for i in range(80)] + [("alone", "alone")] * 3,
    }[kind]
    df = spark.createDataFrame(pairs + [(None, "x"), ("y", None)], "a string, b string")
    got = {r.vertex: r.root for r in components.connected_components(df, "a", "b").collect()}
    assert got == union_find(pairs)


def test_components_keep_names_alone_and_hot_ones(spark):
    pairs = [("hub", f"x{i:03d}") for i in range(300)] + [("self", "self"), ("self", "self"), ("hub", "hub"), ("p", "q"), (None, "p"), ("lone", None)]
    got = {r.vertex: r.root for r in components.connected_components(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()}
    assert got == {**{f"x{i:03d}": "hub" for i in range(300)}, "hub": "hub", "self": "self", "p": "p", "q": "p"}


def test_topic_groups_normalise_and_ignore_empty(spark):
    rows = [("Tax  Law", "tax law", None), ("b!", "TAX law", 0.1), ("!!", "x", 0.9), (None, "x", 0.9)]
    df = spark.createDataFrame(rows, "keep_normalized_name string, drop_normalized_name string, root double")
    assert {tuple(r) for r in components.topic_groups(df).collect()} == {("tax law", "b"), ("b", "b")}
    assert components.topic_groups(df.limit(0)).count() == 0


# Packing --------------------------------------------------------------------

def test_fullest_against_all_subsets():
    rng = random.Random(2)
    for _ in range(60):
        items = [rng.randint(1, 30) for _ in range(8)]
        capacity = rng.randint(30, 60)
        counts = {k: items.count(k) for k in items}
        best = max(s for n in range(9) for c in itertools.combinations(items, n) if (s := sum(c)) <= capacity)
        used = packing.fullest(counts, capacity)
        assert sum(k * n for k, n in used.items()) == best and all(n <= counts[k] for k, n in used.items())


def test_packing_keeps_everything(spark):
    rng = random.Random(3)
    texts = [(i, "w " * rng.choice([0, 1, 5, 9, 9, 9, 10, 11, 37])) for i in range(300)] + [(None, "a b"), (7, None), (8, " \n")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack_documents(docs, 10).collect()
    assert sum(r.length for r in rows) == sum(len((t or "").split()) for _, t in texts)
    loads = {}
    for r in rows:
        loads[r.container] = loads.get(r.container, 0) + r.length
    assert max(loads.values()) <= 10 and sorted(loads) == list(range(len(loads)))
    assert all(r.length == 10 for r in rows if r.size > 10 and (r.piece + 1) * 10 <= r.size)
    assert all(r.piece == 0 for r in rows if r.size <= 10)
    assert packing.pack_documents(docs.limit(0), 10).count() == 0


# Mixing ---------------------------------------------------------------------

def test_schedule_stays_within_one_block():
    weights = {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}
    order = mixing.schedule(weights, {s: round(w * 400) for s, w in weights.items()})
    assert len(order) == 400
    seen = dict.fromkeys(weights, 0)
    for t, (s, j) in enumerate(order, 1):
        assert j == seen[s]
        seen[s] += 1
        assert all(abs(seen[x] - weights[x] * t) <= 1 + 1e-9 for x in weights)


def test_mixture(spark):
    rng = random.Random(5)
    docs = [(i, "t " * rng.randint(1, 400), rng.choice(["Big", "big ", "small"] if i % 10 == 0 else ["big"])) for i in range(400)] + [(900, "x", None), (901, None, "big"), (902, "z", " ")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("none", 0.0, 2)], "source string, target_share double, max_repeats int")
    mixture = mixing.Mixture(df, targets)
    rows = mixture.rows().collect()
    plan = mixture.plan.set_index("source")
    for s in ("big", "small"):
        used = sum(r.tokens for r in rows if r.source == s)
        assert abs(used - plan.loc[s, "quota_tokens"]) <= max(len(t or "") for _, t, _ in docs)
        assert max(r.repeat for r in rows if r.source == s) < plan.loc[s, "max_repeats"]
    assert len({(r.doc_id, r.repeat) for r in rows}) == len(rows)
    short = {s for s in plan.index if plan.loc[s, "target_tokens"] > plan.loc[s, "supply_tokens"]}
    assert {r.source for r in mixture.report().collect() if r.short} == short and short == {"small"}
    assert {r.source for r in mixing.short_sources(df, targets).collect()} == short
    assert {r.source for r in mixing.Mixture(df, targets, block=7).report().collect() if r.short} == short
    assert mixing.Mixture(df.limit(0), targets).rows().count() == 0


# Splitting ------------------------------------------------------------------

def test_range_maximum():
    rng = np.random.default_rng(6)
    v = rng.integers(0, 4, 70)
    table = splitting.RangeMaximum(v)
    for lo in range(70):
        for hi in range(lo, 70):
            assert table.query(lo, hi) == max(range(lo, hi + 1), key=lambda i: (v[i], i))


def test_pieces(spark):
    text = "# T\n\n" + "\n\n".join(" ".join(f"w{i}x{j}" for j in range(13)) + "." for i in range(12))
    long = "x " * 5000
    rows = [("a", "en", text), ("a", "en", text), ("b", "en", "short"), ("c", "ar", None), ("d", "ar", long), ("e", "ar", "!" * 90)]
    df = spark.createDataFrame(rows, "document_id string, language string, text string")
    got = splitting.split_texts(df, 40, 5).orderBy("document_id", "piece_no").collect()
    assert {r.document_id for r in got} == {"a", "d", "e"}
    for key in "ade":
        mine = [r for r in got if r.document_id == key]
        tokens = splitting._TOKEN.findall(next(t for k, _, t in rows if k == key))
        assert [r.piece_no for r in mine] == list(range(len(mine))) and all(r.n_tokens <= 40 for r in mine)
        assert all(splitting._TOKEN.findall(r.text) == tokens[r.first_token : r.first_token + r.n_tokens] for r in mine)
        assert all(b.first_token == a.first_token + a.n_tokens - 5 for a, b in zip(mine, mine[1:]))
        assert mine[-1].first_token + mine[-1].n_tokens == len(tokens)
    assert all(r.text.endswith(".") for r in got if r.document_id == "a")
    with pytest.raises(ValueError):
        splitting.split_texts(df, 5, 5)


# Neighbours -----------------------------------------------------------------

def brute_pairs(vectors, k):
    keys = sorted(vectors)
    x = np.array([vectors[i] for i in keys], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    return {tuple(sorted((keys[i], keys[j]))) for i in range(len(keys)) for j in np.argsort(-s[i], kind="stable")[: min(k, len(keys) - 1)]}


def test_neighbours_recall(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(60, 64))
    vectors = {f"k{i:04d}": centres[i % 60] + 0.3 * rng.normal(size=64) for i in range(900)}
    rows = [("chunk", k, [float(x) for x in v]) for k, v in vectors.items()]
    rows += rows[:40] + [("chunk", "bad1", None), ("chunk", "bad2", [1.0]), ("chunk", "bad3", [0.0] * 64), ("chunk", "bad4", [float("nan")] * 64), ("chunk", None, [1.0] * 64)]
    df = spark.createDataFrame(rows, "collection string, key string, embedding array<double>")
    got = {(r.key_a, r.key_b) for r in neighbours.MultiIndex(df).pairs(5).collect()}
    want = brute_pairs(vectors, 5)
    assert len(got & want) / len(want) >= 0.95 and len(got & want) / len(got) >= 0.95


def test_neighbours_exact_and_many_blocks(spark, monkeypatch):
    """Small blocks divide both halves and cut full cells; recall is measured against the exact mode."""
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 64))
    vectors = {f"k{i:04d}": centres[0 if i % 3 == 0 else i % 20] + 0.3 * rng.normal(size=64) for i in range(1500)}
    df = spark.createDataFrame([("chunk", k, [float(x) for x in v]) for k, v in vectors.items()], "collection string, key string, embedding array<double>")
    index = neighbours.MultiIndex(df)
    assert index.tasks > 10
    asked = index.source.where(F.pmod("id", F.lit(5)) == 0)
    exact = {(r.id, r.other) for r in index.exact(asked, 5).collect()}
    names = {r.id: r.key for r in index.source.collect()}
    want = brute_pairs(vectors, 5)
    right = [tuple(sorted((names[a], names[b]))) in want for a, b in exact]
    assert len(exact) == 5 * asked.count() and sum(right) / len(right) > 0.99  # fixed point turns near ties
    got = {(r.id, r.other) for r in index.search(5).collect()}
    assert len(exact & got) / len(exact) >= 0.95
    assert index.exact(asked.limit(0)).count() == 0


def test_neighbours_with_many_copies(spark):
    rows = [("topic", f"copy{i:02d}", [1.0] + [0.0] * 63) for i in range(30)] + [("topic", "other", [1.0, 0.5] + [0.0] * 62)] + [("topic", "often", [0.0, 1.0] + [0.0] * 62)] * 20
    df = spark.createDataFrame(rows, "collection string, key string, embedding array<double>")
    near = {}
    for r in neighbours.MultiIndex(df).pairs(2).collect():
        near.setdefault(r.key_a, set()).add(r.key_b)
        near.setdefault(r.key_b, set()).add(r.key_a)
    assert len(near) == 32 and all(len(near[f"copy{i:02d}"]) >= 2 for i in range(30))
    assert neighbours.MultiIndex(df.limit(0)).pairs(2).count() == 0


def test_neighbours_with_repeated_copies(spark):
    vector = [1.0] + [0.0] * 63
    rows = [("topic", key, vector) for key in "ABCD" for _ in range(2)] + [("topic", "other", [1.0, 0.5] + [0.0] * 62)]
    df = spark.createDataFrame(rows, "collection string, key string, embedding array<double>")
    got = {(r.key_a, r.key_b) for r in neighbours.MultiIndex(df).pairs(5).collect()}
    assert got == set(itertools.combinations(["A", "B", "C", "D", "other"], 2))


# Alignment ------------------------------------------------------------------

def test_hungarian_against_all_assignments():
    rng = np.random.default_rng(8)
    for _ in range(60):
        n, m = rng.integers(1, 5, 2)
        w = rng.normal(size=(n, m)).round(3)
        best = 0.0
        for size in range(1, min(n, m) + 1):
            for r in itertools.combinations(range(n), size):
                best = max(best, *(sum(w[i, j] for i, j in zip(r, c)) for c in itertools.permutations(range(m), size)))
        pairs = alignment.hungarian(w)
        assert len({i for i, _ in pairs}) == len(pairs) == len({j for _, j in pairs})
        assert abs(sum(w[i, j] for i, j in pairs) - best) < 1e-9


def test_sentences():
    assert [s for _, s in alignment.sentences("# h\n\n|t|\nA b. C؟ d\n\ne 3.5 f.\n")] == ["A b.", "C؟", "d", "e 3.5 f."]


def bilingual_corpus(n=160):
    """Invented words a0.. and e0.. translate each other; order, omissions and merges vary."""
    rng, rows, truth = random.Random(9), [], set()
    for d in range(n):
        facts = [rng.sample(range(60), 6) for _ in range(6)]
        ar = [" ".join(f"a{w}a" for w in f) for f in facts]
        order = list(range(6))
        if d % 3 == 0:
            order[1], order[2] = order[2], order[1]
        if d % 4 == 0:
            order.remove(4)
        en, at = [], 0
        for k in order:
            words = " ".join(f"e{w}e" for w in facts[k])
            if d % 5 == 0 and k == 1 and order.index(0) == order.index(1) - 1:
                en[-1] += " and " + words
                at = len(en) - 1
            else:
                en.append(words)
                at = len(en) - 1
            truth.add((f"d{d}", k, at))
        rows.append((f"d{d}", "".join(s.translate(str.maketrans("0123456789", "bcdfghjklm")) + ".\n" for s in ar), "".join(s.translate(str.maketrans("0123456789", "bcdfghjklm")) + ".\n" for s in en), "x"))
    return rows, truth


def test_alignment_finds_the_planted_pairs(spark):
    rows, truth = bilingual_corpus()
    df = spark.createDataFrame(rows + rows[:3] + [("n", None, "x", "y"), ("e", " ", "x", "y"), ("h", "# only", "# heading", "z")], "id string, contentAr string, contentEn string, document_id string")
    got = {(r.document_id, r.ar_pos, r.en_pos) for r in alignment.aligned_sentences(df).collect()}
    assert len(got & truth) / len(truth) > 0.95 and len(got & truth) / len(got) > 0.95


def test_groups_of_documents_change_nothing(spark, monkeypatch):
    rows, _ = bilingual_corpus(60)
    rows += [("numbers", "غغغ 1234 5678 9012.\nضضض 4321 8765 2109.\n", "Zzz 1234 5678 9012.\nYyy 4321 8765 2109.\n", "x")]
    df = spark.createDataFrame(rows, "id string, contentAr string, contentEn string, other string")
    found = []
    for size in (1, 1000):
        monkeypatch.setattr(alignment, "GROUP_DOCS", size)
        found.append({(r.document_id, r.ar_pos, r.en_pos, round(r.score, 9)) for r in alignment.aligned_sentences(df).collect()})
    assert found[0] == found[1] and any(r[0] == "numbers" for r in found[0])


class Mapped(Exception):
    """Carries the function that a stand-in for documents was mapped with, and its batch."""


def counted(texts):
    """What a task that counts (ar, en) texts for the lexicon hands on, batch by batch."""
    table = pd.DataFrame(texts, columns=["ar", "en"])

    class Docs:
        def mapInArrow(self, function, schema):
            raise Mapped(function, pa.RecordBatch.from_pandas(table))

        def mapInPandas(self, function, schema):
            raise Mapped(function, table)

    with pytest.raises(Mapped) as mapped:
        alignment.induce_lexicon(Docs())
    function, batch = mapped.value.args
    for out in function(iter([batch])):
        yield out if isinstance(out, pd.DataFrame) else out.to_pandas()


def word(side, k):
    return side + str(k).translate(str.maketrans("0123456789", "bcdfghjklm"))


def test_counting_for_the_lexicon_stays_small():
    """Ten million pairs of words in one section, and as many in 400 documents, through one task."""
    def text(side, ks):
        return " ".join(word(side, k) for k in ks) + "."

    rng = random.Random(4)
    long = [(text("a", range(3200)), text("e", range(3200)))]
    many = [(text("a", rng.sample(range(900), 160)), text("e", rng.sample(range(900), 160))) for _ in range(400)]
    for texts, pairs, sections in ((long, 3200**2, 1), (many, 400 * 160**2, 400)):
        total, units, rows = 0, 0, 0
        tracemalloc.start()
        try:
            for out in counted(texts):
                both = out["a"].notna() & out["e"].notna()
                total, rows = total + int(out["n"][both].sum()), max(rows, len(out))
                units += int(out["n"][out["a"].isna() & out["e"].isna()].sum())
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert (total, units) == (pairs, sections)
        assert peak < 150e6 and rows <= 100_000


@pytest.mark.parametrize("limits", [(4_000_000, 1_000_000, 100_000), (40, 9, 4), (300, 70, 1_000), (1, 1, 1)])
def test_counting_in_parts_changes_no_number(monkeypatch, limits):
    for name, limit in zip(("HELD_WORDS", "MADE_PAIRS", "BATCH_ROWS"), limits):
        monkeypatch.setattr(alignment, name, limit)
    texts = [(ar, en) for _, ar, en, _ in bilingual_corpus(12)[0]]
    texts += [("# x\nab.\n# y\n", "zz. yy"), ("# only", "# h"), ("a", "# q"), ("# a\n b", "# b\n c. d\n# z\n e")]
    want, got = {}, {}
    for ar, en in texts:
        for a, e in alignment._units(ar, en):
            for key in [*itertools.product(a, e), *((x, None) for x in a), *((None, x) for x in e), (None, None)]:
                want[key] = want.get(key, 0) + 1
    for out in counted([(None, None), *texts, (None, None)]):
        assert len(out) <= limits[2]
        for a, e, n in zip(*(out[c].astype(object).where(out[c].notna(), None) for c in "aen")):
            got[a, e] = got.get((a, e), 0) + n
    assert got == want


def test_batches_for_counting_hold_little_text(spark):
    rows = [(f"d{k}", f"{k} " + "ا" * (37 * k), "e" * (11 * k) or "e") for k in range(60)] + [("long", "ب" * 90_000, "f")]
    got = alignment._thinned(spark.createDataFrame(rows, "document_id string, ar string, en string").coalesce(1)).collect()
    assert [tuple(r) for r in got if r.ar is not None] == [r[1:] for r in rows]
    chars = [len(r.ar or "") + len(r.en or "") for r in got]
    assert len(chars) - 1 - chars.index(90_001) == 90_001 // alignment.ROW_CHARS
    short = chars[: chars.index(90_001)]
    assert max(sum(short[k : k + 20]) for k in range(len(short))) <= 20 * alignment.ROW_CHARS + 2 * max(short)


def test_hungarian_of_a_large_group():
    """Greedy pairing would take the great weights and leave half of the rows unpaired."""
    n = 340
    w = np.full((n, n), -1.0)
    for i in range(n):
        w[i, i] = 1.0
        if i % 2 == 0:
            w[i, i + 1] = 1.5
    w[1::2] = np.where(w[1::2] > 0, 0.9, -1.0)
    pairs = set()
    for i, j in alignment.hungarian(w):
        pairs.add((i, j))
    assert pairs == {(i, i) for i in range(n)}
    assert alignment.assign(w, [], w, w) == pairs


def test_spans_inside_the_assignment():
    half = np.full((3, 2), 0.1)
    half[0, 0] = half[1, 0] = half[2, 1] = 0.9
    value = np.where(half > 0.5, half - 0.45, -1.0)
    # Both neighbours are worth a pair with the shared sentence; without the span one is left out.
    assert len(alignment.assign(value, [], half, half)) == 2
    assert alignment.assign(value, [(0, 0, 0)], half, half) == {(0, 0), (1, 0), (2, 1)}
    assert {(j, i) for i, j in alignment.assign(value.T, [(1, 0, 0)], half.T, half.T)} == {(0, 0), (1, 0), (2, 1)}
    # A rival that is worth more breaks the span, and its other half goes back to its own worth.
    rival = value.copy()
    rival[1, 1] = 2.0
    assert (1, 1) in alignment.assign(rival, [(0, 0, 0)], half, half) and (0, 0) in alignment.assign(rival, [(0, 0, 0)], half, half)
    # Three sentences that one puts together are two spans.
    three = np.full((3, 1), 0.9)
    assert alignment.assign(three - 0.45, [(0, 0, 0), (0, 1, 0)], three, three) == {(0, 0), (1, 0), (2, 0)}


# Boilerplate ----------------------------------------------------------------

def page(i, lang="main"):
    menu = "".join(f"<li><a href='/{k}'>Entry {k}</a>" for k in range(5))
    body = f"<h1>Order {i}/2001: subject {i}</h1><p>Paragraph number {i} speaks at length of matter {i} and of its duties.<p>Second text of page {i} with enough words in it.<div class='cookie'><p>We use files.</p><button>OK</button></div>"
    return f"<html><head><title>Order {i}</title><script>var x='<p>no</p>'</script></head><body><!-- <p>c</p> --><div class='nav'><ul>{menu}</ul></div><DIV class={lang}>{body}</DIV><div class='side'><p>We use files.</p><button>OK</button></div></body></html>"


def test_main_runs(spark):
    rows = [(i, f"https://s{i % 2}.example/{i}", page(i), "k") for i in range(12)] + [(0, "https://s0.example/0", page(0), "k"), (50, "https://s0.example/l", None, "k"), (51, None, "", "k"), (52, "https://s0.example/l", "plain", "k"), (53, "https://s1.example/l", "<div class='side'><p>We use files.</p><a>x</a></div>" * 3 + "<p>" * 500, "k")]
    df = spark.createDataFrame(rows, "page_id long, source_url string, content_html string, host string")
    got = {}
    for r in boilerplate.main_runs(df).collect():
        got.setdefault(r.page_id, []).append(r.run_no)
    assert sorted(got) == list(range(12)) and all(sorted(runs) == [6, 7, 8] for runs in got.values())
    texts = {r.page_id: r.text for r in boilerplate.main_texts(df).collect()}
    assert texts == {i: f"Order {i}/2001: subject {i}\nParagraph number {i} speaks at length of matter {i} and of its duties.\nSecond text of page {i} with enough words in it." for i in range(12)}


def test_lists_of_other_instruments_lose_by_vote(spark):
    """Entries that other pages have in their side columns are none of the text; a paragraph that cites alike is."""
    entry = lambda i, n: f"Order {n}/2001: subject {i}"
    def html(i):
        side = f"<div class='side'><ul><li>{entry(i, 900 + i)}</li><li>{entry(i + 1, 700 + i)}</li></ul></div>"
        extra = f"<p>{entry(i, 800 + i)}</p>" if i % 3 == 0 else ""
        return f"<body><div class='main'><h1>{entry(i, i)}</h1><p>The officer of matter {i} shall keep the register in full for the whole year.</p>{extra}<p>Pursuant to Order 5/2001: the officer of matter {i} shall pay.</p></div>{side}</body>"
    df = spark.createDataFrame([(i, f"https://s.example/{i}", html(i)) for i in range(12)], "page_id long, source_url string, content_html string")
    for r in boilerplate.main_texts(df).collect():
        i = r.page_id
        assert r.text.split("\n") == [entry(i, i), f"The officer of matter {i} shall keep the register in full for the whole year.", f"Pursuant to Order 5/2001: the officer of matter {i} shall pay."]


# Scans ----------------------------------------------------------------------

def test_scans(spark):
    clean = "# عنوان\n\n" + "\n".join(["يلتزم المستورد بتقديم بيان البضاعة خلال عشرة أيام."] * 10)
    scan = "القرار رقم ٧ / ١٩٩٠ بشأن البضاعة\n\nيلتزم المستورد بتفديم بيان البضا-\nعة خلال عشرة أيام. يلتزم ال§مستورد\n\nصفحة {p}\nالقرار رقم ٧ /\nبتقديم بيان البضاعة خلال عشرة أيام.\nثالثا-\n(١)\nصفحة {q}"
    rows = [(f"c{i}", clean, 1) for i in range(6)] + [(f"s{i}", scan.format(p=i + 3, q=i + 4), 1) for i in range(4)] + [("s0", scan.format(p=3, q=4), 1), ("n", None, 1), ("b", "  ", 1), (None, scan, 1)]
    found = scans.Scans(spark.createDataFrame(rows, "id string, contentAr string, line_no int"))
    got = {(r.document_id, r.line_no, r.defect) for r in found.defects().collect()}
    want = {(2, "misread"), (2, "broken_word"), (3, "misread"), (5, "page_number"), (6, "running_header"), (10, "page_number")}
    assert got == {(f"s{i}", n, d) for i in range(4) for n, d in want}
    text = " ".join(r.text for r in found.paragraphs().where("document_id = 's1'").orderBy("paragraph").collect())
    assert "بتقديم بيان البضاعة خلال عشرة أيام." in text and "صفحة" not in text


# Subjects -------------------------------------------------------------------

def test_citations_are_left_out():
    cut = subjects.without_citations
    assert cut("Pursuant to Order 12/1962 (the organ list); ").strip(" ;") == ""
    assert cut("The bank may copy the ratio, without prejudice to Order 69/1966 on the wage sheet.") == "The bank may copy the ratio"
    assert cut("This text follows Order 4/1972, entitled the wage sheet.") == ""
    assert cut("Mindful of the list as named in Order 15/1966, The bank may pay") == "The bank may pay"


def test_subjects(spark):
    rng = random.Random(11)
    terms = {s: [f"{s}term{c}" for c in "abcd"] for s in ("tax", "sea", "law")}
    docs, labels = [], []
    for i in range(240):
        own = rng.sample(sorted(terms), rng.choice([1, 1, 2]))
        text = " ".join(f"The {rng.choice(terms[s])} shall meet the {rng.choice(terms[s])} on time." for s in own for _ in range(4))
        other = rng.choice(sorted(terms))
        docs.append((i, f"Having regard to Order 3/1984 on the {terms[other][0]},\n{text}", own, "x"))
        if i % 2:
            labels += [(i, s, "a") for s in own] * (1 + i % 3 // 2)
    docs += [(900, None, [], "x"), (901, " \n", [], "x"), (None, "text", [], "x"), (902, "nothing known here. " * 2000, [], "x")]
    df = spark.createDataFrame([d[:2] + d[3:] for d in docs], "doc_id long, text string, subject string")
    lab = spark.createDataFrame(labels + [(None, "tax", "a"), (1, None, "a")], "doc_id long, subject string, annotator string")
    got = {(r.doc_id, r.subject) for r in subjects.classify(df, lab).collect()}
    want = {(i, s) for i, _, own, _ in docs for s in own}
    assert len(got & want) / len(want) > 0.97 and len(got & want) / len(got) > 0.97
    assert subjects.classify(df, lab.limit(0)).count() == 0


def test_subjects_learn_from_all_documents(spark):
    ids = [r.id for r in spark.range(12_400).orderBy(F.xxhash64("id"), "id").collect()]
    text = {i: "Nothing known here." for i in ids}
    labels = [(i, ("tax", "sea", "law", "air")[n % 4], "a") for n, i in enumerate(ids[:240])]
    for i, s, _ in labels:
        text[i] = f"The {s}term shall be met on time."
    # Only the documents of the greatest hashes tell what kelp is.
    for i in ids[-50:-10]:
        text[i] = "The kelp and the seaterm shall be met on time."
    for i in ids[-10:]:
        text[i] = "The kelp shall be met on time."
    df = spark.createDataFrame(sorted(text.items()), "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string, annotator string")
    got = {(r.doc_id, r.subject) for r in subjects.classify(df, lab).collect()}
    assert {(i, "sea") for i in ids[-10:]} <= got and not any(s != "sea" for i, s in got if i in ids[-50:])


def test_frequent_sets_against_all_subsets(spark):
    rng = random.Random(9)
    baskets = [(rng.sample("abcdefg", rng.randint(1, 5)), rng.randint(1, 4)) for _ in range(60)]
    want: dict = {}
    for w, n in baskets:
        for size in range(1, len(w) + 1):
            for a in itertools.combinations(sorted(w), size):
                want[a] = want.get(a, 0) + n
    df = spark.createDataFrame(baskets, "w array<string>, n long")
    got = [(tuple(sorted(r["items"])), r["freq"]) for r in subjects.frequent_sets(df, 5).collect()]
    assert len(got) == len(dict(got)) and dict(got) == {a: n for a, n in want.items() if n >= 5}
    assert subjects.frequent_sets(df, 10_000) is None and subjects.frequent_sets(df.limit(0), 1) is None


def test_formulas_are_no_rules(spark):
    """Closing formulas of two languages, each often in documents of one skewed subject, predict none."""
    rng = random.Random(4)
    terms = {s: [[f"{s}{lang}{c}" for c in "abcdef"] for lang in ("en", "fr")] for s in ("tax", "sea", "law", "air")}
    formulas = ["Whatever conflicts with these provisions is hereby set aside.", "Le présent acte entre en vigueur le lendemain."]
    docs, labels = [], []
    for i in range(600):
        lang = i % 2
        s = rng.choices(sorted(terms), [6, 2, 1, 1])[0]
        said = [f"The {a} shall meet the {b} on time." for a, b in (rng.sample(terms[s][lang], 2) for _ in range(4))]
        docs.append((i, " ".join([*said, *([formulas[lang]] if rng.random() < 0.7 else [])]), s))
        if i % 4 < 2 and i < 400:
            labels.append((i, s if rng.random() < 0.93 else "air", "a"))
    formula_only = [(1000 + i, formulas[i % 2], None) for i in range(20)]
    df = spark.createDataFrame([d[:2] for d in docs + formula_only], "doc_id long, text string")
    got = {(r.doc_id, r.subject) for r in subjects.classify(df, spark.createDataFrame(labels, "doc_id long, subject string, annotator string")).collect()}
    want = {(i, s) for i, _, s in docs}
    assert not [g for g in got if g[0] >= 1000]
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.95


# All queries ----------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = {
        "p1_found": [("document_id", "string"), ("ar_pos", "int"), ("en_pos", "int")], "p2_found": [("document_id", "string"), ("line_no", "int"), ("defect", "string")],
        "p3_found": [("document_id", "string"), ("language", "string")], "p4_found": [("page_id", "bigint"), ("run_no", "int")],
        "p5_found": [("normalized_name", "string"), ("group_name", "string")], "p6_found": [("collection", "string"), ("key_a", "string"), ("key_b", "string")],
        "p8_found": [("doc_id", "bigint")], "p9_found": [("source", "string")], "p10_found": [("doc_id", "bigint"), ("subject", "string")],
    }.get(name)
    rows = df.collect()
    if columns:
        assert df.dtypes == columns and len(set(rows)) == len(rows)
