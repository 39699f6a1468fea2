"""Embedding near-dedup, sharding, licenses, HTML, mixing and the pipeline against plain versions."""

import html
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import differences, oracle_connection
from conftest import TINY
from llm.cases import AWKWARD, SCHEMA, WORD, awkward, components, document, jaccard_components, nothing
from vigil.llm import cells, langid, licenses, mainhtml, mixing, nearvec, sharding
from vigil.llm.queries import CATALOGUE, SQL


def plain_links(rows, cosine=0.95):
    """{id: (links, component)} of (id, vector) rows with distinct ids."""
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=float) / np.linalg.norm(v)
    pairs = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= cosine]
    count = Counter(x for p in pairs for x in p)
    found = components([i for i, _ in rows], pairs)
    return {i: (count[i], found[i]) for i, _ in rows}


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((300, 16))
    rows = [centres[0 if k < 150 else k % 300] + rng.standard_normal(16) * rng.choice([0, 0.05, 0.25]) for k in range(900)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    rows += [(901, None), (902, []), (903, [0.0] * 16), (904, [float("nan")] * 16), (905, [float("inf"), 1.0]), (906, [1.0, None])]
    rows += [(907, [1.0, 2.0]), (908, [2.0, 4.0]), (909, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("node", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in nearvec.dedup(table.repartition(4)).collect()}
    expected = plain_links(rows)
    wrong = [i for i in expected if got[i] != expected[i]]
    assert len(wrong) <= 0.02 * len(rows) and not set(wrong) & set(range(901, 910))
    assert nearvec.dedup(table.filter("vec_id < 0")).count() == 0


def crowd(n, pairs, seed=6, dim=64):
    """Vectors of which a third crowd together at a cosine of 0.9, and planted pairs at 0.951 in the crowd: (rows, pairs)."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(dim))
    around = unit(rng.standard_normal((n, dim)))
    around = unit(around - (around @ centre)[:, None] * centre)
    thick = np.sqrt(0.9) * centre + np.sqrt(0.1) * around
    way = rng.standard_normal((pairs, dim))
    for to in (centre, around[:pairs]):
        way -= (way * to).sum(-1, keepdims=True) * to
    turned = 0.51 * around[:pairs] + np.sqrt(1 - 0.51**2) * unit(way)
    x = np.concatenate([thick, np.sqrt(0.9) * centre + np.sqrt(0.1) * turned, unit(rng.standard_normal((2 * n, dim)))])
    return list(enumerate(x.tolist())), [(i, n + i) for i in range(pairs)]


def test_pairs_in_a_crowd_meet(spark):
    rows, pairs = crowd(20_000, 400)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    of = {r.vec_id: r.component_id for r in nearvec.dedup(table).collect()}
    assert sum(of[a] == of[b] for a, b in pairs) >= 0.98 * len(pairs)


def test_vectors_of_the_small_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{TINY}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in CATALOGUE["op2_nearvec"](spark, TINY).collect()}
    assert got == plain_links(rows)


def test_every_pair_of_a_group_meets_in_one_cell(spark):
    members = spark.range(500).select((F.col("id") % 3).alias("key"), F.col("id").alias("node"))
    seen = Counter()
    rows = cells.in_cells(members.unionByName(spark.range(1).selectExpr("99L AS key", "1000L AS node")), "test").collect()
    by_cell = {}
    for r in rows:
        by_cell.setdefault((r.key, r.lo, r.hi), []).append((r.slice, r.node))
    for (_, lo, hi), found in by_cell.items():
        for a in (n for s, n in found if s == lo):
            seen.update((a, b) if a < b else (b, a) for s, b in found if s == hi and a != b)
    expected = {(a, b) for a in range(500) for b in range(a + 1, 500) if a % 3 == b % 3}
    assert set(seen) == expected and {seen[p] for p in expected} <= {1, 2}


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards(spark, law):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard(docs, law=law).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, slots, homes = Counter(), {}, {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw)) and r.grown_shard is None
        sizes[r.shard] += r.size if law == "bytes" else 1
        slots.setdefault(r.shard, []).append(r.slot)
        homes.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    assert max(sizes.values()) - min(sizes.values()) <= (0.02 * max(sizes.values()) if law == "bytes" else 1)


def test_shards_of_awkward_documents(spark):
    rows = sharding.shard(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2, 13)} == {(1, 0)}
    assert sharding.shard(nothing(spark)).count() == 0
    copies = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    held = Counter(r.shard for r in sharding.shard(copies).collect())
    assert len(held) == 16 and max(held.values()) <= 2 * min(held.values())  # one group, larger than a shard, is cut


@pytest.mark.parametrize("doc_id", ["NULL", "8"])
@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_equal_rows_with_tied_ids_spread(spark, doc_id, law):
    copies = spark.range(400).repartition(4).selectExpr(f"CAST({doc_id} AS BIGINT) AS doc_id", "'same text' AS text")
    held = Counter(r.shard for r in sharding.shard(copies, law=law).collect())
    assert sum(held.values()) == 400 and len(held) == 16 and max(held.values()) <= 2 * min(held.values())


def plain_licenses(text):
    """Containment per template over the same windows, without bands."""
    words = [w for w in re.split(r"[^\w]|_", text.lower()) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [tuple(words)] if words else []
    found = {}
    for name, template in licenses.TEMPLATES.items():
        t = [w for w in re.split(r"[^\w]|_", template.lower()) if w]
        of = {tuple(t[i:i + 3]) for i in range(len(t) - 2)}
        width = 8
        while width // 2 + 1 < len(t):
            width *= 2
        for start in range(0, max(1, len(grams)), width // 2):
            part = len(of & set(grams[start:start + width - 2])) / len(of)
            if part >= 0.8:
                found[name] = max(found.get(name, 0), part)
    return found


def test_licenses(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    texts |= {10_000 + k: f"{'lorem ipsum ' * (k % 40)} {t.upper()} {'dolor sit ' * 9}" for k, t in enumerate(licenses.TEMPLATES.values())}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    expected = {i: f for i, t in texts.items() if (f := plain_licenses(t))}
    assert set(got) == set(expected)
    for i, f in expected.items():  # the best template of a place is kept, with its containment
        best = max(f.values())
        assert max(got[i].values()) == pytest.approx(best) and all(f[k] == pytest.approx(v) for k, v in got[i].items())


def test_neighbouring_licenses_are_all_found(spark):
    """A whole license beside an edited one of the same width: both stay; a variant of the whole one does not."""
    def edited(name):
        return re.sub(r"\w+$", "other", licenses.TEMPLATES[name])

    pairs = [("BSD", "GPL"), ("BSD", "ISC"), ("ISC", "Zlib"), ("BSD", "Apache-2.0"), ("Unlicense", "MPL-2.0"), ("MIT-licensed", "Apache-2.0-notice"), ("CC-BY-4.0", "Apache-2.0-notice")]
    texts = {k: f"{licenses.TEMPLATES[a]}. {edited(b)}." for k, (a, b) in enumerate(pairs)}
    texts |= {100: licenses.TEMPLATES["GPL-2.0-notice"], 101: licenses.TEMPLATES["GPL-2.0-notice"] + ". " + licenses.TEMPLATES["GPL-3.0-notice"]}
    got = {}
    for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    for k, pair in enumerate(pairs):
        brute = plain_licenses(texts[k])
        assert set(brute) >= set(pair) and set(got[k]) >= set(pair), (pair, got[k], brute)
        assert all(got[k][n] == pytest.approx(brute[n]) for n in got[k])
    assert set(got[100]) == {"GPL-2.0-notice"} and set(got[101]) == {"GPL-2.0-notice", "GPL-3.0-notice"}


def test_licenses_of_awkward_documents(spark):
    noted = [document(1, None), document(2, ""), document(3, "MIT License"), document(4, "Released under the MIT License."), document(4, "x")]
    rows = licenses.scan(spark.createDataFrame(noted, SCHEMA)).collect()
    assert [(r.doc_id, r.license, r.containment) for r in rows] == [(4, "MIT-notice", 1.0)]
    assert licenses.scan(nothing(spark)).count() == 0 and licenses.scan(awkward(spark)).count() == 0


def plain_article(page):
    start = page.index("<article>") + 9
    end = page.find("</article>", start)
    blocks = re.split(r"</?(?:p|h1)>", page[start:end if end >= 0 else len(page)])
    texts = (" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks)
    return " ".join(t for t in texts if t)


def test_main_text_of_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = CATALOGUE["op9_mainhtml"](spark, "/root/testdata/sf0.01").collect()
    assert {r.page_id: (r.text, r.n_chars) for r in rows} == {i: (plain_article(p), len(plain_article(p))) for i, p in pages.items()}


@pytest.mark.parametrize("page,text", [
    ("", ""), (None, ""), ("plain &lt;b&gt; text", "plain <b> text"), ("<p>a<p>b &amp; c", "a b & c"),
    ("<nav><a>menu</a></nav><p>one <b>t</b>wo</p><footer>end</footer>", "one two"),
    ("<body><div class='side sidebar'>x</div><main><h1>T</h1>\n<p>a  b</p><form>f</form></main><div>other</div>", "T a b"),
    ("<article><h1>T</h1><p>x<script>var a='</p>'</script>y</p><section id='comments'><p>no</p></section></article>", "T xy"),
    ("<nav><ul><li>open<article><p>in", "in"), ("<p>cut <b", "cut"), ("<!-- a <p>no</p> --><p>yes</p>", "yes"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><ul><li>a<li>b</ul></article>", "a b"), ("<p>" + "x " * 50_000, ("x " * 50_000).strip()),
])
def test_main_text_of_markup(page, text):
    assert mainhtml.extract(page) == text


def test_branches_repeated_on_a_host_go(spark):
    rows = [(i, f"https://h.example/{i}", f"<body><div class='top'>Same words on every page</div><div class='body'><p>own {i} {'w%d ' % i * 9}</p></div></body>") for i in range(30)]
    rows += [(100, None, None), (101, "odd url", "<p>text</p>"), (101, "odd url", "<p>text</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("low", F.lit("x"))
    found = {r.page_id: r.text for r in mainhtml.main_text(pages).collect()}
    assert all(found[i] == f"own {i} {('w%d ' % i * 9).strip()}" for i in range(30))
    assert found[100] == "" and found[101] == "text"
    assert mainhtml.main_text(pages.filter("page_id < 0")).count() == 0


def test_mixing_equals_its_sql(spark):
    assert differences(CATALOGUE["op10_mixing"](spark, TINY), oracle_connection(TINY), SQL["op10_mixing"]) == ""


def test_mixing_awkward_documents(spark):
    rows = mixing.mix(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    words = Counter()
    for _, text, _, source, *_ in AWKWARD:
        words[source] += len(re.findall(WORD, text or ""))
    assert sorted({r.source_size for r in rows}) == sorted(set(words.values()))
    assert all(r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in rows)
    assert mixing.mix(nothing(spark)).count() == 0
    blank = awkward(spark).filter("doc_id IN (1, 2, 3, 13)")
    assert {(r.size, r.taken, r.target) for r in mixing.mix(blank).collect()} == {(0, 0, 0.0)}


def test_quotas_are_those_of_highest_quotients(spark):
    rng = np.random.default_rng(4)
    sizes = [int(x) for x in rng.integers(0, 5000, 17)] + [200_000]
    table = spark.createDataFrame([(False, f"s{k:02d}", s) for k, s in enumerate(sizes)], "no_source boolean, source_key string, source_size long")
    rows = mixing.quotas(mixing.targets(table), 16, 8).orderBy("nth").collect()
    seats = round(sum(sizes) * 1.5 / 16)
    quotients = sorted(((r.target / (2 * k + 1), -r.nth, -k) for r in rows for k in range(int(r.target / 16) + 3)), reverse=True)[:seats]
    won = Counter(-n for q, n, _ in quotients if q > 0)
    assert [r.quota for r in rows] == [min(won[r.nth], 2 * r.blocks) for r in rows]


def test_pipeline_equals_its_plain_version(spark):
    """The trained network is taken as it is; everything after its decisions is done again in plain Python."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    network = langid.fit(docs.filter(~langid.held_out()))
    told = {r.doc_id: r for r in langid.predict(docs, network).collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if told[r.doc_id].lang_pred != "und" and told[r.doc_id].score >= corpus_pipeline.LEAST_SCORE}
    assert len(texts) >= 0.98 * len(told)
    kept = {i for i, (_, c) in jaccard_components(texts, 5, 80).items() if i == c}
    copies = {r.doc_id: r.copies for r in mixing.mix(docs.filter(F.col("doc_id").isin(sorted(kept)))).collect()}
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, TINY).collect())
    assert got == Counter({i: n for i, n in copies.items() if n})


def test_pipeline_of_awkward_documents(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, TINY)
        assert kept.columns == docs.columns, name
        docs = spark.createDataFrame(kept.collect(), SCHEMA)
    assert {None, 1, 2, 3, 5, 7, 10, 13}.isdisjoint({r.doc_id for r in docs.collect()})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing(spark), TINY).count() == 0


def test_pipeline_keeps_extra_columns_with_its_own_names(spark):
    names = ["_lang", "_score", "_id", "_kept", "_set", "_copies", "_copy", "__id"]
    docs = awkward(spark)
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, TINY)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert all(r[n] == n + ("" if r.doc_id is None else str(r.doc_id)) for r in rows for n in names), name
        docs = spark.createDataFrame(rows, docs.schema)
    assert {r.doc_id for r in docs.collect()} and {None, 1, 2, 3, 5, 7, 10, 13}.isdisjoint({r.doc_id for r in docs.collect()})


def test_near_duplicates_go_by_row_not_by_id(spark):
    texts = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "ABCDEF"}
    rows = [
        (1, "A"), (None, "A"), (None, "C"), (None, "D"), (None, "D"),  # a copy without id beside unique rows without id
        (5, "A"), (5, "B"), (9, "B"), (5, "B"),  # an id with two texts: one goes with A, one is the first of B
        (7, "E"), (7, "F"), (8, "E"),
    ]
    docs = spark.createDataFrame([document(i, texts[c]) for i, c in rows], SCHEMA).repartition(3)
    kept = sorted((r.text[0], r.doc_id) for r in corpus_pipeline.duplicates(spark, docs, TINY).collect())
    assert kept == [("A", 1), ("B", 5), ("C", None), ("D", None), ("E", 7), ("F", 7)]


@pytest.mark.parametrize("page,text", [
    ("<div class='layout has-sidebar'><article><p>a</p></article></div>", "a"), ("<main class='no-sidebar'><p>a</p></main>", "a"),
    ("<div id='content' class='with-header'><p>a</p></div>", "a"), ("<article class='post comments-open'><p>a</p></article>", "a"),
    ("<body><form><nav>n</nav><main><p>a</p><form>f</form></main></form></body>", "a"), ("<form><div class='menu'>m</div><p>a</p></form>", "a"),
    ("<div class='widget'><article class='share'><p>a</p></article></div><div class='sidebar'>s</div>", "a"),
    ("<article><p>a</p></article><div id='comments'><article class='comment'><p>c</p></article></div>", "a"),
])
def test_hints_leave_the_article(page, text):
    assert mainhtml.extract(page) == text


@pytest.mark.parametrize("copies", [10, 1000])
def test_copies_of_a_page_keep_their_text(spark, copies):
    body = "<body><div class='top'>Same words on every page</div>%s</body>"
    post = body % "<div class='wrap'><article id='post-17'><h1>T</h1><div class='text'><p>copied words</p></div></article></div>"
    rows = [(i, f"https://h.example/?utm={i}", post) for i in range(copies)]
    # a host of articles in large groups of copies, without article elements, one page of odd structure, and the template
    rows += [(10_000 + i, f"https://g.example/{i}", body % f"<div class='body'><p>group {i % 9}</p></div>") for i in range(9 * copies)]
    rows += [(9_999, "https://g.example/odd", "<body><table><tr><td>odd</td></tr></table></body>")]
    found = {r.page_id: r.text for r in mainhtml.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == "T copied words" for i in range(copies)) and found[9_999] == "odd"
    assert all(found[10_000 + i] == f"group {i % 9}" for i in range(9 * copies))
