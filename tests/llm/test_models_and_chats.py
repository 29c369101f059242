"""Learnt operators, chat formatting and the pipeline."""

import html
import json
import os
import re
import sys
import time
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from check_oracle import duck, rows_norm  # noqa: E402

import corpus_pipeline  # noqa: E402
from strata.llm import boosting, common, dom, html_extract, quality, registry, toolcalls  # noqa: E402

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ------------------------------------------------------------- op2

def test_quality_held_out(spark):
    got = registry.queries()["op2_quality"](spark, SF01).collect()
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF01}/labels.parquet'").fetchall())
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= quality.THRESHOLD) for r in got)
    y, s = map(np.array, zip(*[(labels[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in labels]))
    rank = np.argsort(np.argsort(s)) + 1
    good = y.sum()
    auc = (rank[y == 1].sum() - good * (good + 1) / 2) / (good * (len(y) - good))
    assert auc > 0.97 and ((s >= 0.3) == (y == 1)).mean() > 0.93


def test_quality_ignores_labels_of_held_out_rows(spark):
    docs = common.table(spark, SF, "documents")
    labels = common.table(spark, SF, "labels")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.predict(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_quality_odd_rows(spark):
    data = [(1, None, "a", 0.5), (2, "", "b", 0.5), (None, "x y", "c", 0.5), (2, "word " * 3000, None, 0.5)]
    d = spark.createDataFrame(data, "doc_id long, text string, label string, _score double")
    for labels, share in (([], 0.5), ([(1, 1)], 1.0), ([(1, 1), (2, 0), (2, 0), (2, None)], None)):
        known = spark.createDataFrame(labels, "doc_id long, quality int")
        got = quality.predict(d, known).collect()
        assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
        if share is not None:
            assert {r.score for r in got} == {share}
        assert quality.predict(d.limit(0), known).collect() == []
    kept = quality.keep_good(d, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert kept.columns == d.columns and kept.count() == 4


def test_network_learns_and_calibrates():
    r = np.random.default_rng(0)
    x = r.normal(size=(4500, 5))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (r.random(4500) < 0.05)).astype(float)
    net = quality.calibrate(quality.fit_network(x[:3000], y[:3000]), x[3000:3750], y[3000:3750])
    p = net.probability(x[3750:])
    assert ((p > 0.5) == (y[3750:] > 0)).mean() > 0.85
    raw = quality.fit_network(x[:3000], y[:3000]).probability(x[3750:])
    loss = lambda q: -np.mean(y[3750:] * np.log(q) + (1 - y[3750:]) * np.log(1 - q))
    assert loss(np.clip(p, 1e-9, 1 - 1e-9)) <= loss(np.clip(raw, 1e-9, 1 - 1e-9)) + 0.02


# ------------------------------------------------------------- op7

def _article(page):
    """The given pages' article, read by their own simple template."""
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_html_table(spark):
    got = {r.page_id: r for r in registry.queries()["op7_html_extract"](spark, SF01).collect()}
    pages = duckdb.sql(f"select page_id, url, html from '{SF01}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    assert all(got[i].text == _article(h) and got[i].n_chars == len(got[i].text) and got[i].url == u for i, u, h in pages)


def test_html_other_layout(spark):
    page = ("<html><body><div class='menu'><a href=x>Home</a></div><div class=content><h1>T &lt; t</h1><p>Some  text&nbsp;here, long enough to "
            "be content of the page. It goes on, and on.</p><div class='ad-box'>buy now</div><p>More text; of the same kind, with <b>bold</b> "
            "<a href=y>words</a>. And a second sentence, too.</p><div class=comments><p>first! great article, thanks for it</p></div></div>"
            "<aside>side</aside><form><p>Mail</p><input></form><footer>(c) me</footer><script>var x='<p>no</p>'</script></body></html>")
    trees = html_extract.fit(spark.read.parquet(f"{SF01}/pages.parquet"))
    p = html_extract.Pages([page])
    assert p.texts(p.decode(trees.logit(p.features()))) == [
        "T < t\nSome text here, long enough to be content of the page. It goes on, and on.\n"
        "More text; of the same kind, with bold words. And a second sentence, too."]


def test_html_odd_rows(spark):
    data = ["", None, "plain &amp; text", "<p>a<p>b", "<div>" * 3000 + "deep" + "</div>" * 3000, "<!-- open", "a<b",
            "<article>x < y & z &copy 5", "<article>same</article>", "<article>same</article>"]
    df = spark.createDataFrame([(i, None, h, "t") for i, h in enumerate(data)], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {0: "", 1: "", 2: "plain & text", 3: "a\nb", 4: "deep", 5: "", 6: "a<b", 7: "x < y & z © 5", 8: "same", 9: "same"}
    assert html_extract.extract(df.limit(0)).collect() == []


def test_html_text_straight_in_body(spark):
    long = "The river rose for three days, and the people of the town carried what they could to the hill. "
    nav = "<div class=menu><a href=/>Home</a><a href=/b>News</a></div>"
    data = ["<html><head><title>T</title></head><body>First part of the article.<br>Second part.</body></html>",
            "<body>Text with <b>bold</b> and more.</body>", "<body><script>x</script><b>Lead</b> and text<p>One</p>Two<p>Three</body>",
            f"<html><head><title>T</title></head><body>{nav}{long * 3}<br><br>{long * 2}<p>{long * 2}</p>{long * 4}<footer>(c) me</footer></body></html>",
            "<body><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p></body>"]
    own = " ".join((long * 5).split())
    expected = ["First part of the article. Second part.", "Text with bold and more.", "Lead and text\nOne\nTwo\nThree",
                f"{own}\n{(long * 2).strip()}\n{(long * 4).strip()}", "Let x=1 be."]
    trees = html_extract.fit(spark.read.parquet(f"{SF01}/pages.parquet"))
    for page, text in zip(data, expected):
        p = html_extract.Pages([page])
        assert p.texts(p.decode(trees.logit(p.features()))) == [text]


def test_decoding_never_contradicts_ancestors():
    r = np.random.default_rng(4)
    p = html_extract.Pages(["<div><section><p>a</p><p>b<i>c</i></p></section><ul><li>d<li>e</ul></div>" * 3])
    for _ in range(20):
        kept = p.decode(r.normal(size=len(p.tags)) * 3)
        inner = ~p.frame
        assert (kept[p.parent[inner]] >= kept[inner]).all()


def test_trees_fit_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((2000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    t = boosting.fit(x[:1500], y[:1500])
    assert ((t.logit(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.95


def test_dom_reads_broken_markup():
    p = dom.Page("<p>one<p>two <b>bold<div>three</div><script>if (a<b) '</p>'</script>x</nosuch><br>y")
    assert [t for _, t, _ in p.runs if t.strip()] == ["one", "two ", "bold", "three", "x", "y"]
    assert p.tag[1:5] == ["p", "p", "b", "div"] and p.parent[4] == 0


def test_lists_beside_loose_text(spark):
    html = ("<body><h1>Title</h1>Loose intro text of the piece.<ul><li>First point</li><li>Second <b>point</b></li></ul>"
            "<table><tr><td>One</td><td>Two</td></tr></table><pre>a b</pre><ul><li><a href='/'>Home</a></li><li><a href='/x'>More</a></li></ul></body>")
    pages = common.table(spark, SF, "pages")
    extra = spark.createDataFrame([(10 ** 6, "u", html)], pages.schema)
    (got,) = html_extract.extract(pages.union(extra)).filter("page_id = 1000000").collect()
    assert got.text.split("\n") == ["Title", "Loose intro text of the piece.", "First point", "Second point", "One", "Two", "a b"]


@pytest.mark.parametrize("piece", ["<a ", "<a \"", "<a '", "<a b=\"c' ", "<", "<a<", "<!", "<!-- ", "</", "<x>", "<p><table><x>", "<li><b>", "<b><div>", "&", "<script>", "<a \">\" '"])
def test_broken_pages_are_read_in_proportion(piece):
    for end in ("", ">", "\">", "'>"):
        began = time.monotonic()
        page = dom.Page(piece * (1_000_000 // len(piece)) + end)
        assert time.monotonic() - began < 12, (piece, end)  # seconds, not hours
        assert all(a < b <= len(page.tag) for a, b in enumerate(page.end))


def test_reader_on_odd_tags():
    def texts(html):
        p = dom.Page(html)
        return [(p.tag[e], " ".join(t.split())) for e, t, _ in p.runs if t.strip()]
    assert texts("<p title='a>b'>one</p><p title=\"x'>y\">two</p>") == [("p", "one"), ("p", "two")]
    assert texts("<div>a < b and 1<2, <3</div>") == [("div", "a < b and 1<2, <3")]
    assert texts("<div><!-- <p>no --><p>yes<!-- open") == [("p", "yes")]
    assert texts("<div><script>if (a<b) x=\"</p>\"</script>seen</div>")[-1] == ("div", "seen")


# ------------------------------------------------------------- op2, word by word

def test_word_vectors_and_pooling(spark):
    """Features and context sums against a plain statement of both."""
    texts = ["The cat, the CAT!! sat on 12 mats.", "", "x", "É è été 3rd-party (a) (a) (a)", "one  two\tthree\nfour five?!", None,
             " ".join(f"Word{i % 13}{'.' * (i % 3)}" for i in range(300))]
    texts += [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet' order by doc_id limit 12").fetchall()]
    column = pa.array(texts, pa.string())
    (batch,) = quality._contexts([pa.RecordBatch.from_arrays([column], names=["text"])])
    want = brute.contexts(texts, quality.CONTEXTS)
    got = np.zeros_like(want)
    for b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        got[b] = np.frombuffer(x, np.float32)
    assert np.allclose(got, want, atol=1e-3)
    context = (want / np.maximum(np.sqrt((want ** 2).sum(axis=1, keepdims=True)), 1e-6)).astype(np.float32)
    assert np.allclose(quality.features(column, context), [brute.pooled(t, context) for t in texts], atol=1e-4)


def test_distinct_hashes():
    """Hashes that differ in high bits only are told apart, too."""
    r = np.random.default_rng(3)
    h = np.concatenate([r.integers(0, 40, 3000), r.integers(0, 40, 3000) << 40, r.integers(0, 1 << 62, 2000)]).astype(np.uint64)
    first, code = quality._distinct(h)
    assert len(first) == len(np.unique(h)) and (h[first][code] == h).all()
    first, code = quality._distinct(h[:0])
    assert len(first) == len(code) == 0


def test_pooling_is_bounded_and_exact():
    """Words are pooled without a row of numbers for each of them, and summed
    as numpy sums each row's words: features of parts and of long rows alike."""
    r = np.random.default_rng(5)
    words = np.array([f"W{k}{'!' * (k % 4)}" if k % 3 else f"wo{k:x}" for k in range(60_000)])
    texts = [" ".join(r.choice(words, k)) for k in (33_000, 1, 0, 7, 9, 300, 5000, 0)] + [None, " x ", "a A a", "\x01 \x7f"]
    texts += [" ".join(r.choice(words, 90)) for _ in range(900)]
    column, context = pa.array(texts, pa.string()), r.normal(size=(quality.CONTEXTS, quality.DIM)).astype(np.float32)
    tracemalloc.start()
    got = quality.features(column, context)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20, peak  # 256 rows' words alone had 512 bytes each, the different words twice that
    assert (got == np.vstack([quality.features(column.slice(i, 1), context) for i in range(len(texts))])).all()
    for i in (0, 3, 5, 6, 12):
        assert np.allclose(got[i], brute.pooled(texts[i], context), atol=1e-4)


# ------------------------------------------------------------- op4

@pytest.mark.parametrize("sf", [SF, SF01])
def test_chats_oracle(spark, sf):
    df = registry.queries()["op4_tool_calls"](spark, sf)
    cur = duck(sf).execute(registry.oracle_sql()["op4_tool_calls"])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_norm(df.columns, df.collect()) == rows_norm(names, cur.fetchall())


def test_chats_link_order_and_validate(spark):
    j = json.dumps
    schemas = {"reply": {"prompt": ("string", True)}, "add": {"a": ("number", True), "b": ("integer", False)}, "now": {}}
    calls = [{"id": "c1", "name": "add", "arguments": {"b": 2, "a": 1.5}},
             {"id": "c2", "name": "add", "arguments": '{"a": 1, "b": "x"}', "depends_on": ["c1"]},
             {"id": "c3", "name": "now", "arguments": {}, "depends_on": ["c2", "c1", "zz"]}, {"name": "now", "arguments": {}},
             {"id": "c5", "name": "what", "arguments": {}}, {"id": "c1", "name": "now", "arguments": {"q": 1}}]
    data = [(1, 0, "system", "hi"), (1, 1, "assistant", j({"tool_calls": calls})), (1, 2, "tool", j({"tool_call_id": "c1", "content": "3.5"})),
            (1, 3, "tool", j({"content": "x", "tool_call_id": "c1"})), (1, 4, "tool", j({"tool_call_id": "nope", "content": "?"})),
            (1, 5, "tool", "{bad"),
            (2, 0, "assistant", j({"tool_calls": [{"id": "a", "name": "now", "arguments": {}, "depends_on": ["b"]},
                                                  {"id": "b", "name": "now", "arguments": {}, "depends_on": ["a"]},
                                                  {"id": "d", "name": "add", "arguments": [1]}]})),
            (3, 0, "user", None), (3, 1, "assistant", 'ok "q" \n é/'), (3, 2, "assistant", "more"), (3, 3, "user", "a"), (3, 3, "user", "a"),
            (3, 3, "user", "b"), (3, 4, "assistant", "r"), (None, 0, "user", "n"), (None, 1, "assistant", "m"), (4, None, "user", "t"),
            (4, 0, None, "z")]
    df = spark.createDataFrame([(*r, 1) for r in data], "conv_id long, turn long, role string, text string, level int")
    out = toolcalls.format_chats(df, schemas)
    got = {}
    for r in out.collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.pos, r.kind, r.call_id, r.linked_turn, r.level, r.valid, r.error, r.json))
    assert [x[1:7] for x in sorted(got[1, 1])] == [
        ("call", "c1", 2, 0, True, None), ("call", "c2", None, 1, False, "b is no integer"), ("call", "c3", None, 2, False, "depends on unknown zz"),
        ("call", None, None, 0, False, "no identifier"), ("call", "c5", None, 0, False, "unknown function"),
        ("call", "c1", 2, 0, False, "identifier repeated; unknown q")]
    assert sorted(got[1, 1])[0][7] == '{"arguments":{"a":1.5,"b":2},"id":"c1","name":"add","type":"function"}'
    assert [got[1, t][0][1:7] for t in (2, 3, 4, 5)] == [
        ("result", "c1", 1, None, True, None), ("result", "c1", 1, None, False, "result repeated"),
        ("result", "nope", None, None, False, "no such call"), ("message", None, None, None, None, None)]
    assert [x[6] for x in sorted(got[2, 0])] == ["dependencies form a cycle", "dependencies form a cycle", "no object"]
    assert got[3, 1][0][7] == '{"content":"ok \\"q\\" \\n é/","role":"tool","tool_call_id":"3:0"}'
    assert sorted(x[5] for x in got[3, 3]) == [False, True, True] and got[3, 4][0][3] == 3 and got[None, 1][0][3] == 0
    assert sum(map(len, got.values())) == len(data) + 5 + 2
    assert toolcalls.format_chats(df.limit(0), schemas).collect() == []


def test_chats_lose_nothing(spark):
    """Content beside calls, white space before JSON, unknown dependencies, a
    very long text."""
    long = "x\u00e9 " * 400_000
    data = [
        (1, 0, "assistant", '\n\t {"content": "Let me look", "tool_calls": [{"id": "a", "name": "f", "arguments": {}}, '
                            '{"id": "b", "name": "f", "arguments": {}, "depends_on": ["a", "zz", "y", "zz"]}]}'),
        (1, 1, "tool", ' \r\n{"tool_call_id": "a", "content": "found"}'), (1, 2, "assistant", '{"content": "", "tool_calls": [{"id": "c", "name": "f"}]}'),
        (1, 3, "user", long), (1, 4, "assistant", long), (1, 5, "system", long), (2, 0, "assistant", '{"content": "no calls", "tool_calls": []}')]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn, r.pos): r for r in toolcalls.format_chats(df, {"f": {}, "reply": {"prompt": ("string", True)}}).collect()}
    assert (got[1, 0, -1].kind, got[1, 0, -1].json) == ("message", '{"content":"Let me look","role":"assistant"}')
    assert (got[1, 0, 0].linked_turn, got[1, 0, 0].valid) == (1, True) and got[1, 1, 0].linked_turn == 0
    assert (got[1, 0, 1].valid, got[1, 0, 1].error, got[1, 0, 1].level) == (False, "depends on unknown y, zz", 1)
    assert (1, 2, -1) not in got and got[1, 2, 0].kind == "call"
    assert json.loads(got[1, 3, 0].json)["arguments"]["prompt"] == long and json.loads(got[1, 5, 0].json)["content"] == long
    assert got[1, 4, 0].linked_turn == 3 and got[2, 0, 0].kind == "message" and len(got) == 9


def test_plain_messages_join_nothing(spark):
    """Rows without an identifier, however many a conversation has, meet in no
    join."""
    plan = toolcalls.format_chats(common.table(spark, SF, "conversations"))._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(call_id" in plan and "isnull(call_id" in plan


def test_chats_plan_has_no_python(spark):
    plan = toolcalls.format_chats(common.table(spark, SF, "conversations"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# ------------------------------------------------------------- pipeline

def test_pipeline(spark):
    docs = common.table(spark, SF, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stage(stage(spark, docs, SF), name)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0.5 * before <= out.count() <= docs.count()
        assert out.select("doc_id").distinct().count() == out.count()
        assert out.filter("n_chars <> length(text)").count() == 0
        docs = out
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_on_odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    docs = common.table(spark, SF, "documents")
    some = docs.limit(60).select("doc_id", "text", F.lit("k").alias("_key"), F.lit(3).alias("hub"), F.lit("t").alias("_text"), "lang")
    words = " ".join(f"word{i % 977} and" for i in range(60_000))
    odd = [(None, None), (None, ""), (900_001, None), (900_002, ""), (900_003, words), (900_004, words), (900_005, "\n \n"), (900_006, "a b\na b"),
           (900_006, "a b\na b"), (900_006, "other text"), (900_007, "?!")]
    odd = spark.createDataFrame([(*r, "x", 1, "y", None) for r in odd], some.schema)
    docs, before = common.stage(some.union(odd), "odd"), 71
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns[:6] == some.columns
        docs = common.stage(out.select(some.columns), name)
        assert 0 < docs.count() <= before
        assert docs.filter("_key not in ('k', 'x') or hub not in (1, 3)").isEmpty()
        before = docs.count()
    texts = [r.text for r in docs.select("text").collect()]
    long = [t for t in texts if t and len(t) > 300_000]
    assert len(long) <= 1 and sum(r.n for r in docs.groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect() if r.n > 1) == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= before


def test_stages_of_an_empty_table(spark):
    docs = common.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
