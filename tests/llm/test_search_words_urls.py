"""Ranked search, spelling variants and the URL filter against brute force."""

import os
import random
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from strata.llm import ranking, registry, spelling, url_filter  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, _key string, term int"


def table(name, columns):
    return duckdb.sql(f"select {columns} from '{SF}/{name}.parquet' order by 1").fetchall()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", 7) for r in data], SCHEMA)


# ------------------------------------------------------------- op11

def _found(df):
    return rows(df.select("item_id", "rank", "doc_id", "score"))


def test_ranked_table(spark):
    assert _found(registry.queries()["op11_ranked_search"](spark, SF)) == \
        brute.ranked(table("documents", "doc_id, text"), table("benchmark", "item_id, text"))


def test_ranked_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ranking, "DOCS", 4)  # several blocks and bundles
    monkeypatch.setattr(ranking, "ITEMS", 2)
    r = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["ärger", "Été", "x9"]
    data = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 30)))) for i in range(10, 40)]
    data += [(1, None), (2, ""), (3, "w1 w2"), (4, "W1-w2"), (5, "?!"), (6, "w3 " * 20_000 + "w4"), (7, "unseen " * 3)]
    items = [(1, "w1 w2 w2 x9"), (2, None), (3, "nowhere"), (4, ""), (5, "ÄRGER ärger été W3"), (6, "w4"), (7, " ".join(words) * 3), (8, "w5 w6")]
    q = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    assert _found(ranking.search(frame(spark, data), q)) == brute.ranked(data, items)
    assert _found(ranking.search(frame(spark, data), q, k=2)) == brute.ranked(data, items, 2)
    # a repeated row is one document, or item
    assert _found(ranking.search(frame(spark, data + data[:9]), q.union(q))) == brute.ranked(data, items)


def test_ranked_ids(spark):
    """Null and repeated ids with other texts are documents of their own."""
    q = spark.createDataFrame([(1, "one two"), (None, "two")], "item_id long, text string")
    got = _found(ranking.search(frame(spark, [(None, "one"), (3, "two"), (3, "two two"), (4, "three"), (5, "four")]), q))
    assert sorted(str(x[0]) for x in got) == ["1", "1", "1", "None", "None"]
    assert {x[2] for x in got} == {None, 3}


def test_ranked_empty(spark):
    none = frame(spark, [])
    q = spark.createDataFrame([(1, "one")], "item_id long, text string")
    for docs, items in ((none, q), (frame(spark, [(1, "one")]), q.limit(0)), (frame(spark, [(1, None)]), q), (frame(spark, [(1, "two")]), q)):
        assert ranking.search(docs, items).collect() == []


# ------------------------------------------------------------- op12

def _variants(df):
    return rows(df.select("word", "form", "root", "n", "n_near", "form_n"))


def test_spelling_table(spark):
    docs = table("documents", "doc_id, text")
    assert _variants(registry.queries()["op12_spelling"](spark, SF)) == brute.variants(brute.misspelled(docs))


def test_spelling_odd_rows(spark):
    text = "Hello hello HELLO hallo hallo hallo helo hell hells hells hells hellos"
    data = [(1, text), (2, text), (2, text), (None, "straße strasse straßé " * 4), (3, None), (4, ""), (5, "123 ?! abcd"),
            (6, "l" * 3000 + " " + "l" * 3001), (7, "l" * 3000 + " " + "l" * 3000 + " " + "l" * 3001 + " " + "l" * 3001)]
    assert _variants(spelling.group_variants(spelling.word_counts(frame(spark, data), damage=3))) == brute.variants(brute.misspelled(data, 3))
    assert spelling.group_variants(spelling.word_counts(frame(spark, []))).collect() == []


def test_long_text_is_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 50)
    r = random.Random(2)
    text = " ".join("".join(r.choice("abcé") for _ in range(r.randint(1, 9))) for _ in range(4000)) + " " + "a" * 400
    assert "".join(spelling._pieces(text)) == text
    counted = {}
    import pyarrow as pa
    for batch in spelling._counter(5, 97)([pa.RecordBatch.from_pydict({"i": [9], "t": [text]})]):
        counted.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    assert {w: n for w, n in counted.items() if n >= 3} == brute.misspelled([(9, text)])


@pytest.mark.parametrize("tile", [2, 256])
def test_near_words(spark, monkeypatch, tile):
    """Every pair once, also where groups are split down to single places."""
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "CELLS", 300)
    r = random.Random(tile)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randint(1, 9))) for _ in range(300)} |
                   {"start" + "".join(r.choice("abc") for _ in range(4)) + "ending" for _ in range(60)})
    n = {w: r.randint(1, 50) for w in words}
    got = rows(spelling.near_words(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == sorted([(a, b, n[b]) for a in n for b in n if brute.one_edit(a, b)], key=str)


# ------------------------------------------------------------- op13

def test_urls_table(spark):
    pages = table("pages", "page_id, url, html")
    got = rows(registry.queries()["op13_url_filter"](spark, SF))
    d = spark.read.parquet(f"{SF}/pages.parquet")
    assert got == _judged(spark, d, pages)
    bad = [r for r in got if r[3] is None and ("spam" in r[1] or "pills" in r[1])]
    fine = [r for r in got if r[3] is None and not ("spam" in r[1] or "pills" in r[1])]
    assert all(r[4] == "block" for r in bad) and all(r[4] == "allow" for r in fine)


def _judged(spark, df, pages, rules=url_filter.RULES, seeds=url_filter.SEEDS):
    """Brute force with the operator's own splits, which have their own test."""
    urls = url_filter.parsed(df)
    counts = url_filter.word_counts(df, urls.select("host").distinct(), seeds)
    shape = F.regexp_replace(F.lower("path"), "[0-9]+", "0")
    names = urls.select(F.explode(url_filter._names(F.col("host"))).alias("name")).union(urls.select(F.explode(url_filter._names(shape)))).distinct()
    split = {r.name: r.words for r in url_filter.segment(names, counts).collect()}
    return brute.judged(pages, rules, seeds, counts, split)


def test_urls_odd_rows(spark):
    html = "<html><script>spamfarm()</script><body>cheap farm farm house house flower the the</body></html>"
    urls = [None, "", "no scheme", "http://", "https://COM", "https://com/", "http://www.example.com/en/x?y#z", "http://example.com/en/", "http://notexample.com/en/a",
            "http://a.example.com?q=/en/", "x://net/es", "x://net/es/1", "http://a.net/fr/#t", "http://spam-farm.org/de/1", "http://cheapspam.org/", "http://spamhouse.org/a/b",
            "http://flowerhouse.org/a/b", "http://farmhouse.org/de/2", "ftp://x.net/en/%20/" + "z" * 5000, "http://a.com://b.com/en/", "HTTP://Ünicode.org/É"]
    pages = [(i, u, html if i % 3 else None) for i, u in enumerate(urls)] + [(None, "http://the.org/1", html), (2, "http://spam.org/", ""), (2, "http://spam.org/", "")]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, host int, n string")
    got = rows(url_filter.judge(df))
    assert got == _judged(spark, df, pages)
    assert [r[1:4] for r in got if r[0] == 9] == [("a.example.com", "", None)]
    assert {r[1]: r[4] for r in got if r[3] is None and r[1]}["flowerhouse.org"] == "allow"
    assert {r[1]: r[4] for r in got if r[3] is None and r[1]}["cheapspam.org"] == "block"
    assert url_filter.judge(df.limit(0)).collect() == []
    # without block examples only rules decide
    assert {r[4] for r in rows(url_filter.judge(df, seeds=("nosuchword",))) if r[3] is None} == {"allow"}


def test_rules(spark):
    rules = (("b.org/", "block"), ("org/aa/", "allow"), ("a.b.org/a", "allow"), ("a.b.org/ab/", "block"))
    r = random.Random(1)
    urls = [f"http://{r.choice(['', 'a.', 'x.a.', 'xa.'])}{r.choice(['b.org', 'c.org', 'org'])}{r.choice(['', '/', '/a', '/aa/', '/ab/', '/ab'])}" for _ in range(200)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rule, says = url_filter.longest_rule(rules, F.col("host"), F.col("path"))
    got = url_filter.parsed(df).select("url", rule.alias("r"), says.alias("s")).collect()
    assert [(x.r, x.s) for x in got] == [brute.best_rule(*brute.split_url(x.url), rules) for x in got]


def test_splits():
    r = random.Random(4)
    counts = {"the": 50, "flower": 9, "flow": 20, "er": 3, "house": 12, "a": 40, "spam": 5, "he": 7, "thef": 1}
    total = sum(counts.values())
    for _ in range(60):
        name = "".join(r.choice(["the", "flower", "house", "x", "spam", "a", "er", "q"]) for _ in range(r.randint(1, 4)))[:14]
        known = {(i, j - i): counts[name[i:j]] for i in range(len(name)) for j in range(i + 1, len(name) + 1) if name[i:j] in counts}
        words = url_filter.best_split(name, known, total)
        assert "".join(words) == name
        own = sum(np.log(counts[w] / total) if w in counts else -np.log(total) - len(w) * np.log(10) for w in words)
        assert (round(float(own), 9), -len(words)) == pytest.approx(brute.probable_split(name, counts))
