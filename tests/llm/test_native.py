"""The native operators against plain Python, and their plans."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from tidemark.llm import decontamination, quality_rules, registry, url_filters

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_urls_against_rules_one_by_one(spark):
    rng = random.Random(1)
    labels = ["a", "b", "www", "example", "com", "net"]
    paths = ["/", "/en/", "/e", "/en/x", "", "/en"]
    urls = [f"{rng.choice(['http', 'x'])}://{'.'.join(rng.choice(labels) for _ in range(rng.randint(1, 4)))}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#f'])}" for _ in range(400)]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("a.com", "/e", "block"), ("net", "", "block"), ("NET", "", "allow"), ("b.net", "/en", "allow"), (None, "/", "block"), ("a", None, "block")]
    got = {r["i"]: r for r in url_filters.judge_urls(spark.createDataFrame(list(enumerate(urls)), "i int, url string"), spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for i, u in enumerate(urls):
        host, path = re.match(r"^[^/?#]*", u.split("://", 1)[1])[0], re.match(r"^[^/?#]*([^?#]*)", u.split("://", 1)[1])[1]
        fits = [(len(h) + len(p), len(h), v, h.lower() + p) for h, p, v in rules if h and p is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
        best = max(fits, default=None)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert (got[i]["rule"], got[i]["verdict"]) == ((best[3], best[2]) if best else (None, "allow")), u


def test_quality_counts_against_python(spark):
    rng = random.Random(3)
    docs = []
    for i in range(120):
        t = [rng.choice(["a", "bb", "#x", "the", "*"]) for _ in range(rng.randint(0, 60))]
        t += t[: rng.randint(0, len(t))]
        docs.append((i, "".join(w + rng.choice([" ", "\n", "\t", "  "]) for w in t)))
    for r in quality_rules.quality_rules(spark.createDataFrame(docs, "i int, text string")).collect():
        w = words(r["text"])
        lines = [x for x in r["text"].split("\n") if words(x)]
        windows = {}
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), []).append(k)
        covered = {p for at in windows.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r["text"])), len(lines) - len(set(lines)), len(covered)
        )
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_a_filter_on_a_verdict_is_not_pushed_down(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = quality_rules.quality_rules(docs).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter ") == 1 and plan.index("Filter ") < plan.index("monotonically_increasing_id")


def test_host_and_path_do_not_run_together(spark):
    rules = spark.createDataFrame([("com", "e", "block"), ("zz", "", "block"), ("b.org", "", "block")], "host string, path string, verdict string")
    got = url_filters.judge_urls(spark.createDataFrame([("http://come/",), ("http://a.com/e",), ("http://x.b.org",), ("http://b.org/q",)], "url string"), rules).collect()
    assert {r["url"]: r["rule"] for r in got} == {"http://come/": None, "http://a.com/e": None, "http://x.b.org": "b.org", "http://b.org/q": "b.org"}


def test_large_and_small_items_inside_long_texts(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(3000)]
    take = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, take(n)) for i, n in enumerate([5, 9, 14, 40, 200, 900, 3000])]
    docs = []
    for i, item in items:
        docs.append((i, take(400) + item + take(4000)))
        hurt = list(item)
        for k in range(0, len(hurt), 4):  # every shingle is broken
            hurt[k] = "broken"
        docs.append((100 + i, take(50) + hurt + take(50)))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id bigint, text string")
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id bigint, text string")
    sketches = decontamination.items_with_sketches(table, "item_id", "text").collect()
    assert any(r["scale"] > 0 for r in sketches) and all(len(r["sketch"]) >= min(16, len(r["hashes"])) for r in sketches)
    got = {r["doc_id"]: r["items"] for r in decontamination.decontaminate(df, table).collect()}
    assert all(got[i] == [i] for i, _ in items) and all(got[100 + i] == [] for i, _ in items)


def test_many_items_share_a_passage_and_many_documents_a_text(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(3000)]
    take = lambda n: [rng.choice(vocab) for _ in range(n)]
    stock = take(30)
    items = [(i, " ".join(stock + take(30))) for i in range(1000)] + [(None, "no id but five words"), (7, items_twin := " ".join(take(12)))]
    docs = [(i, " ".join(take(100) + stock + take(100))) for i in range(50)] + [(100 + i, items[3][1]) for i in range(200)]
    docs += [(500, f"x {items[5][1]} y {items[9][1]}"), (501, "no id but five words"), (502, items_twin.upper())]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: (r["items"], r["contaminated"]) for r in decontamination.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), table).collect()}
    want = {i: ([], False) for i in range(50)} | {100 + i: ([3], True) for i in range(200)} | {500: ([5, 9], True), 501: ([None], True), 502: ([7], True)}
    assert got == want


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    cols = df.columns
    key = lambda r: tuple(map(str, r))
    want = c.sql(f"SELECT {', '.join(cols)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(key, map(tuple, df.collect()))) == sorted(map(key, want))


@pytest.mark.parametrize("name", ["op1_url_filters", "op3_quality_rules", "op5_decontamination"])
def test_native_plans_hold_no_python(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
