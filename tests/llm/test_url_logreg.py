import pytest

from tierflow.llm.queries import URL_RULES
from tierflow.llm.url_logreg import fit, judge, labelled_urls


@pytest.fixture(scope="module")
def model(spark):
    return fit(labelled_urls(spark))


def test_hosts_paths_and_rules(spark, model):
    cases = [
        # url, host, path, rule, verdict by rule
        ("https://a.net/x?q#f", "a.net", "/x", "net/", "block"),
        ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
        ("http://www.example.net/en/", "www.example.net", "/en/", "example.net/en/", "allow"),
        ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("FTP://EXAMPLE.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
        ("x://sub.org/fr/1", "sub.org", "/fr/1", "org/fr/", "allow"),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", None, None),
        ("http://a.planet/x", "a.planet", "/x", None, None),
        ("http://b.net?x=/y", "b.net", "", None, None),
        ("http://a.org/FR/", "a.org", "/FR/", None, None),
        ("http://Ä.net/", "Ä.net", "/", "net/", "block"),
        ("a/b://c.net/d://e", "c.net", "/d://e", "net/", "block"),
        ("no scheme.net/", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
        ("http://" + "x" * 50_000 + ".net/", "x" * 50_000 + ".net", "/", "net/", "block"),
    ]
    pages = spark.createDataFrame([(i, c[0], "r", 1.0) for i, c in enumerate(cases)],
                                  "page_id long, url string, rule string, features double")
    out = judge(pages, URL_RULES, model)
    assert out.columns == ["page_id", "url", "features", "host", "path", "rule", "p_block", "verdict"]
    got = {r["page_id"]: r for r in out.collect()}
    for i, (url, host, path, rule, verdict) in enumerate(cases):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == (verdict or ("block" if r["p_block"] >= 0.8 else "allow")), url
    assert judge(pages.limit(0), URL_RULES, model).collect() == []
    both = judge(pages.union(pages), [], model).groupBy("page_id").agg({"verdict": "count"}).collect()
    assert {r[1] for r in both} == {2}


def test_learned_names(spark, model):
    urls = [("https://new-casino-bonus.example/de/4", 1), ("https://cheap-pills-shop.example/x", 1),
            ("https://city-museum.example/en/7", 0), ("https://public-library.example/fr/8", 0)]
    df = spark.createDataFrame(urls, "url string, label int")
    got = {r["url"]: r["p_block"] for r in judge(df, [], model).collect()}
    assert all((got[u] > 0.5) == bool(y) for u, y in urls)


def test_fit_needs_no_unlabelled_rows(spark, model):
    extra = spark.createDataFrame([("https://casino.example/", None)], "url string, blocked double")
    again = fit(labelled_urls(spark).union(extra))
    assert abs(again.intercept - model.intercept) < 1e-9


def test_probabilities_equal_brute_force(spark, model):
    """Features and probability of host and path, computed without Spark's
    transformers."""
    import math

    from pyspark.ml.feature import HashingTF

    from tierflow.llm.url_logreg import FEATURES, NGRAMS
    tf = HashingTF(numFeatures=FEATURES)
    urls = ["https://www.new-casino.com/play?x", "http://museum.org/", "x://é漢😀.com/ü/", "http://ab/", "none", ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for r in judge(df, [], model).collect():
        grams = set()
        for tag, text in (("h", r["host"]), ("p", r["path"])):
            marked = f"\x02{text}\x03"
            grams |= {tag + marked[i:i + n] for n in NGRAMS for i in range(len(marked) - n + 1)}
        z = model.intercept + sum(float(model.coefficients[i]) for i in {tf.indexOf(g) for g in grams})
        assert abs(r["p_block"] - 1 / (1 + math.exp(-z))) < 1e-9, r["url"]


def test_given_unwanted_hosts_are_found_though_the_table_has_none(spark, model):
    from tierflow.llm.url_logreg import ALLOWED, BLOCKED
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    unwanted = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    assert not set(unwanted) & set((BLOCKED + ALLOWED).split())
    rows = judge(pages.select("page_id", "url"), [], model).select("host", "verdict").collect()
    bad = [r["verdict"] == "block" for r in rows if any(u in r["host"] for u in unwanted)]
    good = [r["verdict"] == "block" for r in rows if not any(u in r["host"] for u in unwanted)]
    assert sum(bad) >= 0.9 * len(bad) > 0 and sum(good) <= 0.02 * len(good)
