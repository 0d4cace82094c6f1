from stillwater.llm.url_filters import judge

PAGES = [(1, "https://WWW.Example.com/en/a?x"), (2, "http://m.example.com/en/b"), (3, "http://example.com/fr/"), (4, "http://a.net/es/1"), (5, "http://a.net/de"),
         (6, None), (7, "no scheme"), (8, "http://x.com"), (9, "http://x.com?/en/"), (10, "ftp://notexample.com/en/"), (None, "http://a.net/fr/#y"), (11, "")]
WANT = {1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"), 2: ("m.example.com", "/en/b", "example.com/en/", "block"),
        3: ("example.com", "/fr/", "com/", "allow"), 4: ("a.net", "/es/1", "net/es/", "block"), 5: ("a.net", "/de", None, "allow"),
        6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("x.com", "", None, "allow"), 9: ("x.com", "", None, "allow"),
        10: ("notexample.com", "/en/", "com/", "allow"), None: ("a.net", "/fr/", "net/fr/", "block"), 11: ("", "", None, "allow")}
COLUMNS = "page_id bigint, url string, tokens string, token string, host string, rule string"
LABELS = "doc_id bigint, quality int, toxic int, tokens string"


def test_listed_rules(spark):
    pages = spark.createDataFrame([(*p, "x", "x", "x", "x") for p in PAGES], COLUMNS)
    got = judge(pages, spark.createDataFrame([], LABELS)).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == WANT and len(got) == len(PAGES)
    assert judge(pages.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_rules_are_mined_and_matched_whole(spark):
    rows = [(i, f"http://{'spam' if i % 2 else 'news'}.{'shop' if i % 3 == 0 else 'site'}.org/{'win' if i % 4 < 2 else 'read'}/{i}") for i in range(400)]
    bad = {i for i, u in rows if "spam" in u and "win" in u}
    pages = spark.createDataFrame([(*p, "x", "x", "x", "x") for p in rows], COLUMNS)
    labels = spark.createDataFrame([(i, None if i % 7 else 1, int(i in bad), "x") for i in range(0, 400) if i % 5] + [(3, 0, None, "x"), (None, 0, 1, "x")], LABELS)
    got = judge(pages, labels, min_support=0.05, min_confidence=0.9).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == bad
    assert all((r.mined_rules > 0) == (r.page_id in bad) for r in got)
