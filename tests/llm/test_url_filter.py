import re

from pricelake.llm import url_filter
from tests.llm.conftest import stored

URLS = [
    None, "", "no scheme/x", "http://", "https://example.com", "https://example.com/", "HTTPS://EXAMPLE.com/en/1",
    "https://www.example.com/en/1?x#y", "http://WWW.Example.COM/en", "http://a.b.example.com/en/", "http://x.net/es/1",
    "http://net/fr/", "http://.net/fr/", "http://xnet/fr/", "http://a.net/FR/1", "http://a.net#/fr/", "http://a.net?/es/",
    "x://y://z.com/a", "http://a.com/\nb", "http://é.com/é", "http://com/", "http://example.com:80/en/", "http://u@example.com/en/",
    "http://" + "a." * 300 + "com/" + "p" * 5000, "http://a..com/x", "://h.com/p",
]


def parse(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]


def judged(url, rules, default="allow"):
    host, path = parse(url)
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


def frame(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def test_verdicts_are_those_of_brute_force(spark, folder):
    rows = [(i if i % 7 else None, u, "h") for i, u in enumerate(URLS)] + [(5, URLS[5], "h")] * 50
    pages = stored(spark, rows, "page_id long, url string, host string", folder)
    more = [*url_filter.RULES, ("com", "/a", "block"), ("a.com", "", "block"), ("y:", "", "block"), ("x.net", "/es/1", "allow")]
    for rules in (url_filter.RULES, more, []):
        got = sorted(map(tuple, url_filter.judge(pages, frame(spark, rules)).collect()), key=str)
        assert got == sorted(((p, *judged(u, rules)) for p, u, _ in rows), key=str)


def test_odd_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = [(None, "/", "block"), ("a.com", None, "block"), ("A.com", "/x", "block"), ("a.com", "/x", "allow")]
    assert url_filter.judge(pages, frame(spark, rules)).collect()[0]["verdict"] == "allow"
    assert url_filter.judge(pages.limit(0), frame(spark, rules)).count() == 0


def test_the_filter_lets_every_listed_key_pass_and_few_others(spark):
    rules = spark.range(3000).selectExpr("concat('h', id, '.com') as rule_host", "'/' as rule_path")
    blocks = url_filter.bloom_blocks(rules)
    passing = lambda keys: (
        keys.withColumn("block", url_filter._address("rule_host", "rule_path"))
        .join(blocks, "block")
        .where(
            url_filter.F.col("bits").bitwiseAND(url_filter._mask("rule_host", "rule_path"))
            == url_filter._mask("rule_host", "rule_path")
        )
        .count()
    )
    assert passing(rules) == 3000
    assert passing(spark.range(20000).selectExpr("concat('g', id, '.org') as rule_host", "'/' as rule_path")) < 60
    assert blocks.count() <= url_filter.FILTER_BLOCKS


def test_no_python_runs(spark, sf_dir):
    from pricelake.llm.queries import op2_url_filter
    from tests.conftest import plan

    text = plan(op2_url_filter(spark, sf_dir))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_query_against_its_sql(spark, sf_dir):
    from pricelake.llm.queries import ORACLE, op2_url_filter
    from tools.compare import connect

    cursor = connect(sf_dir).execute(ORACLE["op2_url_filter"])
    names = [column[0] for column in cursor.description]
    got = op2_url_filter(spark, sf_dir)
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=str) == sorted(cursor.fetchall(), key=str)
    assert {r["verdict"] for r in got.collect()} == {"allow", "block"}


def test_empty_table(spark, folder):
    pages = stored(spark, [], "page_id long, url string, html string, verdict string", folder)
    assert url_filter.judge(pages, frame(spark, url_filter.RULES)).count() == 0
