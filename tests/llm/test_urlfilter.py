"""The URL filter against DuckDB SQL, brute force in Python, and any size of its Bloom filter."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from salesflow.llm import urlfilter

SCHEMA = "page_id long, url string"
URLS = [
    None, "", "no scheme", "://", "a:///x", "http://A.Example.NET/en/1?x#y", "http://example.net/EN/", "http://x.net", "http://net/",
    "http://notnet/", "http://badexample.net/en/", "http://m.Example.com/de/5", "http://example.com/d", "https://www.a.org/fr/9.html",
    "https://org/fr/", "http://a.org?x=/fr/", "http://cheap-pills.example.com/en/1", "https://www.Cheap-Pills.example.com:443/en/1/?utm_source=q#top",
    "http://pills.example.org/a?b=2&a=1&ref=z", "http://pills.example.org/a?a=1&b=2", "http://pillsx.example.org/a", "http://a.org/fr/casino",
    "http://a#b://c?d", "http://u@h:80/p//?&&", "http://h/p\nq?r", "http://ünï.example.com/de/ß", "http://h/" + "x/" * 9000 + "?utm_a",
    "http://xxx.example.com/de/1", "http://adult-x.example.com/", "http://adult-x.example.com", "a://b://c/d", "HTTP://WWW.www.org/",
]


def rows():
    out = [(i, u) for i, u in enumerate(URLS)]
    return out + [(None, URLS[16]), (None, None), (3, URLS[16]), (3, URLS[16])] + [(1000 + i, URLS[17]) for i in range(300)]


def brute(rows, rules=urlfilter.RULES, terms=urlfilter.TERMS):
    def low(s):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)

    parsed, listed = [], set()
    for i, u in rows:
        host = path = ""
        canon = None
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host = low(rest[:cut])
            path = re.split("[?#]", rest[cut:])[0]
            before = rest.split("#")[0]
            query = before.split("?", 1)[1] if "?" in before else ""
            kept = sorted(p for p in query.split("&") if p and not re.match(r"(utm_[^=]*|ref|gclid|fbclid)(=|$)", p))
            name = host[4:] if host.startswith("www.") else host
            for port in (":80", ":443"):
                name = name.removesuffix(port) if host.endswith(port) else name
            canon = name + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")
        if set(re.split("[.-]", host)) & set(terms):
            listed.add(canon)
        parsed.append((i, host, path, canon))
    out = []
    for i, host, path, canon in parsed:
        fit = [(len(r), r, v) for v, r in rules for h, p in [(r[:r.index("/")], r[r.index("/"):])]
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fit, default=(0, None, None))
        hit = canon in listed if rule is None else None
        out.append((i, host, path, rule, verdict or ("block" if hit else "allow"), canon, hit))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("max_blocks", [1, 2, urlfilter.MAX_BLOCKS])
def test_whole_result_against_brute_force_with_any_filter(spark, max_blocks):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    assert got(urlfilter.judge(df, urlfilter.term_urls(df), max_blocks=max_blocks)) == brute(rows())


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", rows())
    assert sorted(map(tuple, con.execute(urlfilter.oracle_sql()).fetchall()), key=str) == brute(rows())


def test_full_filter_lets_false_positives_reach_the_join_and_no_further(spark):
    """One block and many listed URLs: every bit is set, the exact join alone decides."""
    listed = spark.range(3000).select(F.concat(F.lit("x.org/"), "id").alias("canonical"))
    words = urlfilter.bloom(listed, 1).collect()[0]
    assert all(words[f"w{w}"] == -1 for w in range(urlfilter.WORDS))
    df = spark.createDataFrame([(i, f"http://x.org/{i}") for i in range(2990, 3010)], SCHEMA)
    said = {r.page_id: r.verdict for r in urlfilter.judge(df, listed, max_blocks=1).collect()}
    assert said == {i: "block" if i < 3000 else "allow" for i in range(2990, 3010)}


def test_filter_passes_all_listed_and_few_others(spark):
    def urls(name):
        return spark.range(20_000).select(F.concat(F.lit(name), "id").alias("canonical"))

    blocks = urlfilter.blocks_for(20_000)
    words = urlfilter.bloom(urls("a.org/"), blocks)

    def passed(df):
        keyed = df.select(*[c.alias(n) for n, c in urlfilter._place("canonical", blocks).items()])
        return keyed.join(words, "block").where(" AND ".join(f"w{w} & m{w} = m{w}" for w in range(urlfilter.WORDS))).count()

    assert passed(urls("a.org/")) == 20_000
    assert passed(urls("b.org/")) < 400


def test_main_path_is_native_and_moves_possible_hits_only(spark):
    df = spark.range(10).select(F.col("id").alias("page_id"), F.lit("http://a.org/").alias("url"))
    plan = urlfilter.judge(df, urlfilter.term_urls(df))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("extra", ["id", "canonical", "block", "may", "listed", "rule", "host", "m0", "w0"])
def test_clashing_columns_and_empty_tables(spark, extra):
    df = spark.createDataFrame(rows(), SCHEMA).withColumn(extra, F.lit("z"))
    assert got(urlfilter.judge(df, urlfilter.term_urls(df))) == brute(rows())
    empty = df.limit(0)
    assert urlfilter.judge(empty, urlfilter.term_urls(df)).collect() == []
    none = urlfilter.judge(df, spark.createDataFrame([(None,)], "u string"))
    assert {r.verdict for r in none.where("rule is null").collect()} == {"allow"}


def test_rules_are_checked():
    for rules in ([("maybe", "a/")], [("allow", "a/"), ("block", "a/")], [("allow", "a")], [("allow", "/a")]):
        with pytest.raises(ValueError):
            urlfilter.ruling(None, None, rules)
