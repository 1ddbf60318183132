"""URL filter: short allow and block rules, else a list of canonical URLs behind a blocked Bloom filter.

A rule names a host (its subdomains included) and a start of the path; of the rules that fit a URL the longest
wins. A URL without a rule is looked up in the list, which may have any number of rows: a Bloom filter of
the listed URLs tells nearly all others apart without moving them, and only possible hits are shuffled to an
exact hash join with the list, which removes the false positives. Everything is built-in expressions.

The filter is cut into blocks of four words of 64 bits. A URL sets two bits in each word of one block, so a
lookup reads one row. The blocks are a table that is broadcast; it has a row for about 16 listed URLs and never
more than ``MAX_BLOCKS`` rows (about 10 MB). A list too long for that fills the blocks up, so that more
rows reach the exact join; the result is the same for any size of the filter.

Canonical URL: scheme, fragment, ``www.``, default ports and closing slashes are dropped, the host is in lower case, tracking
parameters are dropped and the others sorted.

Defined results: a null URL, or one without ``://``, has empty host and path, no canonical form, fits no rule and
is allowed. Repeated rows are judged each. Among rules of equal length that fit, that with the longer host wins.
Null entries of the list are passed over, repeated ones count once. An empty table gives an empty result, an
empty list allows what no rule blocks. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fixed values of the query: verdict and rule (host, then the start of the path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Fixed values of the query: words of host names whose pages make up the list.
TERMS = ("adult", "ads", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
MAX_BLOCKS = 1 << 18
WORDS, BITS_PER_URL = 4, 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The canonical form; null for a URL without ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def term_urls(pages: DataFrame, terms: Sequence[str] = TERMS, url_col: str = "url") -> DataFrame:
    """(canonical): the URLs whose host name has one of the words, each once."""
    words = "|".join(terms)
    url = F.col(url_col).cast("string")
    return (pages.where(host_of(url).rlike(rf"(^|[.-])({words})([.-]|$)"))
            .select(canonical(url).alias("canonical")).where("canonical is not null").distinct())


def _split(rule: str) -> tuple[str, str]:
    at = rule.find("/")
    if at < 1:
        raise ValueError(f"a rule is a host and a start of the path, as in example.net/en/: {rule!r}")
    return rule[:at].translate(str.maketrans(UPPER, LOWER)), rule[at:]


def ruling(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both null where none does. For short lists of rules:
    each is one test in generated code."""
    if any(v not in ("allow", "block") for v, _ in rules) or len({r for _, r in rules}) < len(rules):
        raise ValueError("rules are (allow or block, rule), each rule once")
    rule = verdict = F.lit(None).cast("string")
    # the last test written is the first one made
    for said, text in sorted(rules, key=lambda x: (len(x[1]), x[1].find("/"), x[1])):
        h, p = _split(text)
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _place(key: str, blocks: int) -> dict[str, Column]:
    """The block of a key, and the bits that it sets in the block's words."""
    at = f"xxhash64({key}, 1L)"
    out = {"block": F.expr(f"CAST((shiftrightunsigned(xxhash64({key}), 32) * {blocks}L) >> 32 AS INT)")}
    for w in range(WORDS):
        bits = [f"shiftleft(1L, CAST(shiftrightunsigned({at}, {12 * w + s}) & 63 AS INT))" for s in (0, 6)]
        out[f"m{w}"] = F.expr(" | ".join(bits))
    return out


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3): the filter's blocks that have a bit set."""
    set_bits = listed.select(*[c.alias(n) for n, c in _place("canonical", blocks).items()])
    return set_bits.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS)])


def blocks_for(listed_rows: int, max_blocks: int = MAX_BLOCKS) -> int:
    return max(1, min(max_blocks, -(-listed_rows * BITS_PER_URL // (64 * WORDS))))


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(id, host, path, rule, verdict, canonical, listed) for every row; ``listed`` has one column of canonical URLs.

    ``listed`` is null where a rule decides. Pages that are no possible hits are never shuffled. Of the others one URL may
    have any number of rows: the list has each URL once, so such a group is split by adaptive execution and
    meets one row.
    """
    names = listed.select(F.col(listed.columns[0]).cast("string").alias("canonical"))
    names = stored(names.where("canonical is not null").distinct(), "listed")
    blocks = blocks_for(names.count(), max_blocks)
    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col).alias("id"), F.coalesce(host_of(url), F.lit("")).alias("host"),
                         F.coalesce(path_of(url), F.lit("")).alias("path"), canonical(url).alias("canonical"))
    rule, verdict = ruling(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "verdict": verdict})
    asked = F.col("rule").isNull() & F.col("canonical").isNotNull()
    probe = parts.withColumns({n: F.when(asked, c) for n, c in _place("canonical", blocks).items()})
    found = probe.join(F.broadcast(bloom(names, blocks)), "block", "left")
    may = F.coalesce(reduce(lambda a, b: a & b, [F.expr(f"w{w} & m{w}") == F.col(f"m{w}") for w in range(WORDS)]), F.lit(False))
    found = found.withColumn("may", may).select("id", "host", "path", "rule", "verdict", "canonical", "may")
    # the exact join: only possible hits move, false positives find no partner
    hits = found.where("may").join(names.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
    hits = hits.withColumn("listed", F.coalesce("listed", F.lit(False)))
    rest = found.where("not may").withColumn("listed", F.when(F.col("rule").isNull(), F.lit(False)))
    columns = ["id", "host", "path", "rule", "verdict", "canonical", "listed"]
    both = hits.select(columns).unionByName(rest.select(columns))
    final = F.coalesce("verdict", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return both.select(F.col("id").alias(id_col), "host", "path", "rule", final.alias("verdict"), "canonical", "listed")


def _sql_rules(rules: Sequence[tuple[str, str]]) -> tuple[str, str]:
    cases = {"rule": "", "verdict": ""}
    for said, text in sorted(rules, key=lambda x: (-len(x[1]), -x[1].find("/"), x[1])):
        h, p = _split(text)
        fits = f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}') THEN "
        cases["rule"] += f"{fits}'{text}' "
        cases["verdict"] += f"{fits}'{said}' "
    return f"CASE {cases['rule']}END", f"CASE {cases['verdict']}END"


def oracle_sql(rules: Sequence[tuple[str, str]] = RULES, terms: Sequence[str] = TERMS) -> str:
    rule, verdict = _sql_rules(rules)
    return f"""
WITH a AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, instr(url, '://') > 0 AS whole, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) AS query FROM a),
c AS (SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))), '&') AS kept FROM b),
d AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS said,
  CASE WHEN whole THEN regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canonical FROM c),
l AS (SELECT DISTINCT canonical FROM d WHERE regexp_matches(host, '(^|[.-])({"|".join(terms)})([.-]|$)') AND canonical IS NOT NULL)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  d.canonical, CASE WHEN rule IS NULL THEN l.canonical IS NOT NULL END AS listed FROM d LEFT JOIN l ON d.canonical = l.canonical"""
