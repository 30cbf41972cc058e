"""URL filtering by written rules and mined association rules, native: DataFrame, SQL and Spark ML's FP-growth only.

Written rules name a host (with its subdomains) and a path prefix; the longest that fits decides. They also label URLs:
FP-growth mines combinations of URL tokens together with the label, and combinations of enough support and confidence
become rules that judge the URLs which no written rule fits. Confidence counts labelled URLs alone, blocked against
allowed; a lift over all URLs holds off tokens that are merely common, and rules that only restate written ones go.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.llm import common


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the query's contract.
BASE_RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)
#: Pruning of mined rules.
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.95
MIN_LIFT = 1.2
MAX_TOKENS = 3
#: Items of one URL up to which FP-growth runs over it whole, and items in a block beyond.
LONG_URL = 16
BLOCK_ITEMS = 5


def _low(c: Column) -> Column:
    """A-Z lower-cased, other characters as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ://, up to / ? # or the end; null or no ://: empty."""
    return F.coalesce(_low(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host, up to ? # or the end; null or no ://: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: tuple[UrlRule, ...], host: Column, path: Column, what) -> Column:
    """what(rule) of the longest rule that fits (ties: by name), else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        out = F.when(fits(rule, host, path), F.lit(what(rule))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels by level from the right, path segments by place without digits, file ending, query names."""
    labels = F.transform(F.reverse(F.split(host, r"\.")), lambda x, i: F.concat(F.lit("h"), (i + 1).cast("string"), F.lit("="), x))
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike(r"\d")), lambda x, i: F.concat(F.lit("p"), (i + 1).cast("string"), F.lit("="), _low(x)))
    scheme = F.concat(F.lit("s="), _low(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))
    ending = F.concat(F.lit("e="), _low(F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1)))
    names = F.transform(F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q="), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.coalesce(F.concat(F.array(scheme, ending), labels, segments, names), F.array().cast("array<string>")))


def _items(groups: DataFrame) -> DataFrame:
    """(token, item): tokens that occur in exactly the same URLs are one item, named by the smallest of them.

    groups: distinct (tokens, label, n) rows. Equal sets of groups are told by their number and the sums of two hashes.
    """
    spread = groups.select(F.xxhash64("tokens", "label").alias("a"), F.xxhash64("label", "tokens", F.lit(1)).alias("b"), F.explode("tokens").alias("token"))
    marks = spread.groupBy("token").agg(F.count("*").alias("k"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    return marks.groupBy("k", "a", "b").agg(F.min("token").alias("item"), F.collect_list("token").alias("all")).select("item", F.explode("all").alias("token"))


def _frequent_sets(blocked: DataFrame, least: int, max_tokens: int, long: int = LONG_URL, block: int = BLOCK_ITEMS) -> DataFrame:
    """(items sorted, hits): sets of at most max_tokens items that at least ``least`` of the rows of items hold, by FP-growth.

    FP-growth also enumerates larger sets, so a URL family with many items (names of a long query) would take time with
    the power of their number. From ``long`` items in one row on, the items are dealt into small blocks and every row is
    mined once for each choice of max_tokens blocks, its items marked with that choice: each small set lies in some
    choice, and no larger set spans more than max_tokens blocks.
    """
    if (blocked.agg(F.max(F.size("items"))).first()[0] or 0) > long:
        known = sorted(r["item"] for r in blocked.select(F.explode("items").alias("item")).distinct().collect())
        parts = [known[i : i + block] for i in range(0, len(known), block)]
        choices = list(itertools.combinations(range(len(parts)), min(max_tokens, len(parts))))
        of = F.create_map(*(x for i, part in enumerate(parts) for item in part for x in (F.lit(item), F.lit(i))))
        placed = blocked.select("items", F.transform("items", lambda x: F.try_element_at(of, x)).alias("at"))
        chosen = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.array(*map(F.lit, own)).alias("own")) for c, own in enumerate(choices)))).alias("choice")
        mark = F.concat(F.col("choice.c").cast("string"), F.lit("|"))
        own_items = F.filter(F.transform("items", lambda x, i: F.when(F.array_contains("choice.own", F.get("at", i)), F.concat(mark, x))), lambda x: x.isNotNull())
        blocked = placed.select("items", "at", chosen).select(own_items.alias("items")).where(F.size("items") > 0)
    total = blocked.count()
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, (least - 0.5) / max(1, total))).fit(blocked)
    plain = F.transform("items", lambda x: F.regexp_replace(x, r"^\d+\|", ""))
    return common.materialise(model.freqItemsets.where(F.size("items") <= max_tokens).select(F.array_sort(plain).alias("items"), F.col("freq").alias("hits")).distinct(), "url-itemsets")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS, min_lift: float = MIN_LIFT) -> list[tuple[list[str], float]]:
    """Token combinations (at most max_tokens) that imply a block: [(tokens, confidence)].

    labelled: tokens array<string>, label (block, allow or null). Support: blocked URLs with the combination, of all
    labelled ones. Confidence: (blocked + 1) / (labelled + 2) among the URLs with the combination, so a few URLs are no
    evidence. Lift: the blocked share of all URLs with the combination, unlabelled ones too, over that share of all URLs;
    it holds off tokens that are merely common. Combinations that fire on labelled URLs only restate written rules and are
    dropped, as are those that contain a shorter rule. Their number is bounded by the support, not by the rows: a blocked
    URL's tokens and one part in min_support of the labelled URLs.
    """
    rows = labelled.select("tokens", "label").where(F.size("tokens") > 0)
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_labelled, n_all = totals.get("block", 0) + totals.get("allow", 0), sum(totals.values())
    if not totals.get("block"):
        return []
    least = max(1, math.ceil(min_support * n_labelled))
    frequent = rows.where("label = 'block'").select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    names = sorted(r["t"] for r in frequent.collect())  # bounded by the support
    if not names:
        return []
    known = F.array(*map(F.lit, names))
    # only frequent tokens can be in a rule: distinct sets of them, each with its number of URLs, stand for all rows
    groups = rows.select(F.array_sort(F.array_intersect("tokens", known)).alias("tokens"), "label").groupBy("tokens", "label").agg(F.count("*").alias("n"))
    groups = common.materialise(groups.where(F.size("tokens") > 0).withColumn("g", F.monotonically_increasing_id()), "url-groups")
    items = common.materialise(_items(groups), "url-items")
    item_of = {r["token"]: r["item"] for r in items.collect()}
    kept_items = F.array(*map(F.lit, sorted(set(item_of.values()))))
    own = F.array_intersect("tokens", kept_items)
    blocked = rows.where("label = 'block'").select(F.array_intersect(F.array_sort("tokens"), kept_items).alias("items")).where(F.size("items") > 0)
    sets = _frequent_sets(blocked, least, max_tokens).where(F.col("hits") >= least)
    wanted = sets.select("items", "hits", F.size("items").alias("need"), F.explode("items").alias("t"))
    held = groups.select("g", "label", "n", F.explode(own).alias("t"))
    met = held.join(wanted, "t").groupBy("g", "label", "n", "items", "hits", "need").agg(F.count("*").alias("m")).where(F.col("m") == F.col("need"))
    counted = met.groupBy("items", "hits").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("label") == "allow", F.col("n")).otherwise(0)).alias("allowed"))
    fits_ = (F.col("hits") + 1 >= min_confidence * (F.col("hits") + F.col("allowed") + 2)) & (F.col("hits") * F.lit(float(n_all)) >= min_lift * F.col("total") * totals["block"])
    found = counted.where(fits_ & (F.col("hits") + F.col("allowed") < F.col("total"))).select("items", ((F.col("hits") + 1) / (F.col("hits") + F.col("allowed") + 2)).alias("confidence"))
    kept: list[tuple[list[str], float]] = []
    for r in sorted(found.collect(), key=lambda r: (len(r["items"]), r["items"])):
        if not any(set(k) <= set(r["items"]) for k, _ in kept):
            kept.append((list(r["items"]), r["confidence"]))
    return kept


def fires(mined: list[tuple[list[str], float]], tokens_: Column) -> Column:
    """True where all tokens of a mined rule are in the array: an inverted index gives the rules of each token, and a rule
    fires when it is named as often as it has tokens."""
    index: dict[str, list[int]] = {}
    for i, (own, _) in enumerate(mined):
        for t in own:
            index.setdefault(t, []).append(i)
    if not index:
        return F.lit(False)
    lists = F.create_map(*(x for t, own in sorted(index.items()) for x in (F.lit(t), F.array(*map(F.lit, own)))))
    need = F.array(*(F.lit(len(own)) for own, _ in mined))
    named = F.flatten(F.transform(tokens_, lambda t: F.coalesce(F.try_element_at(lists, t), F.array().cast("array<int>"))))
    return F.exists(F.array_distinct(named), lambda r: F.size(F.filter(named, lambda x: x == r)) == F.get(need, r))


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = BASE_RULES, id_col: str = "page_id", url_col: str = "url", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS, min_lift: float = MIN_LIFT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row.

    Null URLs and URLs without :// have an empty host and path, fit no rule and are allowed unless a mined rule fires. Rows
    repeat as they came, null ids pass through, an empty table gives no rows and other columns are ignored. URLs are cut
    into tokens whole, however long; of two rules of one length the later by name wins.
    """
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    cut = pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    rows = cut.select("page_id", "host", "path", longest_rule(rules, host, path, lambda r: r.name).alias("rule"), longest_rule(rules, host, path, lambda r: r.verdict).alias("label"), tokens(F.col("url"), host, path).alias("tokens"))
    mined = mine(rows, min_support, min_confidence, max_tokens, min_lift)
    verdict = F.coalesce("label", F.when(fires(mined, F.col("tokens")), F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
JUDGE_SQL = rf"""
WITH u AS (SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT k, page_id, url, {_LOW.format("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")} AS host,
  regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
r AS (SELECT * FROM (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in BASE_RULES)}) t(verdict, rhost, rpath)),
f AS (SELECT k, rhost || rpath AS rule, verdict AS label FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY length(rhost || rpath) DESC, rhost || rpath DESC) = 1),
t AS (SELECT DISTINCT k, t FROM (
  SELECT k, 's=' || {_LOW.format("regexp_extract(url, '^(.*?)://', 1, 's')")} AS t FROM h
  UNION ALL SELECT k, 'e=' || {_LOW.format(r"regexp_extract(path, '\.([A-Za-z]{1,5})$', 1)")} FROM h
  UNION ALL SELECT k, 'h' || i || '=' || list_reverse(string_split(host, '.'))[i] FROM (SELECT k, host, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM h)
  UNION ALL SELECT k, 'p' || i || '=' || {_LOW.format("s[i]")} FROM (SELECT k, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT k, list_filter(string_split(path, '/'), lambda x: x <> '' AND NOT regexp_matches(x, '[0-9]')) AS s FROM h))
  UNION ALL SELECT k, 'q=' || string_split(q, '=')[1] FROM (SELECT k, unnest(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: x <> '')) AS q FROM h))),
c AS (SELECT k, t AS a, t AS b, t AS c FROM t UNION ALL SELECT x.k, x.t, x.t, y.t FROM t x JOIN t y ON x.k = y.k AND x.t < y.t
  UNION ALL SELECT x.k, x.t, y.t, z.t FROM t x JOIN t y ON x.k = y.k AND x.t < y.t JOIN t z ON x.k = z.k AND y.t < z.t),
l AS (SELECT count(*) FILTER (label = 'block') AS blocked, count(label) AS labelled, count(*) AS total FROM h LEFT JOIN f USING (k)),
n AS (SELECT a, b, c, count(*) FILTER (label = 'block') AS hits, count(*) FILTER (label = 'allow') AS allowed, count(*) AS total FROM c LEFT JOIN f USING (k) GROUP BY a, b, c),
m AS (SELECT a, b, c FROM n, l WHERE hits >= greatest(1, ceil({MIN_SUPPORT} * labelled)) AND hits + 1 >= {MIN_CONFIDENCE} * (hits + allowed + 2)
  AND CAST(hits AS DOUBLE) * l.total >= {MIN_LIFT} * n.total * blocked),
x AS (SELECT DISTINCT k FROM c JOIN m USING (a, b, c))
SELECT page_id, host, path, rule, CASE WHEN label IS NOT NULL THEN label WHEN x.k IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM h LEFT JOIN f USING (k) LEFT JOIN x USING (k)
"""
