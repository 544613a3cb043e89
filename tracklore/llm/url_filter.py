"""URL filters by Bloom filter cascades, with DataFrame functions only.

A cascade answers exactly, for every key of a known universe, whether it is listed. Level 0 encodes the listed keys; level 1 the
keys of the universe that pass level 0 unlisted; level 2 the listed keys that pass level 1; and so on until none pass
wrongly. A key is looked up level by level; the first level that misses decides. The levels are constants in the
expression, so a url is judged where it lies, without a join.

Rules name a host and a path. A rule fits its host and that host's subdomains where the url's path starts with its
path; the longest rule (host and path together, ties to the longer host) wins. Urls without a fitting rule are blocked
if their host, or a domain above it, is in the host list, and allowed otherwise.

Defined cases: a null url, or one without ``://``, has an empty host and path: no rule fits, and it is allowed. Repeated rows and null
page ids are judged like others; an empty table gives an empty table; extra columns are not read.

Scale: one pass over the urls collects the distinct keys of the shapes that the lists can name (so many last labels, so
many first characters of the path); that universe, not the pages, is shuffled. Level 0 is sized to let through about as many
other keys as are listed, so all levels together take a few bytes per listed key, whatever the corpus. Where the lists
name more than ``max_listed`` keys, which is too many for constants in an expression, each url's distinct host and path
prefixes meet the lists in a shuffle join instead, with the same verdicts.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm.common import materialise, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Hosts blocked where no rule fits.
BLOCKED_HOSTS = ("ads-track.example.com", "adult-x.example.com", "casino-win.example.net", "cheap-pills.example.com", "cheap-pills.example.net", "free-bets.example.net", "spam-farm.example.org")


class Cascade:
    """levels: (number of bits, number of hashes, words of 64 bits)."""

    def __init__(self, levels: list[tuple[int, int, list[int]]]):
        self.levels = levels

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        found = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            found = F.when(_passes(key, i, *self.levels[i]), found).otherwise(i % 2 == 1)
        return found


def _bit(key: Column, level: int, j: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits))


def _passes(key: Column, level: int, bits: int, hashes: int, words: list[int]) -> Column:
    # folded to one array constant by the optimizer
    constant = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    tests = [F.element_at(constant, (F.floor(_bit(key, level, j, bits) / 64) + 1).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(_bit(key, level, j, bits), F.lit(64)).cast("int"))) != 0 for j in range(hashes)]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _by_kind(of: dict[str, Column]) -> Column:
    """The column of the row's kind; null for other kinds."""
    return F.coalesce(*[F.when(F.col("kind") == k, c) for k, c in of.items()])


def _counts(keys: DataFrame) -> dict[str, int]:
    return {r["kind"]: r["count"] for r in keys.groupBy("kind").count().collect()}


def build_cascades(listed: DataFrame, universe: DataFrame, most_levels: int = 40) -> dict[str, Cascade]:
    """A cascade for each kind. listed(kind, key) and universe(kind, key), both distinct; a universe may or may not hold the
    listed keys. All kinds are built together, level by level."""
    counts, totals = _counts(listed), _counts(universe)
    levels: dict[str, list[tuple[int, int, list[int]]]] = {k: [] for k in counts}
    inside, outside = listed, universe
    for i in range(most_levels):
        if not counts:
            return {k: Cascade(v) for k, v in levels.items()}
        shapes = {}
        for k, n in counts.items():
            rate = min(0.5, n / (math.sqrt(2) * max(totals.get(k, 0), 1))) if i == 0 else 0.5
            hashes = max(1, math.ceil(-math.log2(rate)))
            shapes[k] = (max(64, math.ceil(n * hashes / math.log(2) / 64) * 64), hashes)
        at = inside.select("kind", F.explode(_by_kind({k: F.array(*[_bit(F.col("key"), i, j, bits) for j in range(hashes)]) for k, (bits, hashes) in shapes.items()})).alias("at"))
        value = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int")))
        words = {k: [0] * (bits // 64) for k, (bits, _) in shapes.items()}
        for r in at.groupBy("kind", F.floor(F.col("at") / 64).alias("word")).agg(value.alias("value")).collect():
            words[r["kind"]][r["word"]] = r["value"]
        for k in counts:
            levels[k].append((*shapes[k], words[k]))
        wrong = outside.filter(F.coalesce(_by_kind({k: _passes(F.col("key"), i, *levels[k][i]) for k in counts}), F.lit(False)))
        # the first false positives are told from listed keys once, while the cascades are built
        wrong = materialise(wrong.join(listed, ["kind", "key"], "left_anti") if i == 0 else wrong)
        counts = _counts(wrong)
        inside, outside = wrong, inside
    raise ValueError("the cascades do not end")


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """One cascade of listed(key) and universe(key)."""
    one = lambda keys: keys.select(F.lit("").alias("kind"), "key")
    return build_cascades(one(listed), one(universe)).get("", Cascade([]))


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    return (
        pages.withColumn("__rest", F.coalesce(rest, F.lit("")))
        .withColumn("__host", F.regexp_extract("__rest", r"^[^/?#]*", 0))
        .withColumn("path", F.regexp_extract(F.expr("substring(__rest, length(__host) + 1)"), r"^[^?#]*", 0))
        .withColumn("host", F.translate("__host", UPPER, LOWER))
        .drop("__rest", "__host")
    )


def key_of(labels: int, chars: int) -> Column:
    """The last labels of the host and the first characters of the path; null where there are fewer."""
    enough = (F.length("host") > 0) & (F.size(F.split("host", r"\.")) >= labels) & (F.length("path") >= chars)
    return F.when(enough, F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, chars)))


def _shapes(keys: Sequence[tuple[str, str]]) -> list[tuple[int, int]]:
    return sorted({(len(h.split(".")), len(p)) for h, p in keys})


def _listed(spark: SparkSession, keys: set[tuple[str, str]]) -> DataFrame:
    """kind and key as a table, from one constant."""
    text = json.dumps([{"kind": k, "key": key} for k, key in sorted(keys)])
    return spark.range(1).select(F.explode(F.from_json(F.lit(text), "array<struct<kind:string,key:string>>")).alias("k")).select("k.*")


def _lookups(urls: DataFrame, lists: dict[str, Sequence[tuple[str, str]]]) -> dict[str, Callable[[Column], Column]]:
    """By kind, a function from a key column to whether it is listed, exact for the keys that urls can give; one pass over urls."""
    out = {k: lambda key: F.lit(False) for k in lists}
    lists = {k: keys for k, keys in lists.items() if keys}
    if not lists:
        return out
    pair = lambda k, key: F.struct(F.lit(k).alias("kind"), key.alias("key"))
    given = urls.select(F.explode(F.array(*[pair(k, key_of(*shape)) for k, keys in lists.items() for shape in _shapes(keys)])).alias("k")).select("k.*")
    universe = materialise(given.filter("key IS NOT NULL").distinct())
    listed = _listed(urls.sparkSession, {(k, h + p) for k, keys in lists.items() for h, p in keys})
    return out | {k: c.contains for k, c in build_cascades(listed, universe).items()}


#: A fitting rule; structs compare by their first fields.
FOUND = "struct<length:int,host_length:int,rule:string,verdict:string>"


def _found(labels: int, chars: int, verdict: Column) -> Column:
    host_length = F.length(F.substring_index("host", ".", -labels))
    return F.struct((host_length + chars).alias("length"), host_length.alias("host_length"), key_of(labels, chars).alias("rule"), verdict.alias("verdict"))


def _verdicts(best: DataFrame, by_host: Column) -> DataFrame:
    return best.select("page_id", "host", "path", F.col("__best.rule").alias("rule"), F.coalesce(F.col("__best.verdict"), F.when(by_host, "block").otherwise("allow")).alias("verdict"))


def _judge_by_join(urls: DataFrame, rules: Sequence[tuple[str, str, str]], hosts: Sequence[str]) -> DataFrame:
    """The lists as tables: the distinct hosts and paths are taken apart into keys once, joined with the lists, and the best
    rule of each goes back to its urls. A host and path that many urls share is one row of that join."""
    listed = _listed(urls.sparkSession, {(v, h + p) for v, h, p in rules} | {("host", h) for h in hosts})
    shapes = [(k, n, False) for k, n in _shapes([(h, p) for _, h, p in rules])] + [(k, 0, True) for k, _ in _shapes([(h, "") for h in hosts])]
    places = urls.select("host", "path").distinct()
    of = F.array(*[F.struct(key_of(k, n).alias("key"), F.lit(h).alias("of_host"), _found(k, n, F.lit("")).alias("found")) for k, n, h in shapes])
    keys = places.select("host", "path", F.explode(of).alias("k")).select("host", "path", "k.*").filter("key IS NOT NULL")
    met = keys.join(listed, "key").filter((F.col("kind") == "host") == F.col("of_host"))
    rule = F.when(F.col("kind") != "host", F.struct("found.length", "found.host_length", "found.rule", F.col("kind").alias("verdict")))
    best = materialise(met.groupBy("host", "path").agg(F.max(rule).alias("__best"), F.max((F.col("kind") == "host")).alias("__host")))
    return _verdicts(urls.join(best, ["host", "path"], "left"), F.coalesce("__host", F.lit(False)))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, hosts: Sequence[str] = BLOCKED_HOSTS, max_listed: int = 100_000) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of pages(page_id, url)."""
    urls = with_host_and_path(pages.select("page_id", "url"))
    if len({h + p for _, h, p in rules} | set(hosts)) > max_listed:
        return _judge_by_join(urls, rules, hosts)
    names = {v: [(h, p) for kind, h, p in rules if kind == v] for v in ("allow", "block")}
    listed = _lookups(urls, {**names, "host": [(h, "") for h in hosts]})
    found = [F.when(listed[v](key_of(k, n)), _found(k, n, F.lit(v))) for v in ("allow", "block") for k, n in _shapes(names[v])]
    best = urls.withColumn("__best", F.array_max(F.array_compact(F.array(F.lit(None).cast(FOUND), *found))))
    by_host = F.lit(False)
    for k, _ in _shapes([(h, "") for h in hosts]):
        by_host = by_host | F.coalesce(listed["host"](key_of(k, 0)), F.lit(False))
    return _verdicts(best, by_host)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


SQL = f"""
WITH p AS (
 SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
u AS (
 SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(verdict, rhost, rpath) AS (VALUES {", ".join(str(r) for r in RULES)}),
b(bhost) AS (VALUES {", ".join(f"('{h}')" for h in BLOCKED_HOSTS)}),
f AS (
 SELECT u.page_id, u.host, u.path, rhost || rpath AS rule, verdict
 FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) = 1)
SELECT u.page_id, u.host, u.path, f.rule,
 coalesce(f.verdict, CASE WHEN EXISTS (SELECT 1 FROM b WHERE u.host = bhost OR ends_with(u.host, '.' || bhost)) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN f ON u.page_id = f.page_id
"""
