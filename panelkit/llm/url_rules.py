"""Operator 4: url rules by a sort-merge range join, in DataFrame functions only.

A rule (host, path) fits its host and all subdomains where the url's path begins with the rule's. With the host's labels
reversed and closed by a dot (``com.example.``), a rule's hosts are the keys that begin with its own: an interval. For one
rule path the intervals are nested or apart. Urls are reduced to distinct (host, beginnings of the path as long as some
rule's path) before any shuffle; each gives one probe per beginning.

Rules and probes are swept together, ordered by key within (path, top label, salt). A rule's interval opens a level of the
stack and closes it; the running sum of +1 and -1 is the depth, and slot d of the stack holds the last rule opened at depth
d, so the innermost rule around a probe is the last one opened at the probe's depth. Both are window functions over sorted
rows, which spill; a crowded top label is spread over ``salts`` sweeps, each with its own copy of that label's rules.

Answers go back to the rows by (host, beginnings, salt): a row's salt is a hash of its values, and an answer is repeated
for the salts that occur among its rows, so a host with a third of all rows is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 16
_MASK_BITS = 31
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The order of events with one key: what ends here, then what begins here, then the probes.
_CLOSE, _OPEN, _PROBE = 0, 1, 2


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(rest, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    at = F.instr(rest, F.lit("/"))
    return F.when(at > 0, rest.substr(at, F.length(rest))).otherwise(F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def _top(key: Column) -> Column:
    return F.substring_index(key, ".", 1)


def _events(rules: DataFrame, probes: DataFrame, salts: int) -> DataFrame:
    """Rows (path, top, salt, key, kind, rule, verdict): every rule's opening and closing in all salts, every probe in one."""
    fan = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    both = F.explode(
        F.array(
            F.struct(F.col("key"), F.lit(_OPEN).alias("kind")),
            # A key that begins with the rule's sorts below the rule's with "/", the next sign, in place of the last dot.
            F.struct(F.concat(F.expr("substr(key, 1, length(key) - 1)"), F.lit("/")).alias("key"), F.lit(_CLOSE).alias("kind")),
        )
    ).alias("e")
    edges = rules.select("path", _top(F.col("key")).alias("top"), fan, "rule", "verdict", both)
    edges = edges.select("path", "top", "salt", "e.key", "e.kind", "rule", "verdict", F.lit(None).cast("string").alias("host"))
    text = lambda: F.lit(None).cast("string")
    asked = probes.select(
        "path",
        _top(F.col("key")).alias("top"),
        F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int").alias("salt"),
        "key",
        F.lit(_PROBE).alias("kind"),
        text().alias("rule"),
        text().alias("verdict"),
        "host",
    )
    return edges.unionByName(asked)


def innermost(rules: DataFrame, probes: DataFrame, salts: int = SALTS) -> DataFrame:
    """For distinct probes (path, host, key): the rule of that path with the narrowest interval around the key, if any.

    ``rules``: path, key, rule, verdict, one row per (path, key).
    """
    sweep = Window.partitionBy("path", "top", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _CLOSE, -1).otherwise(0)
    swept = _events(rules, probes, salts).withColumn("depth", F.sum(step).over(sweep))
    slot = Window.partitionBy("path", "top", "salt", "depth").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.when(F.col("kind") == _OPEN, F.struct("rule", "verdict"))
    swept = swept.filter((F.col("kind") != _CLOSE) & (F.col("depth") > 0)).withColumn("top_rule", F.last(opened, ignorenulls=True).over(slot))
    return swept.filter(F.col("kind") == _PROBE).select("path", "host", "top_rule.rule", "top_rule.verdict")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    *,
    default: str = DEFAULT,
    salts: int = SALTS,
) -> DataFrame:
    """``pages`` with host, path, rule (as ``host + path``, null if none fits) and verdict; columns so called are replaced.

    ``rules`` has host, path and verdict. The longest fitting rule wins (by characters of host and path, then by text);
    of equal rules ``block`` wins over ``allow``. Rules without a host are ignored; a null path is empty. Urls that are
    null or have no ``://`` get empty host and path and the default verdict. Rows are kept as they are, repeated ones too.
    ``salts`` is at most 31.
    """
    if not 0 < salts <= _MASK_BITS:
        raise ValueError(f"salts must lie in 1..{_MASK_BITS}")
    added = ["host", "path", "rule", "verdict"]
    own = [c for c in pages.columns if c.lower() not in added]
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    table = (
        rules.select(host.alias("h"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .filter("h is not null and h != ''")
        .groupBy("h", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select("path", host_key(F.col("h")).alias("key"), F.concat("h", "path").alias("rule"), "verdict")
    )
    # The lengths of rule paths are as many as a url may be long at most, however many rules there are.
    sizes = sorted(r[0] for r in table.select(F.length("path")).distinct().collect())
    beginnings = [F.when(F.length("__path") >= n, F.substring("__path", 1, n)) for n in sizes]
    # The caller's columns travel in one struct, so that none can clash with those added here.
    plain = [F.col(f"`{f.name}`") for f in pages.schema if f.name in own and isinstance(f.dataType, T.AtomicType)]
    kept = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(own)] or [F.lit(0)])
    url, salt = F.col(f"`{url_col}`"), F.pmod(F.xxhash64(url_path(F.col(f"`{url_col}`")), *plain), F.lit(salts)).cast("int")
    judged = pages.select(kept.alias("__kept"), url_host(url).alias("__host"), url_path(url).alias("__path"), salt.alias("__salt"))
    judged = judged.withColumn("__starts", F.array_compact(F.array(*beginnings)) if sizes else F.array().cast("array<string>"))
    # One bit for each salt among a group's rows.
    marked = judged.select(F.col("__host").alias("host"), F.col("__starts").alias("starts"), F.expr("shiftleft(1, __salt)").alias("mask"))
    asked = marked.groupBy("host", "starts").agg(F.bit_or("mask").alias("mask"))
    each = asked.select("host", "starts", "mask", F.explode("starts").alias("path"))
    probes = each.select("path", "host", host_key(F.col("host")).alias("key")).distinct()
    found = innermost(table, probes, salts)
    longest = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    answers = each.join(found, ["path", "host"]).groupBy("host", "starts").agg(longest, F.bit_or("mask").alias("mask"))
    present = F.expr(f"explode(filter(sequence(0, {salts - 1}), s -> (mask & shiftleft(1, s)) != 0))").alias("__salt")
    answers = answers.select(F.col("host").alias("__host"), F.col("starts").alias("__starts"), present, "best.rule", "best.verdict")
    out = judged.join(answers, ["__host", "__starts", "__salt"], "left")
    verdict = F.coalesce("verdict", F.lit(default)).alias("verdict")
    back = [F.col(f"__kept.c{k}").alias(c) for k, c in enumerate(own)]
    return out.select(*back, F.col("__host").alias("host"), F.col("__path").alias("path"), "rule", verdict)


#: The rules that the registered query applies: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)")
    return judge_urls(pages, rules).drop("url")


OP4_SQL = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS k
  FROM q, rules WHERE (host = h OR suffix(host, '.' || h)) AND prefix(path, p))
SELECT q.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM q LEFT JOIN fits ON q.page_id = fits.page_id AND k = 1
"""
