"""URL filters: allow and block rules, and for urls that no rule fits, trust carried by the link graph.

Rules name a host and a path; a rule fits its host and all subdomains when the url's path starts
with the rule's, and the longest rule wins (of equally long ones that with the longer host).

Hosts whose pages rules allow are trusted seeds, those whose pages rules block are distrusted
seeds, each page a unit of mass. Personalised PageRank carries trust along the links between
hosts, and distrust against them: who links to blocked hosts is suspect. A host is blocked when its
distrust is ``RATIO`` times its trust or more, and at least a ``LEAST``-th of a unit for each of its own
pages. Both are relative: neither other hosts' seeds nor a corpus in which every page stands k times
change a verdict.

Mass goes out in waves, host by host. A host keeps its share of every wave and passes on the rest;
what is left of a wave at a host goes no further when it is below a ``DROP``-th of a unit. Waves go on until
none is left, however long the chains of links are. Masses are whole numbers and divisions round
down, so results do not depend on the order of sums. Links are counted per pair of hosts before
anything is joined. All of it is column expressions.

Results for odd rows: null urls and urls without ``://`` have an empty host and path, fit no rule
and are allowed. A null html has no links. Very long html is searched whole, in time that grows with its
length; a link is an ``a`` tag up to its first ``<`` or ``>``. Repeated rows are judged each and count each as
links and seeds. Equally long rules that both fit: the one with the longer host. Distrust that ties with
trust blocks. Other columns are ignored. With no pages there are no hosts and no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table, with_group, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)<a\s[^<>]*?href\s*=\s*[\"']?(?:https?:)?//([^/\"'?#>\s]+)"
#: Mass of one seed page.
UNIT = 1_000_000
DAMPING_PCT = 85
RATIO, LEAST = 1, 1000
#: A wave at a host ends when it is smaller than this part of a seed page.
DROP = 10_000
#: Rules are a parameter and become part of the plan.
MAX_RULES = 1000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.regexp_replace(_rest(url), r"^[^/?#]*", ""), r"^[^?#]*", 0)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (length, host length, rule, verdict) of the longest rule that fits, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: they become part of every plan")
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(
                F.lit(len(r.text)).alias("length"), F.lit(len(r.host)).alias("host_length"),
                F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"),
            ),
        )
        for r in rules
    ]
    none = F.lit(None).cast("struct<length:int,host_length:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fits)) if fits else none


def ruled(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, by_rule)."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    best = parts.withColumn("_best", best_rule(F.col("host"), F.col("path"), rules))
    return best.select("page_id", "host", "path", F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("by_rule"))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): pages of one host that link to another."""
    found = pages.where("html is not null").select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER)))).alias("dst"),
    )
    return found.where("src <> '' and dst <> src").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def carried(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(kind, host, mass) from stored ``seeds`` (kind, host, mass); kind trust follows links, distrust goes against them."""
    ahead = links.select(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "n")
    back = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), "n")
    edges = ahead.union(back)
    outward = edges.groupBy("kind", "from").agg(F.sum("n").alias("all_n"))
    edges = written(edges.join(outward, ["kind", "from"]), "edges")
    # decimals: masses times counts outgrow 64 bits
    moved = F.expr(f"cast(cast(mass as decimal(19,0)) * cast(n as decimal(18,0)) div cast(all_n as decimal(19,0)) * {DAMPING_PCT} div 100 as bigint)")
    wave, kept = seeds, None
    while True:
        own = wave.select("kind", "host", F.expr(f"mass * {100 - DAMPING_PCT} div 100").alias("mass"))
        kept = own if kept is None else kept.union(own).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        kept = written(kept, "masses")
        gone = wave.withColumnRenamed("host", "from").join(edges, ["kind", "from"])
        gone = gone.select("kind", F.col("to").alias("host"), moved.alias("mass")).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        wave = written(gone.where(F.col("mass") * DROP >= UNIT), "wave")
        if wave.isEmpty():
            return kept


def host_verdicts(hosts: DataFrame, links: DataFrame) -> DataFrame:
    """(host, m, by_host, trust, distrust) of ``hosts`` (host, m pages, allowed, blocked)."""
    both = hosts.select(
        "host", F.explode(F.create_map(F.lit("trust"), F.col("allowed"), F.lit("distrust"), F.col("blocked"))).alias("kind", "n")
    ).where("n > 0")
    seeds = written(both.select("kind", "host", (F.col("n") * UNIT).alias("mass")), "seeds")
    masses = carried(seeds, links).groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass")).otherwise(0)).alias("distrust"),
    )
    enough = F.col("distrust").cast("decimal(38,0)") * LEAST >= F.col("m").cast("decimal(20,0)") * UNIT
    bad = enough & (F.col("distrust") >= RATIO * F.col("trust"))
    return hosts.join(masses, "host", "left").select(
        "host", "m", F.when(F.coalesce(bad, F.lit(False)), "block").otherwise("allow").alias("by_host"),
        F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    each = written(ruled(pages, rules), "ruled")
    hosts = written(
        each.where("host <> ''").groupBy("host").agg(
            F.count(F.lit(1)).alias("m"),
            F.count_if(F.col("by_rule") == "allow").alias("allowed"),
            F.count_if(F.col("by_rule") == "block").alias("blocked"),
        ),
        "hosts",
    )
    verdicts = written(host_verdicts(hosts, written(host_links(pages), "links")), "verdicts")
    return with_group(each, verdicts, "host", "m").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict"), "trust", "distrust"
    )


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    return f"""
WITH RECURSIVE u AS (
    SELECT page_id, html, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
    SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM u
), rules(host, path, verdict) AS (VALUES {", ".join(str(tuple(r)) for r in RULES)}
), fit AS (
    SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path) * 1000 + length(r.host)) AS rule,
        arg_max(r.verdict, length(r.host || r.path) * 1000 + length(r.host)) AS verdict
    FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY page_id
), e AS (SELECT p.page_id, p.host, p.path, f.rule, f.verdict FROM p LEFT JOIN fit f USING (page_id)
), link AS (
    SELECT host AS src, translate(unnest(list_distinct(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1))), '{UPPER}', '{LOWER}') AS dst FROM p
), pair AS (SELECT src, dst, count(*) AS n FROM link WHERE src <> '' AND dst <> src GROUP BY ALL
), edge AS (
    SELECT kind, a, b, n, sum(n) OVER (PARTITION BY kind, a) AS all_n FROM (
        SELECT 'trust' AS kind, src AS a, dst AS b, n FROM pair UNION ALL SELECT 'distrust', dst, src, n FROM pair)
), seed AS (
    SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) * {UNIT} AS mass
    FROM e WHERE verdict IS NOT NULL AND host <> '' GROUP BY ALL
), wave AS (
    SELECT kind, host, CAST(mass AS HUGEINT) AS mass, 0 AS k FROM seed
    UNION ALL
    SELECT edge.kind, b, CAST(sum(mass * n // CAST(all_n AS HUGEINT) * {DAMPING_PCT} // 100) AS HUGEINT), k + 1
    FROM wave JOIN edge ON wave.kind = edge.kind AND host = a GROUP BY edge.kind, b, k
    HAVING sum(mass * n // CAST(all_n AS HUGEINT) * {DAMPING_PCT} // 100) * {DROP} >= {UNIT}
), size AS (SELECT host, count(*) AS m FROM e GROUP BY host
), v AS (
    SELECT host, coalesce(sum(mass * {100 - DAMPING_PCT} // 100) FILTER (kind = 'trust'), 0) AS t,
        coalesce(sum(mass * {100 - DAMPING_PCT} // 100) FILTER (kind = 'distrust'), 0) AS d FROM wave GROUP BY host)
SELECT page_id, e.host, path, rule,
    coalesce(verdict, CASE WHEN d * {LEAST} >= m * {UNIT} AND d >= {RATIO} * t THEN 'block' ELSE 'allow' END) AS verdict
FROM e LEFT JOIN v ON e.host = v.host LEFT JOIN size ON e.host = size.host
"""


ORACLE_OP9 = _oracle()
