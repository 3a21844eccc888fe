"""URL filters: rules first, link-graph propagation for the rest.

Rules name a host (with all its subdomains) and a path prefix, and the longest that fits decides.
A page without a rule gets the verdict of its host. Hosts are judged over the host graph of the
pages' links: trust walks forward from hosts with allowed pages (personalised PageRank, restarting
at them in proportion to their allowed pages), distrust walks backward from hosts with blocked
pages, so who links to a blocked host is held responsible. A host is blocked if its distrust
exceeds `RATIO` times its trust and reaches `SHARE` of its number of pages: one bad page among
many does not condemn a host.

Links are aggregated to weighted host edges before anything else (map-side combined, so a host
that holds a third of all pages costs one row per task and target), and dealt by tail once for all
rounds. Both walks run in one join and one aggregation per round over (walk, host) keys, which lie
as the next join needs them, so a round shuffles only what it moves. A reliable checkpoint cuts
every `ROUNDS` rounds, until no host can change by more than `TOLERANCE` pages; more than `MOST` rounds are an error.
The walk at a host without links ahead returns to its seeds, so no mass is lost.
Only html, url and page_id are read, and html only to find links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import checkpointed, checkpointed_by
from corvane.sources.tables import table

#: (verdict, host and path prefix)
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: ROUNDS lie between two checkpoints, where the walks are tested for convergence.
DAMPING, ROUNDS, MOST = 0.85, 8, 400
#: The sum over all hosts of what trust or distrust, in pages, still lacks at most.
TOLERANCE = 1e-4
RATIO, SHARE = 1.0, 0.1
#: Host tables of up to that many rows are sent to all executors; larger ones are joined by shuffling.
BROADCAST_HOSTS = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)\bhref\s*+=\s*+[\"']?+\s*+(?:https?:)?+//([^/?#\"'\s>]++)"


def with_parts(pages: DataFrame) -> DataFrame:
    """`pages` with host and path of the url (replacing columns of these names)."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def matching_rule(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits host and path; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): absolute links between different hosts, counted."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    linked = with_parts(pages.select("url", "html")).select("host", F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(1))).alias("to"))
    return (
        linked.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst"))
        .where("src <> dst and src <> '' and dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) of both walks from seeds (host, allowed, blocked), run to convergence.

    Restart mass is a host's number of allowed or blocked pages, so the two walks are on one scale and
    each sums to its seeds; without any links a host keeps its own. A walk that comes to a host without
    links ahead restarts: that only multiplies what the walks that end there give by a number, so it is
    done once, at the end, by scaling each walk to the sum of its seeds.

    Before that a host's mass is the sum of what flows to it over 0, 1, 2, ... links; `flow` is the last
    of these terms. All flow of one round is at most `damping` times that of the round before, so later
    rounds add at most flow * damping / (1 - damping) in all; the walks end where that is within
    `tolerance`, the summed error of all hosts.
    """
    walks = F.array(
        F.struct(F.lit(True).alias("forward"), F.col("allowed").cast("double").alias("mass")),
        F.struct(F.lit(False).alias("forward"), F.col("blocked").cast("double").alias("mass")),
    )
    rank = checkpointed(seeds.select("host", F.inline(walks)).where("mass > 0").withColumn("flow", F.col("mass")))
    both = F.array(
        F.struct(F.lit(True).alias("forward"), F.col("src").alias("tail"), F.col("dst").alias("head")),
        F.struct(F.lit(False).alias("forward"), F.col("dst").alias("tail"), F.col("src").alias("head")),
    )
    arcs = edges.select("weight", F.inline(both))
    total = arcs.groupBy("forward", "tail").agg(F.sum("weight").alias("total"))
    arcs = arcs.join(total, ["forward", "tail"]).select("forward", "tail", "head", (F.col("weight") / F.col("total")).alias("share"))
    arcs = checkpointed_by(arcs, "forward", "tail")
    base, done = rank.withColumn("flow", F.lit(0.0)), 0
    while (rank.agg(F.sum("flow")).first()[0] or 0.0) * damping / (1 - damping) > tolerance:
        if done >= MOST:
            raise RuntimeError(f"the walks did not settle within {MOST} rounds")
        for _ in range(rounds):
            carried = [(F.col(c) * F.col("share") * damping).alias(c) for c in ("mass", "flow")]
            moved = arcs.join(rank.withColumnRenamed("host", "tail"), ["forward", "tail"]).select(F.col("head").alias("host"), "forward", *carried)
            rank = base.unionByName(moved).groupBy("forward", "host").agg(F.sum("mass").alias("mass"), F.sum("flow").alias("flow"))
        rank, done = checkpointed(rank), done + rounds
    scale = base.groupBy("forward").agg(F.sum("mass").alias("seeds")).join(rank.groupBy("forward").agg(F.sum("mass").alias("all")), "forward")
    scaled = rank.join(F.broadcast(scale), "forward").select("host", "forward", (F.col("mass") * F.col("seeds") / F.col("all")).alias("mass"))  # two rows
    return scaled.groupBy("host").agg(
        F.sum(F.when(F.col("forward"), F.col("mass")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("forward"), 0.0).otherwise(F.col("mass"))).alias("distrust"),
    )


def filter_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    ratio: float = RATIO,
    share: float = SHARE,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust for every row of `pages`.

    A null url, or one without `://`, has an empty host and path: no rule fits, no seed or edge
    names it, and it is allowed. So is a host that neither walk reaches. Repeated rows count as
    pages of their own. Null html has no links. Other columns are not looked at.
    """
    rule, verdict = matching_rule(rules)
    judged = with_parts(pages.select("page_id", "url")).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    seeds = (
        judged.where("host <> ''")
        .groupBy("host")
        .agg(F.count("*").alias("n_pages"), F.count_if(F.col("by_rule") == "allow").alias("allowed"), F.count_if(F.col("by_rule") == "block").alias("blocked"))
    )
    seeds = checkpointed(seeds)
    reached = propagate(seeds, checkpointed(host_edges(pages)), damping, rounds)
    hosts = checkpointed(seeds.join(reached, "host").select(F.col("host").alias("_host"), "n_pages", "trust", "distrust"))
    if hosts.count() <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    placed = judged.join(hosts, F.col("host") == F.col("_host"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_graph = F.when((distrust > ratio * trust) & (distrust >= share * F.col("n_pages")), "block").otherwise("allow")
    return placed.select(
        F.col("page_id"), "host", "path", "rule", F.coalesce("by_rule", by_graph).alias("verdict"), trust.alias("trust"), distrust.alias("distrust")
    )


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): orders as pages of customers' hosts that link to hosts of other customers.

    A tenth of the hosts is under .com, of whose pages those of low priority are blocked by rule, and a
    tenth under .org, of whose pages all are allowed; the rest has no rule. A twentieth of the hosts
    links to one .com host each, and seeds alone would allow all that these hosts have.
    """
    orders = table(spark, sf_dir, "orders")
    kind = lambda key: F.when(key % 10 == 0, ".com").when(key % 10 == 1, ".org").otherwise(".net")
    host = lambda key: F.concat(F.lit("c"), key.cast("string"), kind(key))
    own = F.col("o_custkey")
    far = F.when(own % 20 == 3, own + 7).otherwise((own * 7 + F.col("o_orderkey") % 3) % 1500 + 1)
    path = F.when(F.col("o_orderpriority").rlike("^[45]"), "/de/").otherwise("/x/")
    link = F.concat(F.lit('<p>a</p><a href="https://'), host(far), F.lit('/y">b</a>'))
    return orders.select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit("https://"), host(own), path, F.col("o_orderkey")).alias("url"), link.alias("html"))


def url_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over pages that link across hosts: host, n_pages, n_blocked, n_ruled (pages that a rule decides), trust and distrust."""
    judged = filter_urls(linked_pages(spark, sf_dir))
    return judged.groupBy("host").agg(
        F.count("*").alias("n_pages"),
        F.count_if(F.col("verdict") == "block").alias("n_blocked"),
        F.count_if(F.col("rule").isNotNull()).alias("n_ruled"),
        F.round(F.max("trust"), 2).alias("trust"),
        F.round(F.max("distrust"), 2).alias("distrust"),
    )


#: host, path and rule, which `url_rules` returns.
RULES_SQL = rf"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS t FROM pages),
part AS (SELECT page_id, regexp_extract(t, '^[^/?#]*') AS h, t FROM rest),
place AS (SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(t, length(h) + 1), '^[^?#]*') AS path FROM part),
rule(r) AS (VALUES {", ".join(f"('{text}')" for _, text in RULES)}),
fit AS (
  SELECT page_id, host, path, arg_max(r, length(r)) FILTER (
    (host = split_part(r, '/', 1) OR ends_with(host, '.' || split_part(r, '/', 1))) AND starts_with(path, substr(r, instr(r, '/')))) AS rule
  FROM place CROSS JOIN rule GROUP BY ALL)
SELECT * FROM fit
"""


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the operator's result that SQL can express."""
    return op1_url_filters(spark, sf_dir).select("page_id", "host", "path", "rule")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
