"""URL filters by link-graph propagation, with rules for hosts and paths.

Rules judge the urls they fit. The hosts they judge are the seeds: of a host, the share of pages that
rules allow is trust, the share that they block is distrust. Trust flows along links from host to
host (personalised PageRank from the trusted seeds), distrust against them (from the blocked seeds
to those that link to them). Both are divided among all that a host hands them to, so both shrink as the
graph grows; what judges a host is their ratio, distrust / (trust + distrust), which does not. A host
can raise its trust only through hosts that have some, and nobody can take it away: links from
unknown hosts add nothing to either.

A ratio says whom a host stands nearer to, not how much it has to do with either: one link among a
thousand to a blocked host, and no trust, is a ratio of 1. So distrust is propagated a second time as
a share, blame: of the links a host has, the share that leads to blamed hosts, damped. A host is
blocked if its ratio and its blame both exceed their thresholds; its verdict holds for the pages that
no rule fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restframe.llm.base import keep, query, table
from restframe.operators.skew import salted_join

DAMPING = 0.85
#: Largest change of a score, as a share of it, at which the propagation has settled, and rounds after which it
#: must have. As a share, since ratios of small scores decide too.
SETTLED = 1e-4
MAX_ROUNDS = 500
#: Thresholds of a host: more distrust than trust, and blame, which is 0.15 s for an unlinked host of which a
#: share s is blocked and 0.1275 for one that links to nothing but wholly blocked hosts, however many others do.
RATIO = 0.5
BLAME = 0.075
#: The rules of the query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def _lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def linked_hosts(html: Column) -> Column:
    """The hosts of a page's links; links without a host stay on the page's own."""
    return F.transform(F.regexp_extract_all(html, F.lit(_LINK), F.lit(1)), _lower)


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the longest rule that fits each different (host, path) it is given.

    A url meets the rules of the domains its host lies in, by equality of the domain and of as many
    characters of its path as a rule of that domain has. What is gathered for a domain are the lengths of
    its rules' paths, not its rules.
    """
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    split = rules.select(
        F.regexp_extract("rule", r"(?s)^([^/]*)", 1).alias("domain"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("prefix"),
        F.struct(
            F.length("rule").alias("size"),
            F.length(F.regexp_extract("rule", r"(?s)^([^/]*)", 1)).alias("host_size"),
            (F.col("verdict") == "block").alias("block"),
            "rule",
            "verdict",
        ).alias("it"),
    )
    split = split.groupBy("domain", "prefix").agg(F.max("it").alias("it"))
    lengths = split.groupBy("domain").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    known = salted_join(urls.select("host", "path", F.explode(domains).alias("domain")), lengths, ["domain"])
    cut = known.withColumn("length", F.explode("lengths")).where(F.col("length") <= F.length("path"))
    cut = cut.select("host", "path", "domain", F.substring("path", F.lit(1), F.col("length")).alias("prefix"))
    met = salted_join(cut, split, ["domain", "prefix"])
    return met.groupBy("host", "path").agg(F.max("it").alias("it")).select("host", "path", "it.rule", "it.verdict")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust, blame) from ``edges`` (src, dst, n) and ``seeds`` (host, trust, distrust).

    Links of a host to itself carry nothing. Rounds go on until no score changes by more than
    ``SETTLED`` of itself; each is written to the shared folder. The edges of a hub are spread over tasks.
    """
    edges = edges.where("src <> dst").groupBy("src", "dst").agg(F.sum("n").alias("n"))
    edges = keep(edges, "edges")
    leaving = keep(edges.groupBy("src").agg(F.sum("n").alias("leaving"), F.count("*").alias("n")), "leaving")
    coming = keep(edges.groupBy("dst").agg(F.sum("n").alias("coming"), F.count("*").alias("n")), "coming")
    shares = salted_join(edges.withColumnRenamed("n", "links"), leaving.select("src", "leaving"), ["src"], counts=leaving)
    shares = salted_join(shares, coming.select("dst", "coming"), ["dst"], counts=coming)
    flows = keep(
        shares.select("src", "dst", (F.col("links") / F.col("leaving")).alias("forth"), (F.col("links") / F.col("coming")).alias("back")),
        "flows",
    )
    nodes = flows.select(F.col("src").alias("host")).unionByName(flows.select(F.col("dst").alias("host"))).distinct()
    base = nodes.join(seeds, "host", "full").select(
        "host",
        (F.coalesce("trust", F.lit(0.0)) * (1 - damping)).alias("base_trust"),
        (F.coalesce("distrust", F.lit(0.0)) * (1 - damping)).alias("base_distrust"),
    )
    base = keep(base, "seeds")
    seeded = {"trust": "base_trust", "distrust": "base_distrust", "blame": "base_distrust"}
    now = base.select("host", *[F.col(seeded[x]).alias(x) for x in seeded])
    if flows.isEmpty():
        return now
    nothing = F.lit(0.0)
    for _ in range(MAX_ROUNDS):
        scores = now.select("host", *seeded)
        forth = salted_join(flows, scores.withColumnRenamed("host", "src"), ["src"], counts=leaving).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("forth")).alias("trust"), nothing.alias("distrust"), nothing.alias("blame")
        )
        # Divided among the hosts that link to one, and as a share of the links that each of these has.
        back = salted_join(flows, scores.withColumnRenamed("host", "dst"), ["dst"], counts=coming).select(
            F.col("src").alias("host"),
            nothing.alias("trust"),
            (F.col("distrust") * F.col("back")).alias("distrust"),
            (F.col("blame") * F.col("forth")).alias("blame"),
        )
        got = forth.unionByName(back).groupBy("host").agg(*[F.sum(x).alias(f"got_{x}") for x in seeded])
        old = scores.select("host", *[F.col(x).alias(f"old_{x}") for x in seeded])
        now = keep(
            base.join(got, "host", "left")
            .join(old, "host")
            .select(
                "host",
                *[(F.col(seeded[x]) + F.lit(damping) * F.coalesce(f"got_{x}", nothing)).alias(x) for x in seeded],
                *[f"old_{x}" for x in seeded],
            ),
            "scores",
        )
        change = F.greatest(*[F.when(F.col(x) > 0, F.abs(F.col(x) - F.col(f"old_{x}")) / F.col(x)).otherwise(0.0) for x in seeded])
        if now.agg(F.max(change)).first()[0] <= SETTLED:
            return now.select("host", *seeded)
    raise RuntimeError("the propagation did not settle")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    blame: float = BLAME,
) -> DataFrame:
    """One row for each row of ``pages``: key, host, path, rule, verdict, and trust, distrust and blame of the host.

    ``rules`` has the columns rule (host and path, like ``example.org/a/``) and verdict (allow or
    block). A rule fits its host and subdomains where the path starts with the rule's; the longest
    wins, then the longer host, then block. A null url, or one without ``://``, has an empty host and
    path; pages without a rule whose host no seed reaches are allowed. Null html has no links.
    Repeated rows are judged alike; other columns are left out.
    """
    parsed = pages.select(
        F.col(f"`{key}`").alias("key"),
        host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"),
        F.coalesce(linked_hosts(F.col(f"`{html}`")), F.array().cast("array<string>")).alias("links"),
    )
    parsed = keep(parsed, "pages")
    # The narrow columns only, so that the rows of hot hosts are small when they are joined.
    counts = keep(parsed.groupBy("host", "path").agg(F.count("*").alias("n")), "urls")
    fits = fitting_rules(counts.select("host", "path"), rules)
    ruled = salted_join(parsed.select("key", "host", "path"), fits, ["host", "path"], "left", counts=counts)
    ruled = keep(ruled.select("key", "host", "path", "rule", "verdict"), "ruled")
    seeds = ruled.groupBy("host").agg(
        (F.count_if(F.col("verdict") == "allow") / F.count("*")).alias("trust"),
        (F.count_if(F.col("verdict") == "block") / F.count("*")).alias("distrust"),
    )
    links = parsed.select("host", F.explode("links").alias("dst")).groupBy(F.col("host").alias("src"), "dst")
    scores = propagate(links.agg(F.count("*").alias("n")).where("src <> '' and dst <> ''"), seeds, DAMPING)
    far = (F.col("distrust") > F.lit(ratio) * (F.col("trust") + F.col("distrust"))) & (F.col("blame") > blame)
    judged = salted_join(ruled, scores, ["host"], "left", counts=counts.groupBy("host").agg(F.sum("n").alias("n")))
    return judged.select(
        F.col("key").alias(key), "host", "path", "rule",
        F.coalesce("verdict", F.when(far, "block").otherwise("allow")).alias("verdict"), "trust", "distrust", "blame",
    )


@query("op1_link_graph")
def op1_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of pages by the four rules, else by what the link graph says of its host."""
    rules = spark.createDataFrame(list(RULES), "rule string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)
