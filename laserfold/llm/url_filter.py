"""URL rules and link-graph verdicts, in DataFrame functions only.

Rules (host, path, allow or block) fit a host and its subdomains when the path starts
with theirs; the longest wins. Pages without a rule get their host's verdict:

- Links of all pages give weighted host → host edges, aggregated before they travel. In
  the graph a host goes without user and port, on both ends.
- Every page allowed by rule makes its host a trusted seed, every page blocked by rule a
  distrusted seed, with the share of such pages among the host's pages as weight.
- Personalised PageRank carries trust along the edges from the trusted seeds, and
  distrust against the edges from the blocked seeds (who links to bad hosts is suspect).
  The edges are dealt to tasks by src once (a src with very many edges to several tasks)
  and kept there, so a round moves only scores: one join and one aggregation, written to
  the shared folder. Lost kept edges are made again from their written table. Rounds go on until the scores move by less than `tolerance` in sum, or by less than
  a small part of the threshold below if that is smaller, as on large graphs; meeting
  `max_rounds` before that is an error.
- A host is blocked when its distrust is above its trust and above `threshold` of an even
  share (1 / hosts). A host's own seed counts in this comparison only if more than half
  of its pages have that verdict (its ruled pages are decided by the rules); what reaches
  it over links always counts.

Results: a null url, or one without "://", has an empty host and path, fits no rule and
is allowed. A null html has no links. Null page_ids and repeated rows are judged like
others. Rules of equal length: the later in (host + path) order wins. Very long urls and
html are read whole. Other columns are ignored; an empty table gives no rows. Without seeds (or
links) all scores but the seeds' own are 0, and pages without a rule are allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laserfold.llm.common import column, read_back
from laserfold.runtime import hot_keys, store

DAMPING = 0.85
# Far above what damping needs; the change shrinks to 0.85 of the last with each round.
MAX_ROUNDS = 500
TOLERANCE = 1e-4
THRESHOLD = 0.1

Rule = tuple[str, str, str]  # verdict, host, path


def _lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"(?s)\A([^/?#]*)", 1))


def node_of(host: Column) -> Column:
    """The host without user and port, by which links and pages meet in the graph."""
    return F.regexp_replace(host, r"(?s)^.*@|:\d*$", "")


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"(?s)\A[^/?#]*(/[^?#]*)", 1)


def rule_name(rule: Rule) -> str:
    return rule[1] + rule[2]


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: (len(rule_name(r)), rule_name(r)))
    for rule in ranked:
        fits = ((host == rule[1]) | F.endswith(host, F.lit("." + rule[1]))) & F.startswith(
            path, F.lit(rule[2])
        )
        name = F.when(fits, F.lit(rule_name(rule))).otherwise(name)
        verdict = F.when(fits, F.lit(rule[0])).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): how many links lead from one host to another."""
    html = F.coalesce(F.col("html"), F.lit(""))
    targets = F.regexp_extract_all(
        html, F.lit(r"(?i)\bhref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"), 1
    )
    links = pages.where(F.col("node") != "").select(
        F.col("node").alias("src"), F.explode(F.array_distinct(targets)).alias("target")
    )
    full = F.when(F.startswith("target", F.lit("//")), F.concat(F.lit("http:"), "target")).otherwise(
        F.col("target")
    )
    named = links.select("src", node_of(host_of(full)).alias("dst"))
    return (
        named.where((F.col("dst") != "") & (F.col("dst") != F.col("src")))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def seeds(judged: DataFrame) -> DataFrame:
    """(host, good, bad) with the seed weight of every host, each at most 1."""
    n = F.count(F.lit(1))
    allowed, blocked = (F.count(F.when(F.col("by_rule") == v, 1)) / n for v in ("allow", "block"))
    nodes = judged.where("node != ''").groupBy(F.col("node").alias("host"))
    return nodes.agg(allowed.alias("good"), blocked.alias("bad"))


def _dealt(edges: DataFrame, task_rows: int | None) -> tuple[DataFrame, DataFrame]:
    """Edges kept by (src, salt), and the table of srcs with several salts: host, salts.

    The number of partitions is fixed, so the join of each round finds the edges in
    place and shuffles the scores alone."""
    hot = hot_keys(edges, ["src"], task_rows).df
    salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int"), F.lit(0))
    salted = edges.join(F.broadcast(hot), "src", "left").withColumn("salt", salt).drop("salts")
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = salted.repartition(parts, "src", "salt").persist()
    kept.count()  # only then does Spark know how the kept rows lie
    return kept, hot.withColumnRenamed("src", "host")


def _moved(kept: DataFrame, hot: DataFrame, scores: DataFrame, damping: float) -> DataFrame:
    """What the scores send along the kept edges, summed by host."""
    # Only scores of hosts with several salts are repeated.
    every = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    spread = scores.join(F.broadcast(hot), "host", "left").select("host", "score", F.explode(every).alias("salt"))
    met = kept.join(spread, (kept["src"] == spread["host"]) & (kept["salt"] == spread["salt"]))
    return met.groupBy(F.col("dst").alias("host")).agg(
        F.sum(damping * F.col("share") * F.col("score")).alias("score")
    )


def propagate(
    edges: DataFrame,
    seed: DataFrame,
    *,
    damping: float = DAMPING,
    max_rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
    task_rows: int | None = None,
) -> DataFrame:
    """Personalised PageRank: (host, score) of hosts with a score, from seeds (host, weight).

    `edges` are (src, dst, share) with the shares of a src adding up to 1. Seed weights
    are scaled to a sum of 1; what reaches a host without edges ends there."""
    total = seed.agg(F.sum("weight")).first()[0]
    if not total:
        return seed.select("host", F.col("weight").alias("score")).where("1 = 0")
    start = store(
        seed.where("weight > 0").select("host", (F.col("weight") / total).alias("score")), "seeds"
    ).df
    kept, hot = _dealt(edges, task_rows)
    try:
        return _rounds(kept, hot, start, damping, max_rounds, tolerance)
    finally:
        kept.unpersist()


def _rounds(kept, hot, start, damping: float, max_rounds: int, tolerance: float) -> DataFrame:
    scores = start
    first = start.select("host", ((1 - damping) * F.col("score")).alias("score"))
    for _ in range(max_rounds):
        moved = _moved(kept, hot, scores, damping)
        fresh = moved.unionByName(first).groupBy("host").agg(F.sum("score").alias("score"))
        both = fresh.join(scores.withColumnRenamed("score", "before"), "host", "full")
        now, before = F.coalesce("score", F.lit(0.0)), F.coalesce("before", F.lit(0.0))
        written = store(
            both.select("host", now.alias("score"), before.alias("before")),
            "ranks",
            change=F.coalesce(F.sum(F.abs(now - before)), F.lit(0.0)),
        )
        scores = written.df.where("score > 0").select("host", "score")
        if written.metrics["change"] < tolerance:
            return scores
    raise RuntimeError(f"scores did not settle in {max_rounds} rounds")


def _shares(edges: DataFrame, src: str, dst: str) -> DataFrame:
    turned = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), "weight")
    sums = turned.groupBy("src").agg(F.sum("weight").alias("sum"))
    return turned.join(sums, "src").select("src", "dst", (F.col("weight") / F.col("sum")).alias("share"))


def host_verdicts(
    edges: DataFrame, seed: DataFrame, *, threshold: float = THRESHOLD, **options
) -> DataFrame:
    """(host, trust, distrust, host_verdict) of every host in `seed`."""
    n = max(1, seed.count())
    # What is still to move then is less than a tenth of the threshold in sum.
    damping = options.get("damping", DAMPING)
    least = 0.1 * threshold / n * (1 - damping) / max(damping, 1e-9)
    options = options | {"tolerance": min(options.get("tolerance", TOLERANCE), least)}
    trust = propagate(
        read_back(_shares(edges, "src", "dst"), "edges-on"),
        seed.select("host", F.col("good").alias("weight")),
        **options,
    ).withColumnRenamed("score", "trust")
    distrust = propagate(
        read_back(_shares(edges, "dst", "src"), "edges-back"),
        seed.select("host", F.col("bad").alias("weight")),
        **options,
    ).withColumnRenamed("score", "distrust")
    sums = seed.agg(F.sum("good"), F.sum("bad")).first()

    def counted(score: str, weight: str, total: float | None) -> Column:
        """The score, without the host's own seed where that is not its main verdict."""
        own = (1 - damping) / (total or 1.0) * F.col(weight)
        return F.col(score) - F.when(F.col(weight) > 0.5, 0.0).otherwise(own)

    both = (
        seed.join(trust, "host", "left")
        .join(distrust, "host", "left")
        .na.fill(0.0, ["trust", "distrust"])
    )
    against, towards = counted("distrust", "bad", sums[1]), counted("trust", "good", sums[0])
    bad = (against > towards) & (against > threshold / n)
    return both.select(
        "host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("host_verdict")
    )


def judge(pages: DataFrame, rules: Sequence[Rule], **options) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's scores for every page."""
    url = column(pages, "url", "string")
    rows = pages.select(
        column(pages, "page_id", "bigint").alias("page_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        column(pages, "html", "string").alias("html"),
    )
    rule, by_rule = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = rows.withColumns({"rule": rule, "by_rule": by_rule, "node": node_of(F.col("host"))})
    edges = read_back(host_edges(judged), "host-edges")
    seed = read_back(seeds(judged), "host-seeds")
    verdicts = store(host_verdicts(edges, seed, **options), "host-verdicts")
    # Few hosts are broadcast by their counted size; else Spark splits a hot host's rows.
    side = F.broadcast(verdicts.df) if verdicts.broadcastable else verdicts.df
    named = side.withColumnRenamed("host", "node")
    return judged.drop("html").join(named, "node", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
