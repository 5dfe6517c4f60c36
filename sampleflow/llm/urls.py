"""Verdicts on URLs by a tree of path templates, learned from URLs with a known label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.graph import kept, small


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or a URL without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.char_length(host) + F.lit(1))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(tail, r"^[^?#]*", 0)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule whose host is the URL's or above it and whose path the URL's path starts with, as a struct, or null."""
    found = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def segments(path: Column) -> Column:
    """The path's segments without a file's ending; one of digits only is ``*``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(s, r"\.[A-Za-z]{1,5}\z", ""), r"^[0-9]+\z", "*"))


def _generalised(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` (``host``, ``segs``, ``bad``) with ``template``: from the root down, a segment with fewer than ``least`` labels below its parent is ``*``.

    ``bad`` is null without a label. Rows without one never change a template.
    """
    labelled = rows.where("bad IS NOT NULL")
    # Below the depth that ``least`` labelled rows reach, no segment can have as many.
    longest = labelled.select(F.size("segs").alias("n")).orderBy(F.desc("n")).limit(least)
    reached = longest.agg(F.count("*").alias("rows"), F.min("n").alias("n")).first()
    levels = reached.n if reached.rows == least else 0
    rows = rows.withColumn("template", F.lit(""))
    for level in range(levels):
        here = F.get("segs", F.lit(level))
        named = rows.where(here.isNotNull() & F.col("bad").isNotNull()).groupBy("host", "template", here.alias("_here")).count()
        named = named.where(F.col("count") >= least).select("host", "template", "_here", F.lit(True).alias("named"))
        rows = rows.withColumn("_here", here).join(small(kept(named, "named")), ["host", "template", "_here"], "left")
        step = F.concat("template", F.lit("/"), F.when(F.col("named"), F.col("_here")).otherwise(F.lit("*")))
        rows = rows.withColumn("template", F.when(F.col("_here").isNull(), F.col("template")).otherwise(step)).drop("named", "_here")
    return rows.withColumn("template", F.concat("template", F.repeat(F.lit("/*"), F.greatest(F.size("segs") - levels, F.lit(0)))))


@dataclass(frozen=True)
class _Smoothing:
    prior: float
    weight: float
    doubt: float

    def purity(self, bad: Column, labelled: Column, rows: Column) -> Column:
        """Share of bad labels, with ``weight`` labels more and ``doubt`` of one for each row without a label, of which ``prior`` are bad."""
        more = self.weight + self.doubt * (rows - labelled)
        return (bad + self.prior * more) / (labelled + more)


def judged_templates(stats: DataFrame, z: float, smoothing: _Smoothing) -> DataFrame:
    """``host``, ``template``, ``branch``, ``purity``, ``evidence`` from each template's ``labelled``, ``bad`` and ``rows`` counts.

    Labelled templates of a host with as many segments stand in order of their share of
    bad labels, then by name; neighbours whose shares differ by less than ``z`` standard
    errors are merged into one branch, named by its smallest template. A template without
    labels takes the nearest node above it that has labels below it, down to the host
    itself (``branch`` is empty); on a host without labels it stands alone. ``evidence`` is
    the number of labels that speak.
    """
    depth = F.size(F.split("template", "/"))
    labelled = stats.where("labelled > 0").withColumn("depth", depth)
    siblings = Window.partitionBy("host", "depth").orderBy(F.col("bad") / F.col("labelled"), "template")
    before = lambda c: F.lag(c).over(siblings)
    share = (F.col("bad") + before("bad")) / (F.col("labelled") + before("labelled"))
    error = F.sqrt(share * (1 - share) * (1 / F.col("labelled") + 1 / before("labelled")))
    apart = F.abs(F.col("bad") / F.col("labelled") - before("bad") / before("labelled"))
    new = F.when(before("template").isNull(), F.lit(1)).otherwise((apart > z * error).cast("int"))
    found = labelled.withColumn("new", new).withColumn("run", F.sum("new").over(siblings))
    branch = Window.partitionBy("host", "depth", "run")
    total = lambda c: F.sum(c).over(branch)
    own = found.select(
        "host", "template", F.min("template").over(branch).alias("branch"),
        smoothing.purity(total("bad"), total("labelled"), total("rows")).alias("purity"), total("labelled").alias("evidence"),
    )

    parts = F.split("template", "/")
    nodes = stats.withColumn("level", F.explode(F.sequence(F.lit(1), F.size(parts)))).withColumn(
        "node", F.array_join(F.slice(parts, 1, F.col("level")), "/")
    )
    above = nodes.groupBy("host", "node").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"), F.sum("rows").alias("r")).where("n > 0")
    value = F.struct(F.col("node").alias("branch"), smoothing.purity(F.col("b"), F.col("n"), F.col("r")).alias("purity"), F.col("n").alias("evidence"))
    others = nodes.where("labelled = 0").join(above, ["host", "node"], "left").groupBy("host", "template").agg(
        F.max_by(value, F.when(F.col("n") > 0, F.col("level"))).alias("found")
    )
    return own.unionByName(others.select(
        "host", "template", F.coalesce("found.branch", "template").alias("branch"),
        F.coalesce("found.purity", F.lit(smoothing.prior)).alias("purity"), F.coalesce("found.evidence", F.lit(0)).alias("evidence"),
    ))


def url_verdicts(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    least: int = 6,
    z: float = 2.0,
    reject: float = 0.8,
    prior: float = 0.5,
    weight: float = 4.0,
    doubt: float = 0.5,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``template``, ``branch``, ``purity``, ``evidence``, ``verdict`` for every row of ``pages``.

    The longest rule that fits decides. It also labels the URL for the tree: block is
    bad. Each host's paths are generalised into templates from the root down: a segment
    keeps its name where at least ``least`` labelled URLs have it below the same template, at
    any depth, and is ``*`` elsewhere. Similar branches are merged, and a branch without labels
    takes its nearest labelled ancestor's. URLs without a rule are blocked where the
    smoothed share of bad labels is ``reject`` or more: by the defaults that takes six
    labels, all bad, and a third more than the unlabelled URLs at most. URLs without a rule
    change no template and only draw a branch's purity towards ``prior``, so more of
    them never block a URL that was allowed. A URL that is null, or without ``://``, has an empty
    host and path, and is allowed unless a rule says otherwise. Repeated rows all come out, each is a label.
    One join with a small table is planned for each level that ``least`` labelled URLs reach.
    Counts of a host, template and segment are all that meets in one place, so a host with
    most of the rows is no larger there than its tree. Other columns are not used.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("segs", segments(F.col("path")))
    rows = _generalised(rows.withColumn("bad", F.col("found.verdict") == "block"), least)
    stats = rows.groupBy("host", "template").agg(
        F.count("bad").alias("labelled"), F.count_if("bad").alias("bad"), F.count("*").alias("rows")
    )
    stats = kept(stats, "stats")
    judged = small(kept(judged_templates(stats, z, _Smoothing(prior, weight, doubt)), "judged"))
    own = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, ["host", "template"]).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), "template", "branch", "purity", "evidence",
        F.coalesce("found.verdict", own).alias("verdict"),
    )
