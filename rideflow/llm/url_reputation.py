"""URL filters: empirical-Bayes host reputation.

Outcomes of labelled pages (1 bad, 0 good) are counted per host.  A host's bad rate is shrunk
towards its registered domain's, that towards its suffix's, and that towards the rate of all pages,
by beta-binomial priors whose strength is estimated at each level by moments.  A host is blocked
when the lower bound of its posterior bad rate is above a limit.  Explicit rules on host and path
come before reputation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.sources import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
    "com.cn", "com.mx", "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
)

#: (verdict, host, path)
Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column) -> Column:
    """The suffix and one label more (the host itself if it has no more)."""
    labels = F.when(F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES), 3).otherwise(2)
    return F.when(labels == 3, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def public_suffix(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The index of the longest rule that fits, or null.

    A rule fits its host and all subdomains if the path starts with the rule's; of equally long rules
    that with the longer host wins.
    """
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), -len(rules[i][1]), rules[i]))
    out = F
    for i in order:
        _, at, prefix = rules[i]
        out = out.when(((host == at) | host.endswith(f".{at}")) & path.startswith(prefix), F.lit(i))
    return out if order else F.lit(None).cast("int")


def _strength(children: DataFrame) -> float:
    """Prior strength a + b of a level: the moments of (n, bad) around the parent's mean.

    One row of sums comes back.  Children that vary no more than chance get a strong prior.
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    sums = children.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("mean"), 2)).alias("seen"),
        F.sum(spread).alias("chance"),
        F.sum(spread * (F.col("n") - 1)).alias("room"),
    ).first()
    if not sums.room:
        return 1.0
    rho = min(max((sums.seen - sums.chance) / sums.room, 1e-4), 0.5)
    return 1.0 / rho - 1.0


def host_reputation(outcomes: DataFrame, *, limit: float = 0.25, z: float = 1.645) -> DataFrame:
    """One row per host: n, bad, posterior mean, bound (lower, ``z`` deviations) and verdict.

    ``outcomes`` has (host, bad), bad being 1, 0 or null (no label).  Hosts without labels get their
    domain's posterior, without those its suffix's, and so on; without any label every host is
    allowed.
    """
    hosts = materialize(
        outcomes.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
        .withColumn("domain", registered_domain(F.col("host")))
        .withColumn("suffix", public_suffix(F.col("host"))),
        label="url-hosts",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = total.bad / total.n if total.n else 0.0

    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    parent = suffixes.withColumn("mean", F.lit(mean))
    strengths = []
    for child, up in ((None, "suffix"), ("domain", "suffix"), ("host", "domain")):
        if child:
            below = hosts if child == "host" else hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
            parent = below.join(parent.select(up, "post").withColumnRenamed("post", "mean"), up)
        parent = materialize(parent, label="url-level")
        s = _strength(parent)
        strengths.append(s)
        parent = parent.withColumn("post", (F.lit(s) * F.col("mean") + F.col("bad")) / (F.lit(s) + F.col("n")))
    s = strengths[-1]
    mass = F.lit(s) + F.col("n")
    deviation = F.sqrt(F.col("post") * (1 - F.col("post")) / (mass + 1))
    return (
        parent.withColumn("bound", F.col("post") - F.lit(z) * deviation)
        .withColumn("verdict", F.when(F.col("bound") > limit, "block").otherwise("allow"))
        .select("host", "n", "bad", "post", "bound", "verdict")
    )


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], **reputation) -> DataFrame:
    """Every row of ``pages`` (a column ``url``) with host, path, rule and verdict.

    ``rule`` is the text (host and path) of the rule that decided, else null and the verdict is the
    host's reputation.  A null url, or one without ``://``, has empty host and path: no rule fits and
    its reputation is that of the empty host.  Rows of ``pages`` are never lost or doubled; columns of
    the same names are replaced.
    """
    made = ["host", "path", "rule", "verdict"]
    carried = [c for c in pages.columns if c not in made]
    verdicts = materialize(host_reputation(outcomes, **reputation), label="url-verdicts")
    known = verdicts.select(F.col("host").alias("of"), F.col("verdict").alias("reputation"))
    texts = F.array(*[F.lit(host + path) for _, host, path in rules])
    kinds = F.array(*[F.lit(kind) for kind, _, _ in rules])
    return (
        pages.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
        .join(known, F.col("host") == F.col("of"), "left")
        .select(
            F.col("row.*"),
            "host",
            "path",
            F.get(texts, F.col("fit")).alias("rule"),
            F.coalesce(F.get(kinds, F.col("fit")), F.col("reputation"), F.lit("allow")).alias("verdict"),
        )
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) per page and label: a page shows the document whose id is the number in its path;
    it is bad if that is labelled toxic or of low quality, null if it has no label."""
    marks = labels.select(
        F.col("doc_id").alias("of"),
        F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1)
        .when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
        .alias("bad"),
    )
    shown = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT)")
    return (
        pages.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .select("host", shown.alias("shown"))
        .join(marks, F.col("shown") == F.col("of"), "left")
        .select("host", "bad")
    )
