"""URL filter by rules and by shrunken host reputation; DataFrame functions only.

Each host's share of bad pages is shrunk towards its registered domain's, that
towards its suffix's, and that towards the whole table's. The strength of each
prior is fitted to the spread of the shares one level down (beta-binomial, by
moments). A host is blocked if even the lower posterior bound of its bad share
is above a limit.

Defined cases: a null url, or one without ``://``, has an empty host and path and
counts as a host of its own. Repeated pages each count. A page whose number has
no label adds nothing to the counts; a label row that is null in both columns
does neither. Without any label every host is allowed. Further columns of the
inputs are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import stored

# The given rules as (verdict, host and path).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# Suffixes of two labels, under which the registered domain has three.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
MAX_BAD_SHARE = 0.3
BOUND_Z = 1.645


def url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lowered) and ``path`` to the rows."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return pages.withColumns({
        "host": F.translate(raw, string.ascii_uppercase, string.ascii_lowercase),
        "path": F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^([^?#]*)", 1),
    })


def rule_column(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict (else null)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, full in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, _, path = full.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, full).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def with_levels(df: DataFrame) -> DataFrame:
    """Add ``domain`` (registered domain) and ``suffix`` to rows with a ``host``."""
    labels = F.split(F.regexp_replace("host", r":[0-9]*$", ""), r"\.")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    long = two.isin(*TWO_LABEL_SUFFIXES) & (F.size(labels) > 2)
    few = F.size(labels) < 2
    number = F.col("host").rlike(r"^[0-9.]+(:[0-9]*)?$")
    return df.withColumns({
        "domain": F.when(few | number, F.col("host")).when(long, F.array_join(F.slice(labels, -3, 3), ".")).otherwise(two),
        "suffix": F.when(number, "").when(long, two).otherwise(F.element_at(labels, -1)),
    })


def _strength(groups: DataFrame) -> float:
    """Pseudo-counts of the prior that fits the spread of ``bad``/``n`` around ``mean``, the parent's share."""
    mean = F.col("mean")
    noise = mean * (1 - mean)
    fit = groups.filter("n > 0").agg(
        F.sum(F.try_divide(F.pow(F.col("bad") - F.col("n") * mean, 2), F.col("n"))).alias("seen"),
        F.sum(noise).alias("due"), F.sum(noise * (F.col("n") - 1)).alias("room")).first()
    rho = (fit["seen"] - fit["due"]) / fit["room"] if fit["room"] else 0.01
    return 1 / max(0.001, min(0.999, rho)) - 1


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, bad, share, bound) from one row per host with ``n`` outcomes, ``bad`` of them bad.

    ``share`` is the posterior mean of the bad share, ``bound`` its lower bound. The table of hosts
    is stored once; from its upper levels only totals and the three strengths come to the driver.
    """
    hosts = stored(with_levels(outcomes.select("host", "n", "bad")), "hosts")
    total = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    mean = F.try_divide(F.col("bad"), F.col("n"))
    whole = hosts.agg(*total).first()
    share = whole["bad"] / whole["n"] if whole["n"] else 0.0

    def shrink(children: DataFrame) -> DataFrame:
        k = _strength(children)
        shares = (F.col("prior") * k + F.col("bad")) / (k + F.col("n"))
        return children.withColumns({"share": shares, "strength": F.lit(k)})

    def below(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
        known = parents.select(parent, mean.alias("mean"), F.col("share").alias("prior"))
        return shrink(children.join(known, parent))

    suffixes = hosts.groupBy("suffix").agg(*total)
    suffixes = shrink(suffixes.withColumns({"mean": F.lit(share), "prior": F.lit(share)}))
    domains = below(hosts.groupBy("domain", "suffix").agg(*total), suffixes, "suffix")
    hosts = below(hosts, domains, "domain")
    spread = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("strength") + F.col("n") + 1))
    return hosts.select("host", "n", "bad", "share", (F.col("share") - BOUND_Z * spread).alias("bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad_share: float = MAX_BAD_SHARE) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_labelled, n_bad), one row per page.

    A page stands for the document whose number its path holds (``/<lang>/<number>``);
    it is bad if that document is labelled of low quality or toxic.
    """
    parts = url_parts(pages).select("page_id", "host", "path")
    number = F.expr("try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]+)', 1), '') AS BIGINT)")
    bad = F.greatest(F.when(F.col("quality") == 0, 1).otherwise(0), F.when(F.col("toxic") == 1, 1).otherwise(0))
    outcomes = labels.filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    outcomes = outcomes.groupBy(F.col("doc_id").alias("number")).agg(F.max(bad).alias("is_bad"))
    per_host = (
        parts.withColumn("number", number).join(outcomes, "number", "left")
        .groupBy("host").agg(F.count("is_bad").alias("n"), F.coalesce(F.sum("is_bad"), F.lit(0)).alias("bad"))
    )
    rule, verdict = rule_column(rules)
    by_method = F.when(F.col("bound") > max_bad_share, "block").otherwise("allow")
    return parts.join(host_reputation(per_host), "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"),
        F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"))
