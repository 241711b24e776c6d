"""URL filters: pattern rules indexed by their rarest literal token.

A rule's regular expression only runs on URLs that contain one of its literal tokens, the one that the URLs at hand
contain least often.  Token counts come from the whole table.  All of it is DataFrame functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.llm.common import ascii_lower, with_row

#: Rules come as a parameter, so their number is known; the index of more rules than this is joined without a broadcast.
BROADCAST_RULES = 50_000
#: The token of rules that have no literal token; every URL has it.
ANY = ""


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains when the path starts with ``path``; the longest such rule decides."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """``*`` is any text, ``^`` a separator or the end, a leading ``|`` the start, ``||`` the start of a host label."""

    verdict: str
    pattern: str

    @property
    def text(self) -> str:
        return self.pattern


HOST_RULES = (
    HostRule("block", "net"),
    HostRule("allow", "example.net", "/en/"),
    HostRule("block", "example.com", "/de/"),
    HostRule("allow", "org", "/fr/"),
)
#: Rules for URLs that no host rule fits; an allowing pattern outweighs a blocking one.
PATTERN_RULES = (
    PatternRule("block", "*/ads/*"),
    PatternRule("block", "||doubleclick.*^"),
    PatternRule("block", "^utm_source=feed^"),
    PatternRule("block", "^casino^"),
    PatternRule("block", "/login^"),
    PatternRule("allow", "||www.*/help/*"),
)

_SEPARATOR = r"(?:[^a-z0-9_.%-]|$)"


def host_regex(rule: HostRule) -> str:
    """Over host + path; only the host is in lower case."""
    return r"^(?:[^/]*\.)?" + re.escape(rule.host) + re.escape(rule.path)


def pattern_regex(rule: PatternRule) -> str:
    """Over the whole URL in lower case."""
    p, head = rule.pattern.lower(), ""
    if p.startswith("||"):
        head, p = r"^[a-z]+://(?:[^/?#]*\.)?", p[2:]
    elif p.startswith("|"):
        head, p = "^", p[1:]
    body = "".join(".*" if c == "*" else _SEPARATOR if c == "^" else re.escape(c) for c in p)
    return "(?s)" + head + re.sub(r"^(\.\*)+|(\.\*)+$", "", body)


def literal_tokens(rule: HostRule | PatternRule) -> list[str]:
    """Runs of a-z0-9 that stand in every fitting URL as whole tokens (a run at an open end may be part of a longer one)."""
    text = (rule.text if isinstance(rule, HostRule) else rule.pattern).lower()
    inner = text if isinstance(rule, PatternRule) else "." + text
    if not inner.startswith(("|", "^", "*", ".", "/")):
        inner = "*" + inner
    out = []
    for m in re.finditer(r"[a-z0-9]+", inner):
        left, right = inner[m.start() - 1 : m.start()], inner[m.end() : m.end() + 1]
        if left not in ("", "*") and right not in ("", "*"):
            out.append(m.group())
    return sorted(set(out)) or [ANY]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_table(spark, host_rules, pattern_rules) -> DataFrame:
    rows = [(r.text, r.verdict, host_regex(r), True, len(r.text), literal_tokens(r)) for r in host_rules]
    rows += [(r.text, r.verdict, pattern_regex(r), False, len(r.text), literal_tokens(r)) for r in pattern_rules]
    return spark.createDataFrame(rows, "rule string, says string, regex string, by_host boolean, size int, tokens array<string>")


def judge_urls(
    urls: DataFrame, id_col: str, url_col: str = "url", host_rules=HOST_RULES, pattern_rules=PATTERN_RULES, default: str = "allow"
) -> DataFrame:
    """One row per input row: ``id_col, host, path, rule, verdict, pattern``.

    ``rule`` is the longest fitting host rule (of equally long ones the first by text), else NULL; ``pattern`` the
    deciding pattern rule where no host rule fits.  NULL URLs, URLs without ``://`` and empty ones get empty host and
    path, which no host rule fits.  Repeated rows stay, whatever their id; other columns are ignored.
    """
    spark = urls.sparkSession
    slim = urls.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    slim = slim.withColumn("_row", F.monotonically_increasing_id()).withColumn("_host", url_host(F.col("_url"))).withColumn("_path", url_path(F.col("_url")))
    # A host rule is tested on host + path, a pattern on the whole URL; the tokens of the URL cover both.
    lower = ascii_lower(F.coalesce(F.col("_url"), F.lit("")))
    tokens = F.concat(F.array(F.lit(ANY)), F.array_distinct(F.regexp_extract_all(lower, F.lit("([a-z0-9]+)"), 1)))
    token_rows = slim.select("_row", "_id", "_url", "_host", "_path", F.explode(tokens).alias("_token"))

    rules = _rule_table(spark, host_rules, pattern_rules)
    n_rules = len(host_rules) + len(pattern_rules)
    bounded = F.broadcast if n_rules <= BROADCAST_RULES else (lambda df: df)
    own = rules.select("rule", F.explode("tokens").alias("_token"))
    # How many URLs hold each token that some rule has: summed inside the tasks, at most one row per rule token goes on.
    seen = token_rows.select("_token").join(bounded(own.select("_token").distinct()), "_token").groupBy("_token").agg(F.count("*").alias("n"))
    chosen = own.join(bounded(seen), "_token", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), F.col("_token").alias("t"))).alias("least"))
    index = rules.drop("tokens").join(bounded(chosen), "rule").select("*", F.col("least.t").alias("_token")).drop("least")

    fits = F.expr("CASE WHEN by_host THEN regexp_like(concat(_host, _path), regex) ELSE regexp_like(_lower, regex) END")
    tried = token_rows.withColumn("_lower", lower).join(bounded(index), "_token", "left").withColumn("_fits", F.coalesce(fits, F.lit(False)))
    # The tokens of a URL are in one task, so this is one row per URL before the shuffle.  Least struct: longest rule, then by text.
    best_host = F.min(F.when(F.col("_fits") & F.col("by_host"), F.struct((-F.col("size")).alias("s"), "rule", "says")))
    best_pattern = F.min(F.when(F.col("_fits") & ~F.col("by_host"), F.struct("says", (-F.col("size")).alias("s"), "rule")))
    judged = tried.groupBy("_row", "_id", "_url", "_host", "_path").agg(best_host.alias("h"), best_pattern.alias("p"))
    pattern = F.when(F.col("h").isNull(), F.col("p.rule"))
    return judged.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("h.rule").alias("rule"),
        F.coalesce("h.says", "p.says", F.lit(default)).alias("verdict"),
        pattern.alias("pattern"),
    )


def keep_allowed(urls: DataFrame, url_col: str = "url", **rules) -> DataFrame:
    """The rows whose URL is allowed, with their columns as they were."""
    marked, row = with_row(urls)
    allowed = judge_urls(marked, row, url_col, **rules).where("verdict = 'allow'").select(row)
    return marked.join(allowed, row, "left_semi").drop(row)
