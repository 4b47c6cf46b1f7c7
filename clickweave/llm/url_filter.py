"""URL filters: rules indexed by their rarest literal token, in DataFrame operations only.

A rule is a host and the start of a path, or a pattern with literal tokens. Every rule is filed under that of its
tokens which the fewest urls hold. A url's tokens fetch the rules filed under them, and only those run
their regular expression. Of the host rules that fit, the longest decides, else the longest pattern;
without either the verdict is `allow`. Equal lengths: the alphabetically first rule.

The rule index is broadcast: it has one row per rule, and `MOST_RULES` bounds it (more are refused).

Defined cases: a null url, or one without `://`, has empty host and path and gets `allow`. Repeated
rows are judged each. Without rules everything is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import common

MOST_RULES = 100_000
#: Host and path rules, and what they decide.
HOST_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]
#: The method's own patterns over host and path, `*` for anything, for urls that no host rule fits.
PATTERNS = [("*.ads.*/*", "block"), ("*.doubleclick.*/*", "block"), ("*/ads/*", "block"), ("*/tracker/*", "block"), ("*.ads-track.*/*", "block")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, host_rules=HOST_RULES, patterns=PATTERNS) -> DataFrame:
    """rule, verdict, fixed (a host rule), regex over host and path, and the tokens that every match holds whole."""
    rows = []
    for rule, verdict in host_rules:
        rows.append((rule, verdict, True, rf"^(?:[^/]*\.)?\Q{rule}\E", rule if rule.endswith("/") else rule.rpartition("/")[0] + "/"))
    for pattern, verdict in patterns:
        regex = "".join(".*" if c == "*" else rf"\Q{c}\E" for c in pattern)
        rows.append((pattern, verdict, False, f"^{regex}$", pattern))
    if len(rows) > MOST_RULES:
        raise ValueError(f"{len(rows)} rules; the index holds {MOST_RULES} at most")
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(x) for x in ("rule", "verdict")], F.lit(True).alias("fixed"), F.lit("").alias("regex"), F.array(F.lit("")).alias("tokens"))
    structs = [F.struct(*[F.lit(x).alias(n) for x, n in zip(row, ("rule", "verdict", "fixed", "regex", "literal"), strict=True)]) for row in rows]
    table = spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
    return table.withColumn("tokens", tokens(F.col("literal"))).drop("literal")


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, r"[./*]+"), lambda t: t != ""))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict for every row.

    Rows are numbered to bring a row's candidates together, since keys and urls may repeat; only
    rows that fetch a rule enter that shuffle, and its keys are even.
    """
    host, path = host_and_path(F.col("url"))
    rows = common.columns(pages, page_id=key, url=url).withColumns({"host": host, "path": path}).drop("url")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    found = rows.select("row", F.concat("host", "path").alias("target"))
    # how many urls hold each token that a rule has; the rules' tokens bound the broadcast side and the result
    by_token = rules.select("rule", F.explode("tokens").alias("token"))
    held = found.select(F.explode(tokens(F.col("target"))).alias("token")).join(F.broadcast(by_token.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = by_token.join(F.broadcast(held), "token", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest"))
    index = rules.join(F.broadcast(rarest), "rule", "left").select("rule", "verdict", "fixed", "regex", F.coalesce("rarest.token", F.lit("")).alias("token"))
    # rules without a whole literal token are filed under the empty one, which every url has
    fetched = (
        found.select("row", "target", F.explode(F.array_union(tokens(F.col("target")), F.array(F.lit("")))).alias("token"))
        .join(F.broadcast(index), "token").filter("target RLIKE regex")
    )
    best = fetched.groupBy("row").agg(F.max_by(F.struct("rule", "verdict", "fixed"), F.struct("fixed", F.length("rule").alias("size"), F.translate("rule", *_reversed()).alias("first"))).alias("best"))
    return rows.join(best, "row", "left").select(
        "page_id", "host", "path", F.when(F.col("best.fixed"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), F.when(~F.col("best.fixed"), F.col("best.rule")).alias("pattern"),
    )


def _reversed() -> tuple[str, str]:
    """Printable characters and their mirror image, so that the alphabetically first text is the largest."""
    order = "".join(map(chr, range(32, 127)))
    return order, order[::-1]
