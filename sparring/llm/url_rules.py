"""URL filtering with host and path rules, by hashed expressions; DataFrame functions only.

Every URL is expanded into expressions: each suffix of its host at a label border, followed by each prefix of its path
at which a rule may end. Expressions and rules meet in an equi-join on the first eight hex digits of their SHA-256;
where those agree the whole digests are compared. Of the rules that fit a URL the longest wins (host and path together,
then the longer host); of a rule that stands in the table as both, `block` wins. A URL that no rule fits is allowed.

The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased and otherwise unchanged (a port
belongs to it); the path follows up to `?`, `#` or the end. A rule fits its host and all its subdomains, if the URL's
path starts with the rule's; an empty path does not start with `/`. No more labels and slashes are expanded than the
rules have, so a long URL has no more expressions than a short one may have; none that a rule could equal is left out.

Null URLs and URLs without `://` have an empty host and path, and no rule fits them. Rules of null or empty host or
null action fit nothing, a null path of a rule is an empty one. Nulls in the other columns pass through, repeated rows
give repeated rows, empty tables an empty result; without rules everything is allowed.

Equal rows are counted first, in up to PARTS parts, and written out again at the end: a row with any number of copies is
neither one group nor one array. The rules are broadcast only if Spark knows that they are small; otherwise the
expressions are shuffled by hash prefix, where one that very many URLs share is split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: Hex digits of a digest by which expressions and rules are joined.
SHORT = 8
#: Parts in which equal rows are counted, and copies that are written from one counted row at once.
PARTS, COPIES = 64, 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def up_to(n: Column) -> Column:
    """The numbers from 1 to n."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def rule_table(rules: DataFrame) -> DataFrame:
    """(host, path, blocks): one row for each rule; hosts have A-Z lower-cased."""
    host = F.translate("host", UPPER, LOWER)
    known = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action")
    known = known.where((F.col("host") != "") & F.col("action").isin(ALLOW, BLOCK))
    return known.groupBy("host", "path").agg(F.max((F.col("action") == BLOCK).cast("int")).alias("blocks"))


def shapes(rules: DataFrame) -> tuple[int, int, list[int]]:
    """Most labels of a rule's host, most slashes of its path, and lengths of paths that end elsewhere than at a slash."""
    slashes = F.when(F.endswith("path", F.lit("/")), F.size(F.split("path", "/")) - 1)
    found = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.max(slashes).alias("slashes"),
        F.collect_set(F.when(slashes.isNull(), F.length("path"))).alias("lengths"),
    ).first()
    return found["labels"] or 0, found["slashes"] or 0, sorted(found["lengths"])


def expressions(host: Column, path: Column, shape: tuple[int, int, list[int]]) -> Column:
    """The expressions (host, path) of a URL that rules of that shape can equal."""
    most_labels, most_slashes, lengths = shape
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    last = lambda k: F.array_join(F.slice(labels, -k, k), ".")
    first = lambda k: F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/"))
    hosts = F.transform(up_to(F.least(F.size(labels), F.lit(most_labels))), last)
    paths = F.transform(up_to(F.least(F.size(parts) - 1, F.lit(most_slashes))), first)
    if lengths:
        other = F.filter(F.array(*map(F.lit, lengths)), lambda k: k <= F.length(path))
        paths = F.array_distinct(F.concat(paths, F.transform(other, lambda k: F.substring(path, F.lit(1), k))))
    each = F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("host"), p.alias("path"))))
    return F.filter(F.flatten(each), lambda e: e["host"] != "")


def judge(rows: DataFrame, rules: DataFrame, url_col: str = "url", key_cols: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row for each of `rows`: `key_cols`, host, path, rule (host and path joined, null if none fits) and verdict.

    `rules` has the columns host, path and action (allow or block). Keys named like an output column are not possible.
    """
    keys = [F.col(c).alias(f"_key{k}") for k, c in enumerate(key_cols)]
    names = [f"_key{k}" for k in range(len(keys))]
    known = rule_table(rules)
    counted = (
        rows.select(*keys, F.col(url_col).alias("_url"), (F.spark_partition_id() % PARTS).alias("_part"))
        .groupBy(*names, "_url", "_part")
        .agg(F.count("*").alias("_copies"))
        .withColumns({"_host": url_host(F.col("_url")), "_path": url_path(F.col("_url"))})
    )
    expanded = counted.select("*", F.explode_outer(expressions(F.col("_host"), F.col("_path"), shapes(known))).alias("_e"))
    hashed = expanded.withColumn("_digest", digest(F.concat("_e.host", "_e.path")))
    # Of one URL's expressions two of equal length in all have hosts of unequal length: the number names the rule.
    number = F.length(F.concat("host", "path")).cast("long") * (1 << 32) + F.length("host") * 2 + F.col("blocks")
    listed = known.select(digest(F.concat("host", "path")).alias("_rule_digest"), number.alias("_number"))
    listed = listed.withColumn("_short", F.substring("_rule_digest", 1, SHORT))
    met = hashed.withColumn("_short", F.substring("_digest", 1, SHORT)).join(listed, "_short", "left")
    confirmed = F.when(F.col("_digest") == F.col("_rule_digest"), F.col("_number"))
    best = met.groupBy(*names, "_url", "_part", "_copies", "_host", "_path").agg(F.max(confirmed).alias("_best"))
    length, hosts = F.expr("cast(shiftright(_best, 32) AS int)"), F.expr("cast(shiftright(_best & 4294967295, 1) AS int)")
    rule = F.concat(F.substring("_host", -hosts, hosts), F.substring("_path", F.lit(1), length - hosts))
    blocked = F.coalesce(F.col("_best").bitwiseAND(1), F.lit(0)) == 1
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {COPIES}"))
    many = best.withColumn("_block", F.explode(blocks))
    size = F.least(F.lit(COPIES).cast("long"), F.col("_copies") - F.col("_block") * COPIES)
    return many.select("*", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(
        *(F.col(n).alias(c) for n, c in zip(names, key_cols)),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.when(F.col("_best").isNotNull(), rule).alias("rule"),
        F.when(blocked, BLOCK).otherwise(ALLOW).alias("verdict"),
    )
