"""Document plumbing: blanking, renaming, registered domains, size-checked
broadcasts and quarantine of unparseable rows (B1-B11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.functions.text import col_of


def bounded_broadcast(df: DataFrame, max_rows: int = config.BROADCAST_MAX_ROWS,
                      max_bytes: int = config.BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if it holds at most ``max_rows`` rows and
    ``max_bytes`` bytes (as JSON text, an upper estimate for most rows).

    One job over at most ``max_rows + 1`` rows of the (small, configuration-sized)
    table checks both; above a bound the table is left to a shuffled join, which
    AQE may still turn into a broadcast from runtime statistics.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))
    n, b = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and b <= max_bytes else df


def blank_columns(df: DataFrame, columns=None, keep_placeholder: bool = False) -> DataFrame:
    """Blank the bulky crawl columns.  By default they are dropped (never read);
    with ``keep_placeholder`` each is set to ``"..."`` even when absent."""
    columns = columns or config.BLANKED_COLUMNS
    if keep_placeholder:
        for c in columns:
            df = df.withColumn(c, F.lit("..."))
        return df
    return df.drop(*[c for c in columns if c in df.columns])


def rename_if_present(df: DataFrame, old: str = "_id", new: str = "cdr_id") -> DataFrame:
    """Rename a column when it exists."""
    return df.withColumnRenamed(old, new) if old in df.columns else df


def host_of(url) -> Column:
    """Lower-cased host of a URL: the authority without user and port, whatever
    characters the rest of the URL has (null when there is no authority)."""
    authority = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)"
    host = F.lower(F.regexp_extract(F.trim(col_of(url)), authority, 1))
    return F.when(host != "", host)


def suffix_rules(spark, rules) -> DataFrame:
    """Public-suffix rules ``(suffix)`` from a list in the list's own notation: ``co.uk``,
    ``*.ck`` (any one label), ``!www.ck`` (an exception to a wildcard)."""
    return spark.createDataFrame([(r,) for r in rules], "suffix string")


def registered_domains(hosts: DataFrame, suffixes: DataFrame, host_col: str = "host") -> DataFrame:
    """``(host, registered_domain)`` for distinct hosts: one label and the public suffix
    behind it, by the rules in ``suffixes(suffix)``.

    An exception rule wins (its suffix lacks the rule's first label), else the matching rule
    with the most labels that leaves a label in front; a wildcard stands for exactly
    one label.  Where no rule fits, the last label is the suffix (the public suffix list's own
    default rule); numeric addresses and hosts of one label have no registered domain.
    Null and blank rules are ignored.

    Candidate suffixes are the host's label tails (bounded by its label
    count); they meet the rules in a size-checked broadcast join and the
    best hit per host wins through a grouped ``max``.
    """
    rule = F.lower(F.trim("suffix"))
    kind = F.when(rule.startswith("!"), F.lit("exception")).when(rule.startswith("*."), F.lit("wildcard")).otherwise(F.lit("plain"))
    rules = bounded_broadcast(suffixes.select(F.regexp_replace(rule, r"^(!|\*\.)", "").alias("tail"), kind.alias("kind"))
                              .where(F.col("tail") != "").distinct())
    labels = F.split(F.col(host_col), r"\.")
    tails = (hosts.select(host_col, labels.alias("labels"))
             .where((F.size("labels") >= 2) & ~F.col(host_col).rlike(r"^[0-9.]+$|^\["))
             .select(host_col, "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("k"))
             .select(host_col, "labels", F.array_join(F.slice("labels", F.col("k"), F.size("labels")), ".").alias("tail"),
                     (F.size("labels") - F.col("k") + 1).alias("n")))
    hit = tails.join(rules, "tail", "left")
    # how many labels the rule makes the suffix have; the default rule gives every last label
    n = (F.when(F.col("kind") == "exception", F.col("n") - 1).when(F.col("kind") == "wildcard", F.col("n") + 1)
         .when(F.col("kind") == "plain", F.col("n")))
    sizes = F.array_compact(F.array(n, F.when(F.col("n") == 1, F.lit(1))))
    best = (hit.select(host_col, "labels", (F.col("kind") == "exception").alias("exception"), F.explode(sizes).alias("n"))
            .where(F.col("n").between(1, F.size("labels") - 1))
            .groupBy(host_col).agg(F.max(F.struct(F.coalesce("exception", F.lit(False)).alias("exception"), "n", "labels")).alias("b")))
    size = F.size("b.labels")
    return best.select(host_col, F.array_join(F.slice("b.labels", size - F.col("b.n"), F.col("b.n") + 1), ".").alias("registered_domain"))


def add_registered_domain(df: DataFrame, suffixes: DataFrame, url_col: str = "url", out_col: str = "tld") -> DataFrame:
    """Add ``out_col`` = registered domain of the URL host by the rules in ``suffixes``; an
    existing non-null ``out_col`` is kept.

    The suffix search runs once per distinct host, not per page.  The host
    map is derived from the data, so its size is measured at run time: AQE
    broadcasts it when small, otherwise the join stays shuffled and AQE splits
    hot hosts.
    """
    with_host = df.withColumn("__host", host_of(F.col(url_col)))
    hosts = with_host.select(F.col("__host").alias("host")).where(F.col("host").isNotNull()).distinct()
    rd = registered_domains(hosts, suffixes).withColumnRenamed("host", "__host")
    out = with_host.join(rd, "__host", "left").drop("__host")
    if out_col in df.columns:
        return out.withColumn(out_col, F.coalesce(F.col(out_col), F.col("registered_domain"))).drop("registered_domain")
    return out.withColumnRenamed("registered_domain", out_col)


def parse_json_column(df: DataFrame, col: str, schema, out_col: str | None = None,
                      quarantine: bool = False):
    """Parse a JSON string column with an explicit schema.

    Returns the parsed frame, or ``(good, bad)`` with ``quarantine=True``,
    where ``bad`` holds the rows whose text is not valid JSON.
    """
    out_col = out_col or col
    parsed = df.withColumn(out_col, F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}))
    if not quarantine:
        return parsed
    valid = F.try_parse_json(F.col(col)).isNotNull()
    tagged = df.withColumn("__ok", valid)
    good = tagged.where("__ok").drop("__ok").withColumn(out_col, F.from_json(F.col(col), schema))
    bad = tagged.where(~F.col("__ok")).drop("__ok")
    return good, bad
