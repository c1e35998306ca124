"""Loading the input tables and the small user-supplied configuration tables
that the registered queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.operators.mentions import vocabulary

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Runtime SQL settings the plans rely on; applied to whatever session runs
# them (a session built elsewhere does not carry ``session.DEFAULT_CONF``).
RUNTIME_CONF = {"spark.sql.constraintPropagation.enabled": "false",
                # The JVM never compiles a method of more than 8,000 bytes; a stage with one runs
                # in smaller methods, operator by operator.
                "spark.sql.codegen.hugeMethodLimit": "8000",
                "spark.sql.adaptive.enabled": "true",
                "spark.sql.adaptive.skewJoin.enabled": "true"}


# Tables whose rows carry the per-row work (text, strings built per row).
FACT_TABLES = {"pages", "documents", "lineitem", "events", "orders", "part", "customer", "embeddings",
               "conversations"}


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Use every core for row-local work: when a scan yields fewer partitions
    than the session's default parallelism (a few large row groups), spread
    the rows round-robin.  Inputs that are already split (the normal case for
    many large files) are left alone, so no extra shuffle is added at scale."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no partition information (e.g. a remote session): leave as is
        return df
    return df.repartition(target) if current < target else df


def dealt(df: DataFrame, rows_per_task: int = 250_000) -> DataFrame:
    """Rows with much work each in tasks of at most about ``rows_per_task`` rows, so that tasks
    grow in number and not in length.  Parquet counts its rows from the footers."""
    tasks = -(-df.count() // rows_per_task)
    return df.repartition(tasks) if tasks > df.rdd.getNumPartitions() else df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in FACT_TABLES else df


# --- user-supplied vocabularies of the registered queries --------------------

# Single-token vocabulary over documents: common function words of the four
# corpus languages plus licence terms.
WORD_VOCAB = ["the", "and", "of", "der", "die", "und", "la", "le", "les", "de", "el", "que",
              "license", "licensed", "released", "mit", "apache", "gnu", "version", "public"]

# Up-to-three-token phrases over documents.
PHRASE_VOCAB = ["mit license", "apache license", "general public license", "gnu general public",
                "released under the", "of the", "de la", "in the", "und der"]

# Prior weight per phrase (used as span probability in span rebuilding).
PHRASE_WEIGHTS = {"mit license": 0.9, "apache license": 0.8, "general public license": 0.7,
                  "gnu general public": 0.6, "released under the": 0.3, "of the": 0.25,
                  "de la": 0.2, "in the": 0.1, "und der": 0.45}

# Correct spellings for vocabulary canonicalisation (the part-name words).
PART_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
              "new", "old", "plate", "red", "ring", "rod", "small", "widget"]

# Landmark rules keyed by registered domain: (site, field, begin, end).
LANDMARK_RULES = [
    ("example.com", "title", "<h1>", "</h1>"),
    ("example.com", "description", '<div class="ad">', "</div>"),
    ("example.net", "title", "<h1>", "</h1>"),
    ("example.net", "posting-date", "<!-- ad ", " -->"),
    ("example.org", "name", '<a href="/', '"'),
]


def suffixes(spark) -> DataFrame:
    from fieldloom import config
    from fieldloom.operators.plumbing import suffix_rules
    return suffix_rules(spark, config.DEFAULT_PUBLIC_SUFFIXES)


def word_vocab(spark) -> DataFrame:
    return vocabulary(spark, WORD_VOCAB)


def phrase_vocab(spark) -> DataFrame:
    rows = [(p, PHRASE_WEIGHTS[p]) for p in PHRASE_VOCAB]
    return spark.createDataFrame(rows, "entry string, weight double")


def landmark_rules(spark) -> DataFrame:
    return spark.createDataFrame(LANDMARK_RULES, "site string, field string, begin string, end string")
