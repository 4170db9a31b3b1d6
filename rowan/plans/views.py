"""Labelled tables derived from the star schema, documents and labels.

Each view is a ``DatasetSpec`` and a lazily derived DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowan.functions.scores import at_least
from rowan.functions.text import normalise_na
from rowan.spec import DatasetSpec

LINES = DatasetSpec(
    key="l_orderkey",
    target="status",
    positive="F",
    negative="O",
    numeric=("raw_price",),
    required=("l_orderkey", "l_linenumber", "raw_price", "flag", "status"),
    allowed={"flag": ("A", "N", "R"), "status": ("F", "O")},
)

CUSTOMERS = DatasetSpec(
    key="c_custkey",
    target="lapsed",
    positive="Yes",
    negative="No",
    numeric=("balance", "n_orders", "spend", "days_since"),
    required=(
        "c_custkey", "segment", "nation", "balance", "n_orders", "spend", "days_since", "lapsed",
    ),
    allowed={"lapsed": ("Yes", "No")},
)

DOCUMENTS = DatasetSpec(
    key="doc_id",
    target="quality",
    positive="1",
    negative="0",
    numeric=("n_chars", "words", "unique_share", "punctuation_share"),
    required=(
        "doc_id", "n_chars", "words", "unique_share", "punctuation_share", "lang", "source",
        "quality",
    ),
    allowed={"quality": ("0", "1")},
)

# Customers are described by what they did before this day and labelled by what follows.
CUTOFF = "2000-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as they might arrive in a text file: prices as text, with dirt.

    The dirt varies by ship year, so that comparing years flags each kind of drift somewhere.
    """
    order, part, year = F.col("l_orderkey"), F.col("l_partkey"), F.year("l_shipdate")
    price = (
        F.when((order % 97 == 0) | ((year == 1999) & (order % 23 == 0)), " ")
        .when(order % 89 == 0, "n/a")
        .when(order % 83 == 0, "12x")
        .when(order % 79 == 0, "1d")
        .otherwise(F.col("l_extendedprice").cast("decimal(14,2)").cast("string"))
    )
    flag = (
        F.when(part % 101 == 0, "Z")
        .when((part % 103 == 0) | ((year == 1998) & (part % 29 == 0)), None)
        .otherwise(F.col("l_returnflag"))
    )
    status = F.when((year == 1999) & (order % 5 == 0), "O").otherwise(F.col("l_linestatus"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        year.alias("yr"),
        price.alias("raw_price"),
        flag.alias("flag"),
        status.alias("status"),
    )


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_na(lines(spark, sf_dir))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order history per customer before the cutoff; lapsed = no order from then on."""
    before = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp")
    price = F.col("o_totalprice").cast("decimal(14,2)")
    history = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count_if(before).alias("earlier"),
            F.count_if(~before).alias("later"),
            F.sum(F.when(before, price)).cast("double").alias("spend"),
            F.max(F.when(before, F.to_date("o_orderdate"))).alias("last_order"),
        )
    )
    return (
        table(spark, sf_dir, "customer")
        .join(history, "c_custkey", "left")
        .select(
            "c_custkey",
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").cast("string").alias("nation"),
            F.col("c_acctbal").alias("balance"),
            F.coalesce("earlier", F.lit(0)).cast("double").alias("n_orders"),
            "spend",
            F.datediff(F.lit(CUTOFF), "last_order").cast("double").alias("days_since"),
            F.when(F.coalesce("later", F.lit(0)) > 0, "No").otherwise("Yes").alias("lapsed"),
        )
    )


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and style measures over each whole text."""
    words = F.array_remove(F.split("text", "[ \\t\\n\\r]+"), "")
    bare = F.regexp_replace("text", "[A-Za-z0-9 \\t\\n\\r]+", "")

    def share(part: Column, whole: Column) -> Column:
        return F.try_divide(part.cast("double"), whole.cast("double"))

    measured = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "source",
        F.length("text").alias("length"),
        F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("unique_words"),
        F.length(bare).alias("punctuation"),
    )
    return measured.select(
        "doc_id",
        F.col("length").cast("double").alias("n_chars"),
        F.col("words").cast("double").alias("words"),
        share(F.col("unique_words"), F.col("words")).alias("unique_share"),
        share(F.col("punctuation"), F.col("length")).alias("punctuation_share"),
        "lang",
        "source",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents; both sides are keyed by ``doc_id``."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("quality")
    )
    return document_features(spark, sf_dir).join(labels, "doc_id")


def scored_orders(spark: SparkSession, sf_dir: str, variants: int = 1) -> DataFrame:
    """Orders under several made-up scorers: (model, trial, fold, label, probability, prediction).

    Scores are integer arithmetic on the key, so every engine gets the same doubles, with many
    ties and values on the threshold grid.
    """
    label = (F.col("o_orderstatus") == "F").cast("int")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 5).cast("int").alias("fold"), label.alias("label")
    )

    def scorer(name: str, trial: int, step: int, lift: int) -> Column:
        points = F.col("o_orderkey") * (step + 2 * trial) % 1000 + lift * F.col("label")
        return F.struct(
            F.lit(name).alias("model"),
            F.lit(trial).alias("trial"),
            (points / F.lit(1000.0 + lift)).alias("probability"),
        )

    scorers = (("a", 7919, 250), ("b", 6101, 500), ("c", 4603, 500))
    cells = F.array(
        *[scorer(name, t, step, lift) for name, step, lift in scorers for t in range(variants)]
    )
    scored = orders.select("o_orderkey", "fold", "label", F.explode(cells).alias("s"))
    prediction = at_least(F.col("s.probability")).alias("prediction")
    return scored.select("o_orderkey", "fold", "label", "s.*", prediction)
