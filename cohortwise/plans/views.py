"""Stand-in tables: the collections the operators work on, as views over the
given tables. All views keep every row of their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.functions.labels import NO_FINDING
from cohortwise.operators.ranks import rank_in_chunks

POSITIVE = "PROMO"
ALLOWED = ["PROMO", "SMALL", "LARGE"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(key: Column, buckets: int = 100) -> Column:
    """Stable bucket of a key."""
    hashed = F.md5(F.concat_ws("|", F.lit("42"), key.cast("string")))
    return F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint") % buckets


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the sorted distinct part types of their lines as ``A|B|C``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    labels = (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(F.col("l_orderkey").alias("order_key"))
        .agg(F.array_join(F.sort_array(F.collect_set("p_type")), "|").alias("finding_labels"))
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
    )
    return orders.join(labels, "order_key", "left").select(
        "order_key", F.coalesce("finding_labels", F.lit(NO_FINDING)).alias("finding_labels"), "total", "priority"
    )


def split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys with the split list they stand on."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return orders.withColumn("part", F.when(bucket(F.col("id")) < 80, "train").otherwise("test"))


def split_lists(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    listed = split_list(spark, sf_dir)
    return {p: listed.where(F.col("part") == p).select("id") for p in ("train", "test")}


def split_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings with a relative file name and a train / validate / test column."""
    place = bucket(F.col("order_key"))
    split = F.when(place < 80, "train").when(place < 90, "validate").otherwise("test")
    name = F.concat(F.lit("files/"), F.col("order_key").cast("string"), F.lit(".png"))
    return findings(spark, sf_dir).withColumn("image_files", name).withColumn("split", split)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as samples: file and a class label, unevenly spread over classes."""
    price = F.col("o_totalprice")
    label = F.when(price < 50000, 1).when(price < 120000, 2).otherwise(0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.concat(F.lit("scans/"), F.col("o_orderkey").cast("string"), F.lit(".png")).alias("image_files"),
        label.alias("labels"),
    )


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as file paths, with the first path part as the class."""
    bare = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "/+$", "")
    path = F.regexp_replace(bare, "^https?://", "/")
    return table(spark, sf_dir, "pages").select(
        "page_id", path.alias("path"), F.split_part(path, F.lit("/"), F.lit(3)).alias("class")
    )


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as files of a tree, each once: class, bucket, file name, content.
    Some names begin with an underscore or a dot, and every second file is empty."""
    pages = scans(spark, sf_dir).select("path", "class").distinct().withColumn("place", bucket(F.col("path")))
    begin = F.when(F.col("place") < 20, "_").when(F.col("place") < 40, ".").otherwise("")
    name = F.concat(begin, F.translate(F.substring("path", 2, 1 << 30), "/", "-"))
    return pages.select("class", "place", name.alias("name"), F.when(F.col("place") % 2 == 0, F.col("path")).otherwise("").alias("content"))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a lookup table; every 7th target is null, every 11th no number."""
    key = F.col("c_custkey")
    target = F.when(key % 7 == 0, None).when(key % 11 == 0, "unknown").otherwise(
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".7"))
    )
    return table(spark, sf_dir, "customer").select((key * 2).cast("int").alias("id"), target.alias("target"))


def pred2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary predictions: labelled documents, the text length as score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (
        table(spark, sf_dir, "labels")
        .join(docs, "doc_id")
        .select(
            "doc_id",
            F.col("quality").alias("y_true"),
            (F.col("n_chars") > 1000).cast("int").alias("y_pred"),
            F.col("n_chars").cast("double").alias("score"),
        )
    )


def pred10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions over many classes: the vector's values as scores."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").alias("y_true"), F.col("embedding").alias("logits")
    )


def pred_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions over many classes with gaps: null truths and predictions, and truths
    that no score belongs to, beyond the last class or negative."""
    row, label = F.col("vec_id") % 10, F.col("label")
    truth = F.when(row == 3, None).when(row == 4, label + 100).when(row == 5, -2).otherwise(label)
    guess = F.when(F.col("vec_id") % 7 == 0, None).otherwise(F.when(F.col("vec_id") % 2 == 0, label).otherwise(1))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", truth.alias("y_true"), guess.alias("y_pred"), F.col("embedding").alias("logits")
    )


def pred_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many predictions with real scores: order lines, the price as score."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        (F.col("l_quantity") > 25).cast("int").alias("y_pred"),
        F.col("l_extendedprice").alias("score"),
        F.array(F.lit(0.0), (F.col("l_quantity") - 25) / 10).alias("logits"),
        F.col("l_linestatus").alias("split"),
        F.col("l_linenumber").alias("epoch"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a metric log; the epoch is the position among the user's events."""
    events = table(spark, sf_dir, "events")
    kept = events.select(
        F.col("user_id").alias("run_id"),
        "event_id",
        "ts",
        F.col("event_type").alias("metric"),
        "value",
        F.when(F.col("event_id") % 5 == 0, "val").otherwise("train").alias("split"),
    )
    minute = F.struct(F.to_date("ts"), F.hour("ts"), F.minute("ts"))
    ranked = rank_in_chunks(kept, minute, ["ts", "event_id"], ["run_id"], "epoch")
    return ranked.select("run_id", F.col("epoch").cast("int").alias("epoch"), "split", "metric", "value")


def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as runs with base and overriding parameters."""
    key = F.col("c_custkey")
    text = lambda c: c.cast("string")
    third = key % 3
    base = F.create_map(
        *[
            x
            for k, v in {
                "_target_": F.concat(F.lit("models."), F.initcap("c_mktsegment"), F.lit("Net")),
                "optimizer": F.lit("torch.optim.Adam"),
                "criterion": F.lit("torch.nn.CrossEntropyLoss"),
                "lr": F.concat(F.lit("0.00"), text(F.col("c_nationkey") + 1)),
                "mode": F.when(third == 0, "train").when(third == 1, "evaluate").otherwise("diffusion"),
                "type": F.when(third == 0, "train").when(third == 1, "eval").otherwise("diff"),
                "use_sampling": F.when(key % 2 == 0, "true").otherwise("false"),
                "sampling_method": F.lit("resample"),
                "sample_to_value": F.lit("3500"),
                "random_state": text(key % 1000),
                "date": F.lit("2024-01-01"),
                "timestamp": F.lit("00-00-00"),
                "postfix": F.lower("c_mktsegment"),
            }.items()
            for x in (F.lit(k), v)
        ]
    )
    override = F.create_map(
        F.lit("lr"), F.when(key % 5 == 0, "0.1").otherwise(F.concat(F.lit("0.00"), text(F.col("c_nationkey") + 1))),
        F.lit("pretrained_model"), F.concat(F.lit("run-"), text(key)),
    )
    return table(spark, sf_dir, "customer").select(key.alias("run_id"), base.alias("params"), override.alias("override"))


def pred_stream(events: DataFrame) -> DataFrame:
    """Events as predictions that arrive over time."""
    return events.select(
        "ts",
        (F.col("event_type") == "error").cast("int").alias("y_true"),
        (F.col("value") > 10).cast("int").alias("y_pred"),
    )
