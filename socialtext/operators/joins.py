"""Joins: keys of the relational tables, gazetteer lookup, vectors against class vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from socialtext.functions.arrays import cosine_similarity

# Class vectors above this count go through the chunked join.
CLASS_CHUNK = 256


def posts_with_users(posts: DataFrame, users: DataFrame, how: str = "inner") -> DataFrame:
    return posts.join(users.select(*[F.col(c).alias(c if c == "user_id" else f"user_{c}") for c in users.columns]),
                      "user_id", how)


def posts_with_payload(posts: DataFrame, payload: DataFrame, how: str = "left") -> DataFrame:
    """Entities, geo or place rows of a post."""
    return posts.join(payload, posts["id"] == payload["tweet_id"], how).drop("tweet_id")


def users_with_location(users: DataFrame, locations: DataFrame, how: str = "left") -> DataFrame:
    return users.join(locations, "user_id", how)


def normal_address(text: Column) -> Column:
    """Lower case, signs to blanks, one blank between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def locate(users: DataFrame, gazetteer: DataFrame, located: str = "located") -> DataFrame:
    """``user_id, address, longitude, latitude`` of accounts whose location text is in the gazetteer.

    Each distinct text is looked up once, then joined back to the accounts.
    """
    keyed = users.filter(F.col(located).isNotNull()).select("user_id", normal_address(F.col(located)).alias("_key"))
    places = (gazetteer.select(normal_address(F.col("address_text")).alias("_key"), "address", "longitude", "latitude")
              .groupBy("_key").agg(F.min(F.struct("address", "longitude", "latitude")).alias("_p"))
              .select("_key", "_p.*"))
    return keyed.filter("_key <> ''").join(places, "_key").drop("_key")


def class_similarity(docs: DataFrame, id_col: str, vector_col: str, classes: DataFrame, label_col: str = "label",
                     class_vector_col: str = "vector", chunk: int = CLASS_CHUNK) -> DataFrame:
    """``id, label, similarity`` of every document with every class vector.

    Up to ``chunk`` classes are one array of vectors, carried as a scalar subquery into a map over the
    documents. More classes are cut into chunks of that size and joined on the chunk number, with
    the documents repeated once per chunk and salted, so that no chunk is one task.
    """
    number = classes.select(label_col).limit(chunk + 1).count()
    entries = F.struct(F.col(label_col).alias("label"), F.col(class_vector_col).alias("vector"))

    def scored(array: Column) -> Column:
        return F.explode(F.transform(array, lambda c: F.struct(
            c["label"].alias("label"), cosine_similarity(F.col(vector_col), c["vector"]).alias("similarity"))))

    if number <= chunk:
        every = classes.agg(F.sort_array(F.collect_list(entries)).alias("c")).scalar()
        rows = docs.select(id_col, vector_col, every.alias("_c")).select(id_col, scored(F.col("_c")).alias("_s"))
    else:
        total = classes.count()
        chunks = -(-total // chunk)
        salts = max(1, docs.sparkSession.sparkContext.defaultParallelism // chunks)
        numbered = classes.withColumn("_chunk", F.pmod(F.xxhash64(label_col), F.lit(chunks)).cast("int"))
        arrays = numbered.groupBy("_chunk").agg(F.collect_list(entries).alias("_c"))
        arrays = arrays.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        repeated = (docs.select(id_col, vector_col)
                    .withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))
                    .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
        rows = repeated.join(arrays, ["_chunk", "_salt"]).select(id_col, scored(F.col("_c")).alias("_s"))
    return rows.select(id_col, F.col("_s.label").alias(label_col), F.col("_s.similarity").alias("similarity"))


def similarity_summary(similarities: DataFrame, id_col: str) -> DataFrame:
    """Average and largest class similarity per document."""
    return similarities.groupBy(id_col).agg(
        F.avg("similarity").alias("avg_similarity"), F.max("similarity").alias("max_similarity"))


def mean_vectors(df: DataFrame, key: str, vector_col: str, dims: int) -> DataFrame:
    """Mean vector per key: one partial sum per dimension, so no group is collected."""
    sums = [F.avg(F.col(vector_col)[i].cast("double")).alias(f"_{i}") for i in range(dims)]
    return df.groupBy(key).agg(*sums).select(key, F.array(*[F.col(f"_{i}") for i in range(dims)]).alias("vector"))


def join_predictions(predictions: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    return predictions.join(labels, id_col)
