"""Configuration by longest prefix, effective settings and limits."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions.validate import Limits, errors, global_limit_rules

#: A configuration table of more rows is joined by prefix instead of being broadcast.
BROADCAST_ROWS = 10_000


def read_configs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of JSON documents, one configuration each."""
    return spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").json(path)


LIMITS_SCHEMA = "maxFileBytes bigint, maxChunkBytes bigint, maxEventBytes int, maxBatchSize int, inputTypes map<string, struct<maxFileBytes: bigint, maxRecordBytes: bigint>>"


def read_limits(spark: SparkSession, path: str) -> Limits:
    """The one JSON document of limits that no configuration may exceed. More or fewer documents, or
    one that breaks a rule, is an error that names the rules."""
    names = {"maxFileBytes": "max_file_bytes", "maxChunkBytes": "max_chunk_bytes", "maxEventBytes": "max_event_bytes", "maxBatchSize": "max_batch_size"}
    of = F.transform_values("inputTypes", lambda _, v: F.struct(v["maxFileBytes"].alias("max_file_bytes"), v["maxRecordBytes"].alias("max_record_bytes")))
    rows = read_configs(spark, path, LIMITS_SCHEMA).withColumnsRenamed(names).withColumn("input_types", of)
    found = rows.withColumn("broken", errors(global_limit_rules())).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{path} holds {'no' if not found else 'more than one'} document of limits")
    if found[0].broken:
        raise ValueError(f"{path} breaks {', '.join(found[0].broken)}")
    r = found[0]
    return Limits(*(r[n] for n in names.values()), {t: (v.max_file_bytes, v.max_record_bytes) for t, v in r.input_types.items()})


def resolve(objects: DataFrame, configs: DataFrame, how: str = "inner") -> DataFrame:
    """Each object with the configuration of its bucket whose prefix is the longest that its key has.

    configs: bucket, prefix, name and more (bucket and prefix come back as config_bucket and
    config_prefix). Of equal prefixes the first name holds; an empty prefix matches nothing. Objects
    without a match are left out, or kept with nulls if ``how`` is "left".

    The prefixes of a key that can match are those of the lengths that occur, so the join is an
    equality on (bucket, prefix): no pair of an object and an unrelated configuration is made.
    """
    known = configs.where(F.col("prefix") != "")
    others = [c for c in known.columns if c not in ("bucket", "prefix")]
    first = known.groupBy("bucket", "prefix").agg(F.min(F.struct("name", *[c for c in others if c != "name"])).alias("c"))
    lengths = sorted(r[0] for r in known.select(F.length("prefix")).distinct().collect())  # bounded by the longest key
    # each different object once: a number made up for a row could differ between the two sides
    keys = objects.select("bucket", "key").distinct()
    tries = keys.select(F.col("bucket").alias("__b"), F.col("key").alias("__k"), F.explode(F.array_distinct(F.array(*[F.substring("key", 1, n) for n in lengths]) if lengths else F.array().cast("array<string>"))).alias("__p"))
    small = len(first.limit(BROADCAST_ROWS + 1).select("bucket").collect()) <= BROADCAST_ROWS
    build = F.broadcast(first) if small else first
    hits = tries.join(build, (F.col("__b") == F.col("bucket")) & (F.col("__p") == F.col("prefix")))
    best = hits.groupBy("__b", "__k").agg(F.max_by(F.struct("bucket", "prefix", "c"), F.length("prefix")).alias("m"))
    out = objects.join(best, (F.col("bucket") == F.col("__b")) & (F.col("key") == F.col("__k")), how)
    return out.select(*objects.columns, F.col("m.bucket").alias("config_bucket"), F.col("m.prefix").alias("config_prefix"), *[F.col(f"m.c.{c}").alias(c) for c in others])


def resolve_small(objects: DataFrame, configs: DataFrame, how: str = "inner") -> DataFrame:
    """``resolve`` in one pass without a shuffle of the objects, for a configuration of checked size:
    it travels as a map (bucket, prefix) -> settings and each key looks its prefixes up, longest first."""
    rows = configs.where(F.col("prefix") != "").limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        return resolve(objects, configs, how)
    others = [c for c in configs.columns if c not in ("bucket", "prefix")]
    table: dict[str, dict] = {}
    for r in rows:
        d = r.asDict()
        k = f"{d['bucket']}\0{d['prefix']}"
        if k not in table or d["name"] < table[k]["name"]:
            table[k] = d
    spark = objects.sparkSession
    kinds = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in configs.schema.fields)
    one = spark.createDataFrame([({k: tuple(d[c] for c in configs.columns) for k, d in table.items()},)], f"__m map<string, struct<{kinds}>>")
    lengths = sorted({len(d["prefix"]) for d in table.values()}, reverse=True)
    joined = objects.crossJoin(F.broadcast(one))  # one row
    found = F.coalesce(*[F.try_element_at("__m", F.concat(F.col("bucket"), F.lit("\0"), F.substring("key", 1, n))) for n in lengths]) if lengths else F.lit(None)
    out = joined.withColumn("__c", found)
    if how == "inner":
        out = out.where(F.col("__c").isNotNull())
    return out.select(*objects.columns, F.col("__c.bucket").alias("config_bucket"), F.col("__c.prefix").alias("config_prefix"), *[F.col(f"__c.{c}").alias(c) for c in others])


@dataclass
class Settings:
    """Defaults of a run; ``from_env`` takes RECORDMILL_<NAME> and checks the range."""

    records_per_chunk: int = 50_000
    batch_size: int = 10
    max_event_bytes: int = 262_144
    max_envelopes_per_message: int = 100
    publish_concurrency: int = 8
    retention_days: int = 90
    max_attempts: int = 3

    LIMITS = {"batch_size": (1, 10), "max_event_bytes": (1, 1_048_576), "publish_concurrency": (1, 16), "max_attempts": (1, 10)}

    @classmethod
    def from_env(cls) -> Settings:
        out = cls(**{f.name: int(os.environ[k]) for f in fields(cls) if (k := f"RECORDMILL_{f.name.upper()}") in os.environ})
        for name, (low, high) in cls.LIMITS.items():
            if not low <= getattr(out, name) <= high:
                raise ValueError(f"{name} must be from {low} to {high}")
        return out
