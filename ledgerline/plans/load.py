"""Loading a star with its constraints kept.

A key constraint refuses a row; a job cannot refuse, but it can keep a row
out of what it loads. ``load_star`` writes the rows that meet every primary
and foreign key to a new folder and those that do not to a quarantine table
beside them, with their reasons, or stops. Readers see a finished folder or
none: everything is written under a working name, which is then renamed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .quality import TABLE_KEYS, _relationships
from .star import Star, read_star, write_star

NULL_KEY, REPEATED_KEY = "null key", "repeated key"


@dataclass
class Load:
    """What was loaded, from where, and what was kept out."""

    star: Star
    folder: str
    quarantine: DataFrame


def _key_reasons(rows: DataFrame, key: str) -> DataFrame:
    """Rows with ``_repeated``: whether another row has their key. Keys are
    counted with map-side aggregation; just repeated ones join back."""
    repeated = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")) \
        .filter("_n > 1").select("_k")
    return rows.join(repeated, F.col(key) == F.col("_k"), "left").withColumn("_repeated", F.col("_k").isNotNull()).drop("_k")


def _reasons(*named: tuple[Column, str]) -> Column:
    return F.concat_ws(", ", *(F.when(rule, F.lit(name)) for rule, name in named))


def checked(star: Star) -> dict[str, DataFrame]:
    """Each table, written once, with ``_reason``: empty if the row meets its
    constraints, else all it breaks, in the order of the constraints.

    A NULL primary key and every row of a repeated one break the table's own
    key. A fact's foreign key must be NULL or the key of a dimension row that
    is itself accepted."""
    keys = {attr: key for _, attr, key in TABLE_KEYS}
    out: dict[str, DataFrame] = {}
    for attr, key in keys.items():
        rows = getattr(star, attr)
        if rows is None or attr == "fact":
            continue
        reason = _reasons((F.col(key).isNull(), NULL_KEY), (F.col("_repeated"), REPEATED_KEY))
        out[attr] = materialize(_key_reasons(rows, key).withColumn("_reason", reason).drop("_repeated"), "checked")
    fact, rules = _key_reasons(star.fact, keys["fact"]), [(F.col(keys["fact"]).isNull(), NULL_KEY), (F.col("_repeated"), REPEATED_KEY)]
    for rel, fk, dim, key in _relationships(star):
        accepted = out[dim].filter("_reason = ''").select(F.col(key).alias(f"_{rel}"))
        fact = fact.join(accepted, F.col(fk) == F.col(f"_{rel}"), "left")
        rules.append((F.col(fk).isNotNull() & F.col(f"_{rel}").isNull(), f"orphan {rel}"))
    out["fact"] = materialize(fact.withColumn("_reason", _reasons(*rules)).select(*star.fact.columns, "_reason"), "checked")
    return out


def quarantined(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_key, reason, row)`` of all rows kept out, the row as JSON."""
    names = {attr: (name, key) for name, attr, key in TABLE_KEYS}
    return reduce(DataFrame.unionByName, (
        df.filter("_reason <> ''").select(
            F.lit(names[attr][0]).alias("table_name"), F.col(names[attr][1]).cast("long").alias("row_key"),
            F.col("_reason").alias("reason"),
            F.to_json(F.struct(*[c for c in df.columns if c != "_reason"])).alias("row"))
        for attr, df in tables.items()))


def load_star(star: Star, folder: str, on_violation: str = "quarantine") -> Load:
    """Save the star's accepted rows in a new folder below ``folder``, with
    the rows kept out in ``quarantine`` there; ``on_violation="stop"`` raises
    if there are any, and nothing is loaded."""
    if on_violation not in ("quarantine", "stop"):
        raise ValueError("on_violation must be 'quarantine' or 'stop'")
    tables = checked(star)
    bad = quarantined(tables)
    if on_violation == "stop":
        found = bad.groupBy("table_name", "reason").count().orderBy("table_name", "reason").limit(20).collect()
        if found:
            raise ValueError("; ".join(f"{r['table_name']}: {r['reason']} ({r['count']} rows)" for r in found))
    spark, name = star.fact.sparkSession, f"load-{uuid.uuid4().hex[:12]}"
    working, done = f"{folder.rstrip('/')}/_{name}", f"{folder.rstrip('/')}/{name}"
    good = replace(star, **{attr: df.filter("_reason = ''").drop("_reason") for attr, df in tables.items()})
    write_star(good, working)
    bad.write.parquet(f"{working}/quarantine")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not path(working).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(path(working), path(done)):
        raise OSError(f"cannot rename {working}")
    return Load(read_star(spark, done, good), done, spark.read.schema(bad.schema).parquet(f"{done}/quarantine"))
