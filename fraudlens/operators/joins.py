"""Equi-joins: identity merge, semi joins, and lookups that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from fraudlens.functions.vectors import or_zeros

BROADCAST_BYTES = 64 * 1024 * 1024


def merge_identity(
    tx: DataFrame,
    idn: DataFrame | None,
    key: str = "TransactionID",
    null_safe: bool = False,
    check_unique: bool = False,
) -> DataFrame:
    """Left outer join of identities onto transactions; without identities the transactions pass through.

    Columns present on both sides get the suffixes ``_x`` and ``_y``. A repeated key on the right
    multiplies rows unless ``check_unique`` asks for an error.
    """
    if idn is None:
        return tx
    if check_unique and not idn.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{key} is not unique in the identity table")
    shared = [c for c in tx.columns if c in idn.columns and c != key]
    left = tx.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = idn.withColumnsRenamed({c: f"{c}_y" for c in shared})
    if not null_safe:
        return left.join(right, key, "left")
    right = right.withColumnRenamed(key, "_key")
    return left.join(right, left[key].eqNullSafe(right["_key"]), "left").drop("_key")


def semi(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(other.select(*keys), keys, "left_semi")


def anti(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(other.select(*keys), keys, "left_anti")


def _value_bytes(col: Column, kind: T.DataType) -> Column:
    """Bytes of a value; what is nested is measured down to its leaves."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(col) + 16
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        size = F.size(col) * 8 + 16
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(col, F.lit(16), lambda total, x: total + _value_bytes(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        entries = T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]))
        size = _value_bytes(F.map_entries(col), entries)
    elif isinstance(kind, T.StructType):
        size = F.lit(16)
        for field in kind.fields:
            size = size + _value_bytes(col[field.name], field.dataType)
    elif isinstance(kind, T.UserDefinedType):
        size = F.octet_length(F.to_json(F.struct(col)))  # a number's text is no shorter than half its bytes
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("int"), F.lit(8))


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as they would be broadcast, measured by one aggregation over the table."""
    row = F.lit(8)
    for field in df.schema.fields:
        row = row + _value_bytes(F.col(f"`{field.name}`"), field.dataType).cast("long")
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Keys that hold at least 1/parts of the rows with a key, the share of a mean partition: never more
    than ``parts`` of them."""
    known = df.select(*keys).na.drop()
    counts = known.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    found = counts.filter(F.col("_n") * parts >= total).select(*keys).collect()
    return df.sparkSession.createDataFrame(found, df.select(*keys).schema)


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: str | Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    parts: int | None = None,
    salts: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``dim`` (unique keys, already written or cheap to read) onto ``facts``.

    The dimension is broadcast when its measured size allows. Beyond that both sides are shuffled, with
    the rows of hot and null keys spread over ``salts`` parts (as many as shuffle partitions, unless
    given) and the few hot dimension rows repeated. With ``null_safe`` a missing key finds the
    dimension's row of the missing key.
    The salt is a hash of the row, so a retried task places its rows as before.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if null_safe:
        return _null_safe_lookup(facts, dim, keys, how, broadcast_bytes, parts, salts)
    if measured_bytes(dim) <= broadcast_bytes:
        return facts.join(F.broadcast(dim), keys, how)
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, keys, parts).withColumn("_hot", F.lit(True))  # at most ``parts`` rows
    salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    left = (
        facts.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.when(F.col("_hot") | any_null, salt).otherwise(F.lit(0)))
        .drop("_hot")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = (
        dim.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    # merge: both sides are beyond broadcast size, and sorting spills where a hash table would not
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def _null_safe_lookup(facts, dim, keys, how, broadcast_bytes, parts, salts) -> DataFrame:
    """Lookup over keys that are never null: each key beside a flag that tells whether it is missing."""
    flags, known = [], []
    for i, key in enumerate(keys):
        flags.append(F.col(key).isNull().alias(f"__null{i}"))
        zero = F.lit("" if facts.schema[key].dataType.typeName() == "string" else 0).cast(facts.schema[key].dataType)
        known.append(F.coalesce(F.col(key), zero).alias(f"__key{i}"))
    names = [f"__{kind}{i}" for i in range(len(keys)) for kind in ("null", "key")]
    left = facts.select("*", *flags, *known)
    right = dim.select(*flags, *known, *[c for c in dim.columns if c not in keys])
    return lookup(left, right, names, how, broadcast_bytes, parts, salts).drop(*names)


def filter_unseen(
    df: DataFrame, vocabs: dict[str, DataFrame], **tuning
) -> tuple[DataFrame, DataFrame]:
    """Keep rows whose every entity is in its vocabulary; second result counts before, after and dropped.

    A missing key is seen if the vocabulary has an entity of the missing key.
    """
    flagged = df
    seen = F.lit(True)
    for i, (key, vocab) in enumerate(vocabs.items()):
        flagged = lookup(flagged, vocab.select(key, F.lit(True).alias(f"_seen{i}")), key, "left", null_safe=True, **tuning)
        seen = seen & F.coalesce(F.col(f"_seen{i}"), F.lit(False))
    flagged = flagged.withColumn("_seen", seen)
    report = flagged.agg(
        F.count("*").alias("rows_before"),
        F.count_if("_seen").alias("rows_after"),
        F.count_if(~F.col("_seen")).alias("rows_dropped"),
    )
    return flagged.filter("_seen").select(*df.columns), report


def attach_embedding(df: DataFrame, emb: DataFrame, key: str | Sequence[str], vec: str, dim: int, **tuning) -> DataFrame:
    """Add the entity's embedding, or a zero vector for an unseen entity; a missing key part is a value like any other."""
    return lookup(df, emb, key, "left", null_safe=True, **tuning).withColumn(vec, or_zeros(F.col(vec), dim))


def take(df: DataFrame, split: str, name: str = "split") -> DataFrame:
    """Rows of one split; on a table written per split this prunes directories."""
    return df.filter(F.col(name) == split).drop(name)


def attach_weights(df: DataFrame, weights: DataFrame, label: str) -> DataFrame:
    """Add the weight of each row's class; ``weights`` has one row per class and is measured before broadcast."""
    return lookup(df, weights, label, "left")
