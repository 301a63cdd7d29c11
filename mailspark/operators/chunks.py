"""Fixed-size chunks, first n per group, one row per id.

No operator here puts a whole group into one task: positions are counted per hash
bucket of the id and shifted by the sizes of the buckets before it, so a mailbox that
holds a third of all rows is numbered by as many tasks as there are buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Hex digits of md5(id) that name a bucket: 16 ** digits buckets per group.
BUCKET_DIGITS = 3


def id_bucket(c: Column, digits: int = BUCKET_DIGITS) -> Column:
    return F.substring(F.md5(c.cast("string")), 1, digits)


def number_rows(
    df: DataFrame,
    id_col: str = "id",
    group_cols: tuple[str, ...] = (),
    digits: int = BUCKET_DIGITS,
    out_col: str = "pos",
) -> DataFrame:
    """Adds the 0-based position of each row in its group, ordered by (bucket, id).

    Dense and stable: the same under every partitioning and after a lost executor.
    """
    group = list(group_cols)
    keyed = df.withColumn("_bucket", id_bucket(F.col(id_col), digits))
    sizes = keyed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # at most 16 ** digits rows per group
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    if not group:
        offsets = F.broadcast(offsets)  # 16 ** digits rows in all
    inside = Window.partitionBy(*group, "_bucket").orderBy(id_col)
    ranked = keyed.withColumn("_rank", F.row_number().over(inside))
    same = F.col("_bucket") == F.col("_b")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return ranked.join(offsets, same).select(
        *df.columns, (F.col("_offset") + F.col("_rank") - 1).cast("bigint").alias(out_col)
    )


def chunk_ids(
    df: DataFrame,
    size: int,
    id_col: str = "id",
    group_cols: tuple[str, ...] = (),
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Adds chunk_id: `size` rows to a chunk, only the last one of a group shorter."""
    numbered = number_rows(df, id_col, group_cols, digits, "_pos")
    return numbered.select(
        *df.columns, F.expr(f"_pos div {int(size)}").alias("chunk_id")
    )


def chunk_arrays(
    df: DataFrame,
    size: int,
    id_col: str = "id",
    group_cols: tuple[str, ...] = (),
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """(group, chunk_id, ids): at most `size` ids to an array."""
    slim = df.select(*group_cols, id_col)
    return (
        chunk_ids(slim, size, id_col, group_cols, digits)
        .groupBy(*group_cols, "chunk_id")
        .agg(F.sort_array(F.collect_list(id_col)).alias("ids"))
    )


def explode_ids(chunks: DataFrame, ids_col: str = "ids", out_col: str = "id") -> DataFrame:
    """Chunk arrays back to one row per id."""
    others = [c for c in chunks.columns if c != ids_col]
    return chunks.select(*others, F.explode(ids_col).alias(out_col))


def first_n_per_group(
    df: DataFrame,
    n: int,
    group_cols: tuple[str, ...],
    order_cols: tuple[Column, ...],
    id_col: str = "id",
    salts: int = 64,
) -> DataFrame:
    """The first n rows of each group: a first cut per (group, salt), the last among
    the at most n * salts rows that are left of a group."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)))
    near = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    last = Window.partitionBy(*group_cols).orderBy(*order_cols)
    cut = salted.withColumn("_rank", F.row_number().over(near)).where(F.col("_rank") <= n)
    return (
        cut.withColumn("_rank", F.row_number().over(last))
        .where(F.col("_rank") <= n)
        .select(*df.columns)
    )


def first_n(df: DataFrame, n: int, order_col: str = "id") -> DataFrame:
    return df.orderBy(order_col).limit(n)


def one_per_id(
    df: DataFrame, id_col: str = "id", order_cols: tuple[str, ...] = ()
) -> DataFrame:
    """One row per id, the least by `order_cols` and then by the other columns.

    An aggregate, so copies of an id shrink before the shuffle.
    """
    rest = [c for c in df.columns if c != id_col and c not in order_cols]
    kept = F.min(F.struct(*order_cols, *rest)).alias("_kept")
    picked = df.groupBy(id_col).agg(kept)
    return picked.select(
        *[F.col(c) if c == id_col else F.col(f"_kept.{c}").alias(c) for c in df.columns]
    )
