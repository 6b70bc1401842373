"""Distinct counts that merge: exact bitmaps over dictionary codes.

A distinct count cannot be added up. A bitmap of the values' codes can: bitmaps of groups are OR-ed into those of
any wider group, and only the bits are counted. Bitmaps are kept in buckets of 64 codes, each one number, so a group
takes one row per bucket that it has a value in: never more than it has distinct values, however few of the codes those are.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

BUCKET_CODES = 64
BUCKET, BITS = "_bucket", "_bits"


def extended(dictionary: DataFrame | None, values: DataFrame, column: str) -> DataFrame:
    """(value, code) of a dictionary and the codes of values that are new to it; NULL has no code.

    Store the result before it is used: codes are given task by task. Old codes stay, so that bitmaps made before can be
    merged with later ones.
    """
    new = values.select(column).where(F.col(column).isNotNull()).distinct()
    if dictionary is None:
        return new.select(column, (F.monotonically_increasing_id() + 1).alias("code"))
    start = dictionary.agg((F.floor((F.max("code") - 1) / BUCKET_CODES) + 1) * BUCKET_CODES + 1).scalar()
    added = new.join(dictionary, column, "left_anti").select(column, (F.monotonically_increasing_id() + F.coalesce(start, F.lit(1))).alias("code"))
    return dictionary.unionByName(added)


def bitmaps(rows: DataFrame, groups: list[str], column: str, dictionary: DataFrame) -> DataFrame:
    """Per group and bucket, the bitmap of the group's values; groups without a value have no row.

    Values are made distinct per group before they meet the dictionary, so that a frequent value is one row of a group.
    """
    pairs = rows.select(*groups, column).where(F.col(column).isNotNull()).distinct()
    return pairs.join(dictionary, column).groupBy(*groups, F.expr(f"(code - 1) DIV {BUCKET_CODES}").alias(BUCKET)).agg(
        F.bit_or(F.expr(f"SHIFTLEFT(1L, CAST((code - 1) % {BUCKET_CODES} AS INT))")).alias(BITS))


def merged(sets: DataFrame, by: list[str]) -> DataFrame:
    """The bitmaps of wider groups."""
    return sets.groupBy(*by, BUCKET).agg(F.bit_or(BITS).alias(BITS))


def counted(sets: DataFrame, by: list[str], name: str) -> DataFrame:
    """How many distinct values each of these (wider) groups has; without groups, one row, also of nothing."""
    return merged(sets, by).groupBy(*by).agg(F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("bigint").alias(name))


def roll_ups(sets: DataFrame, levels: dict[str, list[str]], groups: list[str], name: str) -> DataFrame:
    """Distinct counts of several levels of grouping from one table of bitmaps; columns that a level does not group by are NULL."""
    types = dict(sets.dtypes)
    return reduce(DataFrame.unionByName, [
        counted(sets, by, name).select(
            F.lit(level).alias("level"), *[F.col(g) if g in by else F.lit(None).cast(types[g]).alias(g) for g in groups], name)
        for level, by in levels.items()])


def trailing(sets: DataFrame, by: list[str], step: str, width: int, name: str) -> DataFrame:
    """Distinct values of each group over ``width`` steps (integers) up to each step that the group has."""
    # A step's bitmap counts for itself and the steps after it; only those that the group has are shown.
    shifts = F.explode(F.sequence(F.lit(0), F.lit(width - 1)))
    spread = sets.select(*by, F.col(step).alias("_own"), BUCKET, BITS, shifts.alias("_shift")).select(
        *by, (F.col("_own") + F.col("_shift")).cast(dict(sets.dtypes)[step]).alias(step), BUCKET, BITS, (F.col("_shift") == 0).alias("_there"))
    united = spread.groupBy(*by, step, BUCKET).agg(F.bit_or(BITS).alias(BITS), F.bool_or("_there").alias("_there"))
    return united.groupBy(*by, step).agg(F.sum(F.bit_count(BITS)).cast("bigint").alias(name), F.bool_or("_there").alias("_there")).where(
        "_there").drop("_there")
