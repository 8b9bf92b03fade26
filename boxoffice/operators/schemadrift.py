"""V-3: the narrowest type that holds a text column's values, per file and joined upwards.

Types form a lattice: int below bigint below double, date below timestamp, and all of
them, with boolean, below string; a column without values is void. How many values each
type holds is a count, so the aggregate merges: tasks count their rows, files add up
to folders and days to months, and the join of any number of files is found from their sums
without reading them again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: From narrow to wide: the first type that holds all values is the column's.
LATTICE = ["boolean", "int", "bigint", "double", "date", "timestamp"]
COUNTS = [f"n_{t}" for t in LATTICE]

_INT = r"^[+-]?[0-9]{1,18}$"
_DOUBLE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?$"


def _held(c: Column) -> dict[str, Column]:
    """Whether a value is of each type; a wider numeric or time type holds what a narrower one does."""
    whole = c.rlike(_INT)
    number = F.when(whole, c.try_cast("bigint"))
    day = c.rlike(_DATE) & c.try_cast("date").isNotNull()
    return {"boolean": F.lower(c).isin("true", "false"), "int": F.coalesce(number.between(-(1 << 31), (1 << 31) - 1), F.lit(False)),
            "bigint": whole, "double": c.rlike(_DOUBLE), "date": day, "timestamp": day | (c.rlike(_TIME) & c.try_cast("timestamp_ntz").isNotNull())}


def type_counts(raw: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(*by, column_name, n_rows, n_values, max_width, counts by type) in one pass over text columns."""
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        aggs += [F.count(c).alias(f"v{i}"), F.max(F.length(c)).alias(f"w{i}")]
        aggs += [F.count_if(is_a).alias(f"{t}{i}") for t, is_a in _held(c).items()]
        rows.append(F.struct(F.lit(name).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"v{i}").alias("n_values"),
                             F.col(f"w{i}").alias("max_width"), *[F.col(f"{t}{i}").alias(f"n_{t}") for t in LATTICE]))
    return raw.groupBy(*by).agg(*aggs).select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def joined(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counts of several files as those of one, by ``by``."""
    return counts.groupBy(*by, "column_name").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_values")], F.max("max_width").alias("max_width"),
                                                  *[F.sum(c).alias(c) for c in COUNTS])


def narrowest(counts: DataFrame) -> DataFrame:
    """Adds ``type_name`` and ``nullable``."""
    kind = F.when(F.col("n_values") == 0, "void")
    for t, n in zip(LATTICE, COUNTS):
        kind = kind.when(F.col(n) == F.col("n_values"), t)
    return counts.withColumn("type_name", kind.otherwise("string")).withColumn("nullable", F.col("n_values") < F.col("n_rows"))


def _fits(found: str, declared: str) -> bool:
    wider = {"void": [*LATTICE, "string"], "int": ["bigint", "double"], "bigint": ["double"], "date": ["timestamp"]}
    return declared in ("string", found) or declared in wider.get(found, [])


def drift(types: DataFrame, schema: StructType) -> DataFrame:
    """Adds the declared type and whether what was found fits it: ``ok`` is false for a wider or
    other type, and for NULLs where none may be."""
    spark = types.sparkSession
    kinds = {"timestamp_ntz": "timestamp"}
    declared = [(f.name, kinds.get(f.dataType.simpleString(), f.dataType.simpleString()), f.nullable) for f in schema.fields]
    pairs = [(n, t, null, found) for n, t, null in declared for found in ["void", *LATTICE, "string"] if _fits(found, t)]
    known = spark.createDataFrame(declared, "column_name string, declared string, may_be_null boolean")
    fine = spark.createDataFrame(pairs, "column_name string, declared string, may_be_null boolean, type_name string").select("column_name", "type_name", F.lit(True).alias("_fits"))
    return (types.join(known, "column_name").join(fine, ["column_name", "type_name"], "left")
            .withColumn("ok", F.coalesce("_fits", F.lit(False)) & (F.col("may_be_null") | ~F.col("nullable"))).drop("_fits", "may_be_null"))
