"""V-7/V-8: which keys differ between two tables, by invertible Bloom lookup tables.

Every key, as a 64-bit hash, is added to one cell of each of three parts of its group's table:
a cell holds how many keys it got, their sum and the sum of their check values. Cells
are sums, so each task adds up its own rows before the shuffle, and the other side's
rows are subtracted by adding them with a minus. What both sides hold cancels out;
what is left is as large as the difference, however many keys there are. A cell that
holds one key (its check agrees) gives the key away; taking it out of its other cells
leaves more such cells, until the table is empty.

Keys found this way are looked up in both tables, so the answer rests on the rows
themselves. A group whose table does not empty (its sides differ by more than about
two thirds of the cells) is compared key by key, that group alone."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.scratch import written
from boxoffice.session import ship

PARTS = 3
#: Cells of each part of a group's table.
CELLS = 64
MISSING, EXTRA = "missing", "extra"

_CHECK = 99


def _element(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def difference_table(src: DataFrame, dst: DataFrame, by: Sequence[str], keys: Sequence[str], cells: int = CELLS) -> DataFrame:
    """(*by, cell, n, low, high, check): the cells that do not cancel out. A cell may get
    2^31 rows of a side."""
    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*by, _element(keys).alias("_e"), F.lit(sign).cast("long").alias("_s"))

    both = signed(src, 1).unionByName(signed(dst, -1))
    places = F.array(*[F.pmod(F.xxhash64(F.lit(i).cast("long"), "_e"), F.lit(cells)) + i * cells for i in range(PARTS)])
    part = lambda c: F.sum(F.col("_s") * c)
    low, high = F.col("_e").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("_e", 32)
    check = F.xxhash64(F.lit(_CHECK).cast("long"), "_e").bitwiseAND(F.lit(0x7FFFFFFF))
    cell = both.select("*", F.explode(places.cast("array<int>")).alias("cell"))
    return cell.groupBy(*by, "cell").agg(F.sum("_s").alias("n"), part(low).alias("low"), part(high).alias("high"), part(check).alias("check")) \
        .where("n != 0 or low != 0 or high != 0 or check != 0")


def decode(table: DataFrame, by: Sequence[str], cells: int = CELLS) -> DataFrame:
    """(*by, element): what a group's cells give away; a null element says that the group's
    table does not empty. A group has at most ``PARTS`` x ``cells`` rows."""
    by = list(by)
    fields = [table.schema[b] for b in by]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["element long"])

    def peel(rows: pd.DataFrame) -> pd.DataFrame:
        import struct

        import xxhash

        def hashed(number: int, element: int) -> int:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", number), 42)
            return xxhash.xxh64_intdigest(struct.pack("<q", element), seed)

        def alone(cell: list[int]) -> int | None:
            n, low, high, check = cell
            if n == 0 or low % n or high % n or check % n or not 0 <= low // n < 1 << 32 or not -1 << 31 <= high // n < 1 << 31:
                return None
            element = (high // n << 32) + low // n
            return element if check // n == hashed(_CHECK, element) & 0x7FFFFFFF else None

        left = {int(c): list(map(int, v)) for c, *v in zip(rows["cell"], rows["n"], rows["low"], rows["high"], rows["check"])}
        todo, found = list(left), set()
        while todo:
            cell = todo.pop()
            element = alone(left[cell]) if cell in left else None
            if element is None:
                continue
            found.add(element)
            taken = left[cell]
            n, values = taken[0], list(taken)
            for i in range(PARTS):
                h = hashed(i, element)
                other = ((h - (1 << 64) if h >> 63 else h) % cells) + i * cells
                now = [a - b for a, b in zip(left.get(other, [0] * 4), values)]
                if any(now):
                    left[other] = now
                    todo.append(other)
                else:
                    left.pop(other, None)
            if len(found) > PARTS * cells or n == 0:
                break
        elements = [None] if left else sorted(found)
        out = pd.DataFrame({b: [rows[b].iloc[0]] * len(elements) for b in by})
        out["element"] = pd.array(elements, dtype="Int64")
        return out

    return table.withColumn("_all", F.lit(True)).groupBy("_all", *by).applyInPandas(peel, schema)


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[f"_{n}"])
    return cond


def differing_keys(src: DataFrame, dst: DataFrame, by: Sequence[str], keys: Sequence[str], cells: int = CELLS) -> DataFrame:
    """(*by, *keys, side): the distinct keys of a group that only ``src`` has (missing) or only
    ``dst`` (extra). NULL keys and groups compare as equal to each other."""
    by, keys = list(by), list(keys)
    ship(src.sparkSession)
    src, dst = src.select(*by, *keys), dst.select(*by, *keys)
    marks = written(decode(difference_table(src, dst, by, keys, cells), by, cells), "differing")
    marks = marks.select(*[F.col(b).alias(f"_{b}") for b in by], F.col("element").alias("_element"))
    found, crowded = marks.where("_element is not null"), marks.where("_element is null")

    def suspects(df: DataFrame, bit: int) -> DataFrame:
        # both lists are as small as the differences: Spark broadcasts them if their files prove small
        df = df.withColumn("element", _element(keys))
        some = df.join(found, _same(df, found, [*by, "element"]), "left_semi").unionByName(df.join(crowded, _same(df, crowded, by), "left_semi"))
        return some.select(*by, *keys, F.lit(bit).alias("_side"))

    seen = suspects(src, 1).unionByName(suspects(dst, 2)).groupBy(*by, *keys).agg(F.bit_or("_side").alias("_side"))
    return seen.where("_side < 3").select(*by, *keys, F.when(F.col("_side") == 1, MISSING).otherwise(EXTRA).alias("side"))
