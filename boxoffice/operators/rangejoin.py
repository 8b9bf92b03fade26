"""J-9: network-contains-address lookups.

Disjoint blocks meet addresses by an equi join on /16 buckets. Nested blocks, of any width,
are first flattened by a sweep line into disjoint ranges, each with its smallest
block; ranges and distinct addresses, both dealt by the same borders and sorted, are then
merged in one pass. A wide block is one row and a few more at borders, not one row a /16."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.functions.columns import cidr_bounds, ipv4_to_long, ipv6_expanded, ipv6_longs, ipv6_prefix
from boxoffice.operators.hotkeys import spread_join
from boxoffice.session import ship

BUCKET_BITS = 16


def block_ranges(blocks: DataFrame, network_col: str = "network") -> DataFrame:
    """CIDR text to ``[ip_start, ip_end]`` longs, one row per /16 bucket the
    block touches (a /8 becomes 256 rows, a /24 one)."""
    start, end = cidr_bounds(network_col)
    b = blocks.select("*", start.alias("ip_start"), end.alias("ip_end"))
    buckets = F.sequence(F.shiftright("ip_start", BUCKET_BITS), F.shiftright("ip_end", BUCKET_BITS))
    return b.select("*", F.explode(buckets).alias("_bucket"))


def _bucket_join(addr: DataFrame, ranges: DataFrame) -> DataFrame:
    return addr.join(ranges, (addr["_bucket"] == ranges["_rb"])
                     & addr["_ip"].between(ranges["ip_start"], ranges["ip_end"]), "left")


def ip_range_lookup(df: DataFrame, ip_col: str, blocks: DataFrame, payload: list[str],
                    network_col: str = "network", nested: bool = False) -> DataFrame:
    """LEFT join every row of ``df`` to the block that contains its address.

    Addresses and blocks meet on the /16 bucket (an equi join, so broadcast or
    sort-merge, never a nested loop); ``between`` then keeps the containing
    block. Payload columns are NULL when no block contains the address.

    Published block lists are disjoint, so one join suffices. With
    ``nested=True`` blocks may nest: they are flattened to the longest prefix of
    each address, so every row still gets at most one match.
    """
    if nested:
        cuts = borders(blocks.select(cidr_bounds(network_col)[0].alias("a")), df.select(ipv4_to_long(ip_col).alias("a")))
        return merge_ranges(df, ip_col, flatten_blocks(blocks, payload, network_col, cuts), payload, cuts)
    ranges = block_ranges(blocks, network_col).select(
        F.col("_bucket").alias("_rb"), "ip_start", "ip_end", *payload)

    ip = ipv4_to_long(ip_col)
    # malformed addresses lie in buckets that no block has, each in one of many
    spread = -1 - F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(1 << BUCKET_BITS))
    addr = df.select("*", ip.alias("_ip")).withColumn("_bucket", F.coalesce(F.shiftright("_ip", BUCKET_BITS), spread))
    return _bucket_join(addr, ranges).select(*df.columns, *payload)


#: Blocks, and addresses, that a sweep or merge group gets on average; beyond the most groups they grow.
GROUP_ROWS, MOST_GROUPS = 1 << 14, 1024
TOP = 1 << 32


def borders(*places: DataFrame) -> list[int]:
    """Borders that cut the addresses in each of ``places`` (a column each) into groups of about
    ``GROUP_ROWS``, and the ends of the address space. One pass counts them and draws
    ``MOST_GROUPS`` quantiles, of which as many are borders as there are groups."""
    grid = [i / MOST_GROUPS for i in range(1, MOST_GROUPS)]
    tagged = [p.toDF("a").select(F.lit(i).alias("of"), "a") for i, p in enumerate(places)]
    told = reduce(DataFrame.unionByName, tagged).groupBy("of").agg(
        F.count("a").alias("n"), F.percentile_approx("a", grid, 4 * MOST_GROUPS).alias("q")).collect()
    groups = min(MOST_GROUPS, max((-(-r["n"] // GROUP_ROWS) for r in told), default=1) or 1)
    return sorted({0, TOP, *(r["q"][i * MOST_GROUPS // groups - 1] for r in told if r["n"] for i in range(1, groups))})


def _group_of(place: Column, cuts: list[int]) -> Column:
    """Which stretch between borders a place lies in: a binary search in a balanced CASE."""
    def pick(lo: int, hi: int) -> Column:
        if hi - lo == 1:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(place < F.lit(cuts[mid]), pick(lo, mid)).otherwise(pick(mid, hi))

    return pick(0, len(cuts) - 1)


def flatten_blocks(blocks: DataFrame, payload: Sequence[str], network_col: str = "network",
                   cuts: list[int] | None = None) -> DataFrame:
    """Disjoint ranges ``(ip_start, ip_end, *payload)`` that say for each address which is the
    smallest block that contains it. Blocks are cut at borders between groups (networks nest, so
    at most 33 contain a border) and each group is swept once in order, with the open
    blocks on a stack. Of equal networks the one with the least payload counts; malformed networks
    contain nothing."""
    payload = list(payload)
    ship(blocks.sparkSession)
    start, end = cidr_bounds(network_col)
    nets = blocks.select(start.alias("ip_start"), end.alias("ip_end"), *payload).where("ip_start is not null and ip_end is not null")
    packed = F.min(F.struct(F.lit(0).alias("_"), *payload)).alias("p")
    nets = nets.groupBy("ip_start", "ip_end").agg(packed).select("ip_start", "ip_end", *[F.col(f"p.{c}").alias(c) for c in payload])
    cuts = cuts or borders(nets.select("ip_start"))
    first, last = _group_of(F.col("ip_start"), cuts), _group_of(F.col("ip_end"), cuts)
    # a border cuts nested blocks alike: their sizes before it tell which lies inside which
    at = nets.withColumn("_size", F.col("ip_end") - F.col("ip_start")).withColumn("_group", F.explode(F.sequence(first, last)))
    lows = F.array(*[F.lit(c) for c in cuts])
    low, high = F.get(lows, F.col("_group")), F.get(lows, F.col("_group") + 1) - 1
    cut = at.withColumn("ip_start", F.greatest("ip_start", low)).withColumn("ip_end", F.least("ip_end", high))

    def sweep(table: pa.Table) -> pa.Table:
        table = table.sort_by([("ip_start", "ascending"), ("_size", "descending")])
        starts, ends = table["ip_start"].to_pylist(), table["ip_end"].to_pylist()
        out: list[tuple[int, int, int]] = []
        open_: list[int] = []
        place = 0

        def close(until: int) -> None:
            """Ranges up to ``until`` belong to the open blocks, the innermost first."""
            nonlocal place
            while open_ and place <= until:
                reach = min(ends[open_[-1]], until)
                if place <= reach:
                    out.append((place, reach, open_[-1]))
                    place = reach + 1
                if ends[open_[-1]] <= until:
                    open_.pop()
                else:
                    break

        for i, s in enumerate(starts):
            close(s - 1)
            while open_ and ends[open_[-1]] < s:
                open_.pop()
            place = s
            open_.append(i)
        close(TOP)
        a, b, owner = (list(x) for x in zip(*out)) if out else ([], [], [])
        rows = table.take(pa.array(owner, pa.int64()))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *(rows[c] for c in payload)], names=["ip_start", "ip_end", *payload])

    kinds = dict(nets.dtypes)
    return cut.groupBy("_group").applyInArrow(sweep, "ip_start long, ip_end long, " + ", ".join(f"`{c}` {kinds[c]}" for c in payload))


def merge_ranges(df: DataFrame, ip_col: str, ranges: DataFrame, payload: Sequence[str], cuts: list[int]) -> DataFrame:
    """LEFT join every row to the range of ``flatten_blocks`` that holds its address. Each distinct
    address is looked up once: addresses and range starts, dealt by the same borders ``cuts``, are
    sorted together, and an address takes the last start before it. Rows of an address that many
    rows have are joined back in pieces."""
    payload = list(payload)
    ips = df.select(ipv4_to_long(ip_col).alias("_ip")).where("_ip is not null").distinct()
    lows = F.array(*[F.lit(c) for c in cuts])
    cut = ranges.withColumn("_group", F.explode(F.sequence(_group_of(F.col("ip_start"), cuts), _group_of(F.col("ip_end"), cuts))))
    kinds = dict(ranges.dtypes)
    told = F.struct(F.col("ip_end").alias("_end"), *[F.col(c) for c in payload])
    starts = cut.select("_group", F.greatest("ip_start", F.get(lows, F.col("_group"))).alias("_at"), F.lit(None).cast("long").alias("_ip"), told.alias("_range"))
    none = "struct<_end:bigint," + ",".join(f"`{c}`:{kinds[c]}" for c in payload) + ">"
    asked = ips.select(_group_of(F.col("_ip"), cuts).alias("_group"), F.col("_ip").alias("_at"), "_ip", F.lit(None).cast(none).alias("_range"))
    order = Window.partitionBy("_group").orderBy("_at", F.col("_ip").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    merged = starts.unionByName(asked).withColumn("_range", F.last("_range", ignorenulls=True).over(order)).where("_ip is not null")
    hit = merged.where("_ip <= _range._end").select(F.col("_ip").alias("_hit"), *[F.col(f"_range.{c}").alias(f"_p_{c}") for c in payload])
    rows = df.withColumn("_ip", ipv4_to_long(ip_col))
    out = spread_join(rows, hit, [("_ip", "_hit")], "left")
    return out.select(*df.columns, *[F.col(f"_p_{c}").alias(c) for c in payload])


def ipv6_prefix_lookup(df: DataFrame, ip_col: str, blocks: DataFrame, payload: list[str],
                       network_col: str = "network") -> DataFrame:
    """LEFT join every row to the smallest IPv6 block that contains its address.

    An address lies in a block if their first bits, as many as the block's
    length, are equal: each distinct address is cut to every length that
    occurs among the blocks (129 at most) and equi-joined on (length, prefix), the
    longest match winning. ``ip_ok`` is false for text that is no IPv6 address,
    which matches nothing.
    """
    length = F.try_element_at(F.split(network_col, "/"), F.lit(2)).try_cast("int")
    nets = blocks.select(length.alias("_len"), ipv6_expanded(F.get(F.split(network_col, "/"), F.lit(0))).alias("_full"), *payload) \
        .filter(F.col("_full").isNotNull() & F.col("_len").between(0, 128))
    nets = nets.select("_len", ipv6_prefix(ipv6_longs("_full"), "_len").alias("_prefix"), *payload)
    lengths = sorted(r["_len"] for r in nets.select("_len").distinct().collect())
    ips = df.select(F.col(ip_col).alias("_ip")).distinct().select("_ip", ipv6_expanded("_ip").alias("_full"))
    # malformed text has a prefix that no network has, each another, so that it is spread
    bits = F.when(F.col("_full").isNotNull(), ipv6_longs("_full")) \
        .otherwise(F.struct(F.lit(None).cast("long").alias("hi"), F.xxhash64("_ip").alias("lo")))
    bits = ips.select("_ip", F.col("_full").isNotNull().alias("_ok"), bits.alias("_bits"))
    cut = bits.select("*", F.explode_outer(F.array(*[F.lit(n) for n in lengths]).cast("array<int>")).alias("_len"))
    cut = cut.select("_ip", "_ok", "_len", F.when(F.col("_ok"), ipv6_prefix(F.col("_bits"), "_len")).otherwise(F.col("_bits")).alias("_prefix"))
    row = F.when(F.col("_hit"), F.struct("_len", *payload))
    known = cut.join(nets.withColumn("_hit", F.lit(True)), ["_len", "_prefix"], "left") \
        .groupBy("_ip").agg(F.max("_ok").alias("_ok"), F.max(row).alias("_b"))
    return spread_join(df, known, [(ip_col, "_ip")], "left").select(
        *[df[c] for c in df.columns], F.coalesce("_ok", F.lit(False)).alias("ip_ok"), *[F.col(f"_b.{p}").alias(p) for p in payload])
