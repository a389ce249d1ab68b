"""Shards of equal bytes by histogram sort.

Rows have a 63-bit key: 39 bits of a hash of the text, so that copies are neighbours,
then 24 bits of a hash of the id, so that a group of copies of any share can be cut.
The bytes below candidate keys are counted exactly over all partitions, for all
splitters at once; each round looks only into the one bin that holds a splitter and
cuts it into 512, until the bytes below the splitter are within the tolerance. Rows equal
in text and id have one key; where a splitter must fall among them, the same search goes
on in a second key, a hash of the row's written number. Then the rows are exchanged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import written_table

SHARDS = 24
#: Bytes that every row has beside its text.
ROW_BYTES = 8
#: Error of the bytes below a splitter that ends its search, as a share of a shard.
TOLERANCE = 0.001
#: Bits right of the probes of each round; the first five rounds see the text's hash only.
_SHIFTS = (51, 42, 33, 24, 15, 6, 0)
#: The same for the second key, among rows of one key.
_ROW_SHIFTS = (51, 42, 33, 24)
#: Rows of a shard that are numbered in one task.
NUMBERED = 100_000


def row_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def row_key(text: Column, doc_id: Column) -> Column:
    high = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 25)
    low = F.xxhash64(doc_id).bitwiseAND((1 << 24) - 1)
    return F.shiftleft(high, 24).bitwiseOR(low)


def row_number_hash(number: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(number), 1)


def _searched(
    rows: DataFrame, column: str, shifts: tuple[int, ...], aims: dict[int, float], reach: float
) -> tuple[dict[int, int], dict[int, list[tuple[int, float]]]]:
    """Least value of ``column`` for each aim (bytes below it), and the aims that fall inside one value.

    A round brings at most 512 counts (4096 in the first) for each aim to the driver,
    however many rows there are. The second result has, by value, the number of an aim
    and the bytes of that value's rows that belong below it.
    """
    found: dict[int, int] = {}
    inside: dict[int, list[tuple[int, float]]] = {}
    open_bins: dict[int | None, tuple[float, list[int]]] = {None: (0, list(aims))}
    above = None
    for shift in shifts:
        kept = rows if above is None else rows.filter(F.shiftright(column, above).isin(list(open_bins)))
        counted = kept.groupBy(F.shiftright(column, shift).alias("bin")).agg(F.sum("size").alias("bytes")).collect()
        below: dict[int | None, list[tuple[int, int]]] = {}
        for row in sorted(counted):
            below.setdefault(None if above is None else row["bin"] >> (above - shift), []).append((row["bin"], row["bytes"]))
        narrower: dict[int | None, tuple[float, list[int]]] = {}
        for parent, (start, wanted) in open_bins.items():
            for number in wanted:
                aim, at = aims[number], start
                for bin_, size in below.get(parent, []):
                    if at + size >= aim:
                        low, high = aim - at, at + size - aim
                        if min(low, high) <= reach:
                            found[number] = (bin_ + (high < low)) << shift
                        elif shift == shifts[-1]:
                            found[number] = (bin_ + (high < low)) << shift
                            inside.setdefault(bin_ << shift, []).append((number, low))
                        else:
                            narrower.setdefault(bin_, (at, []))[1].append(number)
                        break
                    at += size
                else:
                    found[number] = 1 << 63
        open_bins, above = narrower, shift
        if not open_bins:
            break
    return found, inside


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Least (key, row) of shards 1, 2, ...; ``keyed`` has key, row and size.

    A splitter falls on the edge between two texts if one is within the tolerance, else
    between two ids of a text, else between two of the rows that are equal in both.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    reach = tolerance * total / shards
    found, tied = _searched(keyed, "key", _SHIFTS, {n: total * n / shards for n in range(1, shards)}, reach)
    edges = {number: (key, 0) for number, key in found.items()}
    for key, aims in tied.items():  # at most shards - 1 keys hold a splitter
        parted, _ = _searched(keyed.filter(F.col("key") == key), "row", _ROW_SHIFTS, dict(aims), reach)
        edges |= {number: (key, row) if row < 1 << 63 else (key + 1, 0) for number, row in parted.items()}
    return [edges[n] for n in range(1, shards)]


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """All columns of ``docs`` with size, text_crc32, shard (from 0) and slot (gapless from 0 in a shard).

    size is the UTF-8 bytes of the text plus 8; a null text counts as empty. Equal texts
    stay together unless a splitter must fall inside their group, be it of rows equal in
    id as well or of null ids. Sizes of the shards differ by the tolerance or, if larger,
    by a document at either edge. An empty table gives an empty result. Input columns
    named as the added ones are replaced. The rows are written once with their numbers,
    so that every pass and every replayed task sees the same; only the columns that are
    asked for are read again and exchanged.
    """
    text = F.col("text")
    rows = docs.withColumns({
        "size": row_bytes(text), "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
        "_key": row_key(text, F.col("doc_id")), "_row": F.monotonically_increasing_id(),
    })
    rows = written_table(rows, "numbered").withColumn("_row", row_number_hash(F.col("_row")))
    keyed = rows.select(F.col("_key").alias("key"), F.col("_row").alias("row"), "size")
    edges = splitters(keyed, shards, tolerance)
    parts = max(1, -(-keyed.count() // (shards * NUMBERED)))

    def shard_of(key: Column, row: Column) -> Column:
        beyond = [(key > F.lit(k)) | ((key == F.lit(k)) & (row >= F.lit(r))) for k, r in edges if k < 1 << 63]
        return sum((b.cast("int") for b in beyond), F.lit(0))

    def part_of(key: Column, row: Column) -> Column:
        return F.pmod(F.xxhash64(key, row), F.lit(parts)).cast("int")

    both = F.col("key"), F.col("row")
    ahead = keyed.groupBy(shard_of(*both).alias("_s"), part_of(*both).alias("_p")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ahead = written_table(ahead.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0))), "ahead").drop("_n")
    both = F.col("_key"), F.col("_row")
    dealt = rows.withColumns({"shard": shard_of(*both), "_part": part_of(*both)})
    order = Window.partitionBy("shard", "_part").orderBy("_key", "doc_id", "_row")
    numbered = dealt.withColumn("_place", F.row_number().over(order))
    joined = numbered.join(ahead, (F.col("shard") == F.col("_s")) & (F.col("_part") == F.col("_p")))
    slot = (F.col("_ahead") + F.col("_place") - 1).cast("long")
    return joined.withColumn("slot", slot).drop("_s", "_p", "_ahead", "_place", "_part", "_key", "_row")
