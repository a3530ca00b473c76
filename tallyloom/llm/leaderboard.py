"""Leaderboard change feed: running revenue by nation and item, and what changes on each nation's board after each arrival day.

Sale lines are priced, given their arrival day and cut into batches by it; the batches are fed in order to a streaming query that is started anew for each on one checkpoint. Its state is numpy arrays of items and cents. A nation's items are dealt out to buckets by hash, so that no nation is one task's: a (nation, bucket) pair is a group of the query. What comes for it in a batch is a sparse day-by-touched-item matrix; the cumulative sum down the days, on top of what the state has, gives each touched item's revenue after each day. Only touched items and the leaders among the untouched can be on a board, so these are merged and the best chosen by lexsort. The nation's board of a day is the best of its buckets' boards.

Equal keys are summed where they lie before anything is dealt out, so one hot item, vendor or nation is a few rows of each task. Vendors and items are joined by shuffles whose large partitions Spark splits.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom.llm.common import _delete, shared_dir, slices, stored, table

#: Length of a board, number of batches, days of lateness; the first arrival day and the days that the batches share out.
BOARD, BATCHES, LATE = 10, 8, 15
FIRST, SPAN = 19723, 180
#: Lines for each bucket of a nation's items; cells of a day-by-item matrix that are held at once.
LINES, CELLS = 250_000, 1 << 21
RESULT = "nation_id int, arrival_day long, item_id long, batch int, change string, old_rank int, new_rank int, revenue long"
_CUT = "nation_id int, item_id long, s long, a long, cents long, batch int"
_LOCAL = "nation_id int, bucket int, day long, item_id long, cents long, kind int"
#: Kinds of rows of a bucket: it had lines in this batch; an item of its board of a day; an item that left it on that day.
TOUCHED, ON, LEFT = 0, 1, 2


def priced(lines: DataFrame, vendors: DataFrame, items: DataFrame) -> DataFrame:
    """nation_id, item_id, s (day), a (arrival day), cents and batch of each line; other columns are ignored.

    nation_id is null where the vendor, its nation or the item is unknown: such lines count for nothing but the latest day. Of repeated vendors or items the least nation and price count. Days before the first batch's are in the first batch. An empty table gives no rows.
    """
    whole = lambda c: F.floor(100 * F.col(c) + 0.5).cast("long")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    h = F.crc32(F.concat_ws(",", *map(text, ("sale_id", "item_id", "vendor_id", "line_no"))))
    rows = lines.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("vendor_id").cast("long").alias("vendor_id"), h.alias("h"),
        F.unix_date(F.col("shipped_at").cast("date")).cast("long").alias("s"), whole("amount").alias("cents"), F.col("quantity").cast("long").alias("quantity"),
        F.when(F.col("flag") == "swapped", -1).otherwise(1).alias("sign"),
    )
    rows = rows.withColumn("s", F.coalesce("s", F.lit(FIRST) + F.col("h") % 150)).withColumn("a", F.col("s") + F.col("h") % 7 + F.when(F.col("h") % 5 == 0, 20).otherwise(0))
    rows = rows.withColumn("batch", F.greatest(F.lit(1), F.least(F.lit(BATCHES), 1 + F.floor((F.col("a") - FIRST) * BATCHES / SPAN))).cast("int")).drop("h")
    where = stored(vendors.where("vendor_id IS NOT NULL").groupBy(F.col("vendor_id").cast("long").alias("vendor_id")).agg(F.min(F.col("nation_id").cast("int")).alias("nation_id")), "vendors")
    known = stored(items.where("item_id IS NOT NULL").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min(whole("price")).alias("price"), F.lit(True).alias("known")), "items")
    # Shuffled, never broadcast: both tables grow with the sales.
    rows = rows.join(where.hint("shuffle_hash"), "vendor_id", "left").drop("vendor_id").join(known.hint("shuffle_hash"), "item_id", "left")
    cents = F.col("sign") * F.coalesce("cents", F.col("quantity") * F.col("price"), F.lit(0))
    return rows.select(F.when(F.col("known"), F.col("nation_id")).alias("nation_id"), "item_id", "s", "a", cents.cast("long").alias("cents"), "batch")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of cents by all other columns, so that a hot item is few rows before they are dealt out."""
    for batch in slices(batches):
        t = pa.Table.from_batches([batch]).group_by(["nation_id", "bucket", "item_id", "a"]).aggregate([("cents", "sum")]).select(["nation_id", "bucket", "item_id", "a", "cents_sum"])
        yield from t.rename_columns(["nation_id", "bucket", "item_id", "a", "cents"]).combine_chunks().to_batches()


def _packed(values: np.ndarray) -> bytes:
    """Integers in as few bytes as they need, compressed."""
    kind = np.result_type(np.min_scalar_type(values.min()), np.min_scalar_type(values.max())) if len(values) else np.dtype("i8")
    kind = kind if kind.kind in "iu" else np.dtype("i8")
    return kind.str.encode() + zlib.compress(values.astype(kind).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[3:]), raw[:3].decode()).astype(np.int64)


def _best(items: np.ndarray, cents: np.ndarray, n: int = BOARD) -> np.ndarray:
    """Places of the n highest positive cents, highest first, ties by smaller item."""
    if len(cents) > 4 * n:
        least = max(1, np.partition(cents, -n)[-n])
        some = np.flatnonzero(cents >= least)
    else:
        some = np.flatnonzero(cents > 0)
    return some[np.lexsort((items[some], -cents[some]))[:n]]


def boards(days: np.ndarray, items: np.ndarray, cents: np.ndarray, item: np.ndarray, day: np.ndarray, more: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """(items, cents after the batch; rows: day, items, cents, kinds after each of days). items (ascending) and cents are the state before it; item, day, more are the batch's lines, in any order; days are ascending and hold every day."""
    touched, column = np.unique(item, return_inverse=True)
    at = np.minimum(np.searchsorted(items, touched), max(0, len(items) - 1))
    had = items[at] == touched if len(items) else np.zeros(len(touched), bool)
    base = np.where(had, cents[at] if len(items) else 0, 0)
    same = np.ones(len(items), bool)
    same[at[had]] = False
    rest, worth = items[same], cents[same]
    top = _best(rest, worth)
    leaders, paid = rest[top], worth[top]
    before = _best(items, cents)
    board, rows = items[before], []
    order = np.argsort(np.searchsorted(days, day), kind="stable")
    row, column, more = np.searchsorted(days, day)[order], column[order], more[order]
    step = max(1, cells // max(1, len(touched)))
    for first in range(0, len(days), step):
        n = min(step, len(days) - first)
        a, b = np.searchsorted(row, [first, first + n])
        matrix = np.zeros((n, len(touched)), np.int64)
        np.add.at(matrix, (row[a:b] - first, column[a:b]), more[a:b])
        matrix[0] += base
        np.cumsum(matrix, axis=0, out=matrix)
        base = matrix[-1].copy()
        for i in range(n):
            own = _best(touched, matrix[i])
            both, sums = np.concatenate([touched[own], leaders]), np.concatenate([matrix[i][own], paid])
            pick = _best(both, sums)
            now = both[pick]
            gone = np.setdiff1d(board, now)
            where = np.minimum(np.searchsorted(touched, gone), len(touched) - 1)
            moved = touched[where] == gone
            old = np.minimum(np.searchsorted(items, gone), max(0, len(items) - 1))
            left = np.where(moved, matrix[i][where], cents[old] if len(items) else 0)
            rows.append((days[first + i], np.concatenate([now, gone]), np.concatenate([sums[pick], left]), np.repeat([ON, LEFT], [len(now), len(gone)])))
            board = now
    every, revenue = np.concatenate([rest, touched]), np.concatenate([worth, base])
    order = np.argsort(every)
    return every[order], revenue[order], rows


def _states(days: list[int]):
    every = np.array(sorted(days), np.int64)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        nation, bucket = key
        came = [(f["item_id"].to_numpy(), f["a"].to_numpy(), f["cents"].to_numpy()) for f in frames]
        items, cents = (_unpacked(bytes(x)) for x in state.get) if state.exists else (np.empty(0, np.int64),) * 2
        steps, cents, rows = boards(every, np.cumsum(items), cents, *(np.concatenate(x).astype(np.int64) for x in zip(*came, strict=True)))
        state.update((_packed(np.diff(steps, prepend=0)), _packed(cents)))
        rows.append((every[0], [0], [0], [TOUCHED]))
        n = [len(r[1]) for r in rows]
        columns = [np.concatenate([r[i] for r in rows]) for i in (1, 2, 3)]
        out = {"nation_id": np.int32(nation), "bucket": np.int32(bucket), "day": np.repeat([r[0] for r in rows], n), "item_id": columns[0], "cents": columns[1], "kind": columns[2].astype(np.int32)}
        yield pd.DataFrame(out, columns=list(out))

    return run


def _listed(days: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{d}L' for d in days)})")


def changes(top: DataFrame, earlier: DataFrame, worth: DataFrame, days: list[int]) -> DataFrame:
    """nation_id, day, item_id, change, old_rank, new_rank, revenue between the boards of days (ascending), the first against earlier. top: nation_id, day, item_id, rank, cents; earlier: nation_id, item_id, rank; worth: nation_id, day, item_id, cents of what left a board."""
    number = F.array_position(_listed(days), F.col("day")).cast("int")
    seen = top.select("nation_id", "item_id", "rank", "cents", number.alias("i")).unionByName(earlier.select("nation_id", "item_id", "rank", F.lit(None).cast("long").alias("cents"), F.lit(0).alias("i")))
    order = Window.partitionBy("nation_id", "item_id").orderBy("i")
    seen = seen.withColumns({"was": F.when(F.lag("i").over(order) == F.col("i") - 1, F.lag("rank").over(order)), "stays": F.coalesce(F.lead("i").over(order) == F.col("i") + 1, F.lit(False))})
    none = F.lit(None).cast("int")
    there = seen.where("i > 0 AND NOT was <=> rank").select("nation_id", "i", "item_id", F.when(F.col("was").isNull(), "enter").otherwise("move").alias("change"), F.col("was").alias("old_rank"), F.col("rank").alias("new_rank"), F.col("cents").alias("revenue"))
    off = seen.where(~F.col("stays") & (F.col("i") < len(days))).select("nation_id", (F.col("i") + 1).alias("i"), "item_id", F.lit("exit").alias("change"), F.col("rank").alias("old_rank"), none.alias("new_rank"))
    off = off.withColumn("day", F.element_at(_listed(days), F.col("i"))).join(worth.withColumnRenamed("cents", "revenue"), ["nation_id", "day", "item_id"], "left")
    there = there.withColumn("day", F.element_at(_listed(days), F.col("i")))
    columns = ["nation_id", "day", "item_id", "change", "old_rank", "new_rank", "revenue"]
    return there.select(columns).unionByName(off.select(columns))


def _merged(spark: SparkSession, root: str, batch: int, days: list[int], last: int | None):
    """What is done with the buckets' boards of a batch: the nations' boards and their changes are written. Every folder is written anew if the batch is repeated. spark: the session outside the query, whose plans adapt."""

    def run(local: DataFrame, _: int) -> None:
        put = lambda df, name: df.write.mode("overwrite").parquet(f"{root}/{name}/{batch}")
        get = lambda name, schema, at: spark.read.schema(schema).parquet(f"{root}/{name}/{at}") if at else spark.createDataFrame([], schema)
        put(local, "local")
        own = get("local", _LOCAL, batch)
        held = "nation_id int, bucket int, item_id long, cents long"
        still = get("held", held, last).join(own.where(F.col("kind") == TOUCHED).select("nation_id", "bucket").distinct(), ["nation_id", "bucket"], "left_anti")
        each = still.withColumn("day", F.explode(_listed(days)))
        rows = own.where(F.col("kind") == ON).select("nation_id", "day", "item_id", "cents").unionByName(each.select("nation_id", "day", "item_id", "cents"))
        best = Window.partitionBy("nation_id", "day").orderBy(F.desc("cents"), "item_id")
        put(rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= BOARD), "top")
        put(own.where((F.col("kind") == ON) & (F.col("day") == days[-1])).drop("day", "kind").unionByName(still), "held")
        board = "nation_id int, day long, item_id long, cents long, rank int"
        top, before = get("top", board, batch), get("top", board, last)
        before = before.where(F.col("day") == F.lit(_last_days.get(f"{root}/{last}"))) if last else before
        worth = own.where(F.col("kind") != TOUCHED).select("nation_id", "day", "item_id", "cents").unionByName(each.select("nation_id", "day", "item_id", "cents"))
        out = changes(top, before, worth, days).withColumn("batch", F.lit(batch)).withColumnRenamed("day", "arrival_day")
        put(out.select("nation_id", "arrival_day", "item_id", "batch", "change", "old_rank", "new_rank", "revenue"), "out")
        _last_days[f"{root}/{batch}"] = days[-1]

    return run


#: Last day of each batch of a feed that has been merged.
_last_days: dict[str, int] = {}


def feed(lines: DataFrame, vendors: DataFrame, items: DataFrame) -> DataFrame:
    """The change feed of the lines, RESULT: what enters, leaves or moves on a nation's board of the BOARD highest positive revenues after each arrival day (ties to the smaller item), revenue in cents afterwards.

    Lines whose day is more than LATE days before the latest of all earlier batches are dropped. Null amounts count as quantity times price, without these as 0; repeated lines count as often as they are there. Without lines the feed is empty. What is collected is a row a batch: its lines, latest day and arrival days.
    """
    spark = lines.sparkSession
    root = f"{shared_dir(spark)}/leaderboard-{uuid.uuid4().hex}"
    priced(lines, vendors, items).write.partitionBy("batch").parquet(f"{root}/cut")
    cut = spark.read.schema(_CUT).parquet(f"{root}/cut")
    known = cut.groupBy("batch").agg(F.count("*").alias("n"), F.max("s").alias("s"), F.collect_set("a").alias("days")).orderBy("batch").collect()
    buckets = max(4, sum(r["n"] for r in known) // LINES)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    at = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{p}")
    fs.mkdirs(at("incoming"))
    latest, last = None, None
    for r in known:
        fs.rename(at(f"cut/batch={r['batch']}"), at(f"incoming/batch={r['batch']}"))
        rows = spark.readStream.schema(_CUT).parquet(f"{root}/incoming").where("nation_id IS NOT NULL")
        if latest is not None:
            rows = rows.where(F.col("s") + LATE >= latest)
        rows = rows.select("nation_id", F.pmod(F.xxhash64("item_id"), F.lit(buckets)).cast("int").alias("bucket"), "item_id", "a", "cents")
        sums = rows.mapInArrow(_combined, "nation_id int, bucket int, item_id long, a long, cents long")
        local = sums.groupBy("nation_id", "bucket").applyInPandasWithState(_states(sorted(r["days"])), _LOCAL, "items binary, cents binary", "append", GroupStateTimeout.NoTimeout)
        query = local.writeStream.foreachBatch(_merged(spark, root, r["batch"], sorted(r["days"]), last)).option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        latest, last = max(r["s"], r["s"] if latest is None else latest), r["batch"]
    for name in ("cut", "incoming", "checkpoint", "local", "held", "top"):
        _delete(spark, f"{root}/{name}")
    return spark.read.schema(RESULT).parquet(*(f"{root}/out/{r['batch']}" for r in known)) if known else spark.createDataFrame([], RESULT)


def op13_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed of all sale lines."""
    return feed(*(table(spark, sf_dir, t) for t in ("sale_lines", "vendors", "items")))


#: crc32 of an ASCII text, bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({t}) + 1), lambda i: CAST(ascii(substr({t}, i, 1)) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"

OP13_SQL = f"""
WITH t AS (SELECT *, concat(coalesce(CAST(sale_id AS VARCHAR), ''), ',', coalesce(CAST(item_id AS VARCHAR), ''), ',', coalesce(CAST(vendor_id AS VARCHAR), ''), ',', coalesce(CAST(line_no AS VARCHAR), '')) AS name FROM sale_lines),
h AS (SELECT *, {_CRC.format(t="name")} AS h FROM t),
s AS (SELECT *, coalesce(CAST(date_diff('day', DATE '1970-01-01', CAST(shipped_at AS DATE)) AS BIGINT), {FIRST} + h % 150) AS s FROM h),
a AS (SELECT *, s + h % 7 + CASE WHEN h % 5 = 0 THEN 20 ELSE 0 END AS a FROM s),
b AS (SELECT *, greatest(1, least({BATCHES}, 1 + CAST(floor((a - {FIRST}) * {BATCHES} / {SPAN}) AS BIGINT))) AS batch FROM a),
m AS (SELECT batch, max(max(s)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM b GROUP BY batch),
e AS (SELECT v.nation_id, b.item_id, b.a, b.batch, CASE WHEN flag = 'swapped' THEN -1 ELSE 1 END * coalesce(CAST(floor(100 * amount + 0.5) AS BIGINT), quantity * CAST(floor(100 * price + 0.5) AS BIGINT), 0) AS cents
  FROM b JOIN m ON b.batch = m.batch JOIN vendors v ON b.vendor_id = v.vendor_id JOIN items i ON b.item_id = i.item_id WHERE v.nation_id IS NOT NULL AND (latest IS NULL OR s + {LATE} >= latest)),
r AS (SELECT nation_id, item_id, a, CAST(sum(sum(cents)) OVER (PARTITION BY nation_id, item_id ORDER BY a) AS BIGINT) AS cents, lead(a, 1, 9999999) OVER (PARTITION BY nation_id, item_id ORDER BY a) AS until FROM e GROUP BY nation_id, item_id, a),
d AS (SELECT nation_id, a, any_value(batch) AS batch, row_number() OVER (PARTITION BY nation_id ORDER BY a) AS i FROM e GROUP BY nation_id, a),
w AS (SELECT d.nation_id, d.a, d.i, item_id, cents FROM d JOIN r ON d.nation_id = r.nation_id AND r.a <= d.a AND d.a < r.until),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nation_id, i ORDER BY cents DESC, item_id) AS rank FROM w WHERE cents > 0) WHERE rank <= {BOARD}),
c AS (SELECT coalesce(n.nation_id, o.nation_id) AS nation_id, coalesce(n.i, o.i + 1) AS i, coalesce(n.item_id, o.item_id) AS item_id, o.rank AS old_rank, n.rank AS new_rank FROM k n FULL JOIN k o ON n.nation_id = o.nation_id AND n.item_id = o.item_id AND n.i = o.i + 1)
SELECT c.nation_id, d.a AS arrival_day, c.item_id, CAST(d.batch AS INTEGER) AS batch, CASE WHEN old_rank IS NULL THEN 'enter' WHEN new_rank IS NULL THEN 'exit' ELSE 'move' END AS change,
  CAST(old_rank AS INTEGER) AS old_rank, CAST(new_rank AS INTEGER) AS new_rank, w.cents AS revenue
FROM c JOIN d ON c.nation_id = d.nation_id AND c.i = d.i JOIN w ON c.nation_id = w.nation_id AND c.i = w.i AND c.item_id = w.item_id WHERE old_rank IS DISTINCT FROM new_rank
"""
