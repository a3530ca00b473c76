"""The leaderboard change feed against its SQL, against a plain loop, and on odd tables."""

import datetime
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from tallyloom.llm import leaderboard

SF = "/root/testdata/sf0.001"
LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz"


def by_loop(lines, nations, prices):
    """The feed by its definition: every line in turn, every board from all items."""
    placed = []
    for sale, line, item, vendor, quantity, amount, _, flag, at in lines:
        h = zlib.crc32(",".join("" if x is None else str(x) for x in (sale, item, vendor, line)).encode())
        s = (at.date() - datetime.date(1970, 1, 1)).days if at else 19723 + h % 150
        a = s + h % 7 + (20 if h % 5 == 0 else 0)
        cents = int(np.floor(100 * amount + 0.5)) if amount is not None else quantity * int(np.floor(100 * prices[item] + 0.5)) if quantity is not None and prices.get(item) is not None else 0
        placed.append((min(8, 1 + (a - 19723) * 8 // 180), a, s, nations.get(vendor), item if item in prices else None, -cents if flag == "swapped" else cents))
    out, revenue, board = [], defaultdict(lambda: defaultdict(int)), defaultdict(list)
    latest = None
    for batch in range(1, 9):
        own = [x for x in placed if x[0] == batch]
        for day in sorted({x[1] for x in own}):
            for _, a, s, nation, item, cents in own:
                if a == day and nation is not None and item is not None and (latest is None or s + 15 >= latest):
                    revenue[nation][item] += cents
            for nation, sums in revenue.items():
                now = [i for i, c in sorted(sums.items(), key=lambda x: (-x[1], x[0])) if c > 0][:10]
                old = {i: r for r, i in enumerate(board[nation], 1)}
                new = {i: r for r, i in enumerate(now, 1)}
                for i in old.keys() | new.keys():
                    if old.get(i) != new.get(i):
                        out.append((nation, day, i, batch, "enter" if i not in old else "exit" if i not in new else "move", old.get(i), new.get(i), sums[i]))
                board[nation] = now
        latest = max([*(x[2] for x in own), *([latest] if latest is not None else [])], default=None)
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def shop(spark):
    rng = random.Random(3)
    lines = []
    for i in range(1500):
        at = None if i % 40 == 0 else datetime.datetime(2024, 1, 1) + datetime.timedelta(days=rng.randrange(150), hours=rng.randrange(24))
        hot = rng.random() < 0.34
        lines.append((i // 3 if i % 50 else None, i % 3, 7 if hot else rng.choice([None, *range(60)]), 1 if hot else rng.choice([None, *range(8)]), rng.choice([None, 1, 5, 20]), rng.choice([None, None, 10.0, 0.005, 99.995, 1.0]), 0.0, rng.choice(["kept", "swapped", None]), at))
    lines += [lines[10]] * 3
    vendors = [(v, "x", None if v == 6 else v % 3, 0.0) for v in range(7)]
    items = [(i, "x", "b", "k", 1, None if i % 9 == 0 else i + 0.995) for i in range(55)]
    return lines, vendors, items


def frames(spark, lines, vendors, items):
    return spark.createDataFrame(lines, LINES), spark.createDataFrame(vendors, "vendor_id long, name string, nation_id int, balance double"), spark.createDataFrame(items, "item_id long, name string, brand string, kind string, size int, price double")


def test_feed_by_loop(spark, shop, monkeypatch):
    monkeypatch.setattr(leaderboard, "LINES", 200)  # several buckets a nation
    monkeypatch.setattr(leaderboard, "CELLS", 40)  # several blocks of days
    lines, vendors, items = shop
    sales, where, known = frames(spark, *shop)
    clash = {c: leaderboard.F.lit("clash") for c in ("nation_id", "batch", "bucket", "cents", "a", "s", "price", "known")}
    got = sorted((tuple(r) for r in leaderboard.feed(sales.withColumns(clash), where, known).collect()), key=repr)
    assert got == by_loop(lines, {v[0]: v[2] for v in vendors if v[2] is not None}, {i[0]: i[5] for i in items})
    assert {r[4] for r in got} == {"enter", "exit", "move"}


def test_empty_tables(spark, shop):
    sales, where, known = frames(spark, *shop)
    assert leaderboard.feed(sales.limit(0), where, known).count() == 0
    assert leaderboard.feed(sales.limit(20), where.limit(0), known).count() == 0


def test_repeated_vendors_and_items_count_once(spark, shop):
    lines, vendors, items = shop
    once = leaderboard.priced(*frames(spark, lines[:100], vendors, items)).collect()
    twice = leaderboard.priced(*frames(spark, lines[:100], vendors * 2, items * 2)).collect()
    assert sorted(once, key=repr) == sorted(twice, key=repr)


def test_state_is_packed_without_loss():
    for values in ([], [0], [5, 300, 2**40], [-7, 3], [-(2**62), 2**62]):
        a = np.array(values, np.int64)
        assert leaderboard._unpacked(leaderboard._packed(a)).tolist() == values


def test_feed_is_its_sql(spark):
    con = duckdb.connect()
    for t in ("sale_lines", "vendors", "items"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = leaderboard.op13_leaderboard(spark, SF)
    names = [c for c in got.columns]
    found = con.execute(f"SELECT {', '.join(names)} FROM ({leaderboard.OP13_SQL})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(found, key=repr) and found
