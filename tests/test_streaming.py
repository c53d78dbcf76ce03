"""Streams with corrections against plain recomputation over last versions."""

import datetime as dt
import random

import pytest

from barloom.streaming import bars as SB

DAY = dt.datetime(2024, 1, 1)


class Folder:
    """A folder of dropped files and the state of the stream over it."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, path, 0
        self.source = path / "in.parquet"
        self.source.mkdir(parents=True)
        self.given = []

    def drop(self, rows):
        """One file with rows (event_id, ts, user_id, ticker, value)."""
        self.n += 1
        self.given.append(rows)
        made = self.path / f"made{self.n}"
        self.spark.createDataFrame([(*r, "{}") for r in rows], SB.EVENTS).coalesce(1).write.parquet(str(made))
        (part,) = made.glob("part-*.parquet")
        (self.source / f"part-{self.n:03d}.parquet").write_bytes(part.read_bytes())

    def run(self, files=1):
        got = SB.run_upsert(SB.read_ticks(self.spark, str(self.source), files), folder=str(self.path / "state"))
        return sorted(tuple(r) for r in got.select("ticker", "bar_ts", "open", "high", "low", "close", "volume", "value").collect())

    def wanted(self):
        last, nameless = {}, []
        for rows in self.given:
            for i, ts, user, ticker, value in rows:
                if i is None:
                    nameless.append((ts, 0, ticker, round(value * 100), user % 10 + 1))
                else:
                    last[ticker, i] = (ts, i, ticker, round(value * 100), user % 10 + 1)
        windows = {}
        for ts, i, ticker, price, size in sorted([*last.values(), *nameless]):
            windows.setdefault((ticker, ts.replace(minute=ts.minute // 5 * 5, second=0, microsecond=0)), []).append((price, size))
        return sorted(
            (*key, x[0][0], max(p for p, _ in x), min(p for p, _ in x), x[-1][0], sum(s for _, s in x), sum(p * s for p, s in x))
            for key, x in windows.items()
        )


def at(**more):
    return DAY + dt.timedelta(**more)


def test_redelivered_with_another_price_time_and_day(spark, tmp_path):
    f = Folder(spark, tmp_path)
    f.drop([(1, at(minutes=1), 1, "a", 10.0), (2, at(minutes=2), 1, "a", 20.0), (3, at(minutes=7), 1, "a", 5.0)])
    assert f.run() == f.wanted()
    f.drop([(1, at(minutes=1), 1, "a", 99.0)])  # price
    assert f.run() == f.wanted() and f.run()[0][3] == 9900
    f.drop([(2, at(minutes=8), 1, "a", 20.0)])  # window
    assert f.run() == f.wanted()
    f.drop([(3, at(days=1), 1, "a", 6.0), (2, at(days=2), 1, "a", 20.0)])  # day; the old window of both is empty now
    assert f.run() == f.wanted() and len(f.run()) == 3
    f.drop([(3, at(minutes=7), 1, "a", 5.0), (2, at(days=1, minutes=1), 1, "a", 21.0)])  # and back
    assert f.run() == f.wanted()


def test_a_path_with_pattern_characters_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="pattern"):
        SB.read_ticks(spark, str(tmp_path / "in[x]"))


def test_ticks_without_id_all_count(spark, tmp_path):
    f = Folder(spark, tmp_path)
    f.drop([(None, at(minutes=1), 2, "a", 10.0), (None, at(minutes=2), 2, "a", 12.0), (None, at(minutes=2), 2, "a", 12.0)])
    f.drop([(None, at(minutes=3), 1, "a", 13.0), (7, at(minutes=3), 1, "a", 14.0)])
    got = f.run()
    assert got == f.wanted() and got[0][6] == 3 + 3 + 3 + 2 + 2


@pytest.mark.parametrize("files", [1, 3])
def test_any_deliveries_equal_their_last_versions(spark, tmp_path, files):
    draw = random.Random(5)
    f = Folder(spark, tmp_path)
    for _ in range(6):
        rows = [
            (draw.choice([None, *range(0, 120_000, 4_000)]), at(days=draw.randrange(3), minutes=draw.randrange(15)), draw.randrange(20), draw.choice("ab"), draw.randrange(50) / 4)
            for _ in range(40)
        ]
        seen = {}  # of two versions within one file none is the newer
        rows = [r for r in rows if r[0] is None or seen.setdefault((r[3], r[0]), r) is r]
        f.drop([(i, ts + dt.timedelta(microseconds=k), *rest) for k, (i, ts, *rest) in enumerate(rows)])
        if files == 1:
            assert f.run(files) == f.wanted()
    assert f.run(files) == f.wanted()


def test_a_batch_repeated_after_a_failure_replaces_itself(spark, tmp_path):
    schema = SB.read_ticks(spark, str(tmp_path), 1).drop("delivered").schema
    store = SB.Store(spark, str(tmp_path / "state"), schema, 5)

    def ticks(*rows):
        return spark.createDataFrame([(t, ts, i, p * 10_000 + i, p, 1) for i, ts, t, p in rows], "ticker string, ts timestamp_ntz, event_id bigint, seq bigint, price bigint, size bigint").select(
            "ticker", "ts", "event_id", "seq", "price", "size"
        ).withColumn("seq", SB.packed_sequence(("seq", 18)))

    first, second = ticks((1, at(minutes=1), "a", 5), (2, at(minutes=2), "a", 6)), ticks((1, at(days=1), "a", 7))
    for number, batch in ((0, first), (1, second), (1, second)):
        store.add(batch, number, None)
    got = sorted((r.bar_ts, r.close, r.volume) for r in store.bars().collect())
    assert got == [(DAY, 6, 1), (at(days=1), 7, 1)]


def test_only_touched_days_are_listed(spark, tmp_path, monkeypatch):
    f = Folder(spark, tmp_path)
    for k in range(4):
        f.drop([(k, at(days=k), 1, "a", 1.0)])
    f.run()
    asked = []
    monkeypatch.setattr(SB, "_there", lambda spark, paths, old=SB._there: asked.extend(paths) or old(spark, paths))
    f.drop([(2, at(days=7), 1, "a", 2.0)])
    assert f.run() == f.wanted()
    assert {p.rpartition("=")[2] for p in asked if "/ticks/" in p} == {"2024-01-03", "2024-01-08"}
