"""The state machine on hand-made deliveries."""

from datetime import datetime, timedelta

from pyspark.sql import Row

from biblioforge.streaming.keyword_states import RESULT_DDL, KeywordStates, keyword_states, replay

START = datetime(2024, 1, 1)


def rows(spark, *events):
    return spark.createDataFrame([(i, k, START + timedelta(seconds=s), ok, 1.0 if ok else None) for i, k, s, ok in events], RESULT_DDL)


def test_retries_late_and_repeated_results(spark):
    hour = 3600
    first = rows(spark, (1, 7, 100, False), (2, 7, 104, False), (3, 8, 100, True), (4, 9, 50, False), (5, 9, 300, False), (6, 9, 600, False), (7, 9, 601, True))
    second = rows(spark, (1, 7, 100, False), (2, 7, 104, False), (8, 7, 90, True), (10, 5, 30 * hour, True))  # repeats, one out of order, and one that moves the watermark on
    third = rows(spark, (11, 8, 200, False), (12, 6, 200, True), (13, 4, 60 * hour, True))  # far too late, both
    end = rows(spark, (14, 1, 10**6, True))
    out = replay([first, second, third, end], lambda s: keyword_states(s, "2 hours", seconds=1.0))
    got = sorted((r.keyword_id, (r["at"] - START).total_seconds(), r.status, r.attempts) for r in out.collect())
    assert got == [
        (4, 60.0 * hour, "completed", 0), (5, 30.0 * hour, "completed", 0),
        (7, 90.0, "completed", 0),  # came after the failures, but before them in time
        (8, 100.0, "completed", 0),
        (9, 50.0, "failed", 1), (9, 55.0, "pending", 1), (9, 300.0, "failed", 2), (9, 310.0, "pending", 2), (9, 600.0, "failed", 3),
    ]


def test_buckets_of_keywords_give_the_same_states(spark):
    chunks = [rows(spark, *[(100 * k + i, i % 17, 1000 * k + 37 * i, i % 5 == k) for i in range(60)]) for k in range(3)]
    end = rows(spark, (9999, 99, 10**6, True))
    got = [sorted(map(tuple, replay([*chunks, end], lambda s, n=n: keyword_states(s, "2 hours", 60.0, buckets=n)).collect()), key=repr) for n in (1, 64)]
    assert got[0] == got[1] and len(got[0]) > 30


def test_the_calls_of_the_state_dont_grow_with_the_keywords():
    class Value:
        def __init__(self):
            self.held, self.calls = [], 0

        def exists(self):
            self.calls += 1
            return bool(self.held)

        def get(self):
            self.calls += 1
            return self.held[0] if self.one else iter(list(self.held))

        def update(self, x):
            self.calls += 1
            self.held = [x]

        def put(self, x):
            self.calls += 1
            self.held = x

        def appendValue(self, x):  # noqa: N802
            self.calls += 1
            self.held.append(x)

        def clear(self):
            self.calls += 1
            self.held = []

    class Handle:
        timers = 0

        def getValueState(self, *_):  # noqa: N802
            self.value = Value()
            self.value.one = True
            return self.value

        def getListState(self, *_):  # noqa: N802
            self.list = Value()
            self.list.one = False
            return self.list

        def registerTimer(self, _):  # noqa: N802
            self.timers += 1

    class Times:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    states, handle = KeywordStates(seconds=1.0), Handle()
    states.init(handle)
    list(states.handleInputRows((0,), iter([Row(keyword_id=k, micros=1000 * (k + t), event_id=k, ok=t == 5000, added=1.0) for k in range(500) for t in (0, 5000)]), Times(0)))
    out = [r for ms in (200, 200, 10**6) for r in states.handleExpiredTimer((0,), Times(ms), None)]
    assert sorted((r.at // 1000, r.keyword_id) for r in out if r.status == "failed") == [(k, k) for k in range(500)]
    assert sum(r.status == "completed" for r in out) == 500 and len(out) == 1500  # the retry is due at the same moment as the second result
    assert handle.value.calls + handle.list.calls + handle.timers <= 20
