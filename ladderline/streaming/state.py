"""Keyed state of the streams: books by level, checks that a timer settles.

State lives in RocksDB through ``transformWithState``: a book is a map with one entry a level, of
which a batch writes the levels that changed; the states of the last window are a log of changes,
undone from the present where an observation asks for the past. So what a batch writes grows with
its messages, not with the depth of the books.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

Level = tuple[int, int]

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Map state and timers need this store; queries that start later on the session use it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class Stored:
    """A map state with the changes of one batch in front of it."""

    def __init__(self, state, loaded: bool):
        self.state = state
        self.now: dict = {tuple(k): tuple(v) for k, v in state.iterator()} if loaded else {}
        self._before = set(self.now)
        self._touched: set = set()

    def put(self, key: tuple, value: tuple) -> None:
        self.now[key] = value
        self._touched.add(key)

    def drop(self, key: tuple) -> None:
        if self.now.pop(key, None) is not None:
            self._touched.add(key)

    def save(self) -> None:
        for k in self._touched:
            if k in self.now:
                self.state.updateValue(k, self.now[k])
            elif k in self._before:
                self.state.removeKey(k)


class Ladder:
    """A two-sided book that snapshots replace and deltas change, with its best prices and totals.

    Keys are (0 for yes or 1 for no, price), values (quantity,)."""

    def __init__(self, levels: Stored, underflows: int = 0):
        self.levels, self.underflows = levels, underflows
        self._sum()

    def _sum(self) -> None:
        self.total, self.count, self.best = [0, 0], [0, 0], [None, None]
        for (s, p), (q,) in self.levels.now.items():
            self.total[s] += q
            self.count[s] += 1
            self.best[s] = p if self.best[s] is None else max(self.best[s], p)

    def get(self, key: Level) -> int | None:
        got = self.levels.now.get(key)
        return got and got[0]

    def snapshot(self, yes, no) -> dict[Level, int]:
        """Replace all levels; returns those before. Of a price that repeats the last counts."""
        old = {k: q for k, (q,) in self.levels.now.items()}
        for k in old:
            self.levels.drop(k)
        for s, side in ((0, yes), (1, no)):
            for lv in side or ():
                self.levels.put((s, int(lv["price"])), (int(lv["quantity"]),))
        self._sum()
        return old

    def delta(self, side: str, price: int, change: int) -> tuple[Level, int | None, int | None]:
        """Change a level; returns it with its quantity before and after (none: absent)."""
        key = (0 if side == "yes" else 1, price)
        before = self.get(key)
        left = (before or 0) + change
        self.underflows += left < 0
        self.set(key, left if left > 0 else None)
        return key, before, left if left > 0 else None

    def set(self, key: Level, quantity: int | None) -> None:
        s, before = key[0], self.get(key)
        self.total[s] += (quantity or 0) - (before or 0)
        self.count[s] += (quantity is not None) - (before is not None)
        if quantity is not None:
            self.levels.put(key, (quantity,))
            self.best[s] = key[1] if self.best[s] is None else max(self.best[s], key[1])
        else:
            self.levels.drop(key)
            if key[1] == self.best[s]:
                self.best[s] = max((p for t, p in self.levels.now if t == s), default=None)

    def side(self, s: int) -> tuple[int | None, int | None, int, int]:
        """Best price, its quantity, total quantity and number of levels of a side."""
        best = self.best[s]
        return best, None if best is None else self.get((s, best)), self.total[s], self.count[s]


def in_order(rows: Iterable[Row]) -> list[Row]:
    return sorted(rows, key=lambda r: (r["file"], r["line_no"]))


_LEVELS = ("levels", "side int, price bigint", "quantity bigint")


class BookTop(StatefulProcessor):
    """Best levels after every message; state: the ladder, messages and underflows so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels, self.head = handle.getMapState(*_LEVELS), handle.getValueState("head", "at bigint, underflows bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, under = self.head.get() if self.head.exists() else (0, 0)
        book = Ladder(Stored(self.levels, True), under)
        for r in in_order(rows):
            if r["kind"] == "snapshot":
                book.snapshot(r["yes"], r["no"])
            else:
                book.delta(r["side"], r["price_micro"], r["delta_centi"])
            (yb, ybs, yt, yl), (nb, nbs, nt, nl) = book.side(0), book.side(1)
            yield Row(
                ticker=key[0], event_idx=at, line_no=r["line_no"], recv_ts_us=r["recv_ts_us"], event_ts_us=r["event_ts_us"], seq=r["seq"], event=r["kind"],
                yb=yb, ybs=ybs, nb=nb, nbs=nbs, yt=yt, nt=nt, yl=yl, nl=nl, underflows=book.underflows,
            )
            at += 1
        book.levels.save()
        self.head.update((at, book.underflows))


class Pending:
    """An observation that waits: its levels, and in how many the book differs from them."""

    def __init__(self, idx: int, at: int, rest: dict[Level, int]):
        self.idx, self.at, self.rest = idx, at, rest
        #: Whether a timer stands for the end of its window.
        self.timed = True

    def against(self, ours: dict[Level, int]) -> int:
        return sum(ours.get(k) != self.rest.get(k) for k in ours.keys() | self.rest.keys())


class Checks(StatefulProcessor):
    """Verdicts on observations of a ticker's book (see ``replay.verify_stream``).

    State: the ladder; a log of the changes of one window; the levels of a waiting observation; and
    a head with the place and times of the last message, snapshot and gap, the bounds of the log,
    the waiting observation, and when the state is to go.
    """

    def __init__(self, window_us: int, idle_us: int):
        self.window_us, self.idle_us = window_us, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels, self.rest = handle.getMapState(*_LEVELS), handle.getMapState("rest", *_LEVELS[1:])
        # What a message undid: a level's quantity before it, or all levels before a snapshot.
        self.log = handle.getMapState("log", "idx bigint", "t bigint, side int, price bigint, quantity bigint, sides array<int>, prices array<bigint>, quantities array<bigint>")
        self.head = handle.getValueState("head", "idx bigint, t bigint, snap_t bigint, gap_t bigint, low bigint, wait_idx bigint, wait_at bigint, drop_ms bigint")

    def _load(self, key) -> None:
        self.ticker = key[0]
        self.idx, self.t, self.snap_t, self.gap_t, self.low, wait_idx, wait_at, self.drop_ms = self.head.get() if self.head.exists() else (None, None, None, None, 0, None, None, None)
        self.book = Ladder(Stored(self.levels, True))
        self.past = Stored(self.log, True)
        self.seen = Stored(self.rest, wait_at is not None)
        self.wait = None if wait_at is None else Pending(wait_idx, wait_at, {k: q for k, (q,) in self.seen.now.items()})
        self.n_diff = self.wait.against(self._ours()) if self.wait else 0

    def _ours(self) -> dict[Level, int]:
        return {k: q for k, (q,) in self.book.levels.now.items()}

    def _save(self) -> None:
        for s in (self.book.levels, self.past, self.seen):
            s.save()
        if self.t is not None:
            # One timer for all: the state goes when its ticker has been silent long enough.
            drop = (self.t + self.idle_us) // 1000 + 1
            if drop != self.drop_ms:
                if self.drop_ms is not None:
                    self.handle.deleteTimer(self.drop_ms)
                self.handle.registerTimer(drop)
                self.drop_ms = drop
        wait = (self.wait.idx, self.wait.at) if self.wait else (None, None)
        self.head.update((self.idx, self.t, self.snap_t, self.gap_t, self.low, *wait, self.drop_ms))

    def _closes_ms(self, at: int) -> int:
        """The first millisecond after an observation's window."""
        return (at + self.window_us) // 1000 + 1

    def _settle(self, outcome: str, lag: int | None = None, by: str = "record") -> Iterator[Row]:
        if self.wait is None:
            return
        w, self.wait = self.wait, None
        for k in list(self.seen.now):
            self.seen.drop(k)
        if by == "record" and w.timed:
            self.handle.deleteTimer(self._closes_ms(w.at))
        yield Row(ticker=self.ticker, event_idx=w.idx, recv_ts_us=w.at, outcome=outcome, match_lag_us=lag, settled_by=by)

    def _message(self, r: Row) -> Iterator[Row]:
        t = r["recv_ts_us"]
        self.idx = 0 if self.idx is None else self.idx + 1
        if r["kind"] == "snapshot":
            old = self.book.snapshot(r["yes"], r["no"])
            undo = (t, None, None, None, [s for s, _ in old], [p for _, p in old], list(old.values()))
            self.snap_t = t
            if self.wait:
                self.n_diff = self.wait.against(self._ours())
        else:
            k, before, after = self.book.delta(r["side"], r["price_micro"], r["delta_centi"])
            undo = (t, k[0], k[1], before, None, None, None)
            if self.wait:
                theirs = self.wait.rest.get(k)
                self.n_diff += (after != theirs) - (before != theirs)
        self.past.put((self.idx,), undo)
        self.t = t
        # States that ended a window ago are no observation's past any more.
        while self.low <= self.idx and self.past.now[(self.low,)][0] <= t - self.window_us:
            self.past.drop((self.low,))
            self.low += 1
        if self.wait:
            if t > self.wait.at + self.window_us:
                yield from self._settle("mismatch")
            elif self.n_diff == 0:
                yield from self._settle("matched", t - self.wait.at)

    def _before(self, at: int) -> int | None:
        """When, in the window before ``at``, the last state equal to the observation began."""
        ours, n_diff = self._ours(), self.n_diff
        for n in range(self.idx, max(self.low, 1) - 1, -1):
            t, s, p, q, sides, prices, quantities = self.past.now[(n,)]
            if t < at - self.window_us:
                return None
            if sides is not None:
                ours = dict(zip(zip(sides, prices, strict=True), quantities, strict=True))
                n_diff = self.wait.against(ours)
            else:
                theirs = self.wait.rest.get((s, p))
                n_diff += (q != theirs) - (ours.get((s, p)) != theirs)
                if q is None:
                    ours.pop((s, p), None)
                else:
                    ours[(s, p)] = q
            if n_diff == 0:
                return self._began(n - 1, at)
        return None

    def _began(self, n: int, at: int) -> int:
        """Receive time of message n, or the start of the window where that was before it."""
        got = self.past.now.get((n,))
        return at - self.window_us if got is None else max(got[0], at - self.window_us)

    def _observed(self, r: Row) -> Iterator[Row]:
        yield from self._settle("mismatch")
        if self.idx is None:
            return
        at = r["recv_ts_us"]
        rest = {(s, int(x["price"])): int(x["quantity"]) for s, side in ((0, r["yes"]), (1, r["no"])) for x in side or ()}
        self.wait = Pending(self.idx, at, rest)
        self.wait.timed = False
        self.n_diff = self.wait.against(self._ours())
        if self.gap_t is not None and (self.snap_t is None or self.gap_t > self.snap_t):
            yield from self._settle("skipped_gap")
        elif self.n_diff == 0:
            yield from self._settle("matched", 0)
        elif (began := self._before(at)) is not None:
            yield from self._settle("matched", began - at)
        else:
            for k, q in rest.items():
                self.seen.put(k, (q,))
            self.handle.registerTimer(self._closes_ms(at))
            self.wait.timed = True

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._load(key)
        for r in in_order(rows):
            if r["kind"] == "gap":
                self.gap_t = r["recv_ts_us"]
                yield from self._settle("skipped_gap")
            elif r["kind"] == "verify":
                yield from self._observed(r)
            else:
                yield from self._message(r)
        self._save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load(key)
        expired = expiredTimerInfo.getExpiryTimeInMs()
        if self.wait and self._closes_ms(self.wait.at) <= expired:
            yield from self._settle("mismatch", by="timer")
        if self.drop_ms is not None and expired >= self.drop_ms:
            for s in (self.levels, self.rest, self.log, self.head):
                s.clear()
            return
        self._save()


class AsOf(StatefulProcessor):
    """Trades with the book in force at their time (see ``replay.trade_book_stream``).

    State: books that a waiting trade may still need, trades that wait, and a count that names them.
    """

    def __init__(self, take: tuple[str, ...]):
        self.take = take

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.books = handle.getMapState("books", "ts bigint, o bigint", ", ".join(f"{c} bigint" for c in self.take))
        self.trades = handle.getMapState("trades", "ts bigint, n bigint", "row string")
        self.head = handle.getValueState("head", "n bigint, timer bigint")

    def _wake(self, n: int, timer: int | None, ts: int) -> None:
        """A timer after the earliest instant that trades wait for."""
        at = ts // 1000 + 1
        if timer is None or at < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
            timer = at
        self.head.update((n, timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, timer = self.head.get() if self.head.exists() else (0, None)
        least = None
        for r in rows:
            if r["row"] is None:
                self.books.updateValue((r["ts"], r["o"]), tuple(r[c] for c in self.take))
            else:
                self.trades.updateValue((r["ts"], n), (r["row"],))
                n += 1
            least = r["ts"] if least is None else min(least, r["ts"])
        self._wake(n, timer, least)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Time has passed the expiry: every record up to it is here."""
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        books = sorted((tuple(k), tuple(v)) for k, v in self.books.iterator())
        waiting = sorted((tuple(k), v[0]) for k, v in self.trades.iterator())
        i, later = 0, None
        for (ts, m), row in waiting:
            if ts >= now:
                later = ts
                break
            while i < len(books) and books[i][0][0] <= ts:
                i += 1
            found = books[i - 1] if i else ((None, None), (None,) * len(self.take))
            yield Row(ticker=key[0], ts=ts, row=row, **dict(zip(self.take, found[1], strict=True)))
            self.trades.removeKey((ts, m))
        # Of the books before now the last one is still in force.
        past = [k for k, _ in books if k[0] < now]
        for k in past[:-1]:
            self.books.removeKey(k)
        n, _ = self.head.get()
        self.head.update((n, None))
        if later is not None:
            self._wake(n, None, later)
        elif len(past) < len(books):
            self._wake(n, None, books[len(past)][0][0])
