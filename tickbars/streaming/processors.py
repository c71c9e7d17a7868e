"""Keyed state for the bar stream (O-70 stream form, O-85).

The EMA needs the previous bar's EMA of the same (symbol, source): one
double of ``ValueState`` per key.  The processor sees bars, not trades:
at most one row per key and interval, so the per-row Python here is a
small helper on a bar-sized stream.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickbars.operators.replay import RUN_COLUMNS, is_gone

# Python workers (including the driver-side runner of transformWithState)
# need not have this package installed: the processors are pickled by
# value; they depend only on pandas and pyspark.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class EmaProcessor(StatefulProcessor):
    """ema = a*close + (1-a)*previous, seeded with the key's first close.

    Several windows of a key can close in one micro-batch, so the rows are
    ordered by window start before folding.  The state survives restarts
    through the query checkpoint.

    ``idle_ms``: a key without a bar for that long (event time, after its last
    window's start) is forgotten by a timer and starts again from its seed; by
    default keys are kept for good."""

    def __init__(self, period: int = 10, value: str = "close", order: str = "window_start_ms",
                 out: str = "ema10", idle_ms: int | None = None):
        self.alpha = 2.0 / (period + 1)
        self.value, self.order, self.out, self.idle_ms = value, order, out, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ema", "ema double")

    def _renew(self, last_ms: int) -> None:
        """One timer a key: idle_ms after its newest window."""
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(last_ms + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        prev = self.state.get()
        ema = None if prev is None else prev[0]
        out = []
        for x in pdf[self.value].tolist():
            ema = x if ema is None else self.alpha * x + (1 - self.alpha) * ema
            out.append(ema)
        self.state.update((ema,))
        if self.idle_ms is not None:
            self._renew(int(pdf[self.order].iloc[-1]))
        yield pdf.assign(**{self.out: out})

    def close(self) -> None:
        pass


class BookProcessor(StatefulProcessor):
    """Level-2 book per (source, symbol) in two MapStates (price -> qty).

    For each message, in (seq, sub) order: a snapshot clears both sides,
    then its levels apply in order; quantity 0 deletes unless
    ``keep_zero``.  A key's messages are handed on in runs of ``run`` with
    the book before each run (``RUN_SCHEMA``); ``replay_runs`` makes the
    published books of them, dealt out over all tasks, so a key's own task
    only carries the book along -- the stream form of operators/book.py.
    The state is written back only where a level changed (or cleared as a
    whole by a snapshot), so the changelog of a micro-batch is as long as
    its changes."""

    def __init__(self, run: int = 1024):
        self.run = run

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sides = {"bid": handle.getMapState("bids", "price double", "quantity double"),
                      "ask": handle.getMapState("asks", "price double", "quantity double")}

    @staticmethod
    def _columns(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        side, time = pdf["side"], pdf["timestamp_ms"]
        return {**{c: pdf[c].to_numpy() for c in ("seq", "sub", "lpos")},
                **{c: pdf[c].to_numpy(np.float64, na_value=np.nan) for c in ("price", "quantity")},
                "snapshot": (pdf["kind"] == "snapshot").to_numpy(bool), "is_bid": (side == "bid").to_numpy(bool),
                "level": side.notna().to_numpy(), "keep": (pdf["keep_zero"] == True).to_numpy(bool),  # noqa: E712
                "timed": time.notna().to_numpy(), "timestamp_ms": time.fillna(0).to_numpy(np.int64)}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [self._columns(pdf) for pdf in rows]
        col = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        del parts
        order = np.lexsort((col["lpos"], col["sub"], col["seq"]))
        col = {c: v[order] for c, v in col.items()}
        seq, sub = col["seq"], col["sub"]
        # rows of one (seq, sub) are a message
        first = np.flatnonzero(np.r_[True, (seq[1:] != seq[:-1]) | (sub[1:] != sub[:-1])])
        level = col["level"] & ~np.isnan(col["price"])
        before = np.r_[0, np.cumsum(level)][np.append(first, len(seq))]
        changes = {c: col[c][level] for c in ("is_bid", "price", "quantity", "keep")}
        heads = {c: col[c][first] for c in ("seq", "sub", "timestamp_ms", "snapshot")}
        if not col["timed"].all():
            heads["timestamp_ms"] = np.where(col["timed"][first], heads["timestamp_ms"].astype(object), None)
        book = {s: {k[0]: v[0] for k, v in st.iterator()} for s, st in self.sides.items()}
        changed: dict[str, set] = {"bid": set(), "ask": set()}
        cleared, out = False, []
        for a in range(0, len(first), self.run):
            b = min(a + self.run, len(first))
            at = slice(before[a], before[b])
            out.append((*key, *[heads[c][a:b] for c in ("seq", "sub", "timestamp_ms", "snapshot")],
                        np.diff(before[a:b + 1]).astype(np.int32), *[changes[c][at] for c in changes],
                        *[np.array(list(x), np.float64) for s in ("bid", "ask") for x in (book[s].keys(), book[s].values())]))
            snapshots = np.flatnonzero(heads["snapshot"][a:b])
            if len(snapshots):  # what came before the last one is gone
                cleared = True
                for s in book:
                    book[s].clear()
                    changed[s].clear()
                at = slice(before[a + snapshots[-1]], before[b])
            for is_bid, price, quantity, keep in zip(*[changes[c][at].tolist() for c in changes]):
                s = "bid" if is_bid else "ask"
                changed[s].add(price)
                if is_gone(quantity, keep):
                    book[s].pop(price, None)
                else:
                    book[s][price] = quantity
            if len(out) == RUNS:
                yield pd.DataFrame(out, columns=["source", "symbol", *RUN_COLUMNS])
                out = []
        for s, st in self.sides.items():
            if cleared:
                st.clear()
            for p in changed[s]:
                if p in book[s]:
                    st.updateValue((float(p),), (float(book[s][p]),))
                elif not cleared and st.containsKey((float(p),)):
                    st.removeKey((float(p),))
        if out:
            yield pd.DataFrame(out, columns=["source", "symbol", *RUN_COLUMNS])


#: Runs handed on at a time.
RUNS = 32
