"""Ordered replay of book messages (O-40, O-41, O-73): the small per-row helper
that the batch replay (operators/book.py, one call per key and chunk) and the
stream (streaming/processors.py, keyed state) share.

A side keeps its prices sorted beside a price -> quantity map, so a change costs
one binary search and the best levels are a slice.
"""

from __future__ import annotations

import sys
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle

# pickled by value: workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Side:
    """One side of a book; ``sign`` -1 sorts the highest price first (bids)."""

    def __init__(self, sign: int):
        self.sign, self.order, self.quantity = sign, [], {}
        self.shown: tuple[list[float], list[float]] | None = None

    def put(self, price: float, quantity: float) -> None:
        self.shown = None
        if price not in self.quantity:
            insort(self.order, self.sign * price)
        self.quantity[price] = quantity

    def load(self, items) -> None:
        """Fill an empty side from (price, quantity) pairs."""
        self.shown = None
        self.quantity = dict(items)
        self.order = sorted(self.sign * p for p in self.quantity)

    def remove(self, price: float) -> None:
        self.shown = None
        if self.quantity.pop(price, None) is not None:
            del self.order[bisect_left(self.order, self.sign * price)]

    def clear(self) -> None:
        self.shown = None
        self.order.clear()
        self.quantity.clear()

    def best(self, depth: int) -> tuple[list[float], list[float]]:
        """Prices and quantities of the best levels; kept until the side changes."""
        if self.shown is None:
            prices = [self.sign * p for p in self.order[:depth]]
            self.shown = prices, [self.quantity[p] for p in prices]
        return self.shown


def is_gone(quantity: float | None, keep_zero: bool) -> bool:
    """A level without a quantity, or with none left, is not in the book."""
    return quantity is None or quantity != quantity or (quantity == 0 and not keep_zero)


def new_book() -> dict[str, Side]:
    return {"bid": Side(-1), "ask": Side(1)}


def apply_level(book: dict[str, Side], side: str, price: float, quantity: float | None, keep_zero: bool) -> None:
    if is_gone(quantity, keep_zero):
        book[side].remove(price)
    else:
        book[side].put(price, quantity)


class Published:
    """Books after each message as parallel arrays, one row per message."""

    def __init__(self, depth: int):
        self.depth = depth
        self.heads: list[tuple] = []
        self.sizes: dict[str, list[int]] = {"bid": [0], "ask": [0]}
        self.levels: dict[str, array] = {c: array("d") for c in LEVEL_COLUMNS}

    def add(self, head: tuple, book: dict[str, Side]) -> None:
        self.heads.append(head)
        for side in ("bid", "ask"):
            prices, quantities = book[side].best(self.depth)
            self.sizes[side].append(len(prices))
            self.levels[f"{side}_price"].extend(prices)
            self.levels[f"{side}_quantity"].extend(quantities)

    def arrays(self) -> list[pa.Array]:
        """Heads (seq, sub, time) and the columns of levels."""
        heads = list(zip(*self.heads)) if self.heads else [(), (), ()]
        ends = {side: pa.array(list(accumulate(n)), pa.int32()) for side, n in self.sizes.items()}
        return [pa.array(list(h), pa.int64()) for h in heads] + [
            pa.ListArray.from_arrays(ends[c[:3]], pa.array(self.levels[c], pa.float64())) for c in LEVEL_COLUMNS]


LEVEL_COLUMNS = ("bid_price", "bid_quantity", "ask_price", "ask_quantity")


def replay_chunk(depth: int, keys: list[str]):
    """applyInArrow function: the rows of one (key, chunk) -- the levels alive at
    the chunk's start (``rank`` 0) and the chunk's own rows -- to one row per
    message with the best ``depth`` levels a side."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rank", "ascending"), ("lpos", "ascending")])
        book, out = new_book(), Published(depth)
        key = [table[k][0] for k in keys]
        col = {c: table[c].to_pylist() for c in ("rank", "header", "kind", "side", "price", "quantity", "keep_zero",
                                                 "seq", "sub", "timestamp_ms")}
        open_message = None
        for i, rank in enumerate(col["rank"]):
            if col["header"][i]:
                if open_message is not None:
                    out.add(open_message, book)
                open_message = (col["seq"][i], col["sub"][i], col["timestamp_ms"][i])
                if col["kind"][i] == "snapshot":
                    for side in book.values():
                        side.clear()
            elif col["price"][i] is not None and col["price"][i] == col["price"][i]:
                apply_level(book, col["side"][i], col["price"][i], col["quantity"][i],
                            rank == 0 or col["keep_zero"][i])
        if open_message is not None:
            out.add(open_message, book)
        arrays = [pa.array([k.as_py()] * len(out.heads), pa.string()) for k in key] + out.arrays()
        return pa.table(arrays, names=[*keys, "seq", "sub", "timestamp_ms", *LEVEL_COLUMNS])
    return run


#: A run of one key's messages as the stream hands it on (streaming/processors.py): per message its head, whether it
#: is a snapshot and its number of level changes; the changes in order; the book before the first message.
RUN_COLUMNS = ("seq", "sub", "timestamp_ms", "snapshot", "changes", "is_bid", "price", "quantity", "keep", *LEVEL_COLUMNS)
RUN_SCHEMA = ("source string, symbol string, seq array<long>, sub array<long>, timestamp_ms array<long>, "
              "snapshot array<boolean>, changes array<int>, is_bid array<boolean>, price array<double>, "
              "quantity array<double>, keep array<boolean>, " + ", ".join(f"{c} array<double>" for c in LEVEL_COLUMNS))


def replay_runs(depth: int, keys: list[str]):
    """mapInArrow function: runs of messages (``RUN_SCHEMA``) to one row per message with the best ``depth`` levels a
    side."""
    def replayed(run: dict) -> pa.RecordBatch:
        book, out = new_book(), Published(depth)
        for side in book:
            book[side].load(zip(run[f"{side}_price"], run[f"{side}_quantity"]))
        changes = zip(run["is_bid"], run["price"], run["quantity"], run["keep"])
        for head, snapshot, n in zip(zip(run["seq"], run["sub"], run["timestamp_ms"]), run["snapshot"], run["changes"]):
            if snapshot:
                for side in book.values():
                    side.clear()
            for _ in range(n):
                is_bid, price, quantity, keep = next(changes)
                apply_level(book, "bid" if is_bid else "ask", price, quantity, keep)
            out.add(head, book)
        arrays = [pa.array([run[k]] * len(out.heads), pa.string()) for k in keys] + out.arrays()
        return pa.RecordBatch.from_arrays(arrays, names=[*keys, "seq", "sub", "timestamp_ms", *LEVEL_COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield replayed(batch.slice(i, 1).to_pylist()[0])
    return run
