"""A plain-Python replay of snapshot and diff rules, for tests only."""

from decimal import Decimal


class Resync(Exception):
    pass


class Replay:
    """One symbol's book; `apply` follows the published synchronisation rules one diff at a time."""

    def __init__(self):
        self.sides = {"bid": {}, "ask": {}}
        self.last_id = None
        self.connected = False

    def load(self, snapshot_id, bids, asks):
        self.sides = {"bid": dict(bids), "ask": dict(asks)}
        self.last_id, self.connected = snapshot_id, False

    def apply(self, first, last, bids, asks):
        if last <= self.last_id:
            return False
        wanted = self.last_id + 1
        if (first != wanted) if self.connected else not (first <= wanted <= last):
            raise Resync
        self.connected, self.last_id = True, last
        for side, changes in (("bid", bids), ("ask", asks)):
            for price, qty in changes:
                if qty == "0.00000000":
                    self.sides[side].pop(price, None)
                else:
                    self.sides[side][price] = qty
        return True

    def top(self, side, n):
        return sorted(self.sides[side], key=Decimal, reverse=side == "bid")[:n]


def random_diffs(rng, count, prices=12, span=4, start=1):
    """Contiguous diffs (first, last, bids, asks) with deletions, empty sides and repeated prices."""
    diffs, next_id = [], start
    for _ in range(count):
        last = next_id + rng.randrange(span)

        def side(base):
            levels = []
            for _ in range(rng.randrange(4)):
                qty = "0.00000000" if rng.random() < 0.35 else f"{rng.randrange(1, 900) / 100:.8f}"
                levels.append([f"{base + rng.randrange(prices)}.00000000", qty])
            return levels

        diffs.append((next_id, last, side(80), side(100)))
        next_id = last + 1
    return diffs
