"""Epochs: which server's reign an event was written in.

Log positions order the events of one server. When another server takes over, its log files are numbered anew, so a
position needs the number of the reign before it. A reign, here an epoch, is known by its server, by the time of its first
event and by the set of global transaction ids (GTIDs) that had been executed before it began. An event with a GTID
belongs to the last epoch whose set does not contain it; one without, to the last epoch of its server that had begun
by then. So late events of an earlier server find their place, and a server may come back.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

Intervals = list[tuple[int, int]]


def parse_gtids(text: str | None) -> dict[str, Intervals]:
    """``source:1-5:7,other:3`` as merged intervals for each source; a tag is part of its source's name."""
    found: dict[str, Intervals] = {}
    for entry in (text or "").replace("\n", "").split(","):
        source, *parts = (p.strip() for p in entry.split(":"))
        name = source
        for part in parts:
            low, _, high = part.partition("-")
            if low.isdigit():
                found.setdefault(name, []).append((int(low), int(high or low)))
            else:
                name = f"{source}:{part}"
    return {name: merged(some) for name, some in found.items()}


def merged(intervals: Iterable[tuple[int, int]]) -> Intervals:
    """The same numbers in the fewest intervals."""
    out: Intervals = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def format_gtids(gtids: dict[str, Intervals]) -> str:
    parts = []
    for name in sorted(gtids):
        parts.append(":".join([name, *(f"{a}-{b}" if b > a else f"{a}" for a, b in gtids[name])]))
    return ",".join(parts)


def contains(outer: dict[str, Intervals], inner: dict[str, Intervals]) -> bool:
    """Whether all transactions of ``inner`` are in ``outer``."""
    return all(any(a <= low and high <= b for a, b in outer.get(name, ())) for name, some in inner.items() for low, high in some)


@dataclass(frozen=True)
class Epoch:
    """``executed`` is the GTID set from before the epoch; empty if it is not known."""

    server_id: int
    since_ms: int = 0
    executed: str = ""


@dataclass(frozen=True)
class Seen:
    """What a batch holds of one server and one source of GTIDs (none for events without)."""

    server_id: int | None
    source: str | None
    last_number: int | None
    first_ms: int
    last_ms: int


@dataclass
class Servers:
    """The epochs of a job and the transactions it has seen; bounded by the number of takeovers and of servers."""

    epochs: list[Epoch] = field(default_factory=list)
    executed: dict[str, Intervals] = field(default_factory=dict)

    @classmethod
    def load(cls, told: dict | None) -> Servers:
        told = told or {}
        return cls([Epoch(**e) for e in told.get("epochs", ())], parse_gtids(told.get("executed")))

    def saved(self) -> dict:
        return {"epochs": [asdict(e) for e in self.epochs], "executed": format_gtids(self.executed)}

    def observe(self, batch: Iterable[Seen]) -> None:
        """Take note of a batch. A repeat of it changes nothing."""
        for s in sorted(batch, key=lambda s: (s.first_ms, s.last_ms, s.server_id or 0)):
            if s.server_id and self._begins(s):
                since = max(s.first_ms, self.epochs[-1].since_ms + 1) if self.epochs else 0
                self.epochs.append(Epoch(s.server_id, since, format_gtids(self.executed)))
            if s.source and s.last_number is not None:
                known = self.executed.get(s.source, [])
                self.executed[s.source] = merged([*known, (1, s.last_number)])

    def _begins(self, s: Seen) -> bool:
        """Whether a server's events begin an epoch: it is new, or it is back with transactions nobody has seen."""
        if not self.epochs:
            return True
        last = self.epochs[-1]
        if s.server_id == last.server_id or s.last_ms < last.since_ms:
            return s.server_id not in {e.server_id for e in self.epochs}
        if s.source and s.last_number is not None:
            return not contains(self.executed, {s.source: [(s.last_number, s.last_number)]})
        return True


def gtid_source(gtid: Column | None = None) -> Column:
    gtid = F.col("gtid") if gtid is None else gtid
    return F.regexp_extract(gtid, r"^(.+):\d+$", 1)


def gtid_number(gtid: Column | None = None) -> Column:
    gtid = F.col("gtid") if gtid is None else gtid
    return F.substring_index(gtid, ":", -1).try_cast("bigint")


def _executed(gtids: dict[str, Intervals]) -> Column:
    source, number, test = gtid_source(), gtid_number(), F.lit(False)
    for name, some in gtids.items():
        inside = F.lit(False)
        for low, high in some:
            inside |= number.between(low, high)
        test |= (source == name) & inside
    return test


def epoch_of(epochs: list[Epoch]) -> Column:
    """The number of an event's epoch; NULL for a server that has none."""
    if len(epochs) < 2:
        return F.lit(0).cast("bigint")
    at, server = F.col("ts_ms"), F.coalesce(F.col("server_id"), F.lit(0))
    numbered = list(enumerate(epochs))
    # Snapshots have no server: they belong to the epoch of their time.
    by_time = F.when(F.lit(False), 0)
    by_server = F.when(F.lit(False), 0)
    for n, e in reversed(numbered):
        by_time = by_time.when(at >= e.since_ms, n)
        by_server = by_server.when((server == e.server_id) & (at >= e.since_ms), n)
    for n, e in numbered:
        by_server = by_server.when(server == e.server_id, n)
    epoch = F.when(server == 0, by_time.otherwise(0)).otherwise(by_server)
    if all(e.executed for e in epochs[1:]):
        by_gtid = F.when(F.lit(False), 0)
        for n, e in numbered[1:]:
            by_gtid = by_gtid.when(_executed(parse_gtids(e.executed)), n - 1)
        known = gtid_number().isNotNull() & (gtid_source() != "")
        epoch = F.when(known, by_gtid.otherwise(len(epochs) - 1)).otherwise(epoch)
    return epoch.cast("bigint")
