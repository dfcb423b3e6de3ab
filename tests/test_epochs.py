"""Order across servers that take over from one another."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_ranges import PETS, event, pet, pets, sync

from tablesync.operators.keyed_table import KeyedTable
from tablesync.sources import epochs
from tablesync.sources.epochs import Epoch, Seen, Servers


def numbers(some):
    return {n for a, b in some for n in range(a, b + 1)}


def test_gtid_sets():
    text = "u1:1-5:7:6,\nu2:tag:3-4, u1:9-9"
    parsed = epochs.parse_gtids(text)
    assert parsed == {"u1": [(1, 7), (9, 9)], "u2:tag": [(3, 4)]}
    assert epochs.format_gtids(parsed) == "u1:1-7:9,u2:tag:3-4"
    assert epochs.parse_gtids(None) == {} and epochs.format_gtids({}) == ""
    assert epochs.contains(parsed, {"u1": [(2, 6)]}) and not epochs.contains(parsed, {"u1": [(7, 9)]})
    assert not epochs.contains(parsed, {"u3": [(1, 1)]}) and epochs.contains(parsed, {})


spans = st.lists(st.tuples(st.integers(1, 30), st.integers(0, 6)).map(lambda x: (x[0], x[0] + x[1])), max_size=6)


@settings(deadline=None)
@given(spans, spans)
def test_intervals_are_sets(a, b):
    one, two = epochs.merged(a), epochs.merged(b)
    assert numbers(one) == numbers(a) and all(y > x + 1 for (_, x), (y, _) in zip(one, one[1:]))
    assert epochs.parse_gtids(epochs.format_gtids({"u": one} if one else {})) == ({"u": one} if one else {})
    assert epochs.contains({"u": one}, {"u": two}) == (numbers(two) <= numbers(one))


def test_servers_take_note():
    servers = Servers()
    first = [Seen(1, "a", 900, 10, 20)]
    servers.observe(first)
    assert servers.epochs == [Epoch(1)] and servers.executed == {"a": [(1, 900)]}
    takeover = [Seen(2, "b", 50, 30, 40), Seen(1, "a", 905, 18, 25), Seen(0, None, None, 5, 50), Seen(None, None, None, 5, 50)]
    for _ in range(2):
        servers.observe(takeover)
        assert servers.epochs == [Epoch(1), Epoch(2, 30, "a:1-905")]
    # Late events of the first server, then its return with transactions nobody has seen.
    servers.observe([Seen(1, "a", 800, 12, 14)])
    servers.observe([Seen(1, "a", 700, 12, 44)])
    assert len(servers.epochs) == 2
    servers.observe([Seen(1, "a", 950, 45, 50)])
    assert servers.epochs[2] == Epoch(1, 45, "a:1-905,b:1-50")
    assert Servers.load(servers.saved()) == servers and Servers.load(None) == Servers()


def placed(spark, some, *events):
    rows = spark.createDataFrame(list(events), "server_id long, gtid string, ts_ms long")
    return [r.e for r in rows.select(epochs.epoch_of(some).alias("e")).collect()]


def test_epoch_of_an_event(spark):
    some = [Epoch(1), Epoch(2, 30, "a:1-900"), Epoch(1, 60, "a:1-900,b:1-50")]
    by_gtid = [(1, "a:100", 99), (1, "a:901", 1), (2, "b:50", 99), (2, "b:51", 1), (9, "c:1", 1)]
    assert placed(spark, some, *by_gtid) == [0, 2, 1, 2, 2]
    by_time = [(1, None, 10), (1, None, 60), (2, None, 10), (2, None, 99), (0, None, 10), (0, None, 45), (None, None, 70), (9, None, 1)]
    assert placed(spark, some, *by_time) == [0, 2, 1, 1, 0, 1, 2, None]
    assert placed(spark, some[:1], (5, None, 1)) == [0] and placed(spark, [], (5, "a:1", 1)) == [0]
    # A set that is not known: times decide.
    assert placed(spark, [Epoch(1), Epoch(2, 30)], (1, "a:100", 99), (2, "b:1", 40)) == [0, 1]


@pytest.mark.parametrize("one_batch", [True, False])
@pytest.mark.parametrize("gtids", [True, False])
def test_failover_to_a_server_with_lower_file_numbers(spark, tmp_path, one_batch, gtids):
    def g(name):
        return name if gtids else None

    old = [event("c", 10, pet(1, "old"), 1, 900, g("a:7")), event("c", 11, pet(2, "kept"), 1, 900, g("a:8"))]
    new = [event("u", 5, pet(1, "new"), 2, 3, g("b:1"), 20), event("d", 6, "null", 2, 3, g("b:2"), 21, before=pet(2, "kept"))]
    back = [event("c", 1, pet(2, "back"), 1, 901, g("a:9"), 30), event("u", 9, pet(1, "late"), 1, 900, g("a:6"), 9)]
    batches = [[*new, *old, *back]] if one_batch and not gtids else [old, new, back]
    if one_batch and gtids:
        batches = [[*new, *old], back]
    for i, lines in enumerate(batches):
        for _ in range(2):
            sync(spark, tmp_path, i, *lines)
    if len(batches) == 1:
        # One batch with both reigns of a server and no transaction ids shows one of them.
        assert (1, "new") in pets(spark, tmp_path)
        return
    assert pets(spark, tmp_path) == [(1, "new"), (2, "back")]
    state = KeyedTable.of(spark, str(tmp_path), PETS).state()
    assert state.last_seq["epoch"] == 2
    assert [e["server_id"] for e in state.last_by_label["job"]["notes"]["epochs"]] == [1, 2, 1]


def test_epochs_given_by_hand(spark, tmp_path):
    known = (Epoch(2), Epoch(1, 100))
    sync(spark, tmp_path, 0, event("c", 10, pet(1, "second"), 1, 1, ts=200), event("c", 900, pet(1, "first"), 2, 9, ts=50), epochs=known)
    rows = sync(spark, tmp_path, 1, event("c", 1, pet(2, "whose"), 7, 1), epochs=known)
    assert pets(spark, tmp_path) == [(1, "second")] and rows[0].quarantined == 1
