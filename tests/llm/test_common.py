import time

from tidemark.llm import common


def test_a_workers_tables_go_when_it_is_idle(monkeypatch):
    monkeypatch.setattr(common, "IDLE_SECONDS", 0.2)
    built = []
    make = lambda d: built.append(d) or [d]
    first = common.per_worker("a", b"1", make)
    common.idle()
    assert common.per_worker("a", b"1", make) is first      # asked for again in time: kept
    time.sleep(0.5)
    assert common._PER_WORKER
    common.idle()
    time.sleep(0.5)
    assert not common._PER_WORKER
    common.per_worker("a", b"1", make)
    common.per_worker("b", b"2", make)                      # a worker keeps one
    assert built == [b"1", b"1", b"2"] and len(common._PER_WORKER) == 1
    common._PER_WORKER.clear()
