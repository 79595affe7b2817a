"""The library's code goes to the executors once, also when fits in threads ask for it at the same time."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from ledgerline import session


def test_threads_send_one_archive(monkeypatch):
    sent = []

    def add(path):
        time.sleep(0.2)
        sent.append(path)

    fake = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="of this test", addPyFile=add))
    monkeypatch.setattr(session, "_sent", set())
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: session.send_library(fake), range(4)))
    assert len(sent) == 1
