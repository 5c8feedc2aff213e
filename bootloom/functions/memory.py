"""What Python workers keep: they stay after a task, and with them what their allocators hold on to."""

from __future__ import annotations

import ctypes
import queue
import threading
from collections.abc import Iterable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Hand freed memory to the system, where the C library can; Arrow's from now on goes there when it is freed."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def read_ahead(batches: Iterable, most: int) -> Iterator:
    """The batches in their order, up to ``most`` of them read by a thread while the caller works on others."""
    held, stopped = queue.Queue(most), threading.Event()

    def put(item) -> None:
        while not stopped.is_set():
            try:
                return held.put(item, timeout=1)
            except queue.Full:
                pass

    def read() -> None:
        try:
            for batch in batches:
                put((batch, None))
                if stopped.is_set():
                    return
            put((None, None))
        except BaseException as error:  # the caller's to see
            put((None, error))

    threading.Thread(target=read, daemon=True).start()
    try:
        while True:
            batch, error = held.get()
            if error is not None:
                raise error
            if batch is None:
                return
            yield batch
    finally:
        stopped.set()
