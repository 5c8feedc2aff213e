"""Plain files in the shared folder, opened by Python tasks through ``pyarrow.fs``."""

from __future__ import annotations

import uuid

from pyarrow import fs


def resolve(uri: str):
    """(file system, path) of a URI, or of a plain path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        fs.LocalFileSystem(), uri)


def make_folder(uri: str) -> None:
    system, path = resolve(uri)
    system.create_dir(path, recursive=True)


def open_out(uri: str):
    system, path = resolve(uri)
    return system.open_output_stream(path, compression=None)


def open_in(uri: str):
    system, path = resolve(uri)
    return system.open_input_file(path)


def write_whole(uri: str, data: bytes) -> None:
    """Appears complete or not at all; a repeated task writes the same again."""
    system, path = resolve(uri)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part, compression=None) as out:
        out.write(data)
    system.move(part, path)


def ranged_reads(spans, gap: int = 1 << 16, most: int = 8 << 20):
    """``(position of the span, bytes)`` for spans ``(uri, offset, length)`` sorted by file and offset.

    Neighbours no more than ``gap`` bytes apart come from one read of up to ``most`` bytes.
    """
    group: list[tuple[int, int, int]] = []
    uri = source = None

    def flush():
        low = group[0][1]
        data = source.read_at(max(o + n for _, o, n in group) - low, low)
        for i, o, n in group:
            yield i, data[o - low:o - low + n]

    high = 0
    for i, (file, offset, length) in enumerate(spans):
        if group and (file != uri or offset > high + gap or offset + length - group[0][1] > most):
            yield from flush()
            group = []
        if file != uri:
            if source is not None:
                source.close()
            uri, source, high = file, open_in(file), 0
        group.append((i, offset, length))
        high = max(high, offset + length) if len(group) > 1 else offset + length
    if group:
        yield from flush()
    if source is not None:
        source.close()
