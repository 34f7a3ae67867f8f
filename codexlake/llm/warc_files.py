"""Splits the bytes of WARC files into records."""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_type

_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.I)


def plain(data: bytes) -> bytes:
    """All gzip members one after the other, or the bytes as they are."""
    out = []
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        out.append(d.decompress(data) + d.flush())
        data = d.unused_data
    return b"".join(out) or data


def cut(data: bytes) -> list[dict]:
    found, at = [], 0
    data = plain(data)
    while data[at : at + 5] == b"WARC/":
        end = data.index(b"\r\n\r\n", at) + 4
        n = _LENGTH.search(data, at, end)
        stop = end + (int(n[1]) if n else 0)
        found.append({"header": data[at:end], "body": data[end:stop]})
        at = stop
        while data[at : at + 2] == b"\r\n":
            at += 2
    return found


@F.arrow_udf(T.ArrayType(row_type(header="binary", body="binary")))
def split_records(content: pa.Array) -> pa.Array:
    return pa.array([cut(x.as_py() or b"") for x in content], pa.list_(pa.struct([("header", pa.binary()), ("body", pa.binary())])))
