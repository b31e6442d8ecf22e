"""ONNX models for onnxruntime: the few fields of the format that a small network needs."""

from __future__ import annotations

import numpy as np

FLOAT, INT32 = 1, 6  # element types


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def message(*fields: tuple[int, int | str | bytes]) -> bytes:
    """A protobuf message of fields by number."""
    out = []
    for number, value in fields:
        if isinstance(value, int):
            out.append(varint(number << 3) + varint(value))
        else:
            data = value.encode() if isinstance(value, str) else value
            out.append(varint(number << 3 | 2) + varint(len(data)) + data)
    return b"".join(out)


def value(name: str, kind: int, *dims: int | str) -> bytes:
    """A graph's input or output; a dimension by name may have any size."""
    shape = message(*[(1, message((2 if isinstance(d, str) else 1, d))) for d in dims])
    return message((1, name), (2, message((1, message((1, kind), (2, shape))))))


def node(operator: str, inputs: str, outputs: str, **attributes: int | bytes) -> bytes:
    """One step; names are separated by spaces, a graph is the value of an attribute in bytes."""
    told = [message((1, name), (6, v), (20, 5)) if isinstance(v, bytes) else message((1, name), (3, v), (20, 2)) for name, v in attributes.items()]
    return message(*[(1, n) for n in inputs.split()], *[(2, n) for n in outputs.split()], (4, operator), *[(5, a) for a in told])


def graph(nodes: list[bytes], inputs: list[bytes], outputs: list[bytes], constants: dict[str, np.ndarray] | None = None) -> bytes:
    fixed = []
    for name, array in (constants or {}).items():
        fixed.append(message(*[(1, d) for d in array.shape], (2, FLOAT), (8, name), (9, np.ascontiguousarray(array, "<f4").tobytes())))
    return message(*[(1, n) for n in nodes], (2, "graph"), *[(5, c) for c in fixed], *[(11, i) for i in inputs], *[(12, o) for o in outputs])


def model(whole: bytes) -> bytes:
    """Format 8, operators 13."""
    return message((1, 8), (7, whole), (8, message((1, ""), (2, 13))))
