"""Writes a tiny ONNX classifier: logits = sum over tokens of weights[token] * attention_mask."""

import numpy as np


def _varint(n):
    out = bytearray()
    while True:
        n, low = n >> 7, n & 0x7F
        out.append(low | (0x80 if n else 0))
        if not n:
            return bytes(out)


def _number(field, value):
    return _varint(field << 3) + _varint(value)


def _bytes(field, value):
    value = value.encode() if isinstance(value, str) else value
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _attribute(name, value):
    if isinstance(value, list):
        return _bytes(5, _bytes(1, name) + b"".join(_number(8, v) for v in value) + _number(20, 7))
    return _bytes(5, _bytes(1, name) + _number(3, value) + _number(20, 2))


def _node(op, inputs, output, **attributes):
    body = b"".join(_bytes(1, i) for i in inputs) + _bytes(2, output) + _bytes(4, op)
    return _bytes(1, body + b"".join(_attribute(k, v) for k, v in attributes.items()))


def _value(field, name, kind, dims):
    shape = b"".join(_bytes(1, _bytes(2, d) if isinstance(d, str) else _number(1, d)) for d in dims)
    tensor = _number(1, kind) + _bytes(2, shape)
    return _bytes(field, _bytes(1, name) + _bytes(2, _bytes(1, tensor)))


FLOAT, INT64 = 1, 7


def write_classifier(path, weights):
    weights = np.asarray(weights, dtype=np.float32)
    tensor = b"".join(_number(1, d) for d in weights.shape) + _number(2, FLOAT) + _bytes(8, "weights")
    graph = (
        _node("Gather", ["weights", "input_ids"], "looked_up", axis=0)
        + _node("Cast", ["attention_mask"], "mask", to=FLOAT)
        + _node("Unsqueeze", ["mask"], "wide_mask", axes=[2])
        + _node("Mul", ["looked_up", "wide_mask"], "masked")
        + _node("ReduceSum", ["masked"], "logits", axes=[1], keepdims=0)
        + _bytes(2, "classifier")
        + _bytes(5, tensor + _bytes(9, weights.tobytes()))
        + _value(11, "input_ids", INT64, ["n", "l"])
        + _value(11, "attention_mask", INT64, ["n", "l"])
        + _value(12, "logits", FLOAT, ["n", weights.shape[1]])
    )
    with open(path, "wb") as file:
        file.write(_number(1, 7) + _bytes(7, graph) + _bytes(8, _bytes(1, "") + _number(2, 11)))
