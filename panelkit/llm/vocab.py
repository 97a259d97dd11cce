"""Piece vocabularies from SentencePiece model files, read on the driver and sent to the tasks."""

from __future__ import annotations

import math
import os
import struct
from dataclasses import dataclass
from functools import cache

#: Folder of the public tokenizer files; the environment variable names another.
FOLDER = os.environ.get("PANELKIT_TOKENIZERS", "/opt/tokenizers")
PIECES = f"{FOLDER}/piece_bpe_32k.model"

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MARK = "▁"


@dataclass(frozen=True)
class Piece:
    text: str
    score: float
    kind: int


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> list[tuple[int, bytes | int]]:
    """Field numbers and raw values of one protocol-buffer message."""
    out: list[tuple[int, bytes | int]] = []
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if wire == 2 else (4 if wire == 5 else 8, at)
            value, at = data[at : at + size], at + size
        out.append((number, value))
    return out


@cache
def read_pieces(path: str = PIECES) -> tuple[Piece, ...]:
    """The pieces of a model file; a piece's id is its place."""
    out = []
    with open(path, "rb") as f:
        data = f.read()
    for number, value in fields(data):
        if number == 1:
            own = dict(fields(value))
            out.append(Piece(own[1].decode(), struct.unpack("<f", own.get(2, bytes(4)))[0], own.get(3, NORMAL)))
    return tuple(out)


@cache
def log_scores(path: str = PIECES) -> tuple[float, ...]:
    """A log score for each piece. A file of merges holds minus the merge's rank; by Zipf's law rank r gets a probability
    in proportion to 1 / (r + 2.7). Scores that are no ranks are log scores already."""
    pieces = read_pieces(path)
    normal = [p.score for p in pieces if p.kind == NORMAL]
    if min(normal) > -1000:
        return tuple(p.score for p in pieces)
    total = sum(1 / (2.7 - s) for s in normal)
    return tuple(-math.log((2.7 - p.score) * total) if p.kind == NORMAL else 0.0 for p in pieces)
