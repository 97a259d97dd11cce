"""A linear-chain conditional random field over hashed token features, in numpy."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np

#: Letters and digits (and all beyond ASCII) run on; any other visible character stands alone.
TOKEN = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+|[^\sA-Za-z0-9\u0080-\U0010ffff]")
SLOTS = 1 << 13
FEATURES = 14


def _size(n: int) -> str:
    for top in (2, 4, 8, 15, 31):
        if n <= top:
            return str(top)
    return "32"


def shape(token: str) -> str:
    """Digits by their number, letters by case and size, mixtures by size and whether they are hexadecimal, signs as such."""
    n = len(token)
    if token.isascii() and token.isdigit():
        return f"9{n if n < 20 else 20}"
    if not token[0].isalnum():
        return token if ord(token[0]) < 128 else "sign"
    if any("0" <= c <= "9" for c in token):
        return ("hex" if not re.search("[^0-9a-fA-F]", token) else "mix") + _size(n)
    case = "a" if token.islower() else "A" if token.isupper() else "Aa"
    return case + _size(n)


def features(tokens: list[str], spaced: list[bool]) -> np.ndarray:
    """Slots of the features of each token: shapes and words around it, and white space before and after."""
    shapes = ["<", "<", *map(shape, tokens), ">", ">"]
    words = ["<", "<", *(t.lower()[:8] for t in tokens), ">", ">"]
    gaps = [*spaced, True]
    out = np.zeros((len(tokens), FEATURES), np.int16)
    for i in range(len(tokens)):
        a, b, c, d, e = shapes[i : i + 5]
        u, v, w, x, y = words[i : i + 5]
        names = (
            f"c{c}", f"b{b}", f"d{d}", f"a{a}", f"e{e}", f"bc{b}|{c}", f"cd{c}|{d}", f"bcd{b}|{c}|{d}",
            f"w{w}", f"v{v}", f"u{u}", f"x{x}", f"g{gaps[i]}{gaps[i + 1]}{c}", f"abc{a}|{b}|{c}",
        )
        out[i] = [zlib.crc32(n.encode()) % SLOTS for n in names]
    return out


def tokenize(text: str) -> tuple[list[str], list[tuple[int, int]], list[bool]]:
    """Tokens, their places, and whether white space (or the text's start) is in front."""
    found = list(TOKEN.finditer(text))
    places = [m.span() for m in found]
    spaced = [k == 0 or places[k - 1][1] < places[k][0] for k in range(len(found))]
    return [m.group() for m in found], places, spaced


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Features as one array; shorter sequences are filled with slot -1 (a row of zeros)."""
    longest = max(map(len, sequences))
    out = np.full((len(sequences), longest, FEATURES), -1, np.int16)
    for k, s in enumerate(sequences):
        out[k, : len(s)] = s
    return out, np.array([len(s) for s in sequences])


@dataclass
class Crf:
    labels: list[str]
    emit: np.ndarray  # slots + 1 x labels; the last row stays zero
    move: np.ndarray  # from x to

    def viterbi(self, sequences: list[np.ndarray], together: int = 2048, tokens: int = 1 << 20) -> list[np.ndarray]:
        """The best label path of each sequence; sequences of like length are decoded together.

        A group takes ``together`` sequences and ``tokens`` tokens with its filling at most; a longer sequence stands alone.
        """
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted((k for k in range(len(sequences)) if len(sequences[k])), key=lambda k: len(sequences[k]))
        ends = [0]
        for k in range(1, len(order) + 1):
            if k == len(order) or k - ends[-1] == together or (k + 1 - ends[-1]) * len(sequences[order[k]]) > tokens:
                ends.append(k)
        for at, end in zip(ends[:-1], ends[1:], strict=True):
            group = order[at:end]
            slots, lengths = _padded([sequences[k] for k in group])
            n, steps = slots.shape[:2]
            score = self.emit[slots[:, 0]].sum(axis=1)
            back = np.zeros((steps, n, len(self.labels)), np.int8)
            for t in range(1, steps):
                ways = score[:, :, None] + self.move
                back[t] = ways.argmax(axis=1)
                moved = ways.max(axis=1) + self.emit[slots[:, t]].sum(axis=1)
                score = np.where((t < lengths)[:, None], moved, score)
            last = score.argmax(axis=1)
            path = np.zeros((n, steps), np.int8)
            for t in range(steps - 1, -1, -1):
                path[:, t] = last
                if t:
                    last = np.where(t < lengths, back[t][np.arange(n), last], last)
            for row, k in enumerate(group):
                out[k] = path[row, : lengths[row]]
        return out


def fit(sequences: list[np.ndarray], targets: list[np.ndarray], labels: list[str], *, rounds: int = 80, decay: float = 1e-3) -> Crf:
    """Maximise the conditional likelihood by Adam steps over all rows; deterministic."""
    slots, lengths = _padded(sequences)
    n, steps = slots.shape[:2]
    m = len(labels)
    y = np.zeros((n, steps), np.int64)
    for k, t in enumerate(targets):
        y[k, : len(t)] = t
    real = np.arange(steps) < lengths[:, None]
    params = [np.zeros((SLOTS + 1, m)), np.zeros((m, m))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rows = np.arange(n)
    for step in range(1, rounds + 1):
        emit, move = params
        scores = emit[slots].sum(axis=2)
        ahead = np.zeros((n, steps, m))
        ahead[:, 0] = scores[:, 0]
        for t in range(1, steps):
            x = _logsum(ahead[:, t - 1][:, :, None] + move, 1) + scores[:, t]
            ahead[:, t] = np.where(real[:, t, None], x, ahead[:, t - 1])
        total = _logsum(ahead[:, -1], 1)
        behind = np.zeros((n, steps, m))
        for t in range(steps - 2, -1, -1):
            x = _logsum(move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], x, 0)
        grad_emit, grad_move = np.zeros_like(emit), np.zeros_like(move)
        for t in range(steps):
            p = np.exp(ahead[:, t] + behind[:, t] - total[:, None]) * real[:, t, None]
            p[rows, y[:, t]] -= real[:, t]
            np.add.at(grad_emit, slots[:, t].ravel(), np.repeat(p, FEATURES, axis=0))
            if t:
                pair = ahead[:, t - 1][:, :, None] + move + (scores[:, t] + behind[:, t])[:, None, :] - total[:, None, None]
                grad_move += (np.exp(pair) * real[:, t, None, None]).sum(axis=0)
                np.add.at(grad_move, (y[:, t - 1], y[:, t]), -real[:, t].astype(float))
        for k, g in enumerate((grad_emit, grad_move)):
            g = g / n + decay * params[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] = params[k] - 0.1 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        params[0][-1] = 0
    return Crf(labels, *params)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))
