"""Forward-backward for chains of two labels, many chains laid end to end at once.

With two labels the forward and the backward vectors matter only by the ratio of their entries, and a step
maps one ratio to the next. Steps compose as 2 x 2 matrices, so the sequence is cut into blocks: the matrices
of all blocks are multiplied up side by side, a scan over the blocks gives the ratio each starts with, and
all blocks are replayed side by side. A chain's first step forgets what came before, so chains need no
padding and a chain may be of any length.
"""

from __future__ import annotations

import numpy as np

#: Emissions are held in this range, so products of RENORM steps stay finite.
CLIP = 30.0
RENORM = 8
BLOCK = 256


def _ratios(c00, c01, c10, c11) -> np.ndarray:
    """x[t] = (c01[t] + c11[t] x[t-1]) / (c00[t] + c10[t] x[t-1]) for all t, from x = 1 on; length a multiple of BLOCK."""
    shape = (-1, BLOCK)
    c00, c01, c10, c11 = (np.ascontiguousarray(c.reshape(shape).T) for c in (c00, c01, c10, c11))
    blocks = c00.shape[1]
    a, b, c, d = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(BLOCK):
        a, b, c, d = c00[t] * a + c10[t] * c, c00[t] * b + c10[t] * d, c01[t] * a + c11[t] * c, c01[t] * b + c11[t] * d
        if t % RENORM == RENORM - 1:
            scale = 1 / (a + b + c + d)
            a, b, c, d = a * scale, b * scale, c * scale, d * scale
    x, before = 1.0, np.empty(blocks)
    for k, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        before[k] = x
        x = (r + s * x) / (p + q * x)
    out = np.empty((BLOCK, blocks))
    for t in range(BLOCK):
        before = (c01[t] + c11[t] * before) / (c00[t] + c10[t] * before)
        out[t] = before
    return out.T.ravel()


def marginals(e: np.ndarray, first: np.ndarray, start: float, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 at each place, and the expected number of each pair of neighbouring labels.

    e: score of label 1 less that of label 0. first: where a chain begins. start, trans: scores of beginning
    with label 1, and of the pairs of labels [before, after].
    """
    n = len(e)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    room = -n % BLOCK
    weight = np.exp(np.clip(np.concatenate([e, np.zeros(room)]), -CLIP, CLIP))
    head = np.concatenate([first, np.ones(room, bool)])
    pair = np.exp(trans)
    first_odds = np.exp(start)
    ones = np.ones(len(head))
    forward = _ratios(
        np.where(head, 1.0, pair[0, 0]),
        np.where(head, first_odds, pair[0, 1]) * weight,
        np.where(head, 0.0, pair[1, 0]),
        np.where(head, 0.0, pair[1, 1] * weight),
    )[:n]
    # Backward, the step out of place t reads the weights of place t + 1; chains end with ratio 1.
    after = np.concatenate([weight[1:], ones[:1]])
    last = np.concatenate([head[1:], [True]])
    backward = _ratios(
        *(
            c[::-1]
            for c in (
                np.where(last, 1.0, pair[0, 0]),
                np.where(last, 1.0, pair[1, 0]),
                np.where(last, 0.0, pair[0, 1] * after),
                np.where(last, 0.0, pair[1, 1] * after),
            )
        )
    )[::-1][:n]
    odds = forward * backward
    inner = np.flatnonzero(~first)
    r, to = forward[inner - 1], weight[inner] * backward[inner]
    cells = np.stack([pair[0, 0] * np.ones(len(inner)), pair[0, 1] * to, r * pair[1, 0], r * pair[1, 1] * to])
    return odds / (1 + odds), (cells / cells.sum(axis=0)).sum(axis=1).reshape(2, 2)
