"""Numeric minimisation for the models that are fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


def minimise(function, at: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with a backtracking line search; ``function`` returns (value, gradient)."""
    value, slope = function(at)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, kept = -slope, []
        for s, y in reversed(moves):
            a = (s @ way) / (s @ y)
            kept.append(a)
            way = way - a * y
        if moves:
            s, y = moves[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), a in zip(moves, reversed(kept)):
            way = way + s * (a - (y @ way) / (s @ y))
        descent, size = slope @ way, 1.0 if moves else 1.0 / max(1.0, np.linalg.norm(slope))
        if descent > -1e-12:
            break
        while size > 1e-10:
            new = at + size * way
            new_value, new_slope = function(new)
            if new_value <= value + 1e-4 * size * descent:
                break
            size /= 2
        else:
            break
        step, change = new - at, new_slope - slope
        if step @ change > 1e-12:
            moves = [*moves, (step, change)][-memory:]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        at, value, slope = new, new_value, new_slope
        if done:
            break
    return at
