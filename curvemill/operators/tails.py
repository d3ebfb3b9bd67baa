"""The late part of curves: drift, and the frames where a Patlak plot is straight. NumPy on one input curve, or rows of curves."""

from __future__ import annotations

import numpy as np

from curvemill.operators.filters import zero_phase_matrix

DETREND = ("none", "aif", "self", "auto", "rigid", "rigid-auto")
#: Decay rates (1/s) at which an exponential counts as washout; beyond them the tail's line is the drift.
WASHOUT = (3e-3, 5e-2)
TAILS = ("curvature", "x_max_fraction", "peak_decay", "smart", "changepoint", "fixed")


def _tail_start(n: int, share: float) -> int:
    return int((1.0 - share) * n)


def tail_slopes(values: np.ndarray, t: np.ndarray, share: float) -> np.ndarray:
    """Slope of the least-squares line through the last ``share`` of each row; 0 with fewer than 3 frames there."""
    i0 = _tail_start(len(t), share)
    if i0 >= len(t) - 2:
        return np.zeros(len(values))
    dt = t[i0:] - t[i0:].mean()
    tail = values[:, i0:]
    return (tail - tail.mean(1, keepdims=True)) @ dt / (dt @ dt)


def rigid_slope(c_a: np.ndarray, t: np.ndarray, share: float, nodes: int = 400) -> float:
    """Drift beside washout: the linear term of a exp(-k t) + b + c t on the tail, the best decay k of a grid.

    The three linear terms are solved at every k; a decay outside WASHOUT (or a rise) leaves the tail's plain slope.
    """
    i0 = _tail_start(len(t), share)
    if i0 >= len(t) - 5:
        return 0.0
    x, y = t[i0:] - t[i0], c_a[i0:]
    rates = np.geomspace(1e-6, 2.0, nodes)
    design = np.stack([np.exp(-rates[:, None] * x), np.ones((nodes, len(x))), np.broadcast_to(x, (nodes, len(x)))], axis=2)
    coef = np.linalg.pinv(design) @ y
    sse = ((np.einsum("gti,gi->gt", design, coef) - y) ** 2).sum(1)
    sse[coef[:, 0] < 0] = np.inf
    best = int(np.argmin(sse))
    if not np.isfinite(sse[best]) or not WASHOUT[0] <= rates[best] <= WASHOUT[1]:
        return float(tail_slopes(c_a[None, :], t, share)[0])
    return float(coef[best, 2])


def drift_slope(c_a: np.ndarray, t: np.ndarray, mode: str, share: float = 0.30, threshold: float = 5e-4) -> tuple[float, bool]:
    """The slope to take from the input curve, and whether curves lose their own slope instead of that one."""
    if mode not in DETREND:
        raise ValueError(f"detrend must be one of {DETREND}")
    if mode == "none" or len(t) < 10 or not 0.05 < share < 0.80 or _tail_start(len(t), share) >= len(t) - 2:
        return 0.0, False
    slope = rigid_slope(c_a, t, share) if mode.startswith("rigid") else float(tail_slopes(c_a[None, :], t, share)[0])
    late = float(np.mean(c_a[_tail_start(len(t), share) :]))
    if mode in ("auto", "rigid-auto") and abs(slope / late if abs(late) > 1e-12 else 0.0) < threshold:
        slope = 0.0
    return slope, mode == "self"


def smooth(y: np.ndarray, cutoff: float = 4.0) -> np.ndarray:
    return zero_phase_matrix(len(y), cutoff=cutoff) @ y if len(y) > 1 else y


def prominent_peaks(y: np.ndarray, *, prominence: float, distance: int) -> np.ndarray:
    """Frames of local maxima (middles of flat ones), the higher ones first to claim ``distance`` frames, that stand out by ``prominence``."""
    at = []
    i = 1
    while i < len(y) - 1:
        if y[i] > y[i - 1]:
            j = i
            while j + 1 < len(y) and y[j + 1] == y[i]:
                j += 1
            if j + 1 < len(y) and y[j + 1] < y[i]:
                at.append((i + j) // 2)
            i = j + 1
        else:
            i += 1
    kept: list[int] = []
    for p in sorted(at, key=lambda p: (-y[p], -p)):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)

    def stands_out(p: int) -> float:
        higher = np.flatnonzero(y > y[p])
        left, right = higher[higher < p], higher[higher > p]
        a, b = (left[-1] + 1 if len(left) else 0), (right[0] if len(right) else len(y))
        return y[p] - max(y[a : p + 1].min(), y[p:b].min())

    return np.array(sorted(p for p in kept if stands_out(p) >= prominence), int)


def tail_frames(
    c_a: np.ndarray, t: np.ndarray, mode: str = "curvature", *, least: float = 0.20, curved: float = 0.05, buffer: int = 3, fraction: float = 1 / 3, baseline: int = 5,
    decay: float = 0.5, prominence: float = 0.10, distance: int = 10,
) -> tuple[int, int]:
    """The frames [start, stop) of an input curve's late part.

    curvature: after the last frame whose smoothed second difference exceeds a share of the largest, and a buffer;
    x_max_fraction: from the first frame where the Patlak time reaches a fraction of its maximum; peak_decay or smart: from where
    the last prominent peak has fallen by half; changepoint: after the last lively frame of the log curve; fixed: a third.
    """
    if mode not in TAILS:
        raise ValueError(f"tail must be one of {TAILS}")
    n = len(c_a)
    last_start = n - max(1, int(least * n))
    if n < 10:
        return 0, n
    if mode == "fixed":
        return round(fraction * n), n
    if mode == "x_max_fraction":
        with np.errstate(all="ignore"):
            x = np.concatenate([[0.0], np.cumsum(c_a[:-1] * np.diff(t))]) / c_a
        ok = np.isfinite(x) & (c_a > 0)
        top = x[ok].max() if ok.any() else -1.0
        inside = np.flatnonzero(ok & (x >= fraction * top)) if top > 0 else []
        return (int(inside[0]) if len(inside) else n // 2), n
    y = smooth(c_a)
    if mode == "curvature":
        bend = np.convolve(np.abs(np.gradient(np.gradient(y))), np.ones(5) / 5, mode="same")
        if not bend.max() > 0:
            return n // 2, n
        return int(min(np.flatnonzero(bend > curved * bend.max())[-1] + buffer, last_start)), n
    if mode == "changepoint":
        lively = smooth(np.abs(np.gradient(np.log(np.maximum(np.abs(y), 1e-6)))), cutoff=2.0)
        above = np.flatnonzero(lively > np.median(lively) + 0.5 * lively.std())
        return (int(min(above[-1] + 1, last_start)) if len(above) else int((1 - least) * n)), n
    base = y[:baseline].mean()
    peaks = prominent_peaks(y, prominence=prominence * (y.max() - base), distance=distance) if y.max() > base else []
    if not len(peaks):
        return 0, n
    fallen = np.flatnonzero(y[peaks[-1] + 1 :] <= base + decay * (y[peaks[-1]] - base))
    return int(min(peaks[-1] + 1 + fallen[0] if len(fallen) else peaks[-1], last_start)), n
